"""Filters, projections and whole-table text steps, DataFrame -> DataFrame."""

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, StructType

from sonoloom import fixed_values as V
from sonoloom.functions import audio, payload, text as tx
from sonoloom.schema import AUDIO_CELL, TARGET


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose attribute equals `value`; None matches NULL. Reaches the scan as a filter. [F1]"""
    return df.filter(F.col(column).eqNullSafe(F.lit(value)))


def where_split(df: DataFrame, split: str, column: str = "split") -> DataFrame:
    """Rows of one split; on a stored corpus this prunes directories. [F4]"""
    return df.filter(F.col(column) == split)


def drop_empty_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Rows that have a text; NULL counts as empty. For a stored column. [F2]"""
    return df.filter(F.length(column) > 0)


def if_not_empty(text: Column) -> Column:
    """Select item that computes a text (never NULL) and drops the row where it is ''. [F2]

    A filter on a computed column is pushed below the projection, which then evaluates the
    whole text chain twice, Python step included. One generator does both in one pass.
    """
    return F.explode(F.array_remove(F.array(text), ""))


def drop_digit_only(df: DataFrame, column: str = "text") -> DataFrame:
    """Rows that have a text other than digits and spaces. [F3]"""
    return df.filter((F.length(column) > 0) & tx.keeps_non_digits(F.col(column)))


def add_metadata(df: DataFrame, **values: str | Column) -> DataFrame:
    """Constant columns, as corpus='x', split='train', language='de'. [P1]"""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()}
    )


def conform(df: DataFrame, schema: StructType = TARGET) -> DataFrame:
    """Exactly the columns of the schema, in its order and with its types. [P2, P3]"""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def lookup(df: DataFrame, key: str, value, column: str) -> DataFrame:
    """One column of the row with the given key; an unknown column is an error. [P5]"""
    return df.filter(F.col(key) == F.lit(value)).select(key, column)


def normalise_table(
    df: DataFrame, text_column: str = "text", language_column: str = "language", **options
) -> DataFrame:
    """Normalise a text column in place, each row in its own language; dropped texts become ''. [T8]"""
    language = F.col(language_column) if language_column in df.columns else V.DEFAULT_LANGUAGE
    return df.withColumn(text_column, tx.normalise_or_empty(F.col(text_column), language, **options))


def clean_table(df: DataFrame, text_column: str = "transcript") -> DataFrame:
    """Clean a transcript column in place. [T11]"""
    return df.withColumn(text_column, tx.clean_transcript(F.col(text_column)))


def audio_cell(df: DataFrame, column: str) -> Column:
    """An audio column of any form as an audio cell; fields that it lacks are NULL. [A1]

    The column may be a struct with some of the fields, encoded bytes, bare samples, or
    bare frames of several channels. Frames are mixed down.
    """
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, BinaryType):
        given = {"bytes": value}
    elif isinstance(kind, ArrayType):
        given = {"array": value}
    else:
        given = {name: value[name] for name in kind.names}
    if "array" in given:
        samples = df.select(given["array"]).schema[0].dataType
        if isinstance(samples.elementType, ArrayType):
            given["array"] = audio.downmix(given["array"].cast("array<array<float>>"))
    return F.struct(
        *(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIO_CELL.fields)
    )


def process_audio(
    df: DataFrame, column: str = "audio", target: int = V.TARGET_RATE, root: str | None = None
) -> DataFrame:
    """Add audio_bytes and audio_size for an audio cell column; relative paths are below `root`. [A11]"""
    processed = payload.process(audio_cell(df, column), target, root)
    data, size = audio.or_empty_audio(processed["audio_bytes"], processed["audio_size"])
    return df.withColumns({"audio_bytes": data, "audio_size": size})


def cast_audio_rate(df: DataFrame, column: str = "audio", target: int = V.TARGET_RATE) -> DataFrame:
    """Bring an audio column of any form to mono samples of one rate; cells without samples stay. [A12]"""
    return df.withColumn(column, payload.at_one_rate(audio_cell(df, column), target))


def _weights(frame: pd.DataFrame) -> np.ndarray:
    """Bytes of each row: the length of texts, bytes and lists, 8 for anything else."""
    total = np.zeros(len(frame), np.int64)
    for name in frame:
        column = frame[name]
        if column.dtype == object:
            total += np.fromiter((len(v) if hasattr(v, "__len__") else 8 for v in column), np.int64, len(column))
        else:
            total += 8
    return total


def _regrouped(frames: Iterator[pd.DataFrame], rows: int, size: int) -> Iterator[pd.DataFrame]:
    """The same rows in batches of `rows`, or of as many as weigh `size` if that is fewer; the last one may be short."""
    parts, count, weight = [], 0, 0
    for frame in frames:
        weights, start = _weights(frame), 0
        for at, w in enumerate(weights.tolist()):
            if count + at - start and (count + at - start == rows or weight + w > size):
                yield pd.concat([*parts, frame.iloc[start:at]], ignore_index=True)
                parts, count, weight, start = [], 0, 0, at
            weight += w
        parts.append(frame.iloc[start:])
        count += len(frame) - start
    if count:
        yield pd.concat(parts, ignore_index=True)


def map_batches(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    batch_rows: int = V.BATCH_ROWS,
    batch_bytes: int = 1 << 26,
) -> DataFrame:
    """A user function over batches of exactly `batch_rows` rows; select the columns it needs beforehand. [X1]

    The last batch of a partition may be shorter, and one whose rows weigh more than `batch_bytes` ends before;
    a heavier row is a batch of its own. How Spark cuts its Arrow batches makes no difference.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        return map(function, _regrouped(batches, batch_rows, batch_bytes))

    return df.mapInPandas(run, schema)


def filter_batches(
    df: DataFrame, predicate: Callable[..., pd.Series], columns: Iterable[str]
) -> DataFrame:
    """Keep the rows a user predicate accepts; it receives the named columns only. [X2]"""

    @F.pandas_udf(BooleanType())
    def run(*series: pd.Series) -> pd.Series:
        return pd.Series(predicate(*series))

    return df.filter(run(*(F.col(c) for c in columns)))


def union_splits(parts: dict[str, DataFrame], column: str = "split") -> DataFrame:
    """Tables of single splits as one table with a split column. [U1]"""
    named = [add_metadata(df, **{column: split}) for split, df in parts.items()]
    return reduce(DataFrame.unionByName, named)
