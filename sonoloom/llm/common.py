"""Helpers that the corpus operators share: scratch tables, content keys, words as numpy arrays."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are none of these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
_CHUNK_BYTES = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder all executors share (`spark.checkpoint.dir`).

    Only a local session may leave the setting out; it then gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = path or shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct `row`, so that added columns cannot clash with any of them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def content_key(*columns: str | Column) -> Column:
    """16 bytes that are equal for rows whose columns are equal (MD5 of the values, nulls told apart)."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts += [F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"))), text]
    return F.unhex(F.md5(F.concat_ws("\x00", *parts).cast("binary")))


def word_list(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def text_chunks(column: pa.Array, limit: int = _CHUNK_BYTES):
    """(first row, bytes, offsets) of runs of whole texts of some `limit` bytes; one longer text is a run of its own."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
    """(starts, ends, first) of the words: byte ranges, and each text's first word with the total at the end.

    `inside` says for each byte value whether it belongs to a word; else all but white space do.
    """
    if inside is None:
        inside = np.ones(256, bool)
        inside[[32, 9, 10, 11, 12, 13]] = False
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    word = inside[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    return starts, np.flatnonzero(word & ~after) + 1, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: differences of one running polynomial over the bytes."""
    powers = np.full(len(data) + 1, _ODD)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((mixed(np.arange(1, 257, dtype=np.uint64))[data]) * powers[:-1], out=running[1:])
    back = np.full(len(data) + 1, _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    return mixed((running[ends] - running[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive words; runs over text borders, which callers leave out."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * _ODD + words[i : len(words) - n + 1 + i]
    return mixed(total)
