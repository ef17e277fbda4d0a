"""The preparation jobs: raw rows to corpus rows, and the whole run with its report.

Each job is one lazy plan. Cheap steps come first: attribute filter, first-N cut, text; audio
is processed, and files that cells name are read, only for the rows that are left. All splits
run together. `audio_root` is where relative paths of audio files start. With `file_bytes` rows are sent to the
task that writes their file before their audio is read, see `sink.placed`.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sonoloom import fixed_values as V
from sonoloom.functions import text as tx
from sonoloom.operators import limits, statistics, tables
from sonoloom.sources import files, scans, sink


def ingest(
    df: DataFrame,
    corpus: str | Column,
    language: str | Column,
    order_by: str | Sequence[str],
    splits: Sequence[str] | None = None,
    text_column: str = "transcription",
    audio_column: str = "audio",
    max_samples: int | None = None,
    rate: int = V.TARGET_RATE,
    split_column: str = "split",
    audio_root: str | None = None,
    file_bytes: int = 0,
) -> DataFrame:
    """Corpus rows with normalised text: lower case, no punctuation, no digit-only text. [C1]"""
    rows = limits.first_rows_per_split(df, max_samples, splits, order_by, split_column)
    text = tx.normalise_or_empty(F.col(text_column), language, drop_digit_only=True)
    return _finish(rows, text, corpus, language, audio_column, split_column, rate, audio_root, file_bytes)


def ingest_transcripts(
    df: DataFrame,
    corpus: str | Column,
    order_by: str | Sequence[str],
    language: str | Column = V.TRANSCRIPT_LANGUAGE,
    state: str | None = V.TRANSCRIPT_STATE,
    splits: Sequence[str] | None = None,
    text_column: str = "transcript",
    audio_column: str = "audio",
    state_column: str = "state",
    max_samples: int | None = None,
    rate: int = V.TARGET_RATE,
    split_column: str = "split",
    audio_root: str | None = None,
    file_bytes: int = 0,
) -> DataFrame:
    """Corpus rows of one state with cleaned transcripts, their punctuation kept. [C2]"""
    rows = tables.where_equal(df, state_column, state)
    rows = limits.first_rows_per_split(rows, max_samples, splits, order_by, split_column)
    text = tx.clean_transcript(F.col(text_column))
    return _finish(rows, text, corpus, language, audio_column, split_column, rate, audio_root, file_bytes)


def _finish(df, text, corpus, language, audio_column, split_column, rate, audio_root, file_bytes) -> DataFrame:
    """Drop rows without text, then process the audio of the others; `file_bytes` places them for the sink before."""
    constants = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in (("corpus", corpus), ("language", language))
    }
    rows = df.select(
        F.col(audio_column).alias("audio"),
        F.col(split_column).alias("split"),
        *(value.alias(name) for name, value in constants.items()),
        tables.if_not_empty(text).alias("text"),
    )
    if file_bytes:
        rows = sink.placed(rows, sink.cell_bytes(tables.audio_cell(rows, "audio")), file_bytes)
    return tables.conform(tables.process_audio(rows, "audio", rate, audio_root))


def ingest_summary(prepared: DataFrame, rate: int = V.TARGET_RATE) -> DataFrame:
    """Samples and hours of each split that a run produced. [G5]"""
    return statistics.corpus_statistics(prepared, rate)


def prepare_corpus(prepared: DataFrame, root: str, version: int = 0, **sink_options) -> DataFrame:
    """Write a prepared corpus and report the stored statistics with their total. [C3]"""
    sink.write_corpus(prepared, root, version, **sink_options)
    return stored_report(prepared.sparkSession, root, version)


def stored_report(spark, root: str, version: int = 0, skip_corrupt: bool = False) -> DataFrame:
    """Statistics lines and TOTAL of a stored corpus. [C4]

    With `skip_corrupt` a file that cannot be read in full is passed over as a whole; `files.skipped_files`
    names those files with the reason.
    """
    if skip_corrupt:
        whole = files.file_states(spark, root, version).where("reason is null")
        return statistics.report_of_sums(whole, "rows", "samples")
    return statistics.statistics_report(scans.read_corpus(spark, root, version=version))
