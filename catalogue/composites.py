"""The preparation jobs over all annotated documents."""

from pyspark.sql import functions as F

from catalogue.stand_ins import RECORDED_SQL, SPEECH_SQL, recorded, speech, wav_sql
from catalogue.text import sql_clean, sql_normal
from sonoloom.plans import ingest
from sonoloom.sources import scans, sink

_COLUMNS = ("text", "audio_size", "corpus", "split", "language")


#: Rows of each split that the limited jobs take, before texts are cleaned and empty ones dropped.
_FIRST = 60


def generic(spark, sf_dir, first=None):
    return ingest.ingest(
        speech(spark, sf_dir),
        corpus=F.col("corpus"),
        language=F.col("language"),
        order_by="doc_id",
        text_column="transcript",
        max_samples=first,
    )


def transcripts(spark, sf_dir, first=None):
    return ingest.ingest_transcripts(
        speech(spark, sf_dir), corpus="speech", order_by="doc_id", state="en", max_samples=first
    )


def flagship(spark, sf_dir):
    """All splits: filter, clean, process audio, write, and the report over what was written.

    There are three partitions, so a task writes three files at most and the audio is not
    shuffled for the sink.
    """
    return ingest.prepare_corpus(transcripts(spark, sf_dir), sink.scratch_folder(spark), dictionary=False)


def _with_digest(df):
    return df.select(*_COLUMNS, F.md5("audio_bytes").alias("audio_md5"))


def _recorded(spark, sf_dir):
    """The generic job over audio cells of all forms, with a digest of the audio it makes."""
    rows = ingest.ingest(
        recorded(spark, sf_dir), corpus=F.col("corpus"), language=F.col("language"), order_by="doc_id", text_column="transcript"
    )
    return _with_digest(rows)


def _recorded_transcripts(spark, sf_dir):
    """The rows of the transcript job over the same, first `_FIRST` of each split, placed by size, written and read back."""
    root = sink.scratch_folder(spark)
    rows = ingest.ingest_transcripts(
        recorded(spark, sf_dir), corpus="speech", order_by="doc_id", state="en", max_samples=_FIRST, file_bytes=1 << 16
    )
    sink.write_corpus(rows, root, dictionary=False)
    return _with_digest(scans.read_corpus(spark, root))


def _recorded_sql(text: str, corpus: str, language: str, rows: str) -> str:
    return f"""
WITH {RECORDED_SQL}, {wav_sql("heard")},
prepared AS (
  SELECT {text} AS text, coalesce(audio_size, 0) AS audio_size, {corpus} AS corpus, split, {language} AS language,
    md5(unhex(coalesce(audio_bytes, ''))) AS audio_md5
  FROM {rows} LEFT JOIN wavs USING (doc_id))
SELECT * FROM prepared WHERE text <> ''"""


def _generic_sql(rows: str) -> str:
    return f"""
WITH {SPEECH_SQL},
prepared AS (
  SELECT coalesce({sql_normal("transcript", digits=True)}, '') AS text, audio_size, corpus, split, language
  FROM {rows})
SELECT * FROM prepared WHERE text <> ''"""


def _transcripts_sql(rows: str) -> str:
    return f"""
WITH {SPEECH_SQL},
prepared AS (
  SELECT {sql_clean("transcript")} AS text, audio_size, 'speech' AS corpus, split, 'gom_Deva' AS language
  FROM {rows}),
kept AS (SELECT * FROM prepared WHERE text <> '')"""


def _first_sql(rows: str) -> str:
    return f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY split ORDER BY doc_id) <= {_FIRST})"


_IN_STATE = "(SELECT * FROM sized WHERE state = 'en')"
_TRANSCRIPTS_SQL = _transcripts_sql(_IN_STATE)

_COUNTS = "count(*) AS num_samples, sum(audio_size) / 16000 / 3600 AS duration_hours"

QUERIES = {
    "ingest_generic": (lambda spark, sf_dir: generic(spark, sf_dir).select(*_COLUMNS), _generic_sql("sized")),
    "ingest_generic_limited": (
        lambda spark, sf_dir: generic(spark, sf_dir, _FIRST).select(*_COLUMNS),
        _generic_sql(_first_sql("sized")),
    ),
    "ingest_transcripts_limited": (
        lambda spark, sf_dir: transcripts(spark, sf_dir, _FIRST).select(*_COLUMNS),
        f"{_transcripts_sql(_first_sql(_IN_STATE))} SELECT * FROM kept",
    ),
    "ingest_transcripts": (
        lambda spark, sf_dir: transcripts(spark, sf_dir).select(*_COLUMNS),
        f"{_TRANSCRIPTS_SQL} SELECT * FROM kept",
    ),
    "ingest_recorded": (
        _recorded,
        _recorded_sql(f"coalesce({sql_normal('transcript', digits=True)}, '')", "corpus", "language", "heard"),
    ),
    "flagship_rows": (
        _recorded_transcripts,
        _recorded_sql(
            sql_clean("transcript"), "'speech'", "'gom_Deva'", _first_sql("(SELECT * FROM heard WHERE state = 'en')")
        ),
    ),
    "ingest_summary": (
        lambda spark, sf_dir: ingest.ingest_summary(transcripts(spark, sf_dir)),
        f"{_TRANSCRIPTS_SQL} SELECT corpus, language, split, {_COUNTS} FROM kept GROUP BY corpus, language, split",
    ),
    "flagship": (
        flagship,
        f"{_TRANSCRIPTS_SQL} SELECT corpus, language, split, {_COUNTS}, CAST(grouping(corpus) AS INTEGER) AS is_total"
        " FROM kept GROUP BY GROUPING SETS ((corpus, language, split), ())",
    ),
}
