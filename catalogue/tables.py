"""Filters, projections, limits and batch functions."""

import pandas as pd
from pyspark.sql import functions as F

from catalogue.stand_ins import ANNOTATED_SQL, SPLIT_SQL, annotated, split_of, table
from catalogue.text import NUMBERED_SQL, numbered, sql_clean, sql_digit_only
from sonoloom.functions import audio, text as tx
from sonoloom.operators import limits, statistics, tables
from sonoloom.schema import TARGET


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _cleaned(spark, sf_dir):
    return annotated(spark, sf_dir).select("doc_id", F.col("transcript").alias("text"))


def _raw(spark, sf_dir):
    """Documents as rows of the target, with an extra column and another column order."""
    return tables.add_metadata(
        _docs(spark, sf_dir).select(
            "doc_id",
            F.col("n_chars").cast("int").alias("audio_size"),
            "text",
            F.encode("text", "utf-8").alias("audio_bytes"),
        ),
        corpus="c1",
        split="train",
        language="eng_Latn",
    )


def _with_split(spark, sf_dir):
    return _docs(spark, sf_dir).withColumn("split", split_of())


def _stage_counts(spark, sf_dir):
    rows = annotated(spark, sf_dir)
    in_state = F.col("state").eqNullSafe("en")
    first = limits.within_first(rows.filter(in_state), 50, "doc_id", ("train", "validation", "test"))
    stages = {
        "after_filter": in_state,
        "after_limit": first,
        "after_cleaning": tx.clean_transcript(F.col("transcript")) != "",
    }
    return statistics.stage_counts(rows, stages, by=["split"])


_RANKED_SQL = f"""
ranked AS (
  SELECT doc_id, source, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS rn
  FROM (SELECT *, {SPLIT_SQL} AS split FROM documents))"""

QUERIES = {
    "state_filter": (
        lambda spark, sf_dir: tables.where_equal(_docs(spark, sf_dir), "source", "src3").select(
            "doc_id", "source", "text"
        ),
        "SELECT doc_id, source, text FROM documents WHERE source = 'src3'",
    ),
    "drop_empty_text": (
        lambda spark, sf_dir: _cleaned(spark, sf_dir).select(
            "doc_id", tables.if_not_empty(tx.clean_transcript(F.col("text"))).alias("text")
        ),
        f"WITH {ANNOTATED_SQL} SELECT * FROM (SELECT doc_id, {sql_clean('transcript')} AS text FROM annotated)"
        " WHERE length(text) > 0",
    ),
    "drop_digit_only": (
        lambda spark, sf_dir: tables.drop_digit_only(numbered(spark, sf_dir)),
        f"WITH {NUMBERED_SQL} SELECT doc_id, text FROM numbered"
        f" WHERE length(text) > 0 AND NOT {sql_digit_only('text')}",
    ),
    "add_metadata": (
        lambda spark, sf_dir: tables.add_metadata(
            _docs(spark, sf_dir).select("doc_id", "text"), corpus="c1", split="train", language="eng_Latn"
        ),
        "SELECT doc_id, text, 'c1' AS corpus, 'train' AS split, 'eng_Latn' AS language FROM documents",
    ),
    "conform_schema": (
        lambda spark, sf_dir: tables.conform(_raw(spark, sf_dir), TARGET).withColumn(
            "audio_bytes", F.md5("audio_bytes")
        ),
        "SELECT text, md5(text) AS audio_bytes, n_chars AS audio_size, 'c1' AS corpus, 'train' AS split,"
        " 'eng_Latn' AS language FROM documents",
    ),
    "row_duration": (
        lambda spark, sf_dir: _docs(spark, sf_dir).select(
            "doc_id", audio.duration_seconds(F.col("n_chars")).alias("duration_s")
        ),
        "SELECT doc_id, n_chars / 16000 AS duration_s FROM documents",
    ),
    "lookup_payload": (
        lambda spark, sf_dir: tables.lookup(_docs(spark, sf_dir), "doc_id", 7, "text"),
        "SELECT doc_id, text FROM documents WHERE doc_id = 7",
    ),
    "distinct_states": (
        lambda spark, sf_dir: statistics.distinct_values(_docs(spark, sf_dir), "source"),
        "SELECT DISTINCT source FROM documents",
    ),
    "stage_counts": (
        _stage_counts,
        f"""WITH {ANNOTATED_SQL},
kept AS (
  SELECT doc_id, transcript, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS rn
  FROM annotated WHERE state = 'en')
SELECT split, count(*) AS loaded, count(k.doc_id) AS after_filter,
       count(*) FILTER (k.rn <= 50) AS after_limit,
       count(*) FILTER (k.rn <= 50 AND {sql_clean('k.transcript')} <> '') AS after_cleaning
FROM annotated a LEFT JOIN kept k ON a.doc_id = k.doc_id GROUP BY split""",
    ),
    "limit_per_split": (
        lambda spark, sf_dir: limits.first_rows_per_split(
            _with_split(spark, sf_dir), 40, ("train", "validation", "test"), "doc_id"
        ).select("doc_id", "split", "text"),
        f"WITH {_RANKED_SQL} SELECT r.doc_id, r.split, d.text FROM ranked r JOIN documents d USING (doc_id)"
        " WHERE rn <= 40",
    ),
    "limit_first_n": (
        lambda spark, sf_dir: limits.first_rows(_docs(spark, sf_dir), 120, ["source", "doc_id"]).select(
            "doc_id", "source", "text"
        ),
        "SELECT doc_id, source, text FROM documents ORDER BY source, doc_id LIMIT 120",
    ),
    "head_rows": (
        lambda spark, sf_dir: limits.head(_docs(spark, sf_dir), "doc_id"),
        "SELECT * FROM documents ORDER BY doc_id LIMIT 5",
    ),
    "map_batches": (
        lambda spark, sf_dir: tables.map_batches(
            _docs(spark, sf_dir).select("doc_id", "text"),
            lambda batch: batch[["doc_id"]].assign(letters=batch["text"].str.len()),
            "doc_id bigint, letters bigint",
        ),
        "SELECT doc_id, length(text) AS letters FROM documents",
    ),
    "map_batches_sizes": (
        lambda spark, sf_dir: tables.map_batches(
            _docs(spark, sf_dir).select((F.col("doc_id") % 4).cast("int").alias("part")).repartitionById(4, "part"),
            lambda batch: pd.DataFrame({"part": [batch["part"][0]], "same": [batch["part"].nunique() == 1], "n": [len(batch)]}),
            "part int, same boolean, n bigint",
        ),
        """WITH sizes AS (SELECT CAST(doc_id % 4 AS INTEGER) AS part, count(*) AS total FROM documents GROUP BY 1)
SELECT part, true AS same, least(100, total - 100 * b) AS n
FROM (SELECT part, total, unnest(range((total + 99) // 100)) AS b FROM sizes)""",
    ),
    "filter_batches": (
        lambda spark, sf_dir: tables.filter_batches(
            _docs(spark, sf_dir).select("doc_id", "lang", "text"), lambda lang: lang == "fr", ["lang"]
        ),
        "SELECT doc_id, lang, text FROM documents WHERE lang = 'fr'",
    ),
}
