"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.llm import (
    decontamination, licenses, mixing, oracles, periodic, quality, secrets, simhash, spelling, substring, toxicity,
    urls, warc, wrapper,
)
from sonoloom.llm.common import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def categories() -> dict[str, Column]:
    """The chain's categories, in order, as conditions on `labels`."""
    return {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def source_weight() -> Column:
    """Sources weigh 1, 2, 3, repeating."""
    return F.col("place") % 3 + 1


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op1_secret_scans(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """With the `ledger` of an earlier run only texts and rule versions that it lacks are scanned."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = ledger or shared_folder(spark)
    secrets.update_ledger(docs, ledger)
    found = secrets.findings(docs, ledger)

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(kind) for kind in secrets.BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    manifest = warc.write_archives(warc.with_record_types(table(spark, sf_dir, "pages")), folder)
    return warc.resolved(warc.read_archives(manifest))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), source_weight())
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = urls.judged(table(spark, sf_dir, "pages"))
    return rows.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.inline("found"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"), categories())
    return toxicity.scored(docs, chain)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wrapper.extracted(table(spark, sf_dir, "pages"))
    return rows.select(
        F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text",
        F.length("text").cast("long").alias("n_chars"),
    )


def _planted(texts: pa.Array, numbers: pa.Array) -> pa.Array:
    """Texts whose words repeat with a period from some word on, both set by a number."""
    out = []
    for text, g in zip(texts.to_pylist(), numbers.to_pylist()):
        words = text.encode("utf-8", "surrogatepass").split() if text is not None and g is not None else []
        if n := len(words):
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            words[a:] = (words[a : a + period] * -(-(n - a) // period))[: n - a]
            text = b" ".join(words).decode("utf-8", "surrogatepass")
        out.append(text)
    return pa.array(out, pa.string())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = h % 10 == 0
    planted = F.arrow_udf(_planted, "string")(F.when(chosen, F.col("text")), F.floor(h / 10))
    text = F.when(chosen, planted).otherwise(F.col("text"))
    rows = periodic.collapsed(docs.select("doc_id", text.alias("text")))
    longest = F.aggregate(
        "runs", F.lit(None).cast(periodic.RUN),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )
    said = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return rows.select("row", "runs", "collapsed", longest.alias("best")).select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    labels = F.array_sort(F.array_distinct(F.transform("base", lambda d: d["label"])))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    plain = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.array_remove(F.split(plain, "[^a-z\u00c0-\u00ff]+"), "")).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return spelling.variants(spelling.counted(runs.select(F.when(h % 97 == 0, less).otherwise(F.col("run")).alias("word"))))


QUERIES = {
    query.__name__: query
    for query in (
        op1_secret_scans, op2_substring_dedup, op3_quality_rules, op4_warc, op5_mixing, op6_url_filters,
        op7_decontamination, op8_simhash, op9_toxicity, op10_html_extraction, op11_periodic_runs, op12_license_scans,
        op13_spelling_variants,
    )
}


def registered() -> dict:
    """Key -> (query(spark, sf_dir) -> DataFrame, DuckDB SQL or None)."""
    return {key: (query, oracles.SQL.get(key)) for key, query in QUERIES.items()}
