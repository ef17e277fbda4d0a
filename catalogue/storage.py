"""The stored corpus: written from the documents, read back, counted."""

from pyspark.sql import functions as F

from catalogue.stand_ins import SPLIT_SQL, audio_cell, split_of, table
from sonoloom.operators import statistics, tables
from sonoloom.schema import TARGET
from sonoloom.plans import ingest
from sonoloom.sources import files, scans, sink

SPLITS = ("train", "validation", "test")


def _prepared(spark, sf_dir):
    """Documents in the target form: their bytes as audio, their length as its size."""
    docs = table(spark, sf_dir, "documents")
    return tables.conform(
        docs.select(
            "text",
            F.encode("text", "utf-8").alias("audio_bytes"),
            F.col("n_chars").alias("audio_size"),
            F.col("source").alias("corpus"),
            split_of().alias("split"),
            F.col("lang").alias("language"),
        ),
        TARGET,
    )


_PREPARED_SQL = f"""
prepared AS (
  SELECT text, md5(text) AS audio_bytes, n_chars AS audio_size, source AS corpus, {SPLIT_SQL} AS split,
         lang AS language FROM documents)"""


def _landed(spark, sf_dir) -> str:
    """A corpus that the query writes for itself."""
    root = sink.scratch_folder(spark)
    sink.write_corpus(_prepared(spark, sf_dir), root)
    return root


def _stored(spark, sf_dir, **partition):
    return scans.read_corpus(spark, _landed(spark, sf_dir), **partition)


def _union_splits(spark, sf_dir):
    root = _landed(spark, sf_dir)
    return _rows(tables.union_splits({s: scans.read_corpus(spark, root, split=s).drop("split") for s in SPLITS}))


def _rows(df):
    return df.select(*(c for c in TARGET.names if c != "audio_bytes"), F.md5("audio_bytes").alias("audio_bytes"))


def _roundtrip(spark, sf_dir):
    """Write all, then write the test split again with other sizes: only its partitions change."""
    root = sink.scratch_folder(spark)
    prepared = _prepared(spark, sf_dir)
    sink.write_corpus(prepared, root)
    again = tables.where_split(prepared, "test").withColumn("audio_size", F.col("audio_size") + 1)
    sink.write_corpus(again, root, dictionary=False)
    return _rows(scans.read_corpus(spark, root))


def _scan_split(spark, sf_dir):
    """A landed raw table with one directory per split."""
    root = sink.scratch_folder(spark)
    docs = table(spark, sf_dir, "documents").withColumn("split", split_of())
    docs.write.partitionBy("split").parquet(f"{root}/prose")
    schema = table(spark, sf_dir, "documents").schema
    return scans.read_split(spark, root, "validation", config="prose", schema=schema)


def _skip_corrupt(spark, sf_dir):
    """A stored corpus in which one partition also holds files that are not Parquet."""
    root = sink.scratch_folder(spark)
    sink.write_corpus(_prepared(spark, sf_dir), root)
    damaged = f"{root}/version=0/corpus=src0/split=train/language=en"
    table(spark, sf_dir, "documents").select("text").write.mode("append").text(damaged)
    return _rows(scans.read_corpus(spark, root, skip_corrupt=True))


def _by_row(spark, sf_dir):
    """A text by its place in the file of the documents, or in the first of them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{sf_dir}/documents.parquet")
    return files.lookup_row(spark, listed.agg(F.min("path")).first()[0], 70, "text")


#: Size of the files into which placed rows go.
_FILE_BYTES = 20_000


def _placed(spark, sf_dir):
    """Rows of each partition, and whether it has no more files than its bytes fill."""
    root = sink.scratch_folder(spark)
    sink.write_corpus(_prepared(spark, sf_dir), root, file_bytes=_FILE_BYTES)
    weight = F.octet_length("text") + F.octet_length("audio_bytes")
    stored = scans.read_corpus(spark, root, file_column="file").withColumn("weight", weight)
    return stored.groupBy("corpus", "split", "language").agg(
        F.count("*").alias("rows"),
        (F.count_distinct("file") <= F.ceil(F.sum("weight") / _FILE_BYTES)).alias("fits"),
    )


def _half_broken(spark, sf_dir) -> str:
    """A stored corpus with half a Parquet file in one partition, and test files that have no audio_size."""
    root = sink.scratch_folder(spark)
    prepared = _prepared(spark, sf_dir)
    sink.write_corpus(prepared.filter(F.col("split") != "test"), root)
    sink.write_corpus(tables.where_split(prepared, "test").drop("audio_size"), root)
    partition = f"{root}/version=0/corpus=src0/split=train/language=en"
    whole = spark.read.format("binaryFile").load(partition)
    half = whole.select(F.expr("substring(content, 1, length(content) div 2)").cast("string").alias("value")).limit(1)
    half.write.text(f"{root}-half")
    spark.read.text(f"{root}-half", wholetext=True).write.mode("append").text(partition)
    return root


def _skipped(spark, sf_dir):
    """Reason and rows of the files that are passed over, by the partition that their paths name."""
    found = files.skipped_files(spark, _half_broken(spark, sf_dir))
    level = {c: F.regexp_extract("file", f"/{c}=([^/]*)/", 1).alias(c) for c in ("corpus", "split", "language")}
    return found.groupBy(*level.values(), "reason").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def _skip_missing(spark, sf_dir):
    """A stored corpus whose test files have no audio_size."""
    root = sink.scratch_folder(spark)
    prepared = _prepared(spark, sf_dir)
    sink.write_corpus(prepared.filter(F.col("split") != "test"), root)
    sink.write_corpus(tables.where_split(prepared, "test").drop("audio_size"), root)
    return statistics.corpus_statistics(scans.read_corpus(spark, root))


def _by_path(spark, sf_dir):
    """Pages landed one file each; three of four rows know only the path of their file."""
    root = sink.scratch_folder(spark)
    pages = table(spark, sf_dir, "pages")
    page = F.concat(F.concat_ws("\t", F.col("page_id").cast("string"), "html"), F.lit("\n"))
    numbered = pages.withColumn("number", F.monotonically_increasing_id())
    sink.write_files(numbered, root, sink.file_name(F.col("number"), ".txt"), page)

    files = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    page_id = F.substring_index("value", "\t", 1).cast("bigint")
    rows = files.select(
        page_id.alias("page_id"),
        audio_cell(
            bytes=F.when(page_id % 4 == 0, F.encode(page_id.cast("string"), "utf-8")), path=F.col("_metadata.file_path")
        ).alias("audio"),
    )
    found = scans.with_payloads(rows, root, pattern="*.txt")
    return found.select("page_id", F.md5("audio.bytes").alias("digest"))


_COUNTS = "count(*) AS num_samples, sum(audio_size) / 16000 / 3600 AS duration_hours"
_GROUPS_SQL = f"WITH {_PREPARED_SQL} SELECT corpus, language, split, {_COUNTS} FROM prepared"

QUERIES = {
    "scan_split": (
        _scan_split,
        f"SELECT *, 'validation' AS split FROM documents WHERE {SPLIT_SQL} = 'validation'",
    ),
    "scan_partitioned": (
        lambda spark, sf_dir: _rows(_stored(spark, sf_dir)),
        f"WITH {_PREPARED_SQL} SELECT * FROM prepared",
    ),
    "scan_one_partition": (
        lambda spark, sf_dir: _rows(_stored(spark, sf_dir, corpus="src1", split="train", language="en")),
        f"WITH {_PREPARED_SQL} SELECT * FROM prepared WHERE corpus = 'src1' AND split = 'train' AND language = 'en'",
    ),
    "filter_by_split": (
        lambda spark, sf_dir: _rows(tables.where_split(_stored(spark, sf_dir), "test")),
        f"WITH {_PREPARED_SQL} SELECT * FROM prepared WHERE split = 'test'",
    ),
    "union_splits": (
        _union_splits,
        f"WITH {_PREPARED_SQL} SELECT * FROM prepared",
    ),
    "audio_by_path": (
        _by_path,
        "SELECT page_id, md5(CASE WHEN page_id % 4 = 0 THEN CAST(page_id AS VARCHAR)"
        " ELSE page_id || chr(9) || html || chr(10) END) AS digest FROM pages",
    ),
    "partitioned_roundtrip": (
        _roundtrip,
        f"WITH {_PREPARED_SQL} SELECT text, audio_bytes, corpus, split, language,"
        " CASE WHEN split = 'test' THEN audio_size + 1 ELSE audio_size END AS audio_size FROM prepared",
    ),
    "scan_skip_corrupt": (_skip_corrupt, f"WITH {_PREPARED_SQL} SELECT * FROM prepared"),
    "lookup_row": (_by_row, "SELECT CAST(70 AS BIGINT) AS row, text FROM (SELECT text FROM documents LIMIT 1 OFFSET 70)"),
    "placed_files": (
        _placed,
        f"WITH {_PREPARED_SQL} SELECT corpus, split, language, count(*) AS rows, true AS fits FROM prepared"
        " GROUP BY corpus, split, language",
    ),
    "skipped_files": (
        _skipped,
        f"""WITH {_PREPARED_SQL}
SELECT corpus, split, language, 'no audio_size' AS reason, count(*) AS rows FROM prepared WHERE split = 'test'
GROUP BY corpus, split, language
UNION ALL SELECT 'src0', 'train', 'en', 'no readable footer', 0""",
    ),
    "stats_skip_corrupt": (
        lambda spark, sf_dir: ingest.stored_report(spark, _half_broken(spark, sf_dir), skip_corrupt=True),
        f"WITH {_PREPARED_SQL} SELECT corpus, language, split, {_COUNTS}, CAST(grouping(corpus) AS INTEGER) AS is_total"
        " FROM prepared WHERE split <> 'test' GROUP BY GROUPING SETS ((corpus, language, split), ())",
    ),
    "stats_skip_missing": (
        _skip_missing,
        f"{_GROUPS_SQL} WHERE split <> 'test' GROUP BY corpus, language, split",
    ),
    "dataset_stats": (
        lambda spark, sf_dir: statistics.corpus_statistics(_stored(spark, sf_dir)),
        f"{_GROUPS_SQL} GROUP BY corpus, language, split",
    ),
    "dataset_totals": (
        lambda spark, sf_dir: statistics.totals(_stored(spark, sf_dir)),
        f"WITH {_PREPARED_SQL} SELECT {_COUNTS} FROM prepared",
    ),
    "loaded_totals": (
        lambda spark, sf_dir: statistics.totals(_stored(spark, sf_dir, split="train")),
        f"WITH {_PREPARED_SQL} SELECT {_COUNTS} FROM prepared WHERE split = 'train'",
    ),
    "stats_report": (
        lambda spark, sf_dir: statistics.statistics_report(_stored(spark, sf_dir)),
        f"WITH {_PREPARED_SQL} SELECT corpus, language, split, {_COUNTS}, CAST(grouping(corpus) AS INTEGER) AS is_total"
        " FROM prepared GROUP BY GROUPING SETS ((corpus, language, split), ())",
    ),
    "stats_rollup": (
        lambda spark, sf_dir: statistics.statistics_rollup(_stored(spark, sf_dir)),
        f"WITH {_PREPARED_SQL} SELECT corpus, language, split, {_COUNTS},"
        " CAST(grouping(corpus, language, split) AS INTEGER) AS level"
        " FROM prepared GROUP BY ROLLUP (corpus, language, split)",
    ),
}
