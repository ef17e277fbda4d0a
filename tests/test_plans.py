"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import catalogue
from catalogue import stand_ins
from conftest import SF_DIR
from sonoloom.operators import limits, statistics, tables
from sonoloom.sources import scans, sink


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, key):
    return plan(catalogue.registered()[key][0](spark, SF_DIR))


@pytest.mark.parametrize("key", catalogue.registered())
def test_no_pairing_of_all_rows(spark, key):
    text = query_plan(spark, key)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key, calls", [("ingest_generic", 2), ("ingest_transcripts", 1), ("text_normalize", 1)])
def test_each_batch_function_runs_once(spark, key, calls):
    text = query_plan(spark, key)
    assert text.count("ArrowEvalPython") == calls
    # the text chain occurs once: no filter repeats it
    assert text.count("(?U)") == 1


def test_audio_comes_after_the_text_filter(spark):
    text = query_plan(spark, "ingest_transcripts")
    assert text.index("ArrowEvalPython") < text.index("Generate explode") < text.index("EqualNullSafe(lang,en)")


def test_attribute_filter_reaches_the_scan(spark):
    df = tables.where_equal(stand_ins.table(spark, SF_DIR, "documents"), "source", "src1").select("doc_id")
    text = plan(df)
    assert "EqualNullSafe(source,src1)" in text
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_limit_moves_keys_only_and_reaches_the_scan(spark):
    docs = stand_ins.table(spark, SF_DIR, "documents")
    text = plan(limits.first_rows(docs, 10, "doc_id"))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(doc_id,ScalarSubquery", text)
    assert text.count("ReadSchema: struct<doc_id:bigint>") >= 1
    # nothing above the subquery shuffles or sorts
    main = [line for line in text.splitlines() if not line.lstrip(" ").startswith(":")]
    main = main[: next(i for i, line in enumerate(main) if "FileScan" in line)]
    assert not any("Exchange" in line or "Sort" in line for line in main)


@pytest.mark.parametrize("splits", [3, 30])
def test_limit_of_all_splits_reads_their_keys_twice(spark, tmp_path, splits):
    """One plan for any number of splits; both scalars take the cuts from one exchange."""
    path = str(tmp_path / "rows")
    rows = spark.range(3000).withColumns({"split": F.concat(F.lit("s"), F.col("id") % splits), "load": F.repeat(F.lit("x"), 50)})
    rows.write.parquet(path)
    out = limits.first_rows_per_split(spark.read.parquet(path), 5, None, "id")
    assert out.count() == 5 * splits
    out.collect()
    text = plan(out)
    run = set(re.findall(r"\*\(\d+\) ColumnarToRow\n[^\n]*FileScan parquet (\[[^]]*\])", text))
    assert len([s for s in run if "load" not in s]) == 2 and len(run) == 3
    assert "ReusedExchange" in text
    assert re.search(r"PushedFilters: \[[^]]*LessThanOrEqual\(id,ScalarSubquery", text)


def test_stored_statistics_read_one_column(spark, tmp_path):
    root = str(tmp_path / "c")
    catalogue_rows = stand_ins.table(spark, SF_DIR, "documents").select(
        "text",
        F.col("n_chars").alias("audio_size"),
        F.lit(b"x").alias("audio_bytes"),
        F.lit("c").alias("corpus"),
        F.lit("train").alias("split"),
        F.col("lang").alias("language"),
    )
    sink.write_corpus(catalogue_rows, root)
    stored = scans.read_corpus(spark, root, version=0, language="en")
    text = plan(statistics.corpus_statistics(stored))
    assert "ReadSchema: struct<audio_size:bigint>" in text
    assert re.search(r"PartitionFilters: \[[^]]*version[^]]*language", text)

    report = statistics.statistics_report(stored)
    report.collect()
    assert "ReusedExchange" in plan(report)


def test_payload_files_are_never_broadcast(spark):
    text = query_plan(spark, "audio_by_path")
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    """One language holds nearly all rows; rebalancing divides it into several files."""
    root = str(tmp_path / "hot")
    rows = spark.range(40_000).repartition(8).select(
        F.concat_ws(" ", *(F.sha2(F.concat(F.col("id"), F.lit(i)), 512) for i in range(4))).alias("text"),
        F.lit(None).cast("binary").alias("audio_bytes"),
        F.lit(1).cast("long").alias("audio_size"),
        F.lit("c").alias("corpus"),
        F.lit("train").alias("split"),
        F.when(F.col("id") % 50 == 0, "de").otherwise("en").alias("language"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        sink.write_corpus(rows, root, rebalance=True)
    finally:
        spark.conf.set(size, before)
    files = scans.read_corpus(spark, root).groupBy("language").agg(
        F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("n")
    )
    assert {r.language: (r.files > 2, r.n) for r in files.collect()} == {"en": (True, 39_200), "de": (False, 800)}


def test_files_follow_the_bytes_of_their_partition(spark, tmp_path):
    """A partition has the files that its bytes fill; each is written by one task, and rows are sent once."""
    root = str(tmp_path / "placed")
    rows = spark.range(20_000).repartition(8).select(
        F.concat(F.lit("text "), "id").alias("text"), F.repeat(F.lit("x"), 100).cast("binary").alias("audio_bytes"),
        F.lit(1).cast("long").alias("audio_size"), F.lit("c").alias("corpus"), F.lit("train").alias("split"),
        F.when(F.col("id") % 50 == 0, "de").when(F.col("id") % 50 == 1, None).otherwise("en").alias("language"),
    )
    weight = F.octet_length("audio_bytes") + F.octet_length("text")
    out = sink.placed(rows, weight, 200_000)
    text = plan(out)
    assert len(re.findall(r"Exchange (?!Round)\S*[^\n]*REPARTITION_BY_NUM", text)) == 1 and "SortMergeJoin" not in text
    sink.write_corpus(rows, root, file_bytes=200_000)
    files = scans.read_corpus(spark, root).groupBy("language").agg(
        F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("n"), F.sum(weight).alias("w")
    )
    got = {r.language: r for r in files.collect()}
    assert {k: r.n for k, r in got.items()} == {"en": 19_200, "de": 400, None: 400}
    assert all(r.files == -(-r.w // 200_000) for r in got.values()) and got["en"].files > 10


def test_small_files_share_a_task(spark, tmp_path):
    """60 partitions of three files each: no task for each file, and still as many files as the bytes fill."""
    root = str(tmp_path / "small")
    rows = spark.range(6000).repartition(4).select(
        F.concat(F.lit("text "), "id").alias("text"), F.repeat(F.lit("x"), 100).cast("binary").alias("audio_bytes"),
        F.lit(1).cast("long").alias("audio_size"), F.concat(F.lit("c"), F.col("id") % 60).alias("corpus"),
        F.lit("train").alias("split"), F.lit("en").alias("language"),
    )
    weight = F.octet_length("audio_bytes") + F.octet_length("text")
    tasks = sink.placed(rows, weight, 4000).rdd.getNumPartitions()
    assert tasks == 4 * spark.sparkContext.defaultParallelism < 180
    sink.write_corpus(rows, root, file_bytes=4000)
    stored = scans.read_corpus(spark, root)
    files = stored.groupBy("corpus").agg(F.count_distinct("_metadata.file_path").alias("files"), F.sum(weight).alias("w"), F.count("*").alias("n"))
    got = files.collect()
    assert len(got) == 60 and all(r.files == -(-r.w // 4000) == 3 and r.n == 100 for r in got)


def test_rows_are_sent_once_to_be_placed(spark):
    """The planned files are broadcast even if Spark would take no table for small, so rows are not shuffled to meet them."""
    texts = [F.concat(F.lit(c), F.col("id") % 3).alias(c) for c in ("corpus", "split", "language")]
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = plan(sink.placed(spark.range(100).select("id", *texts), F.lit(1), 10))
    finally:
        spark.conf.set(threshold, before)
    assert text.count("BroadcastHashJoin") == 1 and len(re.findall(r"(?<!Broadcast)Exchange ", text)) == 1


def test_files_of_one_partition_share_tasks(spark, tmp_path):
    """One partition of 300 small files: not a task for each, neither when they are written nor when they are read."""
    root, group = str(tmp_path / "one"), "one partition"
    rows = spark.range(6000).repartition(4).select(
        F.concat(F.lit("text "), "id").alias("text"), F.repeat(F.lit("x"), 90).cast("binary").alias("audio_bytes"),
        F.col("id").alias("audio_size"), F.lit("c").alias("corpus"), F.lit("train").alias("split"),
        F.when(F.col("id") % 50 == 1, None).otherwise("en").alias("language"),
    )
    weight = F.octet_length("audio_bytes") + F.octet_length("text")
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        sink.write_corpus(rows, root, file_bytes=2000)
        stored = scans.read_corpus(spark, root, file_column="file")
        got = stored.groupBy("language").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"), F.sum(weight).alias("w")).collect()
    finally:
        sc._jsc.sc().clearJobGroup()
    assert {r.language: r.n for r in got} == {"en": 5880, None: 120}
    assert all(r.files == -(-r.w // 2000) for r in got) and max(r.files for r in got) > 280
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    assert max(info.numTasks for s in stages if (info := tracker.getStageInfo(s))) <= 4 * sc.defaultParallelism
    columns = ("text", "audio_bytes", "audio_size", "corpus", "split", "language")
    assert sorted(r.audio_size for r in stored.collect()) == list(range(6000))
    assert stored.select(*columns).exceptAll(rows.select(*columns)).count() == 0
    assert {p.suffix for p in (tmp_path / "one").rglob("*") if p.is_file()} == {".parquet"}
    assert [p.name for p in (tmp_path / "one").iterdir()] == ["version=0"]


def test_recordings_are_landed_under_their_own_names(spark, tmp_path):
    """Paths are known from the ids: nothing is listed or joined, and a repeated id does not multiply its rows."""
    sf_dir = str(tmp_path)
    docs = spark.range(0, 28, numPartitions=4).selectExpr("id % 14 AS doc_id", "'some words' AS text", "'en' AS lang", "'src0' AS source")
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    vectors = spark.range(20).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(0.5).cast("float"), 64).alias("embedding"))
    vectors.write.parquet(f"{sf_dir}/embeddings.parquet")
    out = stand_ins.recorded(spark, sf_dir)
    assert "binaryFile" not in plan(out)
    got = out.where("doc_id % 7 = 6").select("doc_id", "audio.path").collect()
    assert sorted(r.doc_id for r in got) == [6, 6, 13, 13]
    for r in got:
        content = open(r.path.removeprefix("file://"), "rb").read()
        assert content[:4] == b"RIFF" and len(content) == 44 + 2 * 64


def test_landed_files_by_row(spark, tmp_path):
    """One file for each row, in folders of their own, without a checksum file beside each; an empty table gives an empty folder."""
    root = str(tmp_path / "landed")
    rows = spark.range(0, 300, numPartitions=3).select("id", F.repeat(F.lit("é"), F.col("id").cast("int")).alias("text"))
    sink.write_files(rows, root, sink.file_name(F.col("id"), ".txt"), F.col("text"))
    found = [p for p in (tmp_path / "landed").rglob("*") if p.is_file()]
    assert len({p.parent for p in found}) == 64
    assert {p.name: p.read_bytes().decode() for p in found} == {f"{i}.txt": "é" * i for i in range(300)}
    sink.write_files(rows.where("id < 0"), f"{root}-none", F.lit("a"), F.col("text"))
    assert (tmp_path / "landed-none").is_dir()


def test_rows_are_placed_before_their_audio_is_read(spark):
    from sonoloom.plans import ingest

    rows = stand_ins.speech(spark, SF_DIR)
    out = ingest.ingest(rows, F.col("corpus"), F.col("language"), "doc_id", text_column="transcript", file_bytes=100_000)
    text = plan(out)
    audio = text.index("ArrowEvalPython")
    assert "REPARTITION_BY_NUM" not in text[:audio] and "REPARTITION_BY_NUM" in text[audio:]
    assert out.count() == ingest.ingest(rows, F.col("corpus"), F.col("language"), "doc_id", text_column="transcript").count()


def test_hot_path_is_divided(spark, tmp_path):
    """Most rows name one file; adaptive execution splits them over tasks."""
    for i in range(20):
        (tmp_path / f"{i}.wav").write_bytes(bytes([i]) * 100)
    number = F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id") % 20)
    rows = spark.range(60_000).repartition(8).select(
        "id",
        number.alias("number"),
        stand_ins.audio_cell(path=F.concat(F.lit(f"{tmp_path}/"), number, F.lit(".wav"))).alias("audio"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = scans.with_payloads(rows, str(tmp_path)).select("id", "number", F.col("audio.bytes").alias("b"))
        content = F.expr("unhex(repeat(lpad(hex(number), 2, '0'), 100))")
        wrong = out.filter(~F.col("b").eqNullSafe(content))
        seen = out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
        assert tuple(seen.first()) == (60_000, 60_000) and wrong.count() == 0
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
