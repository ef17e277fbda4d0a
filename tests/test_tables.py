import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sonoloom.functions import text as tx
from sonoloom.operators import limits, statistics, tables
from sonoloom.plans import ingest
from sonoloom.schema import AUDIO_CELL, TARGET


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


@pytest.fixture(scope="module")
def keyed(spark):
    """Most rows in one split; keys in no particular order."""
    rng = random.Random(4)
    keys = rng.sample(range(10_000), 600)
    rows = [(k, "train" if i % 3 else rng.choice(["validation", "test"])) for i, k in enumerate(keys)]
    return rows, spark.createDataFrame(rows, "id long, split string").repartition(7)


@pytest.mark.parametrize("n", [1, 5, 399, 400, 5000])
def test_first_rows_per_split(keyed, n):
    rows, df = keyed
    expected = [k for s in ("train", "test") for k in sorted(k for k, x in rows if x == s)[:n]]
    got = limits.first_rows_per_split(df, n, ("train", "test", "absent"), "id")
    assert ids(got) == sorted(expected)


@pytest.mark.parametrize("n", [None, 0])
def test_no_limit(keyed, n):
    rows, df = keyed
    assert ids(limits.first_rows_per_split(df, n, ("train",), "id")) == sorted(k for k, s in rows if s == "train")
    assert limits.first_rows(df, n, "id").count() == len(rows)


def test_first_rows_by_several_columns(keyed):
    rows, df = keyed
    expected = sorted((s, k) for k, s in rows)[:450]
    assert ids(limits.first_rows(df, 450, ["split", "id"])) == sorted(k for _, k in expected)


def test_limit_beyond_the_group_limit_threshold(spark):
    df = spark.range(5000).withColumn("split", F.lit("train")).repartition(5)
    assert ids(limits.first_rows_per_split(df, 3000, ("train",), "id")) == list(range(3000))


def test_cut_against_sorting(spark):
    keys = random.Random(1).sample(range(100_000), 700)
    df = spark.createDataFrame([(k,) for k in keys], "id long").coalesce(2)
    for n in (1, 2, 40, 350, 699, 700, 701, 20_000):
        assert limits.cut_key(df, n, "id").first().cut == sorted(keys)[:n][-1]


def test_cut_among_equal_keys(spark):
    keys = [1] * 300 + [2] + [3] * 200
    df = spark.createDataFrame([(k,) for k in keys], "id long").coalesce(2)
    for n, cut in ((300, 1), (301, 2), (501, 3), (900, 3)):
        assert limits.cut_key(df, n, "id").first().cut == cut
    for n in (299, 302, 500):
        with pytest.raises(Exception, match="not unique"):
            limits.cut_key(df, n, "id").collect()


@pytest.mark.parametrize("n", [1, 7, 500, 1200])
def test_many_splits_of_unequal_size(spark, n):
    """Thirty splits, one of which holds a third of all rows, and one without a name."""
    rows = [(k, None if k % 31 == 30 else "hot" if k % 3 == 0 else f"s{k % 31}") for k in random.Random(2).sample(range(50_000), 4000)]
    df = spark.createDataFrame(rows, "id long, split string").repartition(5)
    want = [k for s in {s for _, s in rows} for k in sorted(k for k, x in rows if x == s)[:n]]
    assert ids(limits.first_rows_per_split(df, n, None, "id")) == sorted(want)
    some = [k for s in ("hot", None) for k in sorted(k for k, x in rows if x == s)[:n]]
    assert ids(limits.first_rows_per_split(df, n, ("hot", None), "id")) == sorted(some)


def test_a_missing_or_tied_key_in_one_split_is_an_error(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (5, "b"), (6, "b")]
    df = spark.createDataFrame(rows, "id long, split string")
    with pytest.raises(Exception, match="not unique at row 2"):
        limits.first_rows_per_split(df, 2, None, "id").collect()
    assert ids(limits.first_rows_per_split(df, 2, ("b",), "id")) == [5, 6]
    with pytest.raises(Exception, match="NULL in some rows"):
        limits.first_rows_per_split(df.union(spark.createDataFrame([(None, "b")], df.schema)), 1, None, "id").collect()


@pytest.mark.parametrize("arrow_rows", [1, 7, 100, 10_000])
def test_batches_are_the_same_however_arrow_cuts_them(spark, arrow_rows):
    def lengths(batch):
        return pd.DataFrame({"n": [len(batch)], "first": [batch["id"].iloc[0]]})

    df = spark.range(250).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 120, 5000).otherwise(10)).alias("t")).coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, arrow_rows)
    try:
        plain = tables.map_batches(df, lengths, "n long, first long").collect()
        small = tables.map_batches(df, lengths, "n long, first long", batch_bytes=1800).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted((r.first, r.n) for r in plain) == [(0, 100), (100, 100), (200, 50)]
    assert sorted((r.first, r.n) for r in small) == [(0, 100), (100, 20), (120, 1), (121, 100), (221, 29)]


def test_tie_at_the_cut_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id long")
    with pytest.raises(Exception, match="not unique"):
        limits.first_rows(df, 2, "id").collect()
    assert ids(limits.first_rows(df, 1, "id")) == [1]
    assert ids(limits.first_rows(df, 3, "id")) == [1, 2, 2]


def test_missing_key_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,)], "id long")
    for n in (1, 3, 10):
        with pytest.raises(Exception, match="NULL in some rows"):
            limits.first_rows(df, n, "id").collect()


def test_limit_of_an_empty_table(spark):
    assert limits.first_rows(spark.range(0), 3, "id").count() == 0


def test_head(keyed):
    rows, df = keyed
    assert ids(limits.head(df, "id")) == sorted(k for k, _ in rows)[:5]


def test_where_equal_matches_null_and_case(spark):
    df = spark.createDataFrame([(1, "Goa"), (2, "goa"), (3, None)], "id long, state string")
    assert ids(tables.where_equal(df, "state", "Goa")) == [1]
    assert ids(tables.where_equal(df, "state", None)) == [3]


def test_empty_and_digit_only_text(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x"), (4, "1 2"), (5, " ")], "id long, text string")
    assert ids(tables.drop_empty_text(df)) == [3, 4, 5]
    assert ids(tables.drop_digit_only(df)) == [3, 5]
    kept = df.select("id", tables.if_not_empty(tx.clean_transcript(F.col("text"))).alias("text"))
    assert ids(kept) == [3, 4]


def test_conform(spark):
    df = spark.createDataFrame([(7, "x", "s", None)], "audio_size int, text string, split string, extra string")
    df = tables.add_metadata(df, corpus="c", language="l").withColumn("audio_bytes", F.lit(b"\x80"))
    out = tables.conform(df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TARGET]
    row = out.first()
    assert (row.audio_size, row.corpus, bytes(row.audio_bytes)) == (7, "c", b"\x80")


def test_lookup_of_an_unknown_column(spark):
    with pytest.raises(AnalysisException):
        tables.lookup(spark.range(3), "id", 1, "audio_bytes")


def test_union_of_splits(spark):
    both = tables.union_splits({"train": spark.range(2), "test": spark.range(5, 6)})
    assert sorted(map(tuple, both.collect())) == [(0, "train"), (1, "train"), (5, "test")]


def test_batches(spark):
    df = spark.range(1000).withColumn("state", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    doubled = tables.map_batches(df.select("id"), lambda b: b * 2, "id long")
    assert ids(doubled) == list(range(0, 2000, 2))
    assert ids(tables.filter_batches(df, lambda s: s == "a", ["state"])) == list(range(0, 1000, 3))
    assert ids(tables.filter_batches(df, lambda s: [x == "a" for x in s], ["state"])) == list(range(0, 1000, 3))


def sized(spark, rows):
    return spark.createDataFrame(rows, "corpus string, language string, split string, audio_size long")


def test_statistics(spark):
    df = sized(spark, [("a", "x", "train", 16000)] * 3 + [("a", "x", "test", 57_600_000), ("b", "y", "test", None)])
    lines = {tuple(r)[:3]: tuple(r)[3:] for r in statistics.corpus_statistics(df).collect()}
    assert lines == {("a", "x", "train"): (3, 3 / 3600), ("a", "x", "test"): (1, 1.0)}
    assert tuple(statistics.totals(df).first()) == (4, (48000 + 57_600_000) / 16000 / 3600)
    report = statistics.statistics_report(df).collect()
    assert [(r.num_samples, r.is_total) for r in report if r.is_total] == [(4, 1)] and len(report) == 3
    levels = sorted((r.level, r.num_samples) for r in statistics.statistics_rollup(df).collect())
    assert levels == [(0, 1), (0, 3), (1, 4), (3, 4), (7, 4)]
    assert statistics.corpus_statistics(df, rate=8000).filter("split = 'test'").first().duration_hours == 2.0


def test_statistics_of_nothing(spark):
    df = sized(spark, [])
    assert statistics.corpus_statistics(df).count() == 0
    assert tuple(statistics.totals(df).first()) == (0, 0.0)
    report = statistics.statistics_report(df).first()
    assert (report.num_samples, report.duration_hours, report.is_total) == (0, 0.0, 1)


def test_stage_counts(spark):
    df = spark.range(10)
    stages = {"even": F.col("id") % 2 == 0, "small": F.col("id") < 5, "unknown": F.lit(None).cast("boolean")}
    assert tuple(statistics.stage_counts(df, stages).first()) == (10, 5, 3, 0)


def _raw(spark):
    cell = lambda n: ([0.5] * n, 8000, None, None)
    rows = [
        (1, "train", "Goa", "One {a}", cell(4)),
        (2, "train", "Goa", "{only}", cell(4)),
        (3, "train", "Goa", "Two!", None),
        (4, "train", "Kerala", "Three", cell(4)),
        (5, "test", "Goa", "१२ 3", cell(6)),
        (6, "other", "Goa", "Six", cell(6)),
    ]
    schema = f"id long, split string, state string, transcript string, audio {AUDIO_CELL.simpleString()}"
    return spark.createDataFrame(rows, schema)


def _seen(df):
    return sorted((r.split, r.text, r.audio_size, r.corpus, r.language) for r in df.collect())


def test_ingest_transcripts(spark):
    out = ingest.ingest_transcripts(_raw(spark), "speech", "id")
    assert out.columns == TARGET.names
    assert _seen(out) == [
        ("other", "Six", 12, "speech", "gom_Deva"),
        ("test", "१२ 3", 12, "speech", "gom_Deva"),
        ("train", "One", 8, "speech", "gom_Deva"),
        ("train", "Two!", 0, "speech", "gom_Deva"),
    ]


def test_limit_comes_before_the_empty_text_filter(spark):
    out = ingest.ingest_transcripts(_raw(spark), "speech", "id", max_samples=2)
    assert [(s, t) for s, t, *_ in _seen(out)] == [("other", "Six"), ("test", "१२ 3"), ("train", "One")]


def test_ingest_generic(spark):
    out = ingest.ingest(_raw(spark), "c", "eng_Latn", "id", text_column="transcript")
    assert _seen(out) == [
        ("other", "six", 12, "c", "eng_Latn"),
        ("train", "one a", 8, "c", "eng_Latn"),
        ("train", "only", 8, "c", "eng_Latn"),
        ("train", "three", 8, "c", "eng_Latn"),
        ("train", "two", 0, "c", "eng_Latn"),
    ]
    summary = ingest.ingest_summary(out).where("split = 'train'").first()
    assert (summary.num_samples, summary.duration_hours) == (4, 24 / 16000 / 3600)


def test_rows_without_a_split_are_one_more_split(spark):
    rows = spark.createDataFrame([(i, (None, "a", "b")[i % 3]) for i in range(12)], "id int, split string")
    for n, want in ((2, 6), (100, 12)):
        kept = limits.first_rows_per_split(rows, n, None, "id").collect()
        assert sorted(r.id for r in kept) == list(range(want))
