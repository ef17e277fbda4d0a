"""Sample counts and hours. Sums stay integers until the last step, so hours are exact."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sonoloom import fixed_values as V

LEVELS = ("corpus", "language", "split")


def hours(samples: Column, rate: int = V.TARGET_RATE) -> Column:
    return samples / rate / 3600


def _sums(df: DataFrame) -> DataFrame:
    """One row per corpus, language and split; reads the partition values and audio_size only."""
    return (
        df.filter(F.col("audio_size").isNotNull())  # files without the column read as NULL [S6]
        .groupBy(*LEVELS)
        .agg(F.count("*").alias("n"), F.sum("audio_size").alias("s"))
    )


def _line(rate: int) -> list[Column]:
    return [F.sum("n").alias("num_samples"), hours(F.sum("s"), rate).alias("duration_hours")]


def _total(sums: DataFrame, rate: int) -> DataFrame:
    """The one line over everything; zero for an empty corpus."""
    n, s = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "s"))
    line = sums.agg(n.alias("num_samples"), hours(s, rate).alias("duration_hours"))
    return line.select(*(F.lit(None).cast("string").alias(c) for c in LEVELS), *line.columns)


def corpus_statistics(df: DataFrame, rate: int = V.TARGET_RATE) -> DataFrame:
    """num_samples and duration_hours per corpus, language and split. [G1]"""
    return _sums(df).select(
        *LEVELS, F.col("n").alias("num_samples"), hours(F.col("s"), rate).alias("duration_hours")
    )


def totals(df: DataFrame, rate: int = V.TARGET_RATE) -> DataFrame:
    """num_samples and duration_hours of everything, in one row. [G2, G6]"""
    known = F.col("audio_size").isNotNull()
    return df.agg(
        F.count_if(known).alias("num_samples"),
        hours(F.coalesce(F.sum("audio_size"), F.lit(0)), rate).alias("duration_hours"),
    )


def statistics_report(df: DataFrame, rate: int = V.TARGET_RATE) -> DataFrame:
    """The statistics lines and the TOTAL line (is_total = 1) in one table. [G3]

    The total is taken from the few rows of the lines; their one exchange is reused.
    """
    sums = _sums(df)
    lines = corpus_statistics(df, rate).withColumn("is_total", F.lit(0))
    return lines.unionByName(_total(sums, rate).withColumn("is_total", F.lit(1)))


def report_of_sums(df: DataFrame, rows: str, samples: str, rate: int = V.TARGET_RATE) -> DataFrame:
    """The same report from rows that are counts and sums already, such as those of whole files. [G3]"""
    sums = df.groupBy(*LEVELS).agg(F.sum(rows).alias("n"), F.sum(samples).alias("s"))
    lines = sums.select(*LEVELS, F.col("n").alias("num_samples"), hours(F.col("s"), rate).alias("duration_hours"))
    return lines.withColumn("is_total", F.lit(0)).unionByName(_total(sums, rate).withColumn("is_total", F.lit(1)))


def statistics_rollup(df: DataFrame, rate: int = V.TARGET_RATE) -> DataFrame:
    """The statistics at every level: 0 split, 1 language, 3 corpus, 7 total. [G4]"""
    sums = _sums(df)
    corpus, language, split = (F.col(c) for c in LEVELS)
    lines = sums.groupingSets(
        [[corpus, language, split], [corpus, language], [corpus]], corpus, language, split
    ).agg(*_line(rate), F.grouping_id().cast("int").alias("level"))
    return lines.unionByName(_total(sums, rate).withColumn("level", F.lit(7)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values an attribute takes. [G7]"""
    return df.select(column).distinct()


def stage_counts(df: DataFrame, stages: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows left after each stage, in one pass; a row passes a stage if it passed all before. [G8]"""
    names = list(stages)
    reached = F
    for i, name in enumerate(names):
        reached = reached.when(~F.coalesce(stages[name], F.lit(False)), i)
    rows = df.select(*by, reached.otherwise(len(names)).alias("reached"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("loaded"),
        *(F.count_if(F.col("reached") > i).alias(name) for i, name in enumerate(names)),
    )
