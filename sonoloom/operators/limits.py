"""The first N rows of a split, without moving rows.

A table has no row order, so an order key is required: one or more columns, not NULL, that
together are unique within a split. The limit is turned into a cut, the N-th smallest key,
and applied as `key <= cut`. Only keys are ranked; payloads are neither sorted nor shuffled,
and on a single-column key the largest cut reaches the Parquet scan and skips row groups.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _key(order_by: str | Sequence[str]) -> Column:
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def _name(split: Column) -> Column:
    """A key for maps: the split with a sign before it, or the empty text for rows without a split."""
    return F.coalesce(F.concat(F.lit("="), split.cast("string")), F.lit(""))


def _as_map(rows: DataFrame, value: str) -> Column:
    """`name` -> `value` of all rows, one for each split, as a scalar subquery."""
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("name", value)))).scalar()


def _cuts(keys: DataFrame, n: int) -> DataFrame:
    """(`name`, `cut`): of each name the `n`-th smallest `key`, or the largest if it has fewer.

    One hash aggregation bounds every cut from above: the largest of the smallest keys of n + 1 random
    groups is a key that more than n keys reach, if every group has one. The keys up to the bounds, some
    n * ln(n) of each name, are ranked; ranking keeps n + 1 of them in every task before it shuffles.
    """
    group = F.pmod(F.xxhash64("key"), F.lit(n + 1)).alias("group")
    smallest = keys.groupBy("name", group).agg(F.min("key").alias("key"))
    bounds = smallest.groupBy("name").agg(F.when(F.count("*") == n + 1, F.max("key")).alias("bound"))
    near = keys.filter(F.coalesce(F.col("key") <= _as_map(bounds, "bound")[F.col("name")], F.lit(True)))
    in_split = Window.partitionBy("name").orderBy(F.col("key").asc_nulls_first())
    ranked = near.withColumn("rank", F.row_number().over(in_split)).filter(F.col("rank") <= n + 1)
    cut, following = F.max(F.when(F.col("rank") <= n, F.col("key"))), F.max(F.when(F.col("rank") > n, F.col("key")))
    # "first n" is undefined without a key, or with a key shared by rows within and beyond it
    missing = F.raise_error(F.lit("the order key is NULL in some rows"))
    tied = F.raise_error(F.lit(f"the order key is not unique at row {n}"))
    cuts = F.when(F.count_if(F.col("key").isNull()) > 0, missing).when(cut == following, tied).otherwise(cut)
    return ranked.groupBy("name").agg(cuts.alias("cut"))


def cut_key(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    """One row, one column `cut`: the `n`-th smallest key, or the largest if there are fewer; NULL without rows."""
    return _cuts(df.select(F.lit("").alias("name"), _key(order_by).alias("key")), n).agg(F.max("cut").alias("cut"))


def within_first(
    df: DataFrame,
    n: int | None,
    order_by: str | Sequence[str],
    splits: Sequence[str | None] | None = None,
    split_column: str | None = "split",
) -> Column:
    """Predicate on the rows of `df`: among the first `n`, of each split if there is a `split_column`.

    Named splits alone count, or all if none are named; rows without a split are one more, named None. However many
    splits there are, their keys are read twice: for the bounds of all cuts, and for the cuts. These
    come as one map, and their largest besides, so that the scan can pass over row groups with larger keys.
    """
    key = _key(order_by)
    if split_column is None:
        return key <= cut_key(df, n, order_by).scalar() if n else F.lit(True)
    split = F.col(split_column)
    named = F.lit(True)
    if splits is not None:
        names = [s for s in splits if s is not None]
        named = F.coalesce(split.isin(names), F.lit(False)) | (split.isNull() if None in splits else F.lit(False))
    if not n:  # 0 and None both mean no limit
        return named
    cuts = _cuts(df.filter(named).select(_name(split).alias("name"), key.alias("key")), n)
    return named & (key <= cuts.agg(F.max("cut")).scalar()) & (key <= _as_map(cuts, "cut")[_name(split)])


def first_rows(df: DataFrame, n: int | None, order_by: str | Sequence[str]) -> DataFrame:
    """The first `n` rows of a table; 0 or None keeps all. [L1]"""
    return df.filter(within_first(df, n, order_by, split_column=None))


def first_rows_per_split(
    df: DataFrame,
    n: int | None,
    splits: Sequence[str] | None,
    order_by: str | Sequence[str],
    split_column: str = "split",
) -> DataFrame:
    """The rows of the named splits, or of all, of each the first `n`; 0 or None keeps all. [L1]"""
    return df.filter(within_first(df, n, order_by, splits, split_column))


def head(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """A look at the first rows. [L2]"""
    return df.orderBy(_key(order_by)).limit(n)
