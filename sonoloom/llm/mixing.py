"""Mixing sources to target weights: tokens per source, targets under a cap, hash-seeded repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import WORD, packed, written

#: Draws are the first 13 hex digits of an MD5 over 16**13: exact in a double and easy to repeat elsewhere.
_DIGITS = 13


def size(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame) -> DataFrame:
    """(`source`, `source_size`) with one row for each source, null included."""
    return docs.groupBy("source").agg(F.sum(size(F.col("text"))).alias("source_size"))


def ranked(sources: DataFrame) -> DataFrame:
    """`sources` with `place`, the number from 0 of its source by code point, null last.

    A range partitioning sorts; places are the rows before the own partition plus those before in it, so no
    task sees all sources and only one count for each partition goes through the driver.
    """
    order = [F.col("source").isNull(), F.encode("source", "utf-8")]
    table = written(
        sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    )
    part = F.shiftright("id", 33).cast("int")
    counts = sorted(table.groupBy(part.alias("part")).count().collect())
    before, rows = [], 0
    for number, count in counts:
        before += [F.lit(number), F.lit(rows).cast("long")]
        rows += count
    if not before:
        return table.withColumn("place", F.lit(0).cast("long")).drop("id")
    inside = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    return table.withColumn("place", F.create_map(*before)[part] + inside).drop("id")


def with_targets(sources: DataFrame, weight: Column, most: int = 3) -> DataFrame:
    """`sources` (`source`, `source_size`, ...) with `target`: its share of all sizes by weight, at most `most` x its size.

    What a cap cuts off is shared among the others by weight until none is above. With a common factor t a
    target is min(cap, t x weight). Each round takes t from the sources not capped so far and caps those
    above; t only grows, so the rounds end. One row with three sums comes to the driver in each.
    """
    table = written(sources.withColumns({"weight": weight.cast("long"), "cap": F.col("source_size") * most}))
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    factor, capped = 0.0, -1
    while True:
        above = F.col("cap") < F.lit(factor) * F.col("weight")
        sums = table.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if sums[0] == capped or not sums[2]:
            break
        capped, factor = sums[0], (total - sums[1]) / sums[2]
    share = F.lit(float(factor)) * F.col("weight")
    return table.withColumn("target", F.when(F.col("cap") < share, F.col("cap").cast("double")).otherwise(share))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the doc_id alone; rows without an id draw by their text."""
    own = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), own))
    digits = F.substring(F.md5(said.cast("binary")), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def mix(docs: DataFrame, weight: Column, most: int = 3, seed: str = "mix", broadcast_rows: int = 10_000) -> DataFrame:
    """Each row as struct `row` with `size`, `source_size`, `target` and `copies`, how often the mix takes it.

    The rate of a source is its target over its size: floor(rate) copies and one more if the row's draw is
    below the fraction. `weight` may use `place`, the source's number by code point (null last). The targets
    are broadcast if there are at most `broadcast_rows` sources, else joined; a source with most rows is
    then split by the adaptive join. Texts without words count 0 and are taken like the others of their
    source; a source without words has target 0 and no copies. Repeated rows share their draw, and rows without an id draw by
    their text, so a source of nothing but one text without ids is taken as a whole or not. An empty
    table gives no rows.
    """
    sources = with_targets(ranked(source_sizes(docs.select("source", "text"))), weight, most)
    targets = written(sources.select("source", "source_size", "target"))
    if targets.count() <= broadcast_rows:
        targets = F.broadcast(targets)
    rows = packed(docs)
    joined = rows.join(targets, F.col("row.source").eqNullSafe(F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    rate = F.coalesce(rate, F.lit(0.0))
    extra = (draw(F.col("row.doc_id"), F.col("row.text"), seed) < rate - F.floor(rate)).cast("int")
    return joined.select(
        "row", size(F.col("row.text")).alias("size"), "source_size", "target",
        (F.floor(rate).cast("int") + extra).alias("copies"),
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The rows themselves, each `copies` times, numbered from 1 by `copy`, or by `copy_` and so on if they have such a column."""
    names = mixed.schema["row"].dataType.names
    number = "copy"
    while number in names:
        number += "_"
    rows = mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_number"))
    return rows.select(*[F.col(f"row.`{n}`") for n in names], F.col("copy_number").alias(number))
