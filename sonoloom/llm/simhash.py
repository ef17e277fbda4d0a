"""SimHash near-duplicates: 64-bit fingerprints linked within a few bits through pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sonoloom.llm.common import packed, written
from sonoloom.llm.components import connected_components

BITS = 64
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _fingerprint(text: str | None, width: int, seed: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], seed) for s, e in zip(starts.tolist(), ends[width - 1 :].tolist())]
    totals = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 65536):
        part = np.array(hashes[first : first + 65536], dtype=">u8")
        totals += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * totals > len(hashes)).tobytes(), "big", signed=True)


def fingerprint(text: Column, width: int = 3, seed: int = 42) -> Column:
    """The SimHash of a text as a long: bit i is set if over half of the shingle hashes have it.

    A to Z are lower-cased; a shingle is `width` words, repeats included; a shorter text is one shingle;
    a null or blank text has fingerprint 0.
    """

    @F.arrow_udf(LongType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t.as_py(), width, seed) for t in texts], pa.int64())

    return of(text)


def linked(prints: DataFrame, max_distance: int = 2, blocks: int = 5, hot: int = 64) -> DataFrame:
    """(`a`, `b`) links that connect exactly the fingerprints `fp` within `max_distance` bits.

    Pigeonhole: of `blocks` blocks at least blocks - max_distance are equal, so each such choice of
    blocks is a key to join on, and pairs are then checked by their Hamming distance. A block with more
    than `hot` different fingerprints gives no pairs: its members meet in the balls instead, all
    fingerprints within max_distance // 2 flips. Two that share a centre are close, and for an even
    distance any two close ones share one, so hanging each centre's members on the smallest one loses no
    connection and makes no pairs. An odd distance adds the ball of the lower radius around one side.
    """
    if max_distance % 2:
        raise ValueError("an even distance is asked for")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for chosen in combinations(range(blocks), blocks - max_distance):
        mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(len(keys)).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("part")))
    members = prints.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.*")
    sizes = members.groupBy("choice", "part").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(members.join(sizes, ["choice", "part"]))
    cool = shared.where(F.col("n") <= hot)
    pairs = (
        cool.select("choice", "part", F.col("fp").alias("a"))
        .join(cool.select("choice", "part", F.col("fp").alias("b")), ["choice", "part"])
        .where("a > b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
        .select("a", "b")
    )
    flips = [0]
    for n in range(1, max_distance // 2 + 1):
        flips += [sum(1 << i for i in chosen) for chosen in combinations(range(BITS), n)]
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in flips]
    balls = (
        shared.where(F.col("n") > hot)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array(*[F.lit(x) for x in signed])).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    )
    hubs = balls.groupBy("centre").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1")
    hung = balls.join(hubs.select("centre", "hub"), "centre").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return pairs.union(hung.where("a <> b")).distinct()


def near_duplicates(
    docs: DataFrame, max_distance: int = 2, width: int = 3, seed: int = 42, blocks: int = 5
) -> DataFrame:
    """Every row's `doc_id` with its `fp`, its class `root` (a fingerprint) and the class's smallest doc_id.

    Null and blank texts have fingerprint 0 and are linked like any other. A null doc_id counts for no
    minimum: a class of such rows only has a null `component_id`. Repeated rows stay and share a class.
    An empty table gives no rows. Other columns of `docs` are not read.
    """
    marked = written(docs.select("doc_id", fingerprint(F.col("text"), width, seed).alias("fp")))
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(linked(least.select("fp"), max_distance, blocks))
    classes = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.select("fp", "root").join(smallest, "root")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_first(docs: DataFrame, max_distance: int = 2, width: int = 3, seed: int = 42, blocks: int = 5) -> DataFrame:
    """`docs` with one row of each class of near duplicates: that with the smallest doc_id.

    Rows that repeat this doc_id, or have none, are put in order by their text, nulls last. Exactly one
    row of a class stays, with all its columns as they are.
    """
    table = written(
        packed(docs).withColumns(
            {"fp": fingerprint(F.col("row.text"), width, seed), "number": F.monotonically_increasing_id()}
        )
    )
    roots = connected_components(linked(table.select("fp"), max_distance, blocks))
    place = F.struct(
        F.col("row.doc_id").isNull().alias("no_id"),
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.text").isNull().alias("no_text"),
        F.sha2(F.coalesce("row.text", F.lit("")).cast("binary"), 256).alias("digest"),
        "number",
    )
    first = (
        table.select("fp", place.alias("place"))
        .join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("place").alias("place"))
        .select(F.col("place.number").alias("number"))
    )
    return table.join(first, "number", "left_semi").select("row.*")
