"""Benchmark decontamination: a size-partitioned MinHash containment search with exact verification.

The sketches of the items are a table. A bitmap of fixed size says which shingles of the texts may be in it; those
alone are joined with it, and the pairs found are verified in tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import gram_hashes, packed, text_chunks, word_hashes, word_spans, written

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Bits of the bitmap, 8 MB, whatever the number of items; with very many it only lets more shingles through.
_BITS = 1 << 26
#: Items that a text is verified against at a time.
_TOGETHER = 1000


def _shingles(texts: list[str], width: int):
    """For each text the hashes of its different shingles; a shorter text has one of all its words."""
    for _, data, offsets in text_chunks(pa.array(texts, pa.string())):
        data = _FOLD[data]
        starts, ends, first = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        for a, b in zip(first[:-1], first[1:]):
            yield np.unique(gram_hashes(words[a:b], min(width, max(1, b - a))))


def _words(text: str) -> list[str]:
    folded = text.encode("utf-8", "surrogatepass").translate(_FOLD.tobytes())
    return [w.decode("utf-8", "surrogatepass") for w in folded.split()]


def _strings(text: str, width: int) -> set[tuple[str, ...]]:
    words = _words(text)
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def sketch_size(shingles: int, share: float) -> int:
    """How many of the smallest hashes of an item's shingles are sketched.

    An item of n shingles that a text contains to `share` lacks at most n - ceil(share * n) of them, so one more
    than that cannot all be missing. Each size partition [2**i, 2**(i+1)) sets this for its largest size, which
    holds for every item in it. A sketch therefore misses nothing: the text is a candidate as soon as it holds
    one sketched shingle.
    """
    largest = 2 ** shingles.bit_length() - 1
    return largest - math.ceil(share * largest) + 1


def _sketches(items: DataFrame, width: int, share: float) -> DataFrame:
    """(`item`, `text`, `length`, `part`, `hashes`) of the items (`item`, `text`) that have words."""
    kind = "struct<length:int,part:int,hashes:array<bigint>>"

    @F.arrow_udf(kind)
    def sketch(texts: pa.Array) -> pa.Array:
        said = texts.to_pylist()
        lengths = [min(width, len(_words(t))) for t in said]
        sets = list(_shingles(said, width))
        hashes = [np.sort(h)[: sketch_size(len(h), share)].view(np.int64) if len(h) else [] for h in sets]
        return pa.StructArray.from_arrays(
            [pa.array(lengths, pa.int32()), pa.array([len(h).bit_length() for h in sets], pa.int32()), pa.array(hashes, pa.list_(pa.int64()))],
            names=["length", "part", "hashes"],
        )

    return items.select("item", "text", sketch("text").alias("s")).where("s.length > 0").select("item", "text", "s.*")


def _positions(hash: Column) -> Column:
    """The lowest and the highest 26 bits."""
    return F.array(hash.bitwiseAND(F.lit(_BITS - 1).cast("long")), F.shiftrightunsigned(hash, 38))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Two bits for every `hash`, as bytes; at most `_BITS` bits come to the driver."""
    at = hashes.select(F.explode(_positions(F.col("hash"))).alias("at")).select((F.col("at") + 1).alias("at"))
    blocks = at.groupBy(F.bitmap_bucket_number("at").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    out = np.zeros(_BITS // 8, np.uint8)
    for block, bits in blocks.collect():
        out[(block - 1) * len(bits) : block * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _may_be_in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    def is_set(at):
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    found = is_set(hashes & np.uint64(_BITS - 1))
    found[found] = is_set(hashes[found] >> np.uint64(38))
    return found


def _hits(lengths: list[int], bits: np.ndarray):
    """The different shingles of each text, of these lengths, that the bitmap lets through; null if there are none."""

    @F.arrow_udf("array<bigint>")
    def hits(texts: pa.Array) -> pa.Array:
        out: list[np.ndarray | None] = [None] * len(texts)
        for base, data, offsets in text_chunks(texts):
            data = _FOLD[data]
            starts, ends, first = word_spans(data, offsets)
            words = word_hashes(data, starts, ends)
            owner, held = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for length in lengths:
                hashes = gram_hashes(words, length)
                at = np.flatnonzero(_may_be_in(bits, hashes))
                text = np.searchsorted(first, at, "right") - 1
                inside = at + length <= first[text + 1]  # else the shingle runs over the text's border
                owner.append(text[inside])
                held.append(hashes[at[inside]])
            owner, held = np.concatenate(owner), np.concatenate(held).view(np.int64)
            order = np.argsort(owner, kind="stable")
            owner, held = owner[order], held[order]
            for t in np.unique(owner):
                out[base + t] = np.unique(held[np.searchsorted(owner, t) : np.searchsorted(owner, t, "right")])
        return pa.array(out, pa.list_(pa.int64()))

    return hits


def contained(text: str, items: list[tuple[bytes, str]], width: int, share: float) -> list[tuple[bytes, float]]:
    """(item, share of its shingles that are in the text), exactly, for shares that reach the limit."""
    have: dict[int, set] = {}
    words = _words(text)
    out = []
    for item, said in items:
        shingles = _strings(said, width)
        n = len(next(iter(shingles)))
        if n not in have:
            have[n] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)}
        common = len(shingles & have[n])
        if common >= share * len(shingles) - 1e-9:
            out.append((item, common / len(shingles)))
    return out


def _verified(pairs: DataFrame, width: int, share: float) -> DataFrame:
    """(`key`, `item`, `containment`) of the rows (`key`, `text`, `items`) that reach the share."""
    entry = pa.list_(pa.struct([("item", pa.binary()), ("containment", pa.float64())]))

    @F.arrow_udf("array<struct<item:binary,containment:double>>")
    def verify(texts: pa.Array, items: pa.Array) -> pa.Array:
        out = []
        for text, some in zip(texts, items):
            tested = [(x["item"], x["text"]) for x in some.as_py()]
            out.append([{"item": i, "containment": c} for i, c in contained(text.as_py(), tested, width, share)])
        return pa.array(out, entry)

    return pairs.select("key", F.inline(verify("text", "items")))


def _small(side: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(side) if rows <= most else side


def matches(
    docs: DataFrame, benchmark: DataFrame, width: int = 5, share: float = 0.8, broadcast_rows: int = 500_000
) -> DataFrame:
    """`row` (all columns of `docs`) and `found`, an array of (item_id, containment), for every row of `docs`.

    An item is found if at least `share` of its different shingles of `width` words (A to Z lower-cased,
    split at white space) occur in the text. An item with fewer words is one shingle of all its words;
    null or blank items and null or blank texts match nothing; repeated items and rows are each reported.
    Texts of any length are searched whole, equal texts once; an item_id is of any type; an empty benchmark
    finds nothing. Tables of items and of texts found are broadcast if they have at most `broadcast_rows` rows,
    else joined.
    """
    stated = benchmark.where("text is not null").select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("item"), "item_id", "text")
    items = written(_sketches(stated.groupBy("item").agg(F.first("text").alias("text")), width, share))
    entries = written(items.select("item", "part", F.explode("hashes").alias("hash")))
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most `width`
    n_items, n_entries = items.count(), entries.count()

    def key(text: Column) -> Column:
        return F.unhex(F.md5(text.cast("binary")))

    hits = _hits(lengths, _bitmap(entries))("text")
    # A filter on the hits would be pushed below them and search every text twice; a generator does not.
    read = docs.where(F.length("text") > 0).select("text", F.explode(F.array_compact(F.array(hits))).alias("hits"))
    texts = written(read.withColumn("key", key(F.col("text"))).groupBy("key").agg(F.first("text").alias("text"), F.first("hits").alias("hits")))
    pairs = (
        texts.select("key", F.explode("hits").alias("hash"))
        .join(_small(entries.select("item", "hash"), n_entries, broadcast_rows), "hash")
        .select("key", "item")
        .distinct()
    )
    pairs = pairs.join(_small(items.select("item", F.col("text").alias("said")), n_items, broadcast_rows // 10), "item")
    some = F.pmod(F.xxhash64("item"), F.lit(max(1, n_items // _TOGETHER)))
    tested = pairs.groupBy("key", some.alias("some")).agg(F.collect_list(F.struct("item", F.col("said").alias("text"))).alias("items"))
    true = _verified(texts.select("key", "text").join(written(tested), "key"), width, share)
    ids = true.join(stated.select("item", "item_id"), "item").groupBy("key")
    found = written(ids.agg(F.sort_array(F.collect_list(F.struct("item_id", "containment"))).alias("found")).withColumnRenamed("key", "k"))
    held = found.agg(F.coalesce(F.sum(F.size("found") + 1), F.lit(0))).first()[0]
    rows = packed(docs)
    joined = rows.join(_small(found, held, broadcast_rows), key(F.col("row.text")) == F.col("k"), "left")
    return joined.select("row", F.coalesce("found", F.array().cast(found.schema["found"].dataType)).alias("found"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without the rows that contain an item; the other rows as they are."""
    return matches(docs, benchmark, **options).where(F.size("found") == 0).select("row.*")
