"""Substring deduplication: FM-indexes of shards, through which the documents' segments are streamed.

Sending every document to every shard would square the work, so a shard holds what can match in it. Each
window of words belongs to its anchor, the word group in it with the smallest hash: windows with the same
words have the same anchor. Neighbouring windows with one anchor form a segment, and a segment whose anchor
occurs nowhere else is done with. The others go to the shard of their anchor, which builds a compressed
FM-index of its different segments and streams them through it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import content_key, gram_hashes, packed, text_chunks, word_hashes, word_spans, written
from sonoloom.llm.fm_index import FMIndex, repeated_windows

_RUN = "array<struct<anchor:bigint,start:int,n:int,uses:bigint>>"
_PLACE_BITS = np.uint64(30)
_BATCH_BYTES = 4_000_000


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values: of two block-wise running minima."""
    count = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchored_runs(words: np.ndarray, first: np.ndarray, window: int, gram: int):
    """(text, start, n, anchor) of the runs of consecutive windows that share an anchor, for a run of texts."""
    grams = gram_hashes(words, gram)
    none = np.empty(0, np.int64)
    if len(words) < window:
        return none, none, none, none
    place = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least(grams >> _PLACE_BITS << _PLACE_BITS | place, window - gram + 1)
    at = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(at)]
    valid = np.arange(len(at)) + window <= first[text + 1]
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
    begin = np.flatnonzero(change)
    n = np.diff(np.append(begin, len(at)))
    good = valid[begin]
    begin, n = begin[good], n[good]
    return text[begin], begin - first[text[begin]], n, grams[at[begin]].view(np.int64)


def _runs_of(window: int, gram: int):
    def runs(batches):
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column("text")):
                starts, ends, first = word_spans(data, offsets)
                text, start, n, anchor = anchored_runs(word_hashes(data, starts, ends), first, window, gram)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pc.take(batch.column("key"), pa.array(text + row)), pa.array(anchor),
                            pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                        ],
                        ["key", "anchor", "start", "n"],
                    )

    return runs


def _segments_of(window: int, hot: int, with_words: bool):
    """Segments of the texts in rows (key, text, runs): whole runs, or single windows where an anchor is hot."""

    def segments(batches):
        names = ["segment", "shard", "key", "start", *["words"] * with_words]
        for batch in batches:
            held: list[list] = [[] for _ in names]
            size = 0
            for key, text, runs in zip(batch.column("key"), batch.column("text"), batch.column("runs")):
                words, key = text.as_py().encode("utf-8", "surrogatepass").split(), key.as_py()
                for run in runs.as_py():
                    begin, n, shard = run["start"], run["n"], run["anchor"]
                    parts = [(begin, n)] if run["uses"] <= hot else [(begin + i, 1) for i in range(n)]
                    for at, count in parts:
                        joined = b" ".join(words[at : at + count + window - 1])
                        digest = hashlib.md5(joined, usedforsecurity=False).digest()
                        if run["uses"] > hot:
                            shard = int.from_bytes(digest[:8], "little", signed=True)
                        for column, value in zip(held, (digest, shard, key, at, joined)):
                            column.append(value)
                        size += 40 + len(joined) * with_words
                    if size >= _BATCH_BYTES:
                        yield _segment_batch(held, names)
                        held, size = [[] for _ in names], 0
            if held[0]:
                yield _segment_batch(held, names)

    return segments


def _segment_batch(held: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names)


def _shard_matches(window: int):
    """Index the different segments of a shard, stream them through it, report their repeated windows."""

    def matches(table: pa.Table) -> pa.Table:
        data = b" ".join(x.as_py() for x in table.column("words"))
        uses = table.column("uses").to_numpy()
        words = data.split()
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int64, len(words))
        lengths = np.fromiter((x.as_py().count(b" ") + 1 for x in table.column("words")), np.int64, len(uses))
        ends = np.cumsum(lengths + 1) - 1  # each segment is followed by a separator
        starts = ends - lengths
        symbols = np.zeros(int(ends[-1]) + 1, np.int64)
        symbols[np.arange(len(ids)) + np.repeat(np.arange(len(uses)), lengths)] = ids
        alone = uses == 1
        if len(uses) > 1 and alone.any():
            marked = repeated_windows(FMIndex(symbols), symbols, starts[alone], ends[alone], window)
        else:
            marked = np.zeros(len(symbols), bool)
        for s, e in zip(starts[~alone], ends[~alone]):
            marked[s : e - window + 1] = True
        edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
        begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(starts, begins, "right") - 1
        return pa.table(
            {
                "segment": pc.take(table.column("segment"), pa.array(owner)),
                "offset": pa.array((begins - starts[owner]).astype(np.int32)),
                "n": pa.array((stops - begins).astype(np.int32)),
            }
        )

    return matches


def candidates(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(`key`, `text`, `runs`) for the different texts with runs whose anchor occurs again anywhere."""
    texts = docs.where("text is not null").select(content_key("text").alias("key"), "text")
    # The filter drops nothing: the join on the key asks for it, and with it everywhere the texts are shuffled only once.
    texts = texts.groupBy("key").agg(F.first("text").alias("text")).where("key is not null")
    runs = texts.mapInArrow(_runs_of(window, gram), "key binary, anchor bigint, start int, n int")
    # Dealt anew, so that it is no aggregation in the join: adaptive execution then splits an anchor of very many runs.
    again = runs.groupBy("anchor").agg(F.count("*").alias("uses")).where("uses > 1").repartition(F.xxhash64("anchor"))
    lists = (
        runs.join(again, "anchor")
        .groupBy("key")
        .agg(F.collect_list(F.struct("anchor", "start", "n", "uses")).cast(_RUN).alias("runs"))  # of one text
    )
    return texts.join(lists, "key").select("key", "text", "runs")


def repeated_intervals(
    found: DataFrame, window: int = 35, hot: int = 4000, shard_words: int = 600_000
) -> DataFrame:
    """(`key`, `start`, `n`): n windows from word `start` of a candidate text whose words occur elsewhere too.

    There are as many shards as give each some `shard_words` words. An anchor with more than `hot` uses
    would fill its shard, so its windows are segments of their own, dealt by their words: equal ones still
    meet, and each is held once. Equal segments are joined before the shuffle.
    """
    total = found.agg(F.sum(F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["n"] + window))).first()[0]
    shards = max(1, math.ceil((total or 0) / shard_words))
    schema = "segment binary, shard bigint, key binary, start int"
    pieces = found.mapInArrow(_segments_of(window, hot, True), f"{schema}, words binary")
    different = (
        pieces.groupBy("segment")
        .agg(F.first("words").alias("words"), F.first("shard").alias("shard"), F.count("*").alias("uses"))
        .withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(shards)))
    )
    matched = written(
        different.groupBy("shard").applyInArrow(_shard_matches(window), "segment binary, offset int, n int")
    )
    places = found.mapInArrow(_segments_of(window, hot, False), schema).select("segment", "key", "start")
    return places.join(matched, "segment").select("key", (F.col("start") + F.col("offset")).alias("start"), "n")


def _kept(window: int):
    def kept(batches):
        for batch in batches:
            texts, removed = [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(words) + 1, np.int32)
                for span in spans.as_py():
                    gone[span["start"]] += 1
                    gone[span["start"] + span["n"] + window - 1] -= 1
                stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                texts.append(b" ".join([words[i] for i in stay.tolist()]).decode("utf-8", "surrogatepass"))
                removed.append(len(words) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(texts, pa.string()), pa.array(removed, pa.int64())],
                ["key", "kept", "n_removed"],
            )

    return kept


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def deduplicated(docs: DataFrame, window: int = 35, gram: int = 10, **options) -> DataFrame:
    """Every row as struct `row` with `n_words`, `n_removed`, the `kept` words and their SHA-256.

    A word is removed if a window of `window` words that covers it starts anywhere else too, in the same
    text or another; all copies go. Repeated rows are copies of each other, so a text of `window` words or
    more that occurs twice keeps nothing. Null and blank texts have no words; their kept text is empty.
    """
    found = written(candidates(docs, window, gram))
    spans = (
        repeated_intervals(found, window, **options)
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "n")).alias("spans"))  # of one text
    )
    cut = (
        found.select("key", "text")
        .join(spans, "key")
        .mapInArrow(_kept(window), "key binary, kept string, n_removed bigint")
        .select(F.col("key").alias("k"), F.col("kept").alias("part"), "n_removed", _digest(F.col("kept")).alias("digest"))
    )
    copies = docs.where("text is not null").groupBy(content_key("text").alias("c")).count().where("count > 1").select("c")
    rows = packed(docs).select(
        "row", content_key("row.text").alias("key"), F.trim(F.regexp_replace(F.coalesce("row.text", F.lit("")), r"[\x20\x09-\x0D]+", " ")).alias("all"),
    )
    spaces = F.octet_length("all") - F.octet_length(F.replace("all", F.lit(" "), F.lit("")))
    n_words = F.when(F.col("all") == "", F.lit(0)).otherwise(spaces + 1).cast("long")
    rows = rows.select("row", "key", "all", n_words.alias("n_words"), _digest(F.col("all")).alias("all_digest"))
    joined = rows.join(cut, F.col("key") == F.col("k"), "left").join(copies, F.col("key") == F.col("c"), "left")
    twice = F.col("c").isNotNull() & (F.col("n_words") >= window)
    empty = F.lit(hashlib.sha256().hexdigest())
    return joined.select(
        "row", "n_words",
        F.when(twice, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(twice, F.lit("")).otherwise(F.coalesce("part", "all")).alias("kept"),
        F.when(twice, empty).otherwise(F.coalesce("digest", "all_digest")).alias("kept_sha256"),
    )
