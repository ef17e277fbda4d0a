"""Spelling variants: words one error apart, by search schemes on bidirectional FM-indexes of the vocabulary.

Words one insertion, deletion or replacement apart share the first half of either unchanged, or else its second half. So
every word goes to the shards of the halves that it can share with words of its own length and of one more or less, and asks
in those of its own two halves. A shard indexes its words, each between delimiters, forwards and backwards. A scheme matches
one half exactly and then extends across the other, allowing one error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import written
from sonoloom.llm.periodic import suffix_order

_END, _DELIMITER, _FIRST = 0, 1, 2
_CHUNK = 4096


class Index:
    """Burrows-Wheeler transform of delimited words, with the counts of every symbol before each block of 64."""

    def __init__(self, symbols: np.ndarray, top: int, owner: np.ndarray):
        """`symbols` hold a delimiter before each word and after the last, then the end; `owner` is a place's word."""
        order = suffix_order(symbols, np.zeros(len(symbols), np.int64))
        last = symbols[order - 1]
        blocks = len(last) // 64 + 1
        self.bits = np.zeros((blocks, top), np.uint64)
        for s in range(top):
            packed = np.zeros(blocks * 8, np.uint8)
            packed[: (len(last) + 7) // 8] = np.packbits(last == s, bitorder="little")
            self.bits[:, s] = packed.view("<u8")
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.zeros((blocks, top), np.int32)
        np.cumsum(counts[:-1], axis=0, out=self.before[1:])
        self.first = np.concatenate([[0], np.cumsum(counts.sum(axis=0))])
        #: Words that the suffixes from a delimiter on start with, in order of the suffixes.
        self.words = owner[order[self.first[_DELIMITER] : self.first[_DELIMITER + 1]]]

    def ranks(self, i: np.ndarray) -> np.ndarray:
        """How often each symbol is before each i."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.bits[i >> 6] & below[:, None])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6, symbol] + np.bitwise_count(self.bits[i >> 6, symbol] & below)

    def extend(self, symbol: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals (low, size) with one symbol more on this index's side."""
        start = self.rank(symbol, low)
        return self.first[symbol] + start, self.rank(symbol, low + size) - start


def _exact(one: Index, two: Index, halves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Intervals in `two` of halves that are matched in `one`, symbol by symbol; both are kept in step.

    With a symbol more on one side, the interval on the other moves by the number of smaller symbols there.
    """
    n, steps = len(halves), max(map(len, halves))
    said = np.full((n, steps), -1, np.int64)
    for i, half in enumerate(halves):
        said[i, : len(half)] = half
    low, other, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, one.first[-1], np.int64)
    for step in range(steps):
        on = np.flatnonzero((said[:, step] >= 0) & (size > 0))
        symbol = said[on, step]
        start = one.ranks(low[on])
        inside = one.ranks(low[on] + size[on]) - start
        rows = np.arange(len(on))
        other[on] += np.cumsum(inside, axis=1)[rows, symbol] - inside[rows, symbol]
        low[on] = one.first[symbol] + start[rows, symbol]
        size[on] = inside[rows, symbol]
    return other, size


def one_error(one: Index, two: Index, patterns: list[np.ndarray], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, row) of the words that share a pattern's first `halves` symbols and have one error in the rest.

    `two` extends words in reading order, `one` against it. `row` numbers `two.words`. Each word is found once: of equal symbols in
    a row the last is the one that goes, and a new one comes behind those that equal it.
    """
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for at in range(0, len(patterns), _CHUNK):
        some, half = patterns[at : at + _CHUNK], halves[at : at + _CHUNK]
        low, size = _exact(one, two, [np.append(p[:h][::-1], _DELIMITER) for p, h in zip(some, half.tolist())])
        lengths = np.array([len(p) for p in some]) - half
        rest = np.full((len(some), int(lengths.max()) + 2), _DELIMITER, np.int64)
        for i, (p, h) in enumerate(zip(some, half.tolist())):
            rest[i, : len(p) - h] = p[h:]
        pattern = np.flatnonzero(size > 0)
        low, size, with_error, j = low[pattern], size[pattern], [], 0
        while len(pattern):
            start = two.ranks(low)
            inside = two.ranks(low + size) - start
            more = j < lengths[pattern]
            symbol = rest[pattern, j]
            # The word lacks the symbol.
            gone = np.flatnonzero(more & (symbol != rest[pattern, j + 1]))
            with_error.append((pattern[gone], np.full(len(gone), j + 1), low[gone], size[gone]))
            # It has another one, in its place or before it.
            row, other = np.nonzero(inside[:, _FIRST:])
            other += _FIRST
            unlike = other != symbol[row]
            row, other = row[unlike], other[unlike]
            new = (pattern[row], two.first[other] + start[row, other], inside[row, other].astype(np.int64))
            with_error.append((new[0], np.full(len(row), j), *new[1:]))
            also = more[row]
            with_error.append((new[0][also], np.full(int(also.sum()), j + 1), new[1][also], new[2][also]))
            on = np.flatnonzero(more)
            low = two.first[symbol[on]] + start[on, symbol[on]]
            size = inside[on, symbol[on]].astype(np.int64)
            alive = size > 0
            pattern, low, size, j = pattern[on][alive], low[alive], size[alive], j + 1
        if not with_error:
            continue
        pattern, place, low, size = (np.concatenate(x) for x in zip(*with_error))
        while len(pattern):
            done = place == lengths[pattern]
            low, size = two.extend(rest[pattern, place], low, size)
            hit = done & (size > 0)
            found.append((pattern[hit] + at, low[hit] - two.first[_DELIMITER]))
            alive = ~done & (size > 0)
            pattern, place, low, size = pattern[alive], place[alive] + 1, low[alive], size[alive]
    return tuple(np.concatenate(x) for x in zip(*found))


def _delimited(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, word that starts behind each delimiter, or -1) of the words in their order."""
    lengths = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    symbols = np.full(starts[-1] + 2, _DELIMITER, np.int64)
    symbols[-1] = _END
    owner = np.full(len(symbols), -1, np.int64)
    owner[starts[:-1]] = np.arange(len(words))
    letters = np.concatenate(words)
    symbols[np.arange(len(letters)) + np.repeat(np.arange(1, len(words) + 1), lengths)] = letters
    return symbols, owner


def near_pairs(words: list[str], first: list[int], second: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(asking word, word one error away) by number; `first` ask with their first half, `second` with their second.

    A word that shares the first half is left to `first`.
    """
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    alphabet, codes = np.unique(letters, return_inverse=True)
    ends = np.cumsum([len(w) for w in words])
    coded = np.split(codes.astype(np.int64) + _FIRST, ends[:-1])
    turned = [w[::-1] for w in coded]
    top = len(alphabet) + _FIRST
    forwards, backwards = (Index(*(lambda s, o: (s, top, o))(*_delimited(x))) for x in (coded, turned))
    # A search from left to right goes through the words turned round.
    half = np.array([len(w) // 2 for w in words])
    asks = np.array(first, np.int64)
    pattern, row = one_error(forwards, backwards, [coded[i] for i in first], half[asks]) if first else (asks, asks)
    pairs = [(asks[pattern], backwards.words[row])]
    asks = np.array(second, np.int64)
    lengths = np.array([len(w) for w in words])
    pattern, row = one_error(backwards, forwards, [turned[i] for i in second], (lengths - half)[asks]) if second else (asks, asks)
    a, b = asks[pattern], forwards.words[row]
    new = np.fromiter((words[x][: half[x]] != words[y][: half[x]] for x, y in zip(a.tolist(), b.tolist())), bool, len(a))
    pairs.append((a[new], b[new]))
    return tuple(np.concatenate(x) for x in zip(*pairs))


def _search(table: pa.Table) -> pa.Table:
    """The words of a shard that ask and have near ones: their number and the one of largest n."""
    said, ns = table.column("word").to_pylist(), table.column("n").to_numpy()
    text, kind, asks = (table.column(c).to_pylist() for c in ("text", "kind", "asks"))
    held = sorted({w for w, t, a in zip(said, text, asks) if t or a})  # by code point
    number = {w: i for i, w in enumerate(held)}
    n = np.zeros(len(held), np.int64)
    in_text = np.zeros(len(held), bool)
    for w, c, t in zip(said, ns.tolist(), text):
        n[number[w]] = c
        in_text[number[w]] |= t
    first = sorted({number[w] for w, k, a in zip(said, kind, asks) if a and k == "first"})
    second = sorted({number[w] for w, k, a in zip(said, kind, asks) if a and k == "second"})
    a, b = near_pairs(held, first, second)
    a, b = a[in_text[b]], b[in_text[b]]
    by = np.lexsort((b, -n[b], a))
    a, b = a[by], b[by]
    head = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    return pa.table(
        {
            "word": pa.array([held[i] for i in a[head].tolist()], pa.string()), "n": pa.array(n[a[head]]),
            "n_near": pa.array(np.diff(np.append(head, len(a)))), "best": pa.array([held[i] for i in b[head].tolist()], pa.string()),
            "best_n": pa.array(n[b[head]]),
        }
    )


def counted(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(`word`, `n`) of the words that are long and frequent enough; `words` has one row an occurrence."""
    long = words.select("word").where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def neighbours(vocabulary: DataFrame, shard_entries: int = 40_000) -> DataFrame:
    """(`word`, `n`, `n_near`, `best`, `best_n`) of every word: how many are one error away, and the largest n of them.

    `vocabulary` (`word`, `n`) has each word once, of 4 code points or more. A shard has some `shard_entries` words. A half that more words than
    that share is a matter of its own: its words are dealt into slices by their hash, and every slice is
    asked by every slice, so that no task holds more.
    """
    m = F.length("word")
    halves = []
    for kind, shift in (("first", 0), ("second", 1)):
        own = F.shiftright(m + shift, 1)
        for length, asks in ((own, True), (F.when(m % 2 == shift, own - 1).otherwise(own + 1), False)):
            halves.append((kind, length, asks))
    parts = []
    for kind, length, asks in halves:
        half = F.substring("word", 1, length) if kind == "first" else F.substring("word", m - length + 1, length)
        parts.append(F.struct(F.lit(kind).alias("kind"), half.alias("half"), F.lit(asks).alias("asks")))
    entries = written(vocabulary.select("word", "n", F.inline(F.array(*parts))))
    sizes = entries.groupBy("kind", "half").agg(F.count("*").alias("entries")).where(F.col("entries") > shard_entries)
    hot = written(sizes.select(F.col("kind").alias("k"), F.col("half").alias("h"), F.ceil(F.col("entries") / shard_entries).alias("slices")))
    shards = max(1, math.ceil(entries.count() / shard_entries))
    shard = F.pmod(F.xxhash64("kind", "half"), F.lit(shards))
    dealt = entries.select(F.lit("").alias("own"), shard.alias("shard"), "kind", "word", "n", "asks", F.lit(True).alias("text"))
    if hot.count():
        joined = entries.join(hot, (F.col("kind") == F.col("k")) & (F.col("half") == F.col("h")), "left")
        slice_ = F.pmod(F.xxhash64("word"), F.col("slices"))
        every = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
        own = F.concat("kind", F.lit(":"), "half")
        as_text = F.transform(every, lambda s: F.struct((slice_ * F.col("slices") + s).alias("shard"), F.lit(True).alias("text"), F.lit(False).alias("asks")))
        as_asking = F.transform(every, lambda s: F.struct((s * F.col("slices") + slice_).alias("shard"), F.lit(False).alias("text"), F.lit(True).alias("asks")))
        both = F.when(F.col("asks"), F.concat(as_text, as_asking)).otherwise(as_text)
        alone = joined.where("slices is not null").select(own.alias("own"), "kind", "word", "n", F.inline(both))
        others = joined.where("slices is null").select(F.lit("").alias("own"), shard.alias("shard"), "kind", "word", "n", "asks", F.lit(True).alias("text"))
        dealt = others.unionByName(alone)
    found = dealt.groupBy("own", "shard").applyInArrow(_search, "word string, n bigint, n_near bigint, best string, best_n bigint")
    rows = found.unionByName(
        vocabulary.selectExpr("word", "n", "0L AS n_near", "cast(null AS string) AS best", "cast(null AS bigint) AS best_n")
    )
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    return rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(`word`, `root`) of the words with a `form`. Each round doubles the steps, so rounds grow with the log of the longest way."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("w"), F.col("root").alias("further"))
        joined = written(now.join(ahead, F.col("root") == F.col("w"), "left").select("word", "root", "further"))
        if not joined.where("further is not null").limit(1).count():
            return now
        now = joined.select("word", F.coalesce("further", "root").alias("root"))


def variants(vocabulary: DataFrame, ratio: int = 2, **options) -> DataFrame:
    """(`word`, `form`, `root`, `n`, `n_near`, `form_n`) of every word of the `vocabulary` (`word`, `n`).

    Near are words that differ by exactly one inserted, deleted or replaced code point. The form is the near word of
    largest n, of equal ones the smallest by code point, if its n is at least `ratio` (2 or more) times that of the word;
    else null. The root is where the forms lead in the end, the word itself without one. An empty vocabulary gives no
    rows; a word comes once, so repeated rows are for `counted` to join; null words are to be left out before.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent, or they may go round in circles")
    rows = neighbours(vocabulary, **options)
    fits = F.col("best_n") >= ratio * F.col("n")
    table = written(rows.select("word", "n", "n_near", F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")))
    roots = _roots(table.where("form is not null")).withColumnRenamed("word", "w")
    return table.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
