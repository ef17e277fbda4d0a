"""Periodic runs of words: maximal pairs of every text, enumerated over its LCP-interval tree.

A run of period q and length L is the maximal pair of its places s and s + q with L - q words in common: the words
before them differ and those behind the common ones too. Such a pair lies in the interval of the suffix order that
shares L - q words, in two different children of it and two different classes of left words. So the intervals are
joined bottom-up, each with a list of its places for every left word, and pairs near enough to each other are runs.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import gram_hashes, packed, text_chunks, word_spans

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_FOUND = f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>"
#: With more left words than this an interval also keeps one list of all its places.
_FEW = 8


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers, from 1, for equal words only."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    letters = np.ascontiguousarray(data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)])
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1


def with_repeats(words: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the texts with `width` words that occur in them twice, and of some others perhaps."""
    n = len(words) - width + 1
    if n < 2:
        return np.empty(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    key = text[:n] << np.uint64(40) | gram_hashes(words.astype(np.uint64), width) >> np.uint64(24)
    key = np.sort(key[text[:n] == text[width - 1 :]])
    return np.unique(key[1:][key[1:] == key[:-1]] >> np.uint64(40)).astype(np.int64)


def suffix_order(symbols: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The suffixes of each text in order, text after text; each text ends with its only 0.

    Prefix doubling from two symbols on; suffixes that stand alone are not looked at again.
    """
    n, top = len(symbols), int(symbols.max(initial=0)) + 1
    following = np.append(symbols[1:], 0)
    key = (text * top + symbols) * top + following
    slots = np.arange(n)
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    places, step, key = order, 1, key[order]
    while len(slots):
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[places] = head
        order[slots] = places
        alone = new & np.append(new[1:], True)
        slots, places, head, step = slots[~alone], places[~alone], head[~alone], 2 * step
        key = head * n + rank[places + step] if len(slots) else head
        by = np.argsort(key)
        places, key = places[by], key[by]
    return order


def common_lengths(symbols: np.ndarray, order: np.ndarray, text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each place of `order` the symbols its suffix shares with the one before; 0 for the first of a text.

    Where both have the same left word it is one less than at the place before, so symbols are compared only
    at the others; all these comparisons together are at most 2 n log n.
    """
    before = np.full(len(order), -1)
    same = text[order[1:]] == text[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    compare = (before < 0) | (left != left[before])
    place = np.flatnonzero(compare & (before >= 0))
    other, shared, at = before[place], np.zeros(len(order), np.int64), 0
    while len(place) > 32:
        alike = symbols[place + at] == symbols[other + at]
        shared[place[~alike]] = at
        place, other, at = place[alike], other[alike], at + 1
    for a, b in zip(place.tolist(), other.tolist()):
        length, block = at, 64
        while True:  # ends at the separator of the later one at least
            stop = len(symbols) - max(a, b) - length
            unlike = symbols[a + length : a + length + min(block, stop)] != symbols[b + length : b + length + min(block, stop)]
            if unlike.any():
                shared[a] = length + int(unlike.argmax())
                break
            length, block = length + len(unlike), 2 * block
    source = np.maximum.accumulate(np.where(compare, np.arange(len(order)), 0))
    return (shared[source] - (np.arange(len(order)) - source))[order]


class _Interval:
    """Places of an LCP interval in order, in one list for each left word."""

    __slots__ = ("classes", "everything", "size")

    def __init__(self, place: int, left: int):
        self.classes, self.everything, self.size = {left: [place]}, None, 1

    def near(self, place: int, left: int, reach: int):
        """The nearest places, `reach` away at most, of other left words.

        Places that near share so much that they follow each other at one period, so among many classes the
        neighbours of all are enough.
        """
        if self.everything is None:
            lists = [places for word, places in self.classes.items() if word != left]
        else:
            own, lists = self.classes.get(left, ()), [self.everything]
        for places in lists:
            i = bisect_left(places, place)
            for y in places[max(0, i - 1) : i + 1]:
                if abs(y - place) <= reach and (self.everything is None or not _holds(own, y)):
                    yield y

    def take(self, other: _Interval) -> None:
        for word, places in other.classes.items():
            _merge(self.classes.setdefault(word, []), places)
            if self.everything is not None:
                _merge(self.everything, places)
        self.size += other.size
        if self.everything is None and len(self.classes) > _FEW:
            self.everything = sorted(x for places in self.classes.values() for x in places)


def _holds(places, y: int) -> bool:
    i = bisect_left(places, y)
    return i < len(places) and places[i] == y


def _merge(into: list[int], places: list[int]) -> None:
    if not into or places[0] > into[-1]:
        into += places
    elif len(places) < 8:
        for x in places:
            insort(into, x)
    else:
        into += places
        into.sort()


def _joined(a: _Interval, b: _Interval, length: int, reach: int, found: dict) -> _Interval:
    """Two children of the interval that shares `length` words; their maximal pairs at most `reach` apart are runs.

    A stretch found with several periods keeps the least, of which the others are multiples.
    """
    if a.size < b.size:
        a, b = b, a
    if len(a.classes) > 1 or a.classes.keys() != b.classes.keys():
        for word, places in b.classes.items():
            for x in places:
                for y in a.near(x, word, reach):
                    start, period = min(x, y), abs(x - y)
                    stretch = (start, start + period + length)
                    found[stretch] = min(period, found.get(stretch, period))
    a.take(b)
    return a


def _walk(places: list[int], shared: list[int], left: list[int], periods: int, found: dict) -> None:
    """Bottom-up over the LCP intervals of neighbouring suffixes, which share `shared` words with the one before.

    A pair that shares `periods` times its distance or more is a run.
    """
    open_intervals: list[tuple[int, _Interval]] = []
    done = _Interval(places[0], left[0])
    for place, length, word in zip(places[1:], shared[1:], left[1:]):
        while open_intervals and open_intervals[-1][0] >= length:
            inner, interval = open_intervals.pop()
            done = _joined(interval, done, inner, inner // periods, found)
        open_intervals.append((length, done))
        done = _Interval(place, word)
    while open_intervals:
        inner, interval = open_intervals.pop()
        done = _joined(interval, done, inner, inner // periods, found)


def find_runs(words: np.ndarray, first: np.ndarray, exponent: int = 4, least: int = 6):
    """(text, start, length, period) of all runs, by text, start and period, for a run of texts of word numbers.

    A run is a stretch with smallest period q, at least `least` and `exponent` x q words long, that no
    neighbouring word extends. Its maximal pair shares (exponent - 1) x q words or more, and `least - 1` at
    least if q is 1, so only intervals that share `shortest` words are walked, and of them only
    those with two places near enough to each other.
    """
    shortest = min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))
    texts = with_repeats(words, first, shortest)
    none = np.empty(0, np.int64)
    if not len(texts):
        return none, none, none, none
    sizes = (first[texts + 1] - first[texts]) + 1
    begin = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(begin[-1]) - begin[text]
    last = offset == sizes[text] - 1
    source = np.where(last, 0, first[texts][text] + offset)
    symbols = np.where(last, 0, words[source])
    left = np.where(offset == 0, -1 - text, np.append(0, symbols[:-1]))
    order = suffix_order(symbols, text)
    shared = common_lengths(symbols, order, text, left)
    group = np.cumsum(shared < shortest)
    many = (shared >= shortest) | np.append(shared[1:] >= shortest, False)
    slots = np.flatnonzero(many)
    if not len(slots):
        return none, none, none, none
    group, places, lengths = group[slots], order[slots], shared[slots]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    most = np.repeat(np.maximum.reduceat(np.where(lengths >= shortest, lengths, 0), head), np.diff(np.append(head, len(slots))))
    by = np.lexsort((places, group))
    near = np.append(False, (np.diff(places[by]) <= most[by][1:] // (exponent - 1)) & (group[by][1:] == group[by][:-1]))
    wanted = np.logical_or.reduceat(near, head)
    found: dict[tuple[int, int], int] = {}
    for a, b in zip(head[wanted].tolist(), np.append(head, len(slots))[1:][wanted].tolist()):
        _walk(places[a:b].tolist(), lengths[a:b].tolist(), left[places[a:b]].tolist(), exponent - 1, found)
    if not found:
        return none, none, none, none
    start, stop, period = (np.array(x) for x in zip(*((a, b, q) for (a, b), q in found.items())))
    good = stop - start >= np.maximum(least, exponent * period)
    start, stop, period = start[good], stop[good], period[good]
    by = np.lexsort((period, start))
    start, stop, period = start[by], stop[by], period[by]
    return texts[text[start]], offset[start], stop - start, period


def _collapsed(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray):
    """(bytes, lengths) of the kept words of each text, joined by one space."""
    begin, end = starts[kept], ends[kept]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[kept]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[begin] += 1
    edge[end] -= 1
    take = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    spaces = end[:-1][owner[1:] == owner[:-1]] if len(end) else end
    out = data.copy()
    out[spaces] = 32
    take[spaces] = True
    before = np.concatenate([[0], np.cumsum(take)])
    return out[take], np.diff(before[offsets])


def _finder(exponent: int, least: int):
    @F.arrow_udf(_FOUND)
    def find(texts: pa.Array) -> pa.Array:
        n_words = np.zeros(len(texts), np.int64)
        lengths = np.zeros(len(texts), np.int64)
        n_runs = np.zeros(len(texts), np.int64)
        parts, runs = [], []
        for base, data, offsets in text_chunks(texts):
            starts, ends, first = word_spans(data, offsets)
            last = base + len(offsets) - 1
            n_words[base:last] = np.diff(first)
            kept = np.ones(len(starts), bool)
            if len(starts):
                text, start, length, period = find_runs(word_numbers(data, starts, ends), first, exponent, least)
                runs.append((start, length, period))
                n_runs[base:last] = np.bincount(text, minlength=last - base)
                gone = np.zeros(len(starts) + 1, np.int64)
                np.add.at(gone, first[text] + start + period, 1)
                np.add.at(gone, first[text] + start + length, -1)
                kept = np.cumsum(gone[:-1]) == 0
            part, lengths[base:last] = _collapsed(data, offsets, starts, ends, first, kept)
            parts.append(part)
        columns = [np.concatenate(x) for x in zip(*runs)] or [np.empty(0, np.int64)] * 3
        pieces = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
        ends_of = np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32)
        at = np.concatenate([[0], np.cumsum(lengths)])
        letters = np.concatenate(parts) if parts else np.empty(0, np.uint8)
        collapsed = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at), pa.py_buffer(letters)).cast(pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.ListArray.from_arrays(pa.array(ends_of), pieces), collapsed], ["n_words", "runs", "collapsed"]
        )

    return find


def collapsed(docs: DataFrame, exponent: int = 4, least: int = 6) -> DataFrame:
    """Every row as struct `row` with `n_words`, its `runs` (start, length, period) and the `collapsed` text.

    Words are split at white space and numbered from 0. A run is a stretch of words with smallest period q,
    at least `least` and `exponent` (3 or more) x q long, that no neighbouring word extends; runs come by start, then
    period. The collapsed text is the words, joined by one space, without those that a run holds after its first q.
    Null, blank and short texts have no runs, and a null one collapses to an empty text. Texts are taken whole, in Arrow
    batches; memory grows with the longest text, and time a little more than in proportion to its words. Repeated rows are each searched,
    there are no ties to settle, an empty table gives no rows, and other columns keep their names within `row`.
    """
    if exponent < 3 or least < 2:
        raise ValueError("runs of fewer than three periods may have other pairs between those of their own")
    rows = packed(docs)
    return rows.select("row", _finder(exponent, least)(F.col("row.text")).alias("found")).select(
        "row", "found.n_words", "found.runs", "found.collapsed"
    )
