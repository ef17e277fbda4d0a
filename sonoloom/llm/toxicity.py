"""Toxicity by a classifier chain: each category's linear model also sees the earlier categories' probabilities."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from sonoloom.llm.common import mixed, text_chunks, word_hashes, word_spans

BUCKETS = 1 << 18
_MARGIN = 1.0
#: A threshold that no probability reaches.
_NEVER = 2.0
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _features(column: pa.Array, buckets: int):
    """(first row, bucket of each different word, texts' borders) in runs of whole texts."""
    for first, data, offsets in text_chunks(column):
        data = _FOLD[data]
        starts, ends, borders = word_spans(data, offsets, _LETTERS)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(borders))
        present = np.unique(text * buckets + (word_hashes(data, starts, ends) % np.uint64(buckets)).astype(np.int64))
        text = present // buckets
        yield first, present % buckets, np.searchsorted(text, np.arange(len(offsets)))


@dataclass
class Chain:
    """Weights of one linear model per category; model i has i more weights, for the earlier categories' log-odds."""

    categories: list[str]
    buckets: int
    words: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)
    bias: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def score(self, bucket: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """Probabilities, a row for each text and a column for each category."""
        logits = np.empty((len(borders) - 1, 0))
        for words, earlier, bias in zip(self.words, self.earlier, self.bias):
            logit = _sums(words[bucket], borders) + logits @ earlier + bias
            logits = np.column_stack([logits, _bounded(logit)])
        return 1 / (1 + np.exp(-logits))


def _bounded(logit: np.ndarray) -> np.ndarray:
    return np.clip(logit, -8, 8)


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return running[borders[1:]] - running[borders[:-1]]


def _groups(lists: list[np.ndarray], buckets: int, signs: int = 3, rare: float = 0.01) -> np.ndarray:
    """A group for each text: that of the first before it that shares two MinHash signs of the rare words."""
    shown = np.bincount(np.concatenate([*lists, np.empty(0, np.int64)]), minlength=buckets)
    keys = [mixed(np.arange(buckets, dtype=np.uint64) + np.uint64((i + 1) << 32)) for i in range(signs)]
    seen: dict[tuple, int] = {}
    out, groups = np.empty(len(lists), np.int64), 0
    for place, words in enumerate(lists):
        few = words[shown[words] <= max(2, rare * len(lists))]
        sign = tuple(int(few[np.argmin(k[few])]) for k in keys) if len(few) else ()
        near = [(i, j, sign[i], sign[j]) for i in range(len(sign)) for j in range(i)]
        group = next((seen[x] for x in near if x in seen), groups)
        groups += group == groups
        out[place] = group
        for x in near:
            seen.setdefault(x, group)
    return out


def _telling(bucket, text, target, weight, buckets):
    """Buckets that go with the category by more than chance would give the best of as many buckets.

    The measure is the root of the likelihood ratio between the category's rate among the texts with the
    bucket and among all; the bound for m buckets is the root of 2 ln m, times a margin.
    Texts count by `weight`.
    """
    total = np.bincount(bucket, weight[text], buckets)
    inside = np.bincount(bucket, (weight * (target > 0))[text], buckets)
    rate = min(max(float(weight @ target / weight.sum()) if len(target) else 0.5, 1e-9), 1 - 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.nan_to_num(inside * np.log(inside / (total * rate)))
        outside = np.maximum(total - inside, 0)
        ratio += np.nan_to_num(outside * np.log(outside / (total * (1 - rate))))
    return 2 * ratio >= _MARGIN * 2 * np.log(max(2, np.count_nonzero(total)))


def _fit(bucket, borders, extra, target, weight, buckets, rounds=120, rate=0.3, decay=1e-4):
    """Logistic regression by AdaGrad over all rows at once, by weight, on the telling words; weights shrink each round."""
    text = np.repeat(np.arange(len(target)), np.diff(borders))
    telling = _telling(bucket, text, target, weight, buckets)
    keep = telling[bucket]
    bucket, text = bucket[keep], text[keep]
    borders = np.searchsorted(text, np.arange(len(target) + 1))
    words, earlier, bias = np.zeros(buckets), np.zeros(extra.shape[1]), 0.0
    seen_w, seen_e, seen_b = np.full(buckets, 1e-8), np.full(extra.shape[1], 1e-8), 1e-8
    for _ in range(rounds):
        logit = _sums(words[bucket], borders) + extra @ earlier + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) * weight / max(1.0, weight.sum())
        grad = np.bincount(bucket, error[text], buckets) + decay * words
        grad_e, grad_b = extra.T @ error, error.sum()
        seen_w += grad**2
        seen_e += grad_e**2
        seen_b += grad_b**2
        words -= rate * grad / np.sqrt(seen_w)
        earlier -= rate * grad_e / np.sqrt(seen_e)
        bias -= rate * grad_b / np.sqrt(seen_b)
    return words, earlier, bias


def _threshold(probability: np.ndarray, target: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1 by weight on out-of-fold probabilities; of equal ones the middle of the gap."""
    order = np.argsort(-probability, kind="stable")
    p, hits, called = probability[order], np.cumsum((weight * target)[order]), np.cumsum(weight[order])
    if not len(p) or not hits[-1]:
        return _NEVER
    last = np.append(p[1:] < p[:-1], True)  # equal probabilities fall on one side
    f1 = np.where(last, 2 * hits / (called + hits[-1]), -1)
    best = int(np.argmax(f1))
    return float((p[best] + (p[best + 1] if best + 1 < len(p) else p[best])) / 2)


def fit_chain(
    docs: DataFrame, labels: DataFrame, targets: dict[str, Column], max_rows: int = 15_000, folds: int = 3,
    buckets: int = BUCKETS,
) -> Chain:
    """Train the chain on a sample of at most `max_rows` labelled rows.

    `targets` maps each category, in chain order, to a condition on `labels`. The sample holds the rows
    with the smallest hashes of their doc_id, so it is the same in each run; its word buckets, not its
    texts, come to the driver. Rows whose doc_id, text or label is null are not trained on; a doc_id that
    is labelled twice counts twice. Earlier probabilities that a model is trained on come from models that
    did not see the row. Near copies are all trained on, in one fold, and weigh as much as one row together;
    equal hashes of the sample are ordered by label. Without labels every probability is 1/2 and no threshold is reached.
    """
    named = labels.where(F.col("doc_id").isNotNull()).select(
        "doc_id", *[c.cast("int").alias(f"y{i}") for i, c in enumerate(targets.values())]
    ).dropna()
    chosen = named.orderBy(F.xxhash64("doc_id"), *named.columns).limit(max_rows)

    def bucketed(batches):
        for batch in batches:
            rows = [None] * len(batch)
            for first, bucket, borders in _features(batch.column("text"), buckets):
                for i in range(len(borders) - 1):
                    rows[first + i] = bucket[borders[i] : borders[i + 1]].astype(np.int32)
            kept = [batch.column(n) for n in batch.schema.names if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.int32()))], [*names, "bucket"])

    ys = [f"y{i}" for i in range(len(targets))]
    sample = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most max_rows rows of a few numbers
        .select("doc_id", *ys, "text")
        .mapInArrow(bucketed, "doc_id long, " + ", ".join(f"{y} int" for y in ys) + ", bucket array<int>")
        .orderBy(F.xxhash64("doc_id"), F.xxhash64("bucket"), *ys)
        .limit(max_rows)
        .toArrow()
    )
    chain = Chain(list(targets), buckets)
    lists = [x.values.to_numpy().astype(np.int64) for x in sample.column("bucket")]
    group = _groups(lists, buckets)
    weight = 1 / np.bincount(group)[group] if len(group) else np.empty(0)
    borders = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
    flat = np.concatenate([*lists, np.empty(0, np.int64)])
    fold = group % folds
    logits = np.empty((len(lists), 0))
    for y in ys:
        target = sample.column(y).to_numpy().astype(float)
        held = np.zeros(len(lists))
        for k in range(folds):
            train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            words, earlier, bias = _fit(*_rows(lists, train), logits[train], target[train], weight[train], buckets)
            flat_k, borders_k = _rows(lists, test)
            held[test] = _bounded(_sums(words[flat_k], borders_k) + logits[test] @ earlier + bias)
        words, earlier, bias = _fit(flat, borders, logits, target, weight, buckets)
        chain.words.append(words.astype(np.float32))
        chain.earlier.append(earlier)
        chain.bias.append(float(bias))
        tells = bool(words.any())  # else all texts have one probability, and none is called out
        chain.thresholds.append(_threshold(1 / (1 + np.exp(-held)), target, weight) if tells else _NEVER)
        logits = np.column_stack([logits, held])
    return chain


def _rows(lists, chosen):
    part = [lists[i] for i in chosen]
    return np.concatenate([*part, np.empty(0, np.int64)]), np.concatenate(
        [[0], np.cumsum([len(x) for x in part], dtype=np.int64)]
    ).astype(np.int64)


def probabilities(text: Column, chain: Chain) -> Column:
    """The chain's probabilities of a text as an array, in chain order; a null text counts as empty.

    The weights, of a fixed number whatever the corpus, travel with the function.
    """
    @F.arrow_udf(ArrayType(DoubleType()))
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for _, bucket, borders in _features(texts, chain.buckets):
            out.extend(chain.score(bucket, borders).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    return of(text)


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """Every row's `doc_id`, `p_<category>` for each category, and `<category>` where the threshold is reached.

    Null texts count as empty, null doc_ids and repeated rows stay as they are, no other column is read.
    """
    rows = docs.select("doc_id", probabilities(F.col("text"), chain).alias("p"))
    return rows.select(
        "doc_id",
        *[F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(chain.categories)],
        *[(F.col("p")[i] >= chain.thresholds[i]).alias(c) for i, c in enumerate(chain.categories)],
    )


def without(docs: DataFrame, chain: Chain, category: str) -> DataFrame:
    """`docs` without the rows that reach the category's threshold; columns and other rows as they are."""
    i = chain.categories.index(category)
    p = probabilities(F.col("text"), chain)
    return docs.where(p[i] < chain.thresholds[i])
