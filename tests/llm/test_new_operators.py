"""Periodic runs, license scans and spelling variants: brute force over a whole table, odd rows, hot groups."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from test_corpus_queries import EXTRA, none, odd, tables  # noqa: F401

from sonoloom.llm import licenses, periodic, queries, spelling

SPACE = b" \t\n\x0b\x0c\r"


def brute_runs(words, exponent=4, least=6):
    """All stretches of equal words at each distance; the least distance that gives a stretch is its period."""
    number = {}
    words, out = np.array([number.setdefault(w, len(number)) for w in words]), {}
    for q in range(1, len(words) // exponent + 1):
        edge = np.diff(np.concatenate([[0], (words[q:] == words[:-q]).astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if b - a + q >= max(least, exponent * q):
                out.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def sha(data):
    return hashlib.sha256(data).hexdigest()


def wanted_runs(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (
        str(doc_id), len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


@pytest.mark.parametrize("where", ["odd", "whole"])
def test_runs_equal_brute_force(spark, odd, where):  # noqa: F811
    folder = odd[0] if where == "odd" else SF_DIR
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    docs = [d for d in docs if len(d["text"] or "") < 300_000]  # brute force takes the square; the long text has a test below
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, folder).collect()]
    ids = {str(d["doc_id"]) for d in docs}
    got = [(str(r[0]), *r[1:]) for r in got if str(r[0]) in ids]
    assert sorted(map(str, got)) == sorted(str(wanted_runs(d["doc_id"], d["text"])) for d in docs)
    assert where == "odd" or sum(r[1] > 0 for r in got) > 20


@pytest.mark.parametrize("few", [0, 8])
def test_runs_of_random_words(monkeypatch, few):
    monkeypatch.setattr(periodic, "_FEW", few)
    chance = random.Random(few)
    for _ in range(400):
        texts = []
        for _ in range(chance.randint(1, 4)):
            n, k = chance.randint(0, 60), chance.choice([1, 2, 3, 30])
            words = [chance.randint(1, k) for _ in range(n)]
            if n and chance.random() < 0.6:
                a = chance.randrange(n)
                p = 1 + chance.randrange(max(1, (n - a) // 3))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        for exponent, least in ((4, 6), (3, 2), (5, 12)):
            got = periodic.find_runs(np.array(sum(texts, []), np.int64), first, exponent, least)
            want = [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, exponent, least)]
            assert list(zip(*(x.tolist() for x in got))) == want


def test_runs_of_very_long_texts():
    """A word, a period and a phrase among different words, each hundreds of thousands of words long."""
    for words, want in (
        ([1] * 300_000, [(0, 300_000, 1)]),
        ([i % 1000 for i in range(300_000)], [(0, 300_000, 1000)]),
        (sum(([10 + i, 1, 2, 3, 4, 5, 900_000 + i] for i in range(50_000)), []), []),
        (sum(([10 + i, *[1] * 7, 900_000 + i] for i in range(30_000)), []), [(9 * i + 1, 7, 1) for i in range(30_000)]),
    ):
        _, *got = periodic.find_runs(np.array(words, np.int64) + 1, np.array([0, len(words)]))
        assert list(zip(*(x.tolist() for x in got))) == want


# op12: the query is held against its SQL with the others


def test_every_rule_holds_its_keyword_and_finds_itself():
    assert len(licenses.RULES) > 300
    for rule in (*licenses.BASE, *licenses.RULES):
        said = rule.words.split()
        assert rule.keyword in said  # as a word that may not be missing
        if re.fullmatch(r"[a-z0-9 |()\[\]]*", rule.words):
            plain = [re.sub(r"\[cs\]", "c", w.split("|")[0]) for w in said if not w.startswith("(") and "[0" not in w]
            text = "".join(f" {w} " for w in plain)
            assert "[0" in rule.words or re.search(rule.pattern, text)
        assert not re.search(rule.pattern, " other  words ")


def test_licenses_overlap_by_priority_and_containment(spark):
    texts = {
        "Licensed under the GNU Lesser General Public License, version 2.1": ["gpl", "lgpl-2.1", "licensed"],
        "the Apache License": ["apache"],
        "Apache License, Version 2.0": ["apache-2.0"],
        "Apache License 2.0 and the Apache License": ["apache", "apache-2.0"],
        "SPDX-License-Identifier: GPL-3.0-or-later": ["gpl-3.0-or-later"],
        "a redistributed MITTEN": [],
        "KC BY, CC Bİ": [],
        "écc by cc byé": [],
        "CC BY\tCC\nBY": ["cc-by"],
        "all rights reserved; some rights reserved": ["reserved"],
    }
    rows = spark.createDataFrame([(t, "x", 1) for t in texts], "text string, norm string, places int")
    found = licenses.scanned(rows).collect()
    assert {r.row.text: r.labels for r in found} == texts
    assert all((r.row.norm, r.row.places) == ("x", 1) for r in found)
    by_text = {r.row.text: r for r in found}
    assert [tuple(d)[:3] for d in by_text["CC BY\tCC\nBY"].base] == [(0, 2, "cc-by"), (2, 4, "cc-by")]
    assert by_text["Apache License, Version 2.0"].score == 0.9 and by_text["a redistributed MITTEN"].score == 0


def test_a_text_full_of_licenses(spark):
    rows = spark.createDataFrame([("cc by " * 30_000,)], "text string")
    (row,) = licenses.scanned(rows).collect()
    assert (len(row.base), row.n_words, row.labels) == (30_000, 60_000, ["cc-by"])


# op13


def brute_variants(counts):
    near = {w: set() for w in counts}
    holes, shorter = {}, {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for w in counts:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1 :]]
        for longer in shorter.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
        near[w].discard(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("letters, longest", [("ab", 8), ("abcé", 7), ("a𝔘", 9)])
def test_variants_of_random_words(spark, letters, longest):
    """Dense vocabularies, with halves that most words share: dealt into slices they give the same."""
    chance = random.Random(longest)
    counts = {"".join(chance.choice(letters) for _ in range(chance.randint(5, longest))): chance.randint(3, 60) for _ in range(250)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    for entries in (40_000, 23):
        assert rows_of(spelling.variants(table, shard_entries=entries)) == brute_variants(counts)


@pytest.mark.parametrize("where", ["odd", "whole"])
def test_variants_equal_brute_force(spark, odd, where):  # noqa: F811
    folder = odd[0] if where == "odd" else SF_DIR
    counts = Counter()
    for d in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d['doc_id'] is None else d['doc_id']}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = brute_variants({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    assert rows_of(queries.op13_spelling_variants(spark, folder)) == want
    assert where == "odd" or sum(r[1] is not None for r in want) > 100
