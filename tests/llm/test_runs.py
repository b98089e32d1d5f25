"""Periodic runs against brute force: Lyndon arrays, runs, and the query on whole tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from namewright.llm import runs

SF_DIR = "/root/testdata/sf0.01"


def _longest_lyndon(s):
    least = lambda w: all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(s) + 1) if least(s[i:j])) for i in range(len(s))]


def _runs(words, min_length=6, min_periods=4):
    """For each period, from the shortest, all longest stretches of words that equal the word one period later."""
    numbers = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int)
    out = set()
    for q in range(1, len(words) // min_periods + 1):
        same = np.concatenate([[False], numbers[q:] == numbers[:-q], [False]])
        for a, b in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            inside = numbers[a : b + q]
            shorter = any(q % d == 0 and np.array_equal(inside[d:], inside[:-d]) for d in range(1, q))
            if b - a + q >= max(min_length, min_periods * q) and not shorter:
                out.add((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(1, 13))]
        assert runs.lyndon_lengths(s) == _longest_lyndon(s)
    assert runs.lyndon_lengths([]) == []


@pytest.mark.parametrize("size", [(6, 4), (2, 2), (6, 2), (5, 3)])
def test_runs_of_words(size):
    rng = random.Random(2)
    texts = []
    for _ in range(400):
        words = [str(rng.randrange(rng.choice([1, 2, 3]))) for _ in range(rng.randrange(30))]
        texts.append(words + words[:3] * rng.randrange(7) + words)
    assert runs.text_runs(texts, *size) == [_runs(words, *size) for words in texts]
    assert runs.text_runs([], *size) == [] and runs.runs_of([]) == []


def test_stretches_are_settled_in_pieces(monkeypatch):
    texts = [["a", "b"] * k + ["c"] for k in range(3, 40)]
    monkeypatch.setattr(runs, "SORTED_WORDS", 50)
    assert runs.text_runs(texts) == [_runs(words) for words in texts]


def _periodic(doc, words):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_by_brute_force(spark):
    got = {r.doc_id: r for r in runs.op11_baier_runs(spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows) == 1000
    made = 0
    for doc, text in rows:
        words = _periodic(doc, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        found = _runs(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        row = got[doc]
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        made += bool(found)
    assert made > 50


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \n\t", 3), (4, "x " * 30_000, 4), (4, "x " * 30_000, 4), (None, "a b " * 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()), key=str)
    assert got == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 10, [(0, 10, 2)], "a b")] + [(4, 30_000, [(0, 30_000, 1)], "x")] * 2, key=str
    )
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    named = docs.toDF("an id", "a.b", "text")
    assert runs.periodic_runs(named, "an id", "a.b").columns == ["an id", "n_words", "runs", "collapsed"]
    assert {r["a.b"] for r in runs.made_periodic(named, "an id", "a.b").where("`an id` IS NULL").collect()} == {"a b " * 5}
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, min_periods=1)
