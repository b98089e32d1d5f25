"""Near duplicates against all pairs compared by brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from namewright.llm import minhash
from namewright.llm.components import components
from namewright.llm.shingles import shingle_sets


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _brute(rows, percent=85):
    sets, parent = {i: _set(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def _families(seed, n, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, common = [], [rng.choice(vocabulary) for _ in range(120)]
    for family in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        if family % 3 == 0:
            words = common + words[:30]
        for copy in range(rng.randrange(1, 30 if family == 0 else 6)):
            own = list(words)
            for _ in range(rng.randrange(0, edits)):
                own[rng.randrange(len(own))] = f"e{rng.random()}"
            rows.append((len(rows) * 7 % 1009, " ".join(own).upper() if copy % 2 else "\n".join(own)))
    return rows


@pytest.mark.parametrize("text", ["", "  \n", "One", "a b c d", "A b\tc d e", "é à ü ö ß x", "x " * 300, None])
def test_shingles(text):
    assert len(next(shingle_sets([text.encode() if text is not None else None]))) == len(_set(text))


def test_a_text_has_the_same_set_wherever_it_stands():
    texts = [f"{i} quick brown foxes jump over lazy dogs".encode() for i in range(50)]
    alone = [next(shingle_sets([t])).tolist() for t in texts]
    assert [s.tolist() for s in shingle_sets(texts)] == alone


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 2)])
def test_same_components_as_brute_force(spark, seed, block):
    rows = _families(seed, 25, 8) + [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE  two"), (2004, "\t")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sig string").repartition(3)
    got = {tuple(r) for r in minhash.near_duplicates(docs, block=block).collect()}
    assert got == _brute(rows)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _, k in got if k}


def test_links_of_similarity_80(spark):
    rows = _families(3, 25, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {tuple(r) for r in minhash.near_duplicates(docs, percent=80, least_matches=11).collect()}
    assert got == _brute(rows, 80) != _brute(rows)


def test_texts_of_one_hash_are_told_apart(spark, monkeypatch):
    texts = [f"w{k} " * 3 + " ".join(f"t{k}x{i}" for i in range(40)) for k in range(12)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(50, texts[3])], "doc_id long, text string")
    few = lambda text, other=False: F.xxhash64(F.lit(1), text) if other else F.pmod(F.xxhash64(text), F.lit(3))
    monkeypatch.setattr(minhash, "_text_hash", few)
    assert sorted(r.doc_id for r in minhash.drop_near_duplicates(docs).collect()) == list(range(12))


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A B C D E F")]
    got = sorted(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (1, 1, True),
        (1, 1, True),
        (2, 1, False),
        (None, None, True),
    ]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_long_chains_and_stars(spark):
    links = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 60)] + [(7, 7), (150, 20), (31, 30)]
    random.Random(5).shuffle(links)
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 0)}
