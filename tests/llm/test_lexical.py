"""Ranked search against plain Python; its SQL is compared in test_oracle."""

import math
import re
from collections import Counter

from namewright.llm import lexical

TERM = re.compile(lexical.TERM)
LOWER = str.maketrans(lexical.UPPER, lexical.LOWER)


def _ranked(docs, items, top):
    texts = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [Counter(t) for _, t in texts]
    n_docs, n_terms = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for (doc, words), tf in zip(texts, held, strict=True):
            score = 0
            for term in terms & set(tf):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(term in h for h in held) + 1)))
                score += weight * (10**9 * tf[term] // (1000 * tf[term] + 20 * (50 + 50 * len(words) * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


DOCS = [(1, "The cat sat on the mat."), (2, "the CAT, the cat; the\x00cat"), (3, "cathedral scat cat's"), (4, None), (5, " \n"), (None, "cat mat"), (7, "cat mat")]
DOCS += [(7, "cat mat"), (8, "naïve Ångström　cat \x85 mat"), (9, "mat " * 20_000), (10, "ＣＡＴ cat"), (11, "#$%")]
ITEMS = [(1, "Cat mat"), (2, "cathedral's ångström"), (2, "the THE"), (3, None), (4, "nowhere"), (None, "on mat"), (6, "　cat"), (7, "naïve")]


def _frames(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS], "doc_id long, text string, score string, item int")
    return docs.repartition(4), spark.createDataFrame([(i, t, 2) for i, t in ITEMS], "item_id long, text string, doc_id int")


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ranks_odd_rows_like_plain_python(spark):
    docs, items = _frames(spark)
    for top in (50, 3, 1):
        assert _got(lexical.ranked_search(docs, items, top=top)) == _ranked(DOCS, ITEMS, top)


def test_several_scans_and_pieces_give_the_same(spark, monkeypatch):
    docs, items = _frames(spark)
    monkeypatch.setattr(lexical, "SCAN_BYTES", 300)
    assert _got(lexical.ranked_search(docs, items)) == _ranked(DOCS, ITEMS, 50)


def test_items_scored_in_slices():
    pairs = {"cat": [0, 2], "mat": [0, 1], "the": [2]}
    queries = lexical.Queries([10, 11, 12], list(pairs), lexical.np.array([0, 2, 4, 5]), lexical.np.array([0, 2, 0, 1, 2]))
    text, term, _, worth = lexical.np.array([[0, 0, 5, 7], [0, 1, 5, 11], [1, 2, 5, 13], [1, 0, 5, 17]]).T
    whole = lexical.summed(queries, 0, 3, 2, text, term, worth)
    assert whole.tolist() == [[18, 11, 7], [17, 0, 30]]
    for first, items in ((0, 2), (2, 1), (1, 2)):
        assert lexical.summed(queries, first, items, 2, text, term, worth).tolist() == whole[:, first : first + items].tolist()


def test_empty_tables(spark):
    docs, items = _frames(spark)
    assert lexical.ranked_search(docs.limit(0), items).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).count() == 0
    named = docs.withColumnsRenamed({"text": "a.b", "doc_id": "my id"})
    assert lexical.ranked_search(named, items, "my id", "a.b").columns == ["item_id", "rank", "my id", "score"]
