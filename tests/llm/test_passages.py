"""Repeated passages below the size of lines: recall, rows without or with repeated ids, hot digests, cuts."""

import collections
import re

from namewright.llm import substring_dedup as sd

SF_DIR = "/root/testdata/sf0.1"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(sd.LOWER))


def test_later_placements_of_long_passages_are_covered(spark):
    """Every later placement of a benchmark passage of over 50 words is covered, and few other documents are touched."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    passages = [" ".join(_words(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() if len(_words(r.text)) > 50]
    found = collections.defaultdict(list)
    for r in sd.op1_substring_dedup(spark, SF_DIR).collect():
        found[r.doc_id].append((r.start, r.end, r.keep_id, r.keep_start))
        assert (r.keep_id, r.keep_start) < (r.doc_id, r.start)
    shares = []
    plain = {doc: " ".join(_words(text)) for doc, text in texts.items()}
    for passage in passages:
        for doc in sorted(doc for doc, text in plain.items() if f" {passage} " in f" {text} ")[1:]:
            spots = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[doc])]
            first = plain[doc][: f" {plain[doc]} ".index(f" {passage} ")].count(" ")
            inside = spots[first : first + len(passage.split())]
            shares.append(sum(any(s <= a < e for s, e, *_ in found[doc]) for a, _ in inside) / len(inside))
    assert len(shares) >= 18
    assert min(shares) >= 0.5
    assert sum(share >= 0.8 for share in shares) >= 0.9 * len(shares)
    assert sum(shares) >= 0.92 * len(shares)


def test_units_of_passages():
    text = "One two.  Three. four, five! six seven\n\n eight"
    got = list(sd.text_units(text, "passage"))
    assert [text[a:b] for a, b, _, _ in got][-1] == "eight" and sum(n for *_, n, _ in got) == 8
    assert all(not text[a].isspace() for a, *_ in got)
    assert "".join(text[a:b] for a, b, *_ in got) == text.replace("\n\n ", "")
    assert [d for *_, d in sd.text_units("ONE two", "passage")] == [d for *_, d in sd.text_units("one\t two", "passage")]
    for empty in ("", " \n\t"):
        assert not list(sd.text_units(empty, "passage"))


def test_rows_without_an_id_are_documents_of_their_own(spark):
    line = "three word line"
    rows = [(1, "\n".join(f"{line} {k}" for k in range(12)))] + [(None, f"{line} {k}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sd.repeated_units(docs).count() == 0
    flagged = sd.repeats(docs).collect()
    assert len(flagged) == 12 and not any(r.removed for r in flagged) and {r.run_words for r in flagged} == {4}
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(5, long), (5, long), (5, "other\n" + long), (None, long), (None, long), (2, None), (3, ""), (4, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for unit in sd.UNITS:
        kept = sorted((str(r.doc_id), r.text) for r in sd.without_repeats(docs, unit=unit).collect() if (r.text or "").strip())
        rest = [("5", "other\n" + long)] if unit == "paragraph" else [("5", "other\n")]
        assert kept == sorted([("5", long)] + rest)
    assert sd.repeats(docs.limit(0)).count() == 0
    assert sd.without_repeats(docs.limit(0)).count() == 0


def test_columns_of_any_name_stay(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long, 1, 2, 3), (2, "é x. " + long + " y.", 4, 5, 6), (3, "z", 7, 8, 9)]
    docs = spark.createDataFrame(rows, "`my id` long, `a.b` string, __spans int, __row int, start int")
    got = {r["my id"]: r for r in sd.without_repeats(docs, "my id", "a.b", "passage").collect()}
    assert sd.without_repeats(docs, "my id", "a.b").columns == docs.columns
    assert got[1]["a.b"] == long and got[3]["a.b"] == "z" and (got[2]["__spans"], got[2]["__row"], got[2]["start"]) == (4, 5, 6)
    assert got[2]["a.b"].startswith("é x. ") and got[2]["a.b"].endswith("y.") and len(_words(got[2]["a.b"])) < 30


def test_hot_digests_are_settled_like_others(spark, monkeypatch):
    hot = " ".join(f"h{k}" for k in range(25))
    rows = [(k % 40, f"line {k}\n{hot}\nend {k % 7}") for k in range(300)] + [(None, hot)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "text")
    plain = sorted(map(str, sd.repeats(docs, min_words=3).drop("row").collect()))
    monkeypatch.setattr(sd, "HOT_LEAST", 20)
    monkeypatch.setattr(sd, "HOT_SHARE", 10**9)
    assert sorted(map(str, sd.repeats(docs, min_words=3).drop("row").collect())) == plain
    assert len([r for r in plain if "words=25" in r]) == 300
