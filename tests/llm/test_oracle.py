"""Corpus queries against their SQL on whole tables, and what every operator makes of odd rows."""

import os
import re
import zlib

import duckdb
import pytest

from namewright.llm import exact_dedup, pii, quality, quotes, registry, sentencepieces, substring_dedup, toxicity, url_filter

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
ODD = [(1, None, "en", 1), (2, "", None, 1), (3, " \t\n", "en", 1), (4, "same", "en", 1), (5, "same", "de", 1), (5, "same", "de", 1)]
ODD += [(6, "long " * 30_000, "en", 1), (None, "same", "en", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, id int").repartition(3)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = registry.QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = con.execute(f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in columns)} FROM ({registry.ORACLE_SQL[name]})")
    assert sorted(map(str, map(tuple, result.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))


def test_quality_counts_by_brute_force(spark, odd):
    got = quality.statistics(odd).collect()
    assert len(got) == len(ODD)
    by_id = {r.id: r for r in got}
    assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0
    assert by_id[6].n_words == by_id[6].n_repeat_words == 30_000
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, None), (None, 1)], "doc_id long, quality int")
    assert quality.quality_rules(odd, labels).where("kept").count() == 0


def test_exact_copies(odd, spark):
    got = exact_dedup.exact_dedup(odd).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got if r.doc_id in (1, 2, 4, 5)) == [
        (1, 2, 2),
        (2, 2, 2),
        (4, 5, 4),
        (5, 5, 4),
        (5, 5, 4),
    ]
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0


def test_repeats_are_cut_at_their_offsets(spark, odd):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"first\n{passage}\nend"), (2, f"é other\n{passage.upper()}\nlast"), (3, "short\nend")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.doc_id, r.start, r.keep_id, r.keep_start) for r in substring_dedup.repeated_units(docs).collect()] == [(2, 8, 1, 6)]
    assert {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).collect()}[2] == "é other\n\nlast"
    assert substring_dedup.without_repeats(odd).count() == len(ODD)


def test_personal_data(spark, odd):
    text = "Mail a.b@c.example.com, +1 (212) 555-0100 or 10.0.0.256 and 192.168.0.1; card 4111 1111 1111 1111."
    spans = {(k, text[a:b]) for a, b, k in pii.base_spans(text)}
    assert spans == {("email", "a.b@c.example.com"), ("phone", "+1 (212) 555-0100"), ("ip", "192.168.0.1"), ("card", "4111 1111 1111 1111")}
    docs = spark.createDataFrame([(1, text, 9), (2, None, 9)], "doc_id long, text string, spans int")
    assert re.findall("<[A-Z]+>", pii.redact(docs, length_col=None).where("doc_id = 1").first().text) == ["<EMAIL>", "<PHONE>", "<IP>", "<CARD>"]
    assert pii.find_pii(odd).count() == len(ODD)
    assert pii.find_pii(odd.limit(0)).count() == 0


def test_toxicity_on_held_out_rows(spark, odd):
    found = toxicity.op4_toxicity(spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").join(found, "doc_id").collect()
    flagged = lambda y: sum(r.predicted for r in labels if r.toxic == y) / sum(r.toxic == y for r in labels)
    assert flagged(1) > 0.5 and flagged(0) < 0.06
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd, none).collect()} == {0.0}


def test_pieces_round_trip_and_stream(spark, odd):
    pieces = sentencepieces.load_pieces()
    for text in ("a▁b  ▁", "\n\n", "漢字😀 x", " lead", "", "é" * 200, "the " * 50 + "quickly"):
        ids = next(sentencepieces.encode_batch([text], {})).tolist()
        assert sentencepieces.decode(ids, pieces) == text
        assert ids == sentencepieces.encode(text, pieces, {})
    words = "▁the▁quickly▁unbelievable▁é漢"
    whole = [i for w in sentencepieces.WORDS.findall(words) for i in sentencepieces.word_ids(w, pieces)]
    assert list(sentencepieces.stream_ids(words, pieces)) == whole
    back = sentencepieces.decode_documents(sentencepieces.encode_documents(odd)).collect()
    assert sorted(map(str, (r.text for r in back))) == sorted(str(t) for _, t, _, _ in ODD)


def test_urls_by_hand(spark):
    rules = spark.createDataFrame(list(url_filter.RULES), "verdict string, host string, path string")
    urls = [(1, "http://WWW.example.com/en/x?y"), (2, "https://a.example.com/en/"), (3, "x.net/es/"), (4, None), (5, "s://b.net/es/q#f"), (6, "s://c.com")]
    got = url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {
        1: ("www.example.com/en/", "allow"),
        2: ("example.com/en/", "block"),
        3: (None, "allow"),
        4: (None, "allow"),
        5: ("net/es/", "block"),
        6: (None, "allow"),
    }


def test_replies_follow_quotations(spark):
    rows = [(1, 0, "u", "First\nwords"), (1, 1, "a", "> first\n> Words\nanswer"), (1, 2, "u", "> > first words\n> answer\nthanks"), (1, 3, "a", None), (2, 0, "u", "> gone\nhi")]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.conv_id, r.turn, r.parent_turn, r.thread, r.depth, r.text) for r in got] == [
        (1, 0, None, 0, 0, "First\nwords"),
        (1, 1, 0, 0, 1, "answer"),
        (1, 2, 1, 0, 2, "thanks"),
        (1, 3, None, 3, 0, ""),
        (2, 0, None, 0, 0, "hi"),
    ]
    base = duckdb.sql(f"SELECT conv_id, turn, text FROM '{SF_DIR}/conversations.parquet'").fetchall()
    texts = {(c, t): x for c, t, x in base}
    for r in quotes.op9_quotation_linking(spark, SF_DIR).collect():
        assert r.text == texts[r.conv_id, r.turn]
        if r.turn:
            to = texts[r.conv_id, zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % r.turn]
            assert texts[r.conv_id, r.parent_turn].lower().split() == to.lower().split()
