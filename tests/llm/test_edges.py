"""Cases at the edges of what the corpus operators read: windows, rows without ids, parts of messages and lines."""

import numpy as np
import pytest

import corpus_pipeline
from namewright.llm import pii, quotes


class _Letters:
    """Tags x, y, @ and dots as one address; ``sees`` only where the window has an @, as a model would."""

    def __init__(self, sees):
        self.sees = sees

    def decode(self, rows, width):
        tags = np.zeros((len(rows), width), np.int8)
        for k, row in enumerate(rows):
            inside = np.isin(row, [ord(c) for c in "xy@."])
            if not self.sees or ord("@") in row:
                tags[k, : len(row)] = np.where(inside, np.where(np.append(False, inside[:-1]), 2, 1), 0)
        return tags


@pytest.mark.parametrize("local,domain,sees", [(16, 24, True), (24, 24, True), (32, 31, True), (50, 50, False)])
def test_an_address_over_windows_is_found_at_every_offset(local, domain, sees):
    address = "x" * local + "@" + "y" * (domain - 4) + ".yyy"
    texts = ["z" * (200 + k) + " " + address + " " + "z" * 300 for k in range(64)] + ["z" * k + " " + address for k in range(64)]
    for text, spans in zip(texts, pii.model_spans(_Letters(sees), texts), strict=True):
        assert [text[a:b] for a, b, _ in spans] == [address]


def _words(seed, n=80):
    return " ".join(f"w{seed}x{i * i % 9973}" for i in range(n))


def test_stages_settle_null_and_repeated_ids(spark, folder):
    a, b = _words(1), _words(2)
    near_b = b + " more"
    junk = "the same three words " * 60
    rows = [
        (1, a, "en", "s", 1), (1, a, "en", "s", 1), (None, a, "en", "s", 1),  # a whole row twice, a copy without id
        (2, b, "en", "s", 1), (2, junk, "en", "s", 1),  # a good and a bad text under one id
        (None, junk, "en", "t", 2), (None, None, None, None, None), (None, None, None, None, None),
        (3, near_b, "en", "s", 1), (None, near_b + " still", "en", "s", 1),
        (None, _words(4), None, None, None), (None, _words(4) + " on", None, "t", None), (None, _words(5), None, None, None),
        (6, _words(6), "en", "s", 1), (6, _words(6), "de", "s", 1), (6, _words(7), "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    result = lambda name: sorted(((r.doc_id, r.text) for r in stages[name](spark, docs, folder).collect()), key=str)
    pairs = [(i, t) for i, t, *_ in rows]
    assert result("quality_rules") == sorted(((i, t) for i, t in pairs if t not in (junk, None)), key=str)
    once = [(1, a), (2, b), (2, junk), (None, None), (3, near_b), (None, near_b + " still")]
    once += [(None, _words(4)), (None, _words(4) + " on"), (None, _words(5)), (6, _words(6)), (6, _words(7))]
    assert result("exact_dedup") == sorted(once, key=str)
    near = result("near_dedup")
    assert len([t for i, t in near if i is None and t in (_words(4), _words(4) + " on")]) == 1
    assert [x for x in near if x[1] not in (_words(4), _words(4) + " on")] == sorted(
        [(1, a), (2, b), (2, junk), (None, None), (None, _words(5)), (6, _words(6)), (6, _words(7))], key=str
    )
    for name in ("exact_dedup", "near_dedup"):
        out = stages[name](spark, docs, folder)
        assert out.columns == docs.columns
        assert {r.lang for r in out.where(f"text = '{_words(6)}'").collect()} <= {"en", "de"}
    assert stages["near_dedup"](spark, docs.limit(0), folder).count() == 0


def test_blank_lines_of_a_message_stay(spark):
    texts = ["a\n\n\n  b = 1\n\n  c\n", "> a\n\nyes\n\nno", "> a\n\n\n> b", "plain"]
    docs = spark.createDataFrame([(1, k, "u", x) for k, x in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r.text for r in quotes.reply_order(docs).collect()}
    assert got == {0: texts[0], 1: "\nyes\n\nno", 2: "", 3: "plain"}


def test_parts_of_messages_are_quotations_too(spark):
    rows = [
        (1, 0, "Hello,\nfirst point\nof two lines\n\nsecond point"),
        (1, 1, "Hello,\nanother thing\nand its reason"),
        (1, 2, "> second point\nyes"),  # one line of an original
        (1, 3, "> First  point of\n> two lines\n\nno\n\n> and its reason\nwhy?"),  # re-wrapped, then another message
        (1, 4, "> Hello,\nhi\n> another thing\nwhich?\n> and its reason\nsee"),  # answers between parts; two say hello
        (1, 5, "> and its reason\n> something nobody says\nhm"),
        (1, 6, "> Hello,\nhey"),
        (1, 7, "> > another thing\n> hi\nok"),
        (1, 8, "> hi\n"),
        (2, 0, "a\n\n\n  b = 1\n\n  c\n"),
    ]
    docs = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.text) for r in quotes.reply_order(docs).collect()}
    assert {t: p for (c, t), (p, _) in got.items() if c == 1} == {0: None, 1: None, 2: 0, 3: 1, 4: 1, 5: 1, 6: 0, 7: 4, 8: 4}
    assert got[1, 0][1] == rows[0][2] and got[2, 0][1] == rows[-1][2]
    assert got[1, 3][1] == "\nno\n\nwhy?" and got[1, 4][1] == "hi\nwhich?\nsee" and got[1, 8][1] == ""


def test_columns_of_any_name_pass_the_pii_stage(spark, folder):
    names = ["doc_id", "text", "my col", "a.b", "x-y", "n:m", "redacted", "spans", "row", "id"]
    rows = [(1, "mail me@example.org", 1, "p", 2.5, None, "r", 3, 4, 5), (2, None, None, None, None, 7, None, None, None, None)]
    kinds = ["long", "string", "int", "string", "double", "long", "string", "int", "int", "int"]
    docs = spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))
    out = dict(corpus_pipeline.STAGES)["pii"](spark, docs, folder)
    assert out.schema.names == names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    got = sorted(map(tuple, out.collect()))
    assert got[0] == (1, "mail <EMAIL>", *rows[0][2:]) and got[1] == rows[1]
