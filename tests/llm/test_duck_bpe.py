"""Encoding by recursive queries against the tiktoken library, and back."""

import base64
import hashlib

import numpy as np
import pytest

from namewright.llm import duck_bpe

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(duck_bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.fixture
def coder():
    own = duck_bpe.Coder()
    yield own
    own.close()


EVERY = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
TEXTS = ["", " ", "  a  b\n\n c \t", " " * 3001 + "a" * 999, "a" * 5000 + " " * 3001 + "=" * 999, "don't I'll 're ¼² <|endoftext|>", "漢字😀" * 300]
TEXTS += ["\x00\x1c\x1d\x1f\x85\xa0  x", EVERY[:3000], EVERY[-2000:], *(EVERY[k : k + 40] for k in range(3000, len(EVERY), 20_011))]


def test_ids_are_tiktokens(coder, plain):
    ids, counts = coder.encode(TEXTS)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in TEXTS]
    assert coder.decode(ids, counts) == [t.encode() for t in TEXTS]
    assert [len(x) for x in coder.encode([])] == [0, 0]


def test_every_letter_number_and_space_is_told_as_by_tiktoken(coder):
    import public_tokenizers
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    words = duck_bpe.splitter().findall
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        known = tiktoken.Encoding("k", pat_str=kind, mergeable_ranks=single, special_tokens={})
        assert "".join(duck_bpe.splitter(kind).findall(EVERY)) == known.decode(known.encode_ordinary(EVERY))
    assert "".join(words(EVERY)) == EVERY
    assert words("a  b\n") == ["a", " ", " b", "\n"] and public_tokenizers.PATTERN


def test_long_words_are_merged_in_several_queries(coder, plain, monkeypatch):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcdefgh"), 3000)), "ab" * 2000, "aab" * 700, "a" * 1001 + "b" + "a" * 64]
    monkeypatch.setattr(duck_bpe, "STATE_ROWS", 20_000)
    monkeypatch.setattr(duck_bpe, "WORD_BYTES", 500)
    ids, counts = coder.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]


def test_forgotten_words_are_learned_again(plain):
    own = duck_bpe.Coder(remembered=3)
    for text in ("one two three four", "five one two", "six one", "one"):
        assert own.encode([text])[0].tolist() == plain(text)
    own.close()


def test_query_on_the_whole_table(spark, plain):
    got = {r.doc_id: r for r in duck_bpe.op13_duckdb_bpe(spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = plain(text or "")
        row = got[doc]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows_and_both_ways(spark, plain):
    rows = [(1, None, 1), (2, "", 2), (3, "same", 3), (3, "same", 3), (None, "long words " * 20_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    encoded = duck_bpe.encode_documents(docs)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(((i, plain(t or "")) for i, t, _ in rows), key=str)
    decoded = duck_bpe.decode_documents(encoded)
    assert sorted(((r.doc_id, bytes(r.bytes).decode()) for r in decoded.collect()), key=str) == sorted(((i, t or "") for i, t, _ in rows), key=str)
    assert duck_bpe.round_trips(docs.limit(0)).count() == duck_bpe.decode_documents(encoded.limit(0)).count() == 0
    named = docs.toDF("an id", "a.b", "text")
    assert duck_bpe.round_trips(named, "an id", "a.b").columns == ["an id", "n_tokens", "ids_sha256", "decoded_sha256"]
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert {(r.doc_id, bytes(r.bytes)) for r in duck_bpe.decode_documents(nulls).collect()} == {(1, b""), (2, b"")}


def test_unknown_ids_and_vocabularies_are_refused(coder, tmp_path):
    with pytest.raises(ValueError):
        coder.decode(np.array([99_999]), np.array([1]))
    lines = [base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)] + [base64.b64encode(b"abc") + b" 256"]
    (tmp_path / "odd").write_bytes(b"\n".join(lines))
    with pytest.raises(ValueError):
        duck_bpe.load_vocabulary(str(tmp_path / "odd"))
