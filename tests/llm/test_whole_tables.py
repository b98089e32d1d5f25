"""Queries without SQL over all rows of a table: pieces by a plain Viterbi search, sequences token by token, reply chains."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from namewright.llm import packing, quotes, sentencepieces

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def _texts(sf_dir):
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall())


def _best_score(text, pieces):
    """The greatest sum of scores of any segmentation of the whole text."""
    best = [0.0]
    for end in range(1, len(text) + 1):
        known = [
            best[start] + pieces.scored[text[start:end]][0]
            for start in range(max(0, end - pieces.longest), end)
            if text[start:end] in pieces.scored
        ]
        if text[end - 1] not in pieces.scored:
            known.append(best[-1] + pieces.unknown)
        best.append(max(known))
    return best[-1]


def test_pieces_have_the_best_score_there_is(spark):
    pieces, texts = sentencepieces.load_pieces(), _texts(SMALL)
    score = {i: s for s, i in pieces.scored.values()}
    byte = {i: b for b, i in enumerate(pieces.byte_ids)}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sentencepieces.encode_documents(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        assert sentencepieces.SPACE not in text
        # A character without a piece is charged once, at its first byte.
        got = sum(score[i] if i in score else pieces.unknown * (byte[i] & 0xC0 != 0x80) for i in row.ids or [])
        marked = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE) if text else ""
        assert got == pytest.approx(_best_score(marked, pieces), rel=1e-9)
        assert "".join(pieces.texts[i] for i in row.ids or [] if i in score) == "".join(c for c in marked if c in pieces.scored)


def test_op8_on_all_documents(spark):
    texts = _texts(SF_DIR)
    rows = sentencepieces.op8_sentencepiece(spark, SF_DIR).collect()
    assert {row.doc_id: row.decoded_crc32 for row in rows} == {i: zlib.crc32(text.encode()) for i, text in texts.items()}
    assert len(rows) == len(texts) and all((row.n_ids > 0) == bool(texts[row.doc_id]) for row in rows)


def test_op7_on_all_documents(spark):
    import public_tokenizers

    library, texts = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), _texts(SF_DIR)
    ids = {i: np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4") for i, text in texts.items()}
    of_document, of_sequence = defaultdict(list), defaultdict(list)
    for row in packing.op7_packing(spark, SF_DIR).collect():
        own = ids[row.doc_id]
        assert row.doc_tokens == len(own)
        assert row.ids_crc32 == zlib.crc32(own[row.start : row.start + row.length].tobytes())
        of_document[row.doc_id].append((row.start, row.length))
        of_sequence[row.sequence_id].append((row.offset, row.length))
    # Pieces of a document, and of a sequence, follow each other without a gap.
    for pieces in (*of_document.values(), *of_sequence.values()):
        ends = [0, *np.cumsum([length for _, length in sorted(pieces)])]
        assert [start for start, _ in sorted(pieces)] == ends[:-1]
    assert {i: sum(n for _, n in pieces) for i, pieces in of_document.items()} == {i: len(own) for i, own in ids.items()}
    filled = [sum(n for _, n in pieces) for pieces in of_sequence.values()]
    assert max(filled) <= 2048 and sum(n < 2048 and n & (n - 1) > 0 for n in filled) <= len(filled) // 100 + 1


def test_reply_chains_on_all_conversations(spark):
    rows = quotes.op9_quotation_linking(spark, SF_DIR).collect()
    parent = {(row.conv_id, row.turn): row.parent_turn for row in rows}
    assert len(parent) == len(rows)
    for row in rows:
        at, depth = row.turn, 0
        while parent[row.conv_id, at] is not None:
            at, depth = parent[row.conv_id, at], depth + 1
        assert (row.thread, row.depth) == (at, depth)
    keys = [(row.conv_id, row.thread, row.depth, row.turn) for row in rows]
    assert keys == sorted(keys)
