"""Packing against a brute-force check of every token."""

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from namewright.llm import packing
from namewright.llm.vocab import byte_bpe

TEXTS = ["", "a", "Hello  world\n\n 12 \t x", "été à Zürich — 漢字 😀", "a<|endoftext|>b", "x" * 500, " 　 \r\n", "don't"]


def _by_library(text):
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_tokenizers_library(text):
    assert byte_bpe()(text).tolist() == _by_library(text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_ids_agree_on_any_text(text):
    assert byte_bpe()(text).tolist() == _by_library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=8), st.integers(0, 64))
def test_filling_is_the_best_there_is(lengths, room):
    items = {n: [0] * lengths.count(n) for n in lengths}
    used = packing.best_filling(sorted(items), items, room)
    assert all(times <= len(items[n]) for n, times in used)
    sums = {sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k)}
    assert sum(n * times for n, times in used) == max(s for s in sums if s <= room)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(2, 12))
def test_every_token_is_packed_once_and_without_padding(lengths, pool):
    ids = [np.arange(n, dtype="<u4") + 1000 * i for i, n in enumerate(lengths)]
    pieces = list(packing.pack_documents(enumerate(ids), capacity=32, pool_size=pool, kept=pool // 2))
    for i, own in enumerate(ids):
        mine = sorted((p for p in pieces if p[0] == i), key=lambda p: p[1])
        assert np.array_equal(np.concatenate([p[2] for p in mine]), own)
        assert [p[1] for p in mine] == list(np.cumsum([0] + [len(p[2]) for p in mine[:-1]]))
        assert all(p[3] == len(own) for p in mine)
    for _, group in itertools.groupby(sorted(pieces, key=lambda p: p[4:]), key=lambda p: p[4]):
        group = list(group)
        assert [p[5] for p in group] == list(np.cumsum([0] + [len(p[2]) for p in group[:-1]]))
        size = sum(len(p[2]) for p in group)
        assert size <= 32 and size.bit_count() == 1


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "word " * 3000, 7), (3, "word " * 3000, 7), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(2)
    got = packing.pack(docs).withColumn("crc", F.crc32("ids")).collect()
    long = np.append(byte_bpe()("word " * 3000), 1).astype("<u4")
    assert sum(r.length for r in got if r.doc_id == 3) == 2 * len(long)
    for r in got:
        assert r.crc == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        if r.doc_id == 3:
            assert bytes(r.ids) == long[r.start : r.start + r.length].tobytes()
    assert [bytes(r.ids) for r in got if r.doc_id in (1, 2)] == [b"\x01\0\0\0"] * 2
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
