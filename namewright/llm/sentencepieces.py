"""Encoding to and decoding from a vocabulary of scored pieces by a streaming Viterbi search."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.common import quoted, table

SPACE = "▁"
#: A character that no piece begins with costs the worst score less this much, and becomes its bytes.
UNKNOWN_PENALTY = 10.0
#: A task remembers the ids of so many words; then it starts afresh.
REMEMBERED = 200_000
#: Longer words are searched as a stream and not remembered.
LONG_WORD = 64
#: Words up to this length are searched by arrays.
SHORT_WORD = 24
#: Characters below this code are searched by arrays over many words.
LATIN = 0x180


@dataclass(frozen=True)
class Pieces:
    """Scores and ids by piece, the proper starts of pieces, the ids of the 256 bytes, and the pieces by id."""

    scored: dict[str, tuple[float, int]]
    starts: frozenset[str]
    byte_ids: tuple[int, ...]
    texts: tuple[str | None, ...]
    plain: dict[int, str]
    longest: int
    unknown: float
    #: Whether no piece has a blank after another character, so every segmentation breaks before a word's blank.
    words_apart: bool


@functools.lru_cache(maxsize=2)
def load_pieces(path: str | None = None) -> Pieces:
    """The pieces of a model file; None is the 32k vocabulary installed on each machine."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scored = {model.id_to_piece(i): (model.get_score(i), i) for i in plain}
    byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    texts: list[str | None] = [None] * len(ids)
    for piece, (_, i) in scored.items():
        texts[i] = piece
    return Pieces(
        scored,
        frozenset(piece[:n] for piece in scored for n in range(1, len(piece))),
        byte_ids,
        tuple(texts),
        {i: piece.replace(SPACE, " ") for piece, (_, i) in scored.items()},
        max(map(len, scored)),
        min(score for score, _ in scored.values()) - UNKNOWN_PENALTY,
        not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in scored),
    )


def stream_ids(chars: Iterable[str], pieces: Pieces) -> Iterator[int]:
    """Ids of the segmentation with the highest sum of scores; of equal ones the one whose last piece is longest.

    ``chars`` are read one by one. Kept are the last ``longest`` positions and the paths that lead to them: each path is
    a chain of pieces from the last committed boundary. As soon as all paths that can still win begin with the same
    piece, that piece is committed and its ids are given out; memory is bounded by the window and what is undecided.
    A character of its own that is no piece becomes its UTF-8 bytes.
    """
    scored, longest, byte_ids, unknown = pieces.scored, pieces.longest, pieces.byte_ids, pieces.unknown
    window = ""
    # (score, path) at the positions -len(window) .. 0; a path is (before, ids) back to the boundary, None there
    states: list[tuple[float, tuple | None]] = [(0.0, None)]
    since = 0
    for char in chars:
        window = (window + char)[-longest:]
        best = None
        for n in range(min(len(window), len(states)), 0, -1):
            found = scored.get(window[-n:])
            if found:
                score, path = states[-n]
                if best is None or score + found[0] > best[0]:
                    best = (score + found[0], (path, (found[1],)))
        if char not in scored:
            score, path = states[-1]
            if best is None or score + unknown > best[0]:
                best = (score + unknown, (path, tuple(byte_ids[b] for b in char.encode())))
        states.append(best)
        del states[:-longest]
        since += 1
        if since >= longest or len(states) == 1:
            since = 0
            firsts, states = _committed(states)
            for ids in firsts:
                yield from ids
    if states[-1][1] is not None:
        yield from (i for ids in _path(states[-1][1]) for i in ids)


def _path(path: tuple | None) -> list[tuple]:
    out = []
    while path is not None:
        path, ids = path
        out.append((ids, path))
    return [ids for ids, _ in reversed(out)]


def _committed(states: list) -> tuple[list[tuple], list]:
    """The pieces with which all paths begin, and the states with paths beyond them."""
    chains = []
    for _, path in states:
        chain = []
        while path is not None:
            chain.append(path)
            path = path[0]
        chains.append(chain[::-1])
    common = 0
    while all(len(c) > common for c in chains) and len({id(c[common]) for c in chains}) == 1:
        common += 1
    if not common:
        return [], states
    firsts = [ids for _, ids in chains[0][:common]]
    renewed: dict[int, tuple | None] = {id(chains[0][common - 1]): None}
    out = []
    top = states[-1][0]
    for (score, _), chain in zip(states, chains, strict=True):
        at = None
        for node in chain[common:]:
            at = renewed.setdefault(id(node), (at, node[1]))
        out.append((score - top, at))
    return firsts, out


def word_ids(word: str, pieces: Pieces) -> tuple[int, ...]:
    """The same search for a whole short word, with plain lists."""
    scored, starts, n = pieces.scored, pieces.starts, len(word)
    best = [0.0] + [-1e300] * n
    back: list[tuple | None] = [None] * (n + 1)
    for i in range(n):
        base = best[i]
        j = i + 1
        piece = word[i]
        found = scored.get(piece)
        if found is None:
            found = (pieces.unknown, tuple(pieces.byte_ids[b] for b in piece.encode()))
        while True:
            if found is not None and base + found[0] > best[j]:
                best[j] = base + found[0]
                back[j] = (i, found[1])
            if j == n or piece not in starts:
                break
            j += 1
            piece = word[i:j]
            found = scored.get(piece)
    out: list[int] = []
    at = n
    while at:
        at, ids = back[at]
        if type(ids) is int:
            out.append(ids)
        else:
            out.extend(reversed(ids))
    out.reverse()
    return tuple(out)


@functools.lru_cache(maxsize=2)
def _trie(path: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of Latin characters as a table of moves: class of a code point, next node, score and id of a node."""
    pieces = load_pieces(path)
    chars = sorted(c for c in pieces.scored if len(c) == 1 and (ord(c) < LATIN or c == SPACE))
    known = set(chars)
    own = [p for p in pieces.scored if known.issuperset(p)]
    nodes = {"": 0}
    for piece in own:
        for n in range(1, len(piece) + 1):
            nodes.setdefault(piece[:n], len(nodes))
    classes = np.zeros(0x2600, np.int32)
    for k, char in enumerate(chars, 1):
        classes[ord(char)] = k
    moves = np.zeros((len(nodes), len(chars) + 1), np.int32)
    score, ids = np.full(len(nodes), -np.inf), np.full(len(nodes), -1, np.int32)
    for start, node in nodes.items():
        if start:
            moves[nodes[start[:-1]], classes[ord(start[-1])]] = node
        if start in pieces.scored:
            score[node], ids[node] = pieces.scored[start]
    return classes, moves, score, ids


def words_ids(words: list[str], path: str | None = None) -> Iterator[tuple[str, tuple[int, ...]]]:
    """``word_ids`` for many words at once, all but those with rare characters by arrays over the words."""
    pieces = load_pieces(path)
    classes, moves, score, piece_ids = _trie(path)
    flat, kinds = moves.ravel(), moves.shape[1]
    words = sorted(words, key=len)
    for begin in range(0, len(words), 20_000):
        part = words[begin : begin + 20_000]
        sizes = np.array([len(w) for w in part])
        width = int(sizes[-1])
        points = np.frombuffer("".join(w.ljust(width, "\0") for w in part).encode("utf-32-le"), np.uint32)
        points = points.reshape(len(part), width)
        codes = np.where(points < len(classes), classes[np.minimum(points, len(classes) - 1)], 0)
        plain = ((codes > 0) == (np.arange(width) < sizes[:, None])).all(1)
        for k in np.flatnonzero(~plain).tolist():
            yield part[k], word_ids(part[k], pieces)
        part, codes, sizes = [part[k] for k in np.flatnonzero(plain)], codes[plain], sizes[plain]
        n = len(part)
        # a row per position and a column per word, words by length, so that those that reach a position are the last ones
        codes = np.ascontiguousarray(codes.T)
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0
        back_id, back_len = np.zeros((width + 1, n), np.int32), np.ones((width + 1, n), np.int32)
        for i in range(width):
            rows = np.arange(np.searchsorted(sizes, i, "right"), n)
            node = moves[0].take(codes[i, rows])
            before = best[i].take(rows)
            for size in range(1, min(pieces.longest, width - i) + 1):
                if size > 1:
                    node = flat.take(node * kinds + codes[i + size - 1].take(rows))
                on = np.flatnonzero(node)
                if not len(on):
                    break
                rows, node, before = rows.take(on), node.take(on), before.take(on)
                sums = before + score.take(node)
                better = np.flatnonzero(sums > best[i + size].take(rows))
                at = rows.take(better)
                best[i + size, at] = sums.take(better)
                back_id[i + size, at] = piece_ids.take(node.take(better))
                back_len[i + size, at] = size
        at, columns, k = sizes.copy(), np.arange(n), width
        out = np.zeros((n, width), np.int32)
        while n and at.any():
            k -= 1
            out[:, k] = np.where(at > 0, back_id[at, columns], -1)
            at = np.where(at > 0, at - back_len[at, columns], 0)
        counts = (out[:, k:] >= 0).sum(1) if n else []
        # ids were written from the last column backwards, one per step, so each row's ids end in the last column
        for word, row, count in zip(part, out.tolist(), counts, strict=True):
            yield word, tuple(row[width - count :])


def encode_batch(texts: list[str | None], known: dict[str, tuple[int, ...]], path: str | None = None) -> Iterator[np.ndarray]:
    """``encode`` for several texts, whose new words are searched together first. A null gives no ids."""
    pieces = load_pieces(path)
    if len(known) >= REMEMBERED:
        known.clear()
    if not pieces.words_apart:
        yield from (np.array(encode(text or "", pieces, known), np.int32) for text in texts)
        return
    words = [None if SPACE in (text or "") else WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
    new = set().union(*(own for own in words if own)).difference(known)
    known.update(words_ids([w for w in new if len(w) <= SHORT_WORD], path))
    for text, own in zip(texts, words, strict=True):
        try:
            yield np.fromiter(chain.from_iterable(map(known.__getitem__, own)), np.int32)
        except (KeyError, TypeError):  # a long word, or the alphabet's blank in the text
            yield np.array(encode(text, pieces, known), np.int32)


def encode(text: str, pieces: Pieces, known: dict[str, tuple[int, ...]]) -> list[int]:
    """Ids of a text: a blank is put before it and every blank written as the piece alphabet's own.

    Where no piece crosses into a word, all surviving paths meet before each word, so words are committed one by one
    and equal ones need one search. The alphabet's blank in the text itself becomes bytes, so decoding gives it back.
    """
    if not text:
        return []
    out: list[int] = []
    parts = text.split(SPACE)
    raw = [pieces.byte_ids[b] for b in SPACE.encode()]
    for k, part in enumerate(parts):
        if k:
            out += raw
        marked = (SPACE if k == 0 else "") + part.replace(" ", SPACE)
        if not pieces.words_apart:
            out += stream_ids(marked, pieces)
            continue
        for word in WORDS.findall(marked):
            ids = known.get(word)
            if ids is None:
                if len(word) > LONG_WORD:
                    out += stream_ids(word, pieces)
                    continue
                ids = known[word] = word_ids(word, pieces)
            out += ids
    return out


WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def decode(ids: Iterable[int], pieces: Pieces) -> str:
    """The text of ids; for ``encode``'s ids the very text. Bytes that are no UTF-8 give replacement characters."""
    try:
        text = "".join(map(pieces.plain.__getitem__, ids))
        return text[1:] if text.startswith(" ") else text
    except KeyError:  # bytes among them
        first = {i: b for b, i in enumerate(pieces.byte_ids)}
    out, run = [], bytearray()
    for i in ids:
        if i in first:
            run.append(first[i])
            continue
        if run:
            out.append(run.decode("utf-8", "replace"))
            run = bytearray()
        out.append((pieces.texts[i] or "").replace(SPACE, " "))
    out.append(run.decode("utf-8", "replace"))
    text = "".join(out)
    return text[1:] if text.startswith(" ") else text


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: the id and ``ids``, the token ids of its whole text as an array.

    A null text has null ids, an empty one none. Nothing is shuffled; a task holds a batch of texts and a bounded number
    of words it has met. Repeated rows are encoded alike, an empty table gives no rows.
    """
    source = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = part.column("text").to_pylist()
                found = encode_batch(texts, known, model_path)
                rows = [None if t is None else ids for t, ids in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, pa.list_(pa.int32()))], ["id", "ids"])

    schema = f"id {source.schema['id'].dataType.simpleString()}, ids array<int>"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """One row per row of ``encoded``: the id and ``text``; null ids give a null text. Ids must be of the vocabulary."""
    source = encoded.select(quoted(id_col).alias("id"), quoted(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model_path)
        for batch in batches:
            texts = [None if ids is None else decode(ids, pieces) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    schema = f"id {source.schema['id'].dataType.simpleString()}, text string"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of its ids, their checksum, and the checksum of the text that they decode to."""
    encoded = encode_documents(table(spark, sf_dir, "documents"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces()
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                n, ids_crc, text_crc = [], [], []
                for ids in part.column("ids"):
                    own = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32)
                    n.append(len(own))
                    ids_crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                    text_crc.append(zlib.crc32(decode(own.tolist(), pieces).encode()))
                columns = [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, ids_crc, text_crc))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids_crc32", "decoded_crc32"])

    return encoded.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long")


QUERIES = {"op8_sentencepiece": op8_sentencepiece}
ORACLE_SQL: dict[str, str] = {}
