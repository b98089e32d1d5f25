"""Byte-level BPE by recursive queries: every task holds the merge table in a DuckDB of its own, in its own process."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from namewright.llm.common import parts, quoted, table, text_or_empty

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters of text that are worked on together.
TEXT_CHARS = 4_000_000
#: Words whose ids a task remembers; it forgets them all when there are more.
REMEMBERED = 600_000
#: Bytes of new words in one query, and rows that a query's recursion may gather; longer words take several queries.
WORD_BYTES = 1_500_000
STATE_ROWS = 12_000_000
#: Words of more bytes are merged by the query that takes a whole run of equal pairs in one step.
LONG_WORD = 64
#: What DuckDB may hold. It is told to write no file.
MEMORY = "400MB"

# A row of `state` is a token of a word; `pos` is its first byte's place in all words of the query, so rows of one word
# stand together. A step looks every neighbouring pair up in the merge table and contracts, in each word, the pairs of
# the word's smallest rank. The last token of a word has no pair, so a run of such pairs never crosses words.
_STEPS = """
    WITH RECURSIVE state AS (
        SELECT word, pos, id, 0 AS step FROM start
        UNION ALL
        (WITH pairs AS (
            SELECT *, CASE WHEN lead(word) OVER w = word THEN (CAST(id AS BIGINT) << 32) + lead(id) OVER w END AS pair
            FROM state WHERE step < {steps} WINDOW w AS (ORDER BY pos)),
        ranked AS MATERIALIZED (SELECT word, pos, id, step{pair}, rank FROM pairs LEFT JOIN merges USING (pair)),
        best AS (SELECT word, min(rank) AS best FROM ranked WHERE rank IS NOT NULL GROUP BY word),
        found AS (SELECT ranked.*, best, coalesce(rank = best, false) AS hit FROM ranked JOIN best USING (word)),
        {contracted}
        SELECT word, pos, CASE WHEN contracts THEN best ELSE id END, step + 1 FROM contracted WHERE NOT gone))
    SELECT word, pos, id, step FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
    ORDER BY pos"""
# Pairs of one rank overlap only in a run of one token; of such a run the first pair is contracted...
_FIRST_OF_RUN = "", """contracted AS (
            SELECT *, hit AND NOT before AS contracts, before AND NOT before_that AS gone FROM (
                SELECT *, lag(hit, 1, false) OVER w AS before, lag(hit, 2, false) OVER w AS before_that
                FROM found WINDOW w AS (ORDER BY pos)))"""
# ...or the first, third and so on: those at an odd distance from the row before the run.
_WHOLE_RUN = ", pair", """numbered AS (SELECT *, row_number() OVER (ORDER BY pos) AS n FROM found),
        chosen AS (
            SELECT *, hit AND (id <> pair & 4294967295 OR (n - coalesce(max(CASE WHEN NOT hit THEN n END) OVER w, 0)) % 2 = 1)
                AS contracts FROM numbered WINDOW w AS (ORDER BY pos ROWS UNBOUNDED PRECEDING)),
        contracted AS (SELECT *, coalesce(lag(contracts) OVER (ORDER BY pos), false) AS gone FROM chosen)"""
_DECODED = """
    SELECT doc, count(*) AS n, unhex(string_agg(bytes, '' ORDER BY pos)) AS bytes
    FROM tokens JOIN vocabulary USING (id) GROUP BY doc"""


class Vocabulary(NamedTuple):
    """Each token's bytes as hexadecimal digits, the merges as pairs of ids (one number: the left
    one in the upper half) with the id they make, the ids of the bytes."""

    tokens: pa.Table
    merges: pa.Table
    byte_ids: np.ndarray


@functools.lru_cache(maxsize=2)
def load_vocabulary(path: str | None = None) -> Vocabulary:
    """Read a file of ranks, a token's rank being its id. None is the file of VOCABULARY, installed on each machine.

    A token is made from the two parts to which merges of smaller ranks bring its bytes, and from no others: whoever
    merges by rank meets no other pair of parts that makes it. So ranks rise from one merge to the next, which lets a
    query contract all pairs of one rank in one step. A vocabulary with a token that is not made from two parts is refused.
    """
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"no token for byte {missing[0]}")
    merges = []
    for token, rank in ranks.items():
        own = [token[k : k + 1] for k in range(len(token))]
        while len(own) > 2:
            made = [(ranks.get(a + b, rank), k) for k, (a, b) in enumerate(zip(own, own[1:], strict=False))]
            least, k = min(made)
            if least >= rank:
                raise ValueError(f"token {rank} is not made from two others")
            own[k : k + 2] = [own[k] + own[k + 1]]
        if len(own) == 2:
            merges.append((ranks[own[0]], ranks[own[1]], rank))
    tokens = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "bytes": [t.hex() for t in ranks]})
    pairs = pa.array([(a << 32) + b for a, b, _ in merges], pa.int64())
    table = pa.table({"pair": pairs, "rank": pa.array([rank for _, _, rank in merges], pa.int32())})
    return Vocabulary(tokens, table, np.array([ranks[bytes([b])] for b in range(256)], np.int32))


@functools.lru_cache(maxsize=2)
def splitter(pattern: str | None = None) -> re.Pattern:
    """The pattern that cuts text into words (None: the one of the public tokenizers), for Python's own matcher.

    The classes of letters, numbers and white space are written out as ranges, asked of the tiktoken library itself, as
    libraries differ in the version of Unicode they know.
    """
    import public_tokenizers
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    ranks = {bytes([b]): b for b in range(256)}

    def ranges(kind: str) -> str:
        encoding = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        codes = np.frombuffer(encoding.decode(encoding.encode_ordinary(every)).encode("utf-32-le"), "<u4").astype(np.int64)
        breaks = np.flatnonzero(np.diff(codes) != 1)
        firsts, lasts = codes[np.r_[0, breaks + 1]], codes[np.r_[breaks, len(codes) - 1]]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts, strict=True))

    letters, numbers, white = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    own = pattern or public_tokenizers.PATTERN
    own = own.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{numbers}]")
    for kind, chars in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\s", f"[{white}]"), (r"\S", f"[^{white}]")):
        own = own.replace(kind, chars)
    return re.compile(own)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class Numbers(dict):
    """A number for each word asked for; ``new`` gathers those asked for the first time."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class Coder:
    """Encodes and decodes batches of texts with one DuckDB connection, to be closed after use."""

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED):
        import duckdb

        vocabulary = load_vocabulary(path)
        self.byte_ids, self.split, self.remembered = vocabulary.byte_ids, splitter().findall, remembered
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self._load("vocabulary", vocabulary.tokens)
        self._load("merges", vocabulary.merges)
        self._forget()

    def close(self) -> None:
        self.db.close()

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS FROM rows")
        self.db.unregister("rows")

    def _forget(self) -> None:
        self.known = Numbers()
        self.starts = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _contracted(self, words: list[bytes], runs: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words, and how many each word has."""
        lengths = np.array([len(w) for w in words])
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        state = [word, np.arange(len(ids), dtype=np.int32), ids]
        done: list[list[np.ndarray]] = []
        while len(state[0]):
            steps = max(1, STATE_ROWS // len(state[0]))
            self.db.register("start", pa.table(state, ["word", "pos", "id"]))
            query = _STEPS.format(steps=steps, pair=runs[0], contracted=runs[1])
            found = self.db.sql(query).to_arrow_table()
            self.db.unregister("start")
            *rows, step = (found.column(c).to_numpy() for c in ("word", "pos", "id", "step"))
            done.append([c[step < steps] for c in rows])
            state = [c[step == steps] for c in rows]
        word, pos, ids = (np.concatenate(c) for c in zip(*done, strict=True))
        return ids[np.argsort(pos, kind="stable")], np.bincount(word, minlength=len(words))

    def _learn(self) -> None:
        """Find the ids of the new words, in the order of their numbers."""
        words, self.known.new = [w.encode() for w in self.known.new], []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lengths = np.array([len(w) for w in words], np.int64)
        for group, runs in ((lengths <= LONG_WORD, _FIRST_OF_RUN), (lengths > LONG_WORD, _WHOLE_RUN)):
            own = np.flatnonzero(group)
            before = np.cumsum(lengths[own]) - lengths[own]
            for some in np.split(own, np.flatnonzero(np.diff(before // WORD_BYTES)) + 1):
                if len(some):
                    found.append((some, *self._contracted([words[k] for k in some.tolist()], runs)))
        if found:
            number, ids, counts = (np.concatenate(c) for c in zip(*found, strict=True))
            starts = np.empty_like(counts)
            starts[number] = len(self.ids) + np.cumsum(counts) - counts
            self.starts = np.concatenate([self.starts, starts])
            self.counts = np.concatenate([self.counts, counts[np.argsort(number)]])
            self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        if len(self.known) > self.remembered:
            self._forget()
        words = [self.split(text) for text in texts]
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64)
        self._learn()
        counts = self.counts[number]
        before = np.concatenate([[0], np.cumsum(counts)])
        ends = before[np.cumsum([0] + [len(own) for own in words])]
        return self.ids[_ranges(self.starts[number], counts)], np.diff(ends)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids, the lists standing one after the other. An unknown id is an error."""
        doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.db.register("tokens", pa.table([doc, np.arange(len(ids), dtype=np.int32), ids.astype(np.int32)], ["doc", "pos", "id"]))
        out, seen = [b""] * len(counts), 0
        for k, n, raw in self.db.sql(_DECODED).fetchall():
            out[k] = raw
            seen += n
        self.db.unregister("tokens")
        if seen != len(ids):
            raise ValueError("ids that are not of the vocabulary")
        return out


def _mapped(source: DataFrame, schema: T.StructType, column: str, most: int, path: str | None, work) -> DataFrame:
    """mapInArrow with a Coder per task: ``work(coder, piece)`` gives the columns after the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path)
        try:
            for batch in batches:
                for piece in parts(batch, column, most):
                    yield pa.RecordBatch.from_arrays([piece.column("id"), *work(coder, piece)], schema.names)
        finally:
            coder.close()

    return source.mapInArrow(run, schema)


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the id and ``ids``, the token ids of its whole text as an array.

    Words are the matches of the pattern, and each is encoded by itself. The new words of a piece of the partition
    become rows of one token per byte; a recursive query joins neighbouring tokens with the merge table and contracts
    each word's leftmost pair of smallest rank, with the further pairs of that rank, until no word has a pair left.

    Nothing is shuffled. A task holds a batch of texts and a bounded number of words. A null text counts as empty and
    has no ids; repeated rows are encoded alike; an empty table gives no rows; other columns are not read. ``path``
    names a file of ranks that every machine has.
    """
    source = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([source.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def work(coder: Coder, piece: pa.RecordBatch) -> list[pa.Array]:
        return [_lists(*coder.encode(piece.column("text").to_pylist()))]

    return _mapped(source, schema, "text", TEXT_CHARS, path, work).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """One row per row of ``encoded``: the id and ``bytes``, what the ids stand for, by an ordered aggregation.

    For ``encode_documents``'s ids that is the text in UTF-8. Null ids count as none. An id that the vocabulary lacks
    fails the job.
    """
    source = encoded.select(quoted(id_col).alias("id"), quoted(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([source.schema["id"], T.StructField("bytes", T.BinaryType())])

    def work(coder: Coder, piece: pa.RecordBatch) -> list[pa.Array]:
        ids = piece.column("ids")
        counts = np.nan_to_num(pc.list_value_length(ids).to_numpy(zero_copy_only=False)).astype(np.int64)
        return [pa.array(coder.decode(ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False), counts), pa.binary())]

    return _mapped(source, schema, "ids", TEXT_CHARS // 4, path, work).withColumnRenamed("id", id_col)


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode and decode in one pass: ``id, n_tokens, ids_sha256, decoded_sha256`` per row of ``docs``.

    The checksums are those of the ids as little-endian unsigned 32-bit numbers and of the decoded bytes. Odd rows are as
    in ``encode_documents``.
    """
    source = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    schema = T.StructType([source.schema["id"]] + [T.StructField(n, t) for n, t in fields])

    def work(coder: Coder, piece: pa.RecordBatch) -> list[pa.Array]:
        ids, counts = coder.encode(piece.column("text").to_pylist())
        own = np.split(ids.astype("<u4"), np.cumsum(counts)[:-1])
        return [
            pa.array(counts, pa.int64()),
            pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in own]),
            pa.array([hashlib.sha256(x).hexdigest() for x in coder.decode(ids, counts)]),
        ]

    return _mapped(source, schema, "text", TEXT_CHARS, path, work).withColumnRenamed("id", id_col)


def op13_duckdb_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"))


QUERIES = {"op13_duckdb_bpe": op13_duckdb_bpe}
ORACLE_SQL: dict[str, str] = {}
