"""Packing documents into token sequences by minimum bin slack."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewright.llm.common import quoted, table, text_or_empty
from namewright.llm.vocab import byte_bpe

CAPACITY = 2048
END_ID = 1
#: A task keeps at most so many document ends (each shorter than a sequence) before it packs all but ``KEPT`` of them.
POOL = 2048
KEPT = 512


class Pool:
    """Rests shorter than a sequence, by length; ``window`` takes out the best filling of one sequence."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.lengths: list[int] = []  # distinct, ascending
        self.items: dict[int, list[tuple]] = {}
        self.size = 0

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        n = len(ids)
        if n not in self.items:
            self.items[n] = []
            insort(self.lengths, n)
        self.items[n].append((doc, start, ids, total))
        self.size += 1

    def take(self, n: int) -> tuple:
        item = self.items[n].pop()
        self.size -= 1
        if not self.items[n]:
            del self.items[n]
            del self.lengths[bisect_right(self.lengths, n) - 1]
        return item

    def window(self) -> list[tuple]:
        """The longest rest with the multiset of others whose sum comes closest to what it leaves.

        Where no multiset fills the sequence exactly, the next longest rest is cut to fill it; only the last window of
        all stays short.
        """
        out = [self.take(self.lengths[-1])]
        room = self.capacity - len(out[0][2])
        for n, times in best_filling(self.lengths, self.items, room):
            out += [self.take(n) for _ in range(times)]
            room -= n * times
        if room and self.size:
            doc, start, ids, total = self.take(self.lengths[-1])
            out.append((doc, start, ids[:room], total))
            self.add(doc, start + room, ids[room:], total)
        return out


def best_filling(lengths: list[int], items: dict[int, list], room: int) -> list[tuple[int, int]]:
    """(length, times) of a multiset with the largest sum up to ``room``: subset sums as bits of an integer.

    Lengths are tried from the longest; bit s of ``reach`` says that the lengths so far can sum to s. Counts are
    doubled, so c copies cost log c shifts. Walking back through the kept bitsets gives how often each was used.
    """
    mask, reach, full = (1 << room + 1) - 1, 1, 1 << room
    stages = []
    for k in range(bisect_right(lengths, room) - 1, -1, -1):
        n = lengths[k]
        left = most = min(len(items[n]), room // n)
        stages.append((n, most, reach))
        batch = 1
        while left > 0:
            batch = min(batch, left)
            reach |= reach << n * batch & mask
            left -= batch
            batch *= 2
        if reach & full:
            break
    at = reach.bit_length() - 1
    used = []
    for n, most, before in reversed(stages):
        times = next(m for m in range(most + 1) if at >= m * n and before >> at - m * n & 1)
        if times:
            used.append((n, times))
            at -= n * times
    return used


def pack_documents(
    documents: Iterable[tuple[object, np.ndarray]], capacity: int = CAPACITY, pool_size: int = POOL, kept: int = KEPT
) -> Iterator[tuple]:
    """Pieces ``(doc, start, ids, total, sequence, offset)`` of ``(doc, ids)``, sequences numbered from 0.

    Whole sequences are cut off the front of long documents. The rests go to a pool, from which sequences are filled
    when it holds ``pool_size`` of them, down to ``kept``. What cannot fill a last sequence is cut into
    sequences whose lengths are powers of two, which need no padding.
    """
    pool, sequence = Pool(capacity), 0

    def put(window: list[tuple]) -> Iterator[tuple]:
        nonlocal sequence
        offset = 0
        for doc, start, ids, total in window:
            yield doc, start, ids, total, sequence, offset
            offset += len(ids)
        sequence += 1

    for doc, ids in documents:
        total, start = len(ids), 0
        while total - start >= capacity:
            yield from put([(doc, start, ids[start : start + capacity], total)])
            start += capacity
        if start < total:
            pool.add(doc, start, ids[start:].copy() if start else ids, total)
        if pool.size >= pool_size:
            while pool.size > kept:
                window = pool.window()
                if tokens(window) < capacity:  # it took all there is: wait for more
                    for piece in window:
                        pool.add(*piece)
                    break
                yield from put(window)
    while pool.size:
        window = pool.window()
        if tokens(window) == capacity:
            yield from put(window)
        else:
            yield from (piece for part in powers_of_two(window) for piece in put(part))


def tokens(window: list[tuple]) -> int:
    return sum(len(ids) for _, _, ids, _ in window)


def powers_of_two(window: list[tuple]) -> Iterator[list[tuple]]:
    """A window cut anew into parts whose lengths are falling powers of two."""
    left = tokens(window)
    rest = list(reversed(window))
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        part = []
        while room:
            doc, start, ids, total = rest.pop()
            part.append((doc, start, ids[:room], total))
            if len(ids) > room:
                rest.append((doc, start + room, ids[room:], total))
            room -= min(room, len(ids))
        yield part


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocab_path: str | None = None,
    pool_size: int = POOL,
    kept: int = KEPT,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids. A document's tokens are its text's ids and then ``end_id``; each
    is in exactly one piece, ``start`` being the number of the document's tokens before it. A sequence's pieces lie
    without gaps from offset 0. Sequences have ``capacity`` tokens but for the last few of each task, whose lengths are
    powers of two. Every task packs what it reads and nothing is shuffled; it holds a batch of texts and ``pool_size``
    rests. ``sequence_id`` joins the task's partition number with its own count, so a repeated task gives the same rows as
    long as its input comes in the same order, as from files.

    A null or empty text has the one token ``end_id``. Repeated rows are packed each on its own. An empty table gives no
    rows. Columns other than the two named are not read.
    """
    source = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType(
        [T.StructField("id", source.schema["id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]
    )
    last = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = byte_bpe(vocab_path)
        base = TaskContext.get().partitionId() << 33
        id_type = None

        def documents() -> Iterator[tuple]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("id").type
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                    yield doc, np.concatenate([encode(text.as_py()), last])

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, total, sequence, offset = zip(*rows, strict=True)
            as_long = lambda values: pa.array(values, pa.int64())
            columns = [
                pa.array(doc, id_type),
                as_long(start),
                as_long([len(x) for x in ids]),
                pa.array([x.tobytes() for x in ids], pa.binary()),
                as_long(total),
                as_long([base + s for s in sequence]),
                as_long(offset),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        rows: list[tuple] = []
        for piece in pack_documents(documents(), capacity, pool_size, kept):
            rows.append(piece)
            if len(rows) >= 2000:
                yield emit(rows)
                rows = []
        if rows:
            yield emit(rows)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {"op7_packing": op7_packing}
ORACLE_SQL: dict[str, str] = {}
