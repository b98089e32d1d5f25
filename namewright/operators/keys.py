"""Which sets of columns tell all rows apart."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import ceil, log2, prod
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, MapType

from namewright.sources.tables import require

Columns = tuple[str, ...]

# A column whose estimated distinct values are below this share of all rows is no key; the sketch is some 30 times as exact.
_LIKELY = 0.5
# Repeats are looked for among so many rows first, then among a 64th and an 8th of all: those whose hash is 0 modulo a
# number. A repeat there rules a set out; the slice is one of values, so rows that agree are all in it or none.
_FIRST_ROWS = 1_000_000
_SLICES = (64, 8)
# Hashes that are sorted and cut at a time, and those a partition gets.
_BLOCK = 1 << 21
_PARTITION = 1 << 21


def _value(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    # 0.0 and -0.0 are one value to a grouping but two to a hash.
    return F.when(col == 0, F.lit(0.0)).otherwise(col) if isinstance(df.schema[name].dataType, (DoubleType, FloatType)) else col


class Counted(NamedTuple):
    """A table and its number of rows."""

    df: DataFrame
    rows: int


def _hashes(df: DataFrame, sets: dict[int, Columns], slices: int, bits: int) -> DataFrame:
    """A row per set and row of the slice: (h, b). The lowest ``bits`` of h tell the set, the others its hash; b is a second hash."""
    names = sorted({c for one in sets.values() for c in one})
    # Two hashes of every column once; then for each set the two hashes of its columns' hashes.
    hashes = df.select(*[F.array(*[F.xxhash64(F.lit(k), _value(df, c)) for c in names]).alias(f"__h{k}") for k in (0, 1)])
    width = max(map(len, sets.values()))
    wanted = [F.struct(*[F.lit(v) for v in (i, *(names.index(c) for c in one), *[-1] * (width - len(one)))]) for i, one in sets.items()]
    places = [f"__c{k}" for k in range(width)]
    each = hashes.select("*", F.inline(F.array(*wanted)).alias("i", *places))
    each = each.select("i", *[F.xxhash64(F.col("i"), *[F.get(f"__h{k}", F.col(c)) for c in places]).alias(n) for k, n in enumerate("ab")])
    if slices > 1:
        each = each.filter(F.pmod(F.col("b"), F.lit(slices)) == 0)
    return each.select(F.shiftleft("a", bits).bitwiseOR(F.col("i").cast("bigint")).alias("h"), "b")


def _wide_hashes(df: DataFrame, sets: dict[int, Columns], bits: int) -> DataFrame:
    """The same h of all rows in a column per set, which saves making a row of each."""
    names = sorted({c for one in sets.values() for c in one})
    first = df.select(*[F.xxhash64(F.lit(0), _value(df, c)).alias(f"__{names.index(c)}") for c in names])
    each = {i: F.xxhash64(F.lit(i), *[F.col(f"__{names.index(c)}") for c in one]) for i, one in sets.items()}
    return first.select(*[F.shiftleft(a, bits).bitwiseOR(F.lit(i).cast("bigint")).alias(f"h{i}") for i, a in each.items()])


def _packed(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Hashes in sorted arrays, one for each range of values, of a value no more than two copies from a block of rows."""
    bounds = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - int(log2(buckets)))) if buckets > 1 else np.empty(0, np.uint64)

    def block(parts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.sort(np.concatenate(parts))
        keep = np.ones(len(values), bool)
        keep[2:] = values[2:] != values[:-2]
        cut = np.split(values[keep], np.searchsorted(values[keep], bounds))
        full = [(i, one.tobytes()) for i, one in enumerate(cut) if len(one)]
        return pa.record_batch([pa.array([i for i, _ in full], pa.int32()), pa.array([one for _, one in full], pa.binary())], ["bucket", "hashes"])

    parts, held = [], 0
    for batch in batches:
        parts += [column.to_numpy().view(np.uint64) for column in batch.columns]
        held += batch.num_rows * batch.num_columns
        if held >= _BLOCK:
            yield block(parts)
            parts, held = [], 0
    if held:
        yield block(parts)


def _twice(batches: Iterator[pa.RecordBatch], bits: int, most: int) -> Iterator[pa.RecordBatch]:
    """How many values of a set are there twice, and the first ``most`` of them: (i, n, some)."""
    parts = [np.frombuffer(one.as_buffer(), np.uint64) for batch in batches for one in batch.column("hashes")]
    if not parts:
        return
    values = np.concatenate(parts)
    del parts
    values.sort()
    values = np.unique(values[1:][values[1:] == values[:-1]])
    of = values & np.uint64((1 << bits) - 1)
    for i in np.unique(of).tolist():
        own = values[of == i].view(np.int64)
        yield pa.record_batch(
            [pa.array([i], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([own[:most].tolist()], pa.list_(pa.int64()))], ["i", "n", "some"]
        )


def _repeated(table: Counted, sets: list[Columns], slices: int) -> set[Columns]:
    """The sets in which two rows agree; with ``slices`` only rows of one slice of the values are looked at.

    Every row sends one 64-bit number per set, eight bytes in a sorted array, to the partition of its range; a partition
    sorts some millions of them. Two unlike rows of a large table may meet in such a number, so repeats decide only if they are
    far more than chance brings; fewer are compared by a second hash.
    """
    if not sets:
        return set()
    bits = (len(sets) - 1).bit_length()
    sent = table.rows * len(sets) / slices
    buckets = 1 << max(0, ceil(log2(max(1.0, sent / _PARTITION))))
    # Pairs of unlike rows that chance lets agree in a set; more repeats than ``most`` are not all by chance.
    chance = (table.rows / slices) ** 2 / 2.0 ** (65 - bits)
    most = int(8 + 32 * chance)
    numbered = dict(enumerate(sets))
    hashes = _hashes(table.df, numbered, slices, bits).select("h") if slices > 1 else _wide_hashes(table.df, numbered, bits)
    packed = hashes.mapInArrow(lambda batches: _packed(batches, buckets), "bucket int, hashes binary")
    found = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(lambda batches: _twice(batches, bits, most), "i int, n bigint, some array<bigint>")
    # A row per set; values come back only where they are few.
    few = F.col("n") <= most
    counted = found.groupBy("i").agg(F.sum("n").alias("n"), F.flatten(F.collect_list(F.when(few, F.col("some")))).alias("some"))
    counted = counted.select("i", "n", F.when(few, F.col("some")).alias("some")).collect()
    repeated = {sets[row["i"]] for row in counted if row["n"] > most}
    open_sets = {row["i"]: row["some"] for row in counted if row["n"] <= most}
    if open_sets:
        again = _hashes(table.df, {i: sets[i] for i in open_sets}, slices, bits).filter(F.col("h").isin(sum(open_sets.values(), [])))
        again = again.groupBy("h", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        repeated |= {sets[row["h"] & ((1 << bits) - 1)] for row in again.select("h").distinct().collect()}
    return repeated


def minimal_keys(
    df: DataFrame, columns: list[str] | None = None, max_columns: int = 3, declared: Iterable[Iterable[str]] = ()
) -> list[Columns]:
    """All sets of up to ``max_columns`` columns that tell every row apart and hold no smaller such set, in column order.

    A column with a null is in no key. The lattice of column sets is searched level by level. A set is left out if it
    holds a key already found or ``declared``, or if the distinct values of its columns, estimated by fixed-size sketches
    in one pass, multiplied fall short of the rows. The others are looked at in slices of their values first; only
    those without a repeat there are looked at in full, by 64-bit hashes in one shuffle a level; where few hashes are there
    twice, their rows are compared by 128 bits.

    In an empty table every column is a key. Repeated rows leave no key. Without ``columns`` all are taken but maps, which
    cannot be compared; for a wide table name the columns, as the sets of three grow with the cube of their number.
    """
    keys = [tuple(key) for key in declared]
    require(df, [*(columns or []), *(c for key in keys for c in key)])
    names = columns if columns is not None else [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    if not names:
        return keys
    seen = [F.count(F.lit(1)), *[F.count(f"`{c}`") for c in names]]
    seen += [F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(_value(df, c)))) for c in names]
    rows, *counted = df.agg(*seen).first()
    distinct = dict(zip(names, counted[len(names) :], strict=True))
    names = [c for c, n in zip(names, counted, strict=False) if n == rows]
    for size in range(1, max_columns + 1):
        sets = [one for one in combinations(names, size) if not any(set(key) <= set(one) for key in keys)]
        likely = [one for one in sets if prod(distinct[c] for c in one) >= _LIKELY * rows]
        for slices in sorted({1, *_SLICES, max(_SLICES[0], rows // _FIRST_ROWS)}, reverse=True):
            repeated = _repeated(Counted(df, rows), likely, slices)
            likely = [one for one in likely if one not in repeated]
        keys += likely
    return keys


def composite_keys(
    df: DataFrame, columns: list[str] | None = None, max_columns: int = 3, declared: Iterable[Iterable[str]] = ()
) -> DataFrame:
    """``minimal_keys`` as rows: (key, columns), the names joined by a comma and as an array."""
    found = [(",".join(key), list(key)) for key in minimal_keys(df, columns, max_columns, declared)]
    return df.sparkSession.createDataFrame(found, "key string, columns array<string>")
