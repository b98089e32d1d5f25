"""Equi joins that hold when one key owns a third of the rows.

A lookup is unique on its key. Three ways to join rows with it, chosen by measurement:

* the lookup was counted and is small: broadcast it, the rows never move;
* it is large and no key of the rows is hot: a plain shuffle join;
* it is large and some keys are hot: rows of hot keys meet the few lookup rows of those keys by broadcast and are
  never shuffled; all others take the shuffle join. Both branches together are the whole result.

Rows of a stream cannot be counted before they come. For them keys are found hot in a static history, and their lookup
rows are salted: see salted_join().

A large lookup is settled first. It is then built once for both branches, and the shuffle join stands directly on two
shuffles, the shape in which adaptive execution can still split a partition that turns out large.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.plans.shared import Settled, row_width, settle


@dataclass(frozen=True)
class Limits:
    """Bounds that steer the physical plan. They never change a result."""

    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 * 1024 * 1024
    hot_rows: int = 1_000_000
    hot_keys: int = 3_000
    tracked_keys: int = 20_000


DEFAULT_LIMITS = Limits()

# Tasks that merge the sketches of all others.
_MERGERS = 256

# Salts a shuffle partition for a key that owns all rows; with 16 the fullest partition stays near the mean.
_SPREAD = 16

# Fixed, so that a repeated task draws the same salts.
_SALT_SEED = 7


def fits(rows: int, size: int, limits: Limits = DEFAULT_LIMITS) -> bool:
    return rows <= limits.broadcast_rows and size <= limits.broadcast_bytes


def settled_fits(table: Settled, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Whether a settled table may be broadcast; it was measured when it was written."""
    return fits(table.measures["rows"], table.measures["bytes"], limits)


def fits_broadcast(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Count the rows and bytes of a static DataFrame and say whether it may be broadcast."""
    return fits(*df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_width(df)), F.lit(0))).first(), limits)


def hot_counts(rows: DataFrame, on: list[str], limits: Limits = DEFAULT_LIMITS, key_hash: Column | None = None) -> dict[int, int]:
    """Hashes of the keys that own at least ``hot_rows`` rows, ``hot_keys`` of them at most, with their counts.

    One pass over the key columns with frequent-items sketches of fixed size, merged in two levels: nothing is shuffled
    but sketches. The default size finds every key with a 2,800th of the rows; one it misses is slower, never wrong.
    Null keys hash as well, so a pile of nulls is hot like any other key.
    """
    hashed = rows.select((F.xxhash64(*on) if key_hash is None else key_hash).alias("__h"), F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("__m"))
    size = limits.tracked_keys
    partial = hashed.groupBy("__m").agg(F.expr(f"approx_top_k_accumulate(__h, {size})").alias("__sketch"))
    # Grouped, as an empty partition has no sketch to combine; no group is left of no rows at all.
    merged = partial.groupBy(F.lit(0).alias("__all")).agg(F.expr(f"approx_top_k_combine(__sketch, {size})").alias("__sketch"))
    top = merged.select(F.expr(f"approx_top_k_estimate(__sketch, {limits.hot_keys})").alias("top")).first()
    return {entry["item"]: entry["count"] for entry in (top.top if top else None) or [] if entry["count"] >= limits.hot_rows}


def hot_hashes(rows: DataFrame, on: list[str], limits: Limits = DEFAULT_LIMITS, key_hash: Column | None = None) -> list[int]:
    """The hashes of hot_counts()."""
    return list(hot_counts(rows, on, limits, key_hash))


def _key_hash(rows: DataFrame, lookup: DataFrame, on: list[str]) -> Column:
    """The hash of the key in the type both sides have in common: an int and the same bigint hash differently."""
    common = rows.select(*on).limit(0).union(lookup.select(*on).limit(0)).schema if not rows.isStreaming else rows.schema
    return F.xxhash64(*[F.col(k).cast(common[k].dataType) for k in on])


def _join(rows: DataFrame, lookup: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    renamed = lookup.withColumnsRenamed({k: f"__key_{k}" for k in on})
    pairs = [(rows[k], renamed[f"__key_{k}"]) for k in on]
    same = reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    return rows.join(renamed, same, how).drop(*[f"__key_{k}" for k in on])


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    history: DataFrame,
    how: str = "left",
    null_safe: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """A shuffle join whose hot keys are spread over many tasks; ``rows`` may be a stream.

    Keys are hot when they are so in ``history``, static rows with the same key columns that resemble those to come. A
    key gets salts in proportion to its share, _SPREAD times the number of shuffle partitions for a key that owns all
    rows: its lookup row is repeated once for each, and a row with that key draws one of them. The shares add up to one,
    so all replicas together are fewer than _SPREAD rows a partition and one a hot key. A key that the history does not
    show is joined like any other: slower if it is hot, never wrong. Whatever salt a row draws, the lookup row is there.
    """
    spark = rows.sparkSession
    counts = hot_counts(history, on, limits, _key_hash(history, lookup, on))
    if not counts:
        return _join(rows, lookup, on, how, null_safe)
    total = max(history.count(), sum(counts.values()))
    most = _SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = [(item, math.ceil(most * n / total)) for item, n in counts.items()]
    # A row per hot key, at most limits.hot_keys of them.
    hot = F.broadcast(spark.createDataFrame(salts, "__hash bigint, __salts int"))

    def salted(side: DataFrame, salt: Column) -> DataFrame:
        hashed = side.withColumn("__hash", _key_hash(rows, lookup, on)).join(hot, "__hash", "left")
        return hashed.withColumn("__salt", salt).drop("__hash", "__salts")

    drawn = F.floor(F.rand(_SALT_SEED) * F.coalesce("__salts", F.lit(1))).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    return _join(salted(rows, drawn), salted(lookup, each), [*on, "__salt"], how, null_safe).drop("__salt")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame | Settled,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    small: bool | None = None,
    limits: Limits = DEFAULT_LIMITS,
    history: DataFrame | None = None,
) -> DataFrame:
    """The rows of lookup_parts() together."""
    return reduce(DataFrame.unionByName, lookup_parts(rows, lookup, on, how, null_safe, small, limits, history))


def lookup_parts(
    rows: DataFrame,
    lookup: DataFrame | Settled,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    small: bool | None = None,
    limits: Limits = DEFAULT_LIMITS,
    history: DataFrame | None = None,
    hot: list[int] | None = None,
    hot_side: DataFrame | None = None,
) -> list[DataFrame]:
    """Join ``rows`` (left, left_semi or left_anti) with a lookup that is unique on ``on``.

    ``history`` tells the hot keys of a stream from static rows; without it a stream's hot keys are not split. ``small`` is the answer of fits_broadcast() for the table the lookup was reduced from, where the caller has it: a
    scan of that table is cheaper than building the lookup just to measure it. ``hot`` are the hashes of the hot keys, where
    the caller knows them; ``hot_side`` then may be fewer rows that hold all with these keys.

    No key is in two parts, and after a shuffle join the rows of a part are still dealt out by the key.
    """
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    if isinstance(lookup, DataFrame):
        if small if small is not None else fits_broadcast(lookup, limits):
            return [_join(rows, F.broadcast(lookup), on, how, null_safe)]
        lookup = settle(lookup, "lookup")
    if settled_fits(lookup, limits):
        return [_join(rows, F.broadcast(lookup.df), on, how, null_safe)]
    if rows.isStreaming and history is not None:
        return [salted_join(rows, lookup.df, on, history, how, null_safe, limits)]
    hashed = _key_hash(rows, lookup.df, on)
    if hot is None:
        hot = [] if rows.isStreaming else hot_hashes(rows, on, limits, hashed)
    if not hot:
        return [_join(rows, lookup.df, on, how, null_safe)]
    is_hot = hashed.isin(hot)
    spread = _join(rows.filter(~is_hot), lookup.df.filter(~is_hot), on, how, null_safe)
    pinned = _join((rows if hot_side is None else hot_side).filter(is_hot), F.broadcast(lookup.df.filter(is_hot)), on, how, null_safe)
    return [spread, pinned]


def few_keys(df: DataFrame, on: list[str], limits: Limits = DEFAULT_LIMITS) -> bool:
    """Whether the distinct keys are likely to fit a broadcast, from one pass without a shuffle."""
    distinct, widest = df.select(*on).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*on))), F.coalesce(F.max(row_width(df.select(*on))), F.lit(0))
    ).first()
    return fits(distinct, distinct * widest, limits)


def drop_known(
    incoming: DataFrame, existing: DataFrame, on: list[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Incoming rows whose key no existing row has; a null key is never had.

    Few incoming keys are broadcast to the existing rows, of which only the matching keys then move: a small batch
    against a huge table shuffles next to nothing. Otherwise both sides are shuffled, the existing keys as distinct
    ones, hot keys of the incoming rows apart.
    """
    present = existing.select(*on).na.drop("any")
    if few_keys(incoming, on, limits):
        wanted = settle(incoming.select(*on).na.drop("any").distinct(), "keys")
        if settled_fits(wanted, limits):
            # A subset of `wanted`, so it fits as well.
            found = _join(present, F.broadcast(wanted.df), on, "left_semi", null_safe=False).distinct()
            return lookup_join(incoming, settle(found, "keys"), on, "left_anti", limits=limits)
    return lookup_join(incoming, present.distinct(), on, "left_anti", small=False, limits=limits)
