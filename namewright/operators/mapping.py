"""Apply name corrections and keep their table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.functions import norm_key, not_blank
from namewright.plans.joins import DEFAULT_LIMITS, Limits, fits_broadcast, lookup_join
from namewright.plans.shared import settle
from namewright.sources.tables import require


def last_per_key(rows: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """One row per key, the last by ``order_col``. Combines map-side, so a hot key costs one row per task.

    Of rows of the same order the greatest content stands, so runs agree. A null order fails the job: such a row has no
    place among the others.
    """
    rest = [c for c in rows.columns if c not in [*key, order_col]]
    order = F.coalesce(F.col(order_col), F.raise_error(F.lit(f"{order_col} is null"))).alias(order_col)
    last = F.max(F.struct(order, *rest)).alias("__last")
    return rows.groupBy(*key).agg(last).select(*key, "__last.*").select(*rows.columns)


def upsert(
    target: DataFrame | None, updates: DataFrame, key: list[str], order_col: str, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Replace rows whose key is updated, add new keys, keep all others; within the updates the last row wins.

    Without a target the updates become the table. The result is unique on the key if the target is.
    """
    require(updates, [*key, order_col], "updates")
    fresh = last_per_key(updates, key, order_col).drop(order_col)
    if target is None:
        return fresh
    require(target, key, "target")
    small = fits_broadcast(updates.select(*key), limits)
    kept = lookup_join(target, fresh.select(*key), key, "left_anti", small=small, limits=limits)
    return kept.unionByName(fresh, allowMissingColumns=True)


def _unique_targets(mapping: DataFrame) -> DataFrame:
    """One target per original: repeated originals would multiply rows. Of several targets the greatest text stands."""
    named = mapping.filter(F.col("original").isNotNull())
    return named.groupBy("original").agg(F.max("normalized").alias("normalized"))


def apply_mapping(
    rows: DataFrame,
    mapping: DataFrame,
    col: str,
    as_of: Column | None = None,
    passthrough: list[str] | None = None,
    fold: bool = False,
    limits: Limits = DEFAULT_LIMITS,
    history: DataFrame | None = None,
) -> DataFrame:
    """Replace the names in ``col`` by their mapped form and say what was done to each row.

    Rows without a name are dropped. The match is exact, case and outer blanks included, and takes one hop; unmatched
    rows stay as they are. Adds ``original_<col>``, ``was_deduplicated`` and ``deduplication_timestamp``; the other
    columns pass through (all, or those named). With ``fold`` a name that has no exact match is tried again by its
    comparison key; where folded originals disagree the greatest target stands. ``history`` holds names like those of
    a stream in ``col``; its hot names are split over tasks (see salted_join()).
    """
    require(rows, [col, *(passthrough or [])], "rows")
    if history is not None:
        require(history, [col], "history")
        history = history.filter(not_blank(F.col(col))).select(col)
    require(mapping, ["original", "normalized"], "mapping")
    others = passthrough if passthrough is not None else [c for c in rows.columns if c != col]
    targets = _unique_targets(mapping)
    small = fits_broadcast(mapping.select("original", "normalized"), limits)

    named = rows.filter(not_blank(F.col(col)))
    exact = targets.select(F.col("original").alias(col), F.col("normalized").alias("__target"))
    joined = lookup_join(named, exact, [col], small=small, limits=limits, history=history)
    target = F.col("__target")
    if fold:
        by_key = targets.groupBy(norm_key(F.col("original")).alias("__folded"))
        folded = by_key.agg(F.max("normalized").alias("__folded_target"))
        keyed = joined.withColumn("__folded", norm_key(F.col(col)))
        keys = None if history is None else history.select(norm_key(F.col(col)).alias("__folded"))
        joined = lookup_join(keyed, folded, ["__folded"], small=small, limits=limits, history=keys)
        target = F.coalesce(target, F.col("__folded_target"))
    return joined.select(
        F.coalesce(target, F.col(col)).alias(col),
        F.col(col).alias(f"original_{col}"),
        target.isNotNull().alias("was_deduplicated"),
        F.when(target.isNotNull(), as_of if as_of is not None else F.current_timestamp()).alias(
            "deduplication_timestamp"
        ),
        *others,
    )


def resolve_chains(mapping: DataFrame, max_hops: int | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Follow a -> b -> c to its end: every original gets the last name of its chain, once.

    Each round looks the targets up in the table itself and so doubles the hops covered. Of several targets of a name
    the greatest stands, itself included; a name mapped to itself is an end. Raises when names run in a circle, which a
    chain of more hops than there are links does, and when a chain has more than ``max_hops`` hops, if given.
    """
    targets = _unique_targets(mapping)
    own = F.col("original").eqNullSafe(F.col("normalized"))
    ends = targets.filter(own)
    table = settle(targets.filter(~own).withColumn("__hops", F.lit(1).cast("bigint")), "chains")
    links = table.measures["rows"]
    while True:
        step = table.df.select(
            F.col("original").alias("normalized"), F.col("normalized").alias("__next"), F.col("__hops").alias("__more")
        )
        looked = lookup_join(table.df, replace(table, df=step), ["normalized"], limits=limits)
        onward = looked.select(
            "original",
            F.when(F.col("__more").isNull(), F.col("normalized")).otherwise(F.col("__next")).alias("normalized"),
            (F.col("__hops") + F.coalesce("__more", F.lit(0))).alias("__hops"),
            F.col("__more").isNotNull().alias("__moved"),
        )
        moved = F.count_if("__moved")
        circles = F.count_if(F.col("original") == F.col("normalized"))
        longest = F.coalesce(F.max("__hops"), F.lit(0))
        settled = settle(onward, "chains", moved=moved, circles=circles, longest=longest)
        table = replace(settled, df=settled.df.drop("__moved"))
        if table.measures["circles"] > 0 or table.measures["longest"] > links:
            raise ValueError("mapping has a circle")
        if max_hops is not None and table.measures["longest"] > max_hops:
            raise ValueError(f"mapping has a circle or a chain of more than {max_hops} hops")
        if table.measures["moved"] == 0:
            return table.df.drop("__hops").unionByName(ends)
