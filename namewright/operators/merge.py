"""Merges that say what they did to each row, and rebuilding only what a changed mapping concerns."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.functions import differs
from namewright.operators.mapping import apply_mapping, last_per_key
from namewright.plans.joins import DEFAULT_LIMITS, Limits, fits_broadcast, lookup_join
from namewright.plans.shared import Settled, delete_folder, settle
from namewright.sources.tables import require

ACTION = "_action"
ACTIONS = ("inserted", "updated", "unchanged", "kept")


def _same(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"t.{k}").eqNullSafe(F.col(f"u.__key_{k}")) for k in keys])


def merge(
    target: DataFrame | None, updates: DataFrame, key: list[str], order_col: str, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The table after an upsert, with ``_action`` for each row: inserted, updated, unchanged (an update that says what
    the row said before) or kept (no update). Within the updates the last row of a key wins.

    The target must be unique on the key and have the columns of the updates but the order; its other columns are null in
    inserted rows. A null key matches a null key. Both sides are unique on the key, so no key is hot. Large updates meet
    the target in one full outer join; of few, measured first, the target is told by broadcast and not shuffled, and the
    new ones are found by their keys alone.
    """
    require(updates, [*key, order_col], "updates")
    fresh = last_per_key(updates, key, order_col).drop(order_col)
    values = [c for c in fresh.columns if c not in key]
    if target is None:
        return fresh.withColumn(ACTION, F.lit("inserted"))
    require(target, fresh.columns, "target")
    new = F.struct(F.lit(True).alias("__there"), *[F.col(c) for c in values]).alias("__new")
    whole = F.struct(*[F.col(c) for c in target.columns]).alias("__old")
    if fits_broadcast(updates.drop(order_col), limits):
        settled = settle(fresh, "updates").df
        told = lookup_join(target.select(*key, whole), settled.select(*key, new), key, null_safe=True, small=True, limits=limits)
        found = told.filter(F.col("__new").isNotNull()).select(*key)
        absent = lookup_join(settled.select(*key, new), found, key, "left_anti", null_safe=True, small=True, limits=limits)
        joined = told.unionByName(absent.withColumn("__old", F.lit(None).cast(told.schema["__old"].dataType)))
    else:
        told = target.select(*[F.col(k) for k in key], whole).alias("t")
        other = fresh.select(*[F.col(k).alias(f"__key_{k}") for k in key], new).alias("u")
        keys = [F.when(F.col("__old").isNotNull(), F.col(f"t.{k}")).otherwise(F.col(f"u.__key_{k}")).alias(k) for k in key]
        joined = told.join(other, _same(key), "full").select(*keys, "__old", "__new")
    return _tagged(joined, target.columns, key, values)


def _tagged(joined: DataFrame, columns: list[str], key: list[str], values: list[str]) -> DataFrame:
    old, new = F.col("__old"), F.col("__new")
    changed = reduce(Column.__or__, [differs(old[c], new[c]) for c in values], F.lit(False))
    action = (
        F.when(new.isNull(), "kept").when(old.isNull(), "inserted").when(changed, "updated").otherwise("unchanged").alias(ACTION)
    )
    value = {c: F.when(new.isNotNull(), new[c]).otherwise(old[c]) for c in values}
    shown = [F.col(c) if c in key else value.get(c, old[c]).alias(c) for c in columns]
    return joined.select(*shown, action)


def action_counts() -> dict[str, Column]:
    """Measures of a merge for write_table() or settle(): how many rows of each action were written."""
    return {name: F.count_if(F.col(ACTION) == name) for name in ACTIONS}


def merge_report(merged: DataFrame) -> DataFrame:
    """(action, rows) of a merge that was not measured while it was written; actions without rows are left out."""
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("rows"))


# Changed mappings -----------------------------------------------------------------------------------------------------


def changed_originals(before: DataFrame, after: DataFrame) -> DataFrame:
    """``original`` for every name that two versions of a mapping treat differently: added, removed or mapped elsewhere."""
    tagged = before.select("original", "normalized", F.lit(1).alias("side")).unionByName(
        after.select("original", "normalized", F.lit(2).alias("side"))
    )
    named = tagged.filter(F.col("original").isNotNull())
    best = [F.max(F.when(F.col("side") == side, F.col("normalized"))).alias(n) for side, n in ((1, "old"), (2, "new"))]
    seen = [F.max(F.col("side") == side).alias(n) for side, n in ((1, "was"), (2, "is"))]
    sides = named.groupBy("original").agg(*best, *seen)
    return sides.filter(differs(F.col("old"), F.col("new")) | (F.col("was") != F.col("is"))).select("original")


def remap_changed(
    spark: SparkSession,
    path: str,
    before: DataFrame,
    after: DataFrame,
    col: str,
    as_of: Column | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> dict[str, int]:
    """Bring a canonicalised table, stored as a folder of Parquet files, from one version of its mapping to the next.

    Rows whose original name is in the difference of the two versions are mapped anew; only files that hold such a row
    are rewritten, all others are not touched. The files are found by a join of names alone. New files are written
    before the old ones go, rows of unchanged names in them as they were. A reader in between sees rows twice, so
    let nobody read meanwhile. Returns the numbers of changed names, rows mapped anew and files rewritten. Files are
    listed on the driver: their number counts, not that of the rows.
    """
    stored = spark.read.parquet(path)
    original = f"original_{col}"
    require(stored, [col, original, "was_deduplicated", "deduplication_timestamp"], path)
    names = settle(changed_originals(before, after), "changed")
    counts = {"names": names.measures["rows"], "rows": 0, "files": 0}
    if counts["names"] == 0:
        return counts
    keys = replace(names, df=names.df.withColumnRenamed("original", original))
    with_file = stored.withColumn("__file", F.col("_metadata.file_path"))
    concerned = lookup_join(with_file.select(original, "__file"), keys, [original], "left_semi", limits=limits)
    files = [unquote(r["__file"]) for r in concerned.select("__file").distinct().collect()]
    if not files:
        return counts
    rows = spark.read.schema(stored.schema).parquet(*files)
    changed = lookup_join(rows, keys, [original], "left_semi", limits=limits)
    others = lookup_join(rows, keys, [original], "left_anti", limits=limits)
    plain = [c for c in stored.columns if c not in (col, original, "was_deduplicated", "deduplication_timestamp")]
    again = apply_mapping(changed.select(F.col(original).alias(col), *plain), after, col, as_of, plain, limits=limits)
    tagged = again.select(*stored.columns).withColumn("__anew", F.lit(True)).unionByName(others.withColumn("__anew", F.lit(False)))
    anew = settle(tagged, "remapped", anew=F.count_if("__anew"))
    anew.df.drop("__anew").coalesce(len(files)).write.mode("append").parquet(path)
    for file in files:
        delete_folder(spark, file)
    return counts | {"rows": anew.measures["anew"], "files": len(files)}

