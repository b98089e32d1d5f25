"""Columns, lookups and identifiers of the deduplicated table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from namewright.functions import differs
from namewright.plans.joins import DEFAULT_LIMITS, Limits, fits_broadcast, lookup_join, settled_fits
from namewright.plans.shared import settle
from namewright.sources.tables import require

# monotonically_increasing_id() keeps the position within the partition in its low 33 bits.
_POSITION_BITS = 33


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Add the missing ones of ``columns`` (name to type) as nulls; report which were added and which were there."""
    report: dict[str, list[str]] = {"executed": [], "skipped": []}
    for name in columns:
        report["skipped" if name in df.columns else "executed"].append(name)
    return df.withColumns({n: F.lit(None).cast(columns[n]) for n in report["executed"]}), report


def enrich(rows: DataFrame, lookup: DataFrame, key: str, col: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Take ``col`` from the lookup row with the same key; without one keep the current value.

    The lookup should be unique on the key. If it is not, the smallest value stands, so that runs agree.
    """
    require(rows, [key, col], "rows")
    require(lookup, [key, col], "lookup")
    found = lookup.groupBy(key).agg(F.min(col).alias("__found"), F.lit(True).alias("__hit"))
    small = fits_broadcast(lookup.select(key, col), limits)
    joined = lookup_join(rows, found, [key], small=small, limits=limits)
    value = F.when(F.col("__hit"), F.col("__found")).otherwise(F.col(col))
    return joined.withColumn(col, value).select(*rows.columns)


def unify_ids(
    rows: DataFrame,
    group: list[str],
    id_col: str,
    deprecated_col: str,
    flag_col: str,
    strict: list[str] | None = None,
    include_unmapped: bool = False,
    changed_col: str | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Within a group give flagged rows the smallest id and keep the id they had in ``deprecated_col``.

    Null group values are a group of their own, except in the ``strict`` columns (default: the first), where a null
    joins nothing. Unflagged rows keep their ids unless ``include_unmapped``. ``changed_col`` names an extra column that
    tells whether this call changed the row.

    The minimum is aggregated map-side and only groups with something to change are kept, so no group ever has to meet
    in one task, as it would in a window. Where few groups have flagged rows, as with a short mapping, only rows of
    those groups are aggregated at all. Rows then look their group up: by broadcast if those groups are few; otherwise
    only the flagged rows are shuffled, hot groups apart.
    """
    require(rows, [*group, id_col, deprecated_col, flag_col], "rows")
    flagged = F.lit(True) if include_unmapped else F.coalesce(F.col(flag_col), F.lit(False))
    named = rows
    for name in strict if strict is not None else group[:1]:
        named = named.filter(F.col(name).isNotNull())
    if not include_unmapped:
        affected = settle(named.filter(flagged).select(*group).distinct(), "groups")
        if settled_fits(affected, limits):
            named = lookup_join(named, affected, group, "left_semi", null_safe=True, limits=limits)
    groups = named.groupBy(*group).agg(
        F.min(id_col).alias("__lowest"),
        F.max(id_col).alias("__highest"),
        F.count_if(F.col(id_col).isNull()).alias("__without"),
        F.bool_or(flagged).alias("__flagged"),
    )
    mixed = (F.col("__lowest") != F.col("__highest")) | (F.col("__without") > 0)
    changing = settle(
        groups.filter(F.col("__flagged") & F.col("__lowest").isNotNull() & mixed).select(*group, "__lowest"), "groups"
    )

    def rewrite(part: DataFrame) -> DataFrame:
        joined = lookup_join(part, changing, group, null_safe=True, limits=limits)
        changed = flagged & F.col("__lowest").isNotNull() & differs(F.col(id_col), F.col("__lowest"))
        new_id = F.when(changed, F.col("__lowest")).otherwise(F.col(id_col))
        deprecated = F.when(changed, F.col(id_col)).otherwise(F.col(deprecated_col))
        told = {changed_col: changed} if changed_col else {}
        return joined.withColumns({id_col: new_id, deprecated_col: deprecated, **told}).select(*rows.columns, *told)

    if include_unmapped or settled_fits(changing, limits):
        return rewrite(rows)
    untouched = rows.filter(~flagged)
    if changed_col:
        untouched = untouched.withColumn(changed_col, F.lit(False))
    return rewrite(rows.filter(flagged)).unionByName(untouched)


def assign_ids(rows: DataFrame, order_by: list[str], col: str = "id") -> DataFrame:
    """Number the rows 1..n in the order of a key, unless the column exists.

    Rows are range-partitioned and sorted, each partition on its own; a row's number is its position plus the sizes of
    the partitions before it. The placed rows are settled first, so both passes see the same positions even when
    executors are lost. Rows equal in ``order_by`` are split by a hash of the rest, so ties need not share a task.
    """
    if col in rows.columns:
        return rows
    require(rows, order_by, "rows")
    rest = [f.name for f in rows.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in order_by]
    keys = [F.col(c) for c in order_by] + ([F.xxhash64(*rest)] if rest else [])
    placed = settle(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}),
        "placed",
    ).df
    # One row per partition from here on: the running sum and the broadcast are bounded by the partition count.
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    earlier = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    position = F.col("__row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), "__part")
    return numbered.select(*rows.columns, (F.col("__offset") + position + 1).alias(col))


def audit_trail(rows: DataFrame, name_col: str, id_col: str, deprecated_col: str = "uuid_deprecated") -> DataFrame:
    """The rows a run changed, with old and new name, old and new id, and when."""
    original = f"original_{name_col}"
    require(rows, [name_col, original, id_col, deprecated_col, "was_deduplicated", "deduplication_timestamp"])
    touched = rows.filter(F.col("was_deduplicated") | F.col(deprecated_col).isNotNull())
    return touched.select(
        F.col(original).alias("old_name"),
        F.col(name_col).alias("new_name"),
        F.coalesce(deprecated_col, id_col).alias("old_id"),
        F.col(id_col).alias("new_id"),
        F.col("deduplication_timestamp").alias("changed_at"),
    )
