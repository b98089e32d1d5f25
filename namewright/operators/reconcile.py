"""Compare two tables by keys; find and add only what is new."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from namewright.functions import norm_key, stable_id
from namewright.plans.joins import DEFAULT_LIMITS, Limits, drop_known
from namewright.sources.tables import require

KeyPairs = list[tuple[str, str]]


def compare_tables_by_keys(left: DataFrame, right: DataFrame, keys: KeyPairs) -> DataFrame:
    """Full outer comparison on pairs of (left, right) columns: (match_type, uuid_left, uuid_right, pairs).

    Keys are compared by norm_key() and must all agree; a null agrees with nothing. The two uuid columns hold the raw
    values of the first pair, which also decide the type: match, only_in_left, only_in_right, or unknown where both
    are null. ``pairs`` says how many row pairs the line stands for.

    Each side is first counted by its keys and spelling, map-side, so a key held by a third of both tables is joined
    as one row each rather than as every pair of rows.
    """
    if not keys:
        raise ValueError("at least one key pair is needed")
    require(left, [k for k, _ in keys], "left table")
    require(right, [k for _, k in keys], "right table")
    names = [f"k{i}" for i in range(len(keys))]

    def counted(df: DataFrame, cols: list[str], side: str) -> DataFrame:
        normed = [norm_key(F.col(c)).alias(f"{side}_{n}") for c, n in zip(cols, names)]
        spelled = df.filter(F.col(cols[0]).isNotNull()).select(
            *normed, F.col(cols[0]).cast("string").alias(f"uuid_{side}")
        )
        return spelled.groupBy(*spelled.columns).agg(F.count(F.lit(1)).alias(f"{side}_rows"))

    a = counted(left, [k for k, _ in keys], "left")
    b = counted(right, [k for _, k in keys], "right")
    same = reduce(Column.__and__, [a[f"left_{n}"] == b[f"right_{n}"] for n in names])
    in_left, in_right = F.col("uuid_left").isNotNull(), F.col("uuid_right").isNotNull()
    match_type = F.when(in_left & in_right, "match").when(in_left, "only_in_left").otherwise("only_in_right")
    rows = F.coalesce("left_rows", F.lit(1)) * F.coalesce("right_rows", F.lit(1))
    columns = ["match_type", "uuid_left", "uuid_right"]
    known = a.join(b, same, "full_outer").select(match_type.alias("match_type"), *columns[1:], rows.alias("pairs"))
    if len(keys) > 1:
        # The same spellings may meet under several values of the other keys.
        known = known.groupBy(*columns).agg(F.sum("pairs").alias("pairs"))

    # Rows without a first key match nothing and show nothing: they only need counting.
    blank = [df.filter(F.col(k).isNull()).select(F.lit(1).alias("n")) for df, k in zip((left, right), keys[0])]
    unknown = (
        blank[0]
        .unionByName(blank[1])
        .agg(F.count("n").alias("pairs"))
        .filter("pairs > 0")
        .select(
            F.lit("unknown").alias("match_type"),
            F.lit(None).cast("string").alias("uuid_left"),
            F.lit(None).cast("string").alias("uuid_right"),
            "pairs",
        )
    )
    return known.unionByName(unknown)


def _unmatched(incoming: DataFrame, existing: DataFrame, keys: KeyPairs, limits: Limits) -> DataFrame:
    """Incoming rows none of the existing rows agrees with; a null key agrees with nothing."""
    names = [f"__n{i}" for i in range(len(keys))]
    tagged = incoming.withColumns({n: norm_key(F.col(k)) for n, (k, _) in zip(names, keys)})
    present = existing.select(*[norm_key(F.col(k)).alias(n) for n, (_, k) in zip(names, keys)])
    return drop_known(tagged, present, names, limits).drop(*names)


def preview_new_rows(
    incoming: DataFrame,
    existing: DataFrame,
    keys: KeyPairs,
    projection: dict[str, Column],
    id_col: str,
    id_expr: Column | None = None,
    as_of: Column | None = None,
    time_col: str = "last_update",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Incoming rows without an existing match, cast to a target schema, with a fresh id and a load time.

    ``keys`` pairs (incoming, existing) columns, compared by norm_key(); a row with a null key is new. ``projection``
    names the target columns. The id is by default ``new:`` and a hash of the whole incoming row, so that looking
    twice gives the same ids.
    """
    require(incoming, [k for k, _ in keys], "incoming")
    require(existing, [k for _, k in keys], "existing")
    fresh = _unmatched(incoming, existing, keys, limits)
    row_id = id_expr if id_expr is not None else stable_id("new:", *[F.col(f"`{c}`") for c in sorted(incoming.columns)])
    return fresh.select(
        row_id.alias(id_col),
        *[col.alias(name) for name, col in projection.items()],
        (as_of if as_of is not None else F.current_timestamp()).alias(time_col),
    )


def _one_each(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. One row per key and task is left before the shuffle, so a hot key is no burden."""
    first = W.partitionBy(*by).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").drop("__rank")


def rows_to_insert(
    target: DataFrame, incoming: DataFrame, keys: list[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """One incoming row for every key the target lacks; of those that share the key the smallest, column by column in
    the order of their names.

    A row with a null key is known by its whole content instead, so inserting the same batch twice adds nothing. The
    target is read in its key columns only, but for such rows.
    """
    require(target, [*keys, *incoming.columns], "target")
    require(incoming, keys, "incoming")
    columns = incoming.columns
    ordered = [F.col(f"`{c}`") for c in sorted(columns)]
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    names = {f"__n{i}": norm_key(F.col(k)) for i, k in enumerate(keys)}

    keyed = incoming.filter(~no_key).withColumns(names)
    had = target.filter(~no_key).select(*[col.alias(name) for name, col in names.items()])
    new = _one_each(drop_known(keyed, had, list(names), limits), list(names), ordered).select(*columns)

    keyless = incoming.filter(no_key)
    if keyless.isEmpty():
        return new
    types = {f.name: f.dataType for f in target.schema.fields}
    content = F.to_json(F.struct(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in sorted(columns)]))
    digest = F.sha2(content, 256).alias("__row")
    had_rows = target.filter(no_key).select(digest)
    new_rows = _one_each(drop_known(keyless.select("*", digest), had_rows, ["__row"], limits), ["__row"], ordered)
    return new.unionByName(new_rows.select(*columns))


def insert_missing(
    target: DataFrame, incoming: DataFrame, keys: list[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The target with the rows it lacks; rows it has are never updated."""
    return target.unionByName(rows_to_insert(target, incoming, keys, limits), allowMissingColumns=True)
