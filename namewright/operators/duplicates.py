"""Which values occur more than once, in which rows; which columns are keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from namewright.functions import SHORT_KEY_CHARS, dup_key, short_key
from namewright.operators.keys import minimal_keys
from namewright.plans.joins import DEFAULT_LIMITS, Limits, hot_hashes, lookup_parts, settled_fits
from namewright.plans.shared import Settled, settle
from namewright.sources.tables import require

# Ids in one list; a group with more of them gets several lists.
IDS_PER_LIST = 10_000


def _checked_columns(df: DataFrame, columns: list[str] | None, keys: list[str]) -> list[str]:
    require(df, [*(columns or []), *keys])
    return [c for c in df.columns if c not in keys and (columns is None or c in columns)]


def _values(df: DataFrame, columns: list[str], case_insensitive: bool) -> dict[str, Column]:
    return {c: dup_key(F.col(f"`{c}`"), df.schema[c].dataType, case_insensitive) for c in columns}


def _short_keys(df: DataFrame, values: dict[str, Column]) -> dict[str, Column]:
    """short_key() of every value; numbers and times are never long, so their text is made only once."""
    brief = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)
    return {c: v if isinstance(df.schema[c].dataType, brief) else short_key(v) for c, v in values.items()}


def _is_long(key: Column) -> Column:
    return F.length(key) > SHORT_KEY_CHARS


def _groups(df: DataFrame, values: dict[str, Column], limit: int | None) -> Settled:
    """The groups of every column, or the ``limit`` largest, as (__column, __key, __count).

    All columns are counted in one pass, combined map-side, so a value owning a third of the rows sends one row a
    task; the top-k filter also runs before its shuffle. Equal counts are ordered by key. The groups found are
    settled: ids, texts and records all start from them, and the table is not counted again for each.
    """
    keyed = df.select(*[k.alias(c) for c, k in _short_keys(df, values).items()])
    pairs = keyed.unpivot([], list(values), "__column", "__key").filter(F.col("__key").isNotNull())
    counts = pairs.groupBy("__column", "__key").agg(F.count(F.lit(1)).alias("__count")).filter("__count > 1")
    if limit is not None:
        order = W.partitionBy("__column").orderBy(F.col("__count").desc(), "__key")
        counts = counts.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= limit).drop("__rank")
    return settle(counts, "groups", long_keys=F.count_if(_is_long(F.col("__key"))))


def _member_parts(df: DataFrame, values: dict[str, Column], groups: Settled, limits: Limits, every: bool = False) -> list[DataFrame]:
    """Every row of ``df`` once for each group it belongs to; no group is in two parts.

    Groups that fit a broadcast come to the rows; more of them are joined by shuffle, rows of hot values apart. If ``every``
    group is there, their counts tell the hot values.
    """
    on = ["__key", "__column"]
    keyed = {c: (k, f"__key_{i}") for i, (c, k) in enumerate(_short_keys(df, values).items())}

    def each(columns: Iterable[str]) -> DataFrame:
        # Keys are made ahead of the array, which would make them anew wherever it names them.
        rows = df.select("*", *[k.alias(name) for c, (k, name) in keyed.items() if c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("__column"), F.col(name).alias("__key")) for c, (_, name) in keyed.items() if c in columns])
        return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(pairs)).filter(F.col("__key").isNotNull())

    hot = hot_side = None
    if every and not settled_fits(groups, limits):
        largest = groups.df.filter(F.col("__count") >= limits.hot_rows).orderBy(F.col("__count").desc(), *on).limit(limits.hot_keys)
        found = largest.select("__column", F.xxhash64(*on).alias("h")).collect()
        hot = [row["h"] for row in found]
        hot_side = each({row["__column"] for row in found}) if found else None
    parts = lookup_parts(each(values), groups, on, limits=limits, hot=hot, hot_side=hot_side)
    return [part.filter(F.col("__count").isNotNull()) for part in parts]


def _members(df: DataFrame, values: dict[str, Column], groups: Settled, limits: Limits, every: bool = False) -> DataFrame:
    return reduce(DataFrame.unionByName, _member_parts(df, values, groups, limits, every))


def _value_of_column(values: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(F.col("__column") == c, v) for c, v in values.items()])


def _with_values(df: DataFrame, values: dict[str, Column], groups: Settled, limits: Limits) -> DataFrame:
    """Add ``__value``, the full text of the group. Only digest keys need a look at the rows for it."""
    if groups.measures["long_keys"] == 0:
        return groups.df.withColumn("__value", F.col("__key"))
    texts = (
        _members(df, values, replace(groups, df=groups.df.filter(_is_long(F.col("__key")))), limits)
        .groupBy("__column", "__key")
        .agg(F.min(_value_of_column(values)).alias("__text"))
    )
    return groups.df.join(texts, ["__column", "__key"], "left").withColumn("__value", F.coalesce("__text", "__key"))


def _id_lists(members: DataFrame, id_col: str, per_list: int, counted: list[int] | None, dealt: bool) -> DataFrame:
    """The ids of each group in lists of about ``per_list``, as (__column, __key, __count, part, ids).

    Ids are spread over the lists of their group by hash and take one shuffle, to their list, or none if the members are
    ``dealt`` out by group already. Copies of null ids and of those whose hashes are ``counted`` are counted first and then cut
    into runs, so that neither a hot group nor a hot id has to fit one task or one list; with None there are none of these.
    """
    group = ["__column", "__key", "__count"]
    members = members.select(*group, F.col(f"`{id_col}`").alias("__id"))
    lists = F.ceil(F.col("__count") / per_list)
    # The digest leads the keys, so that sorting by them compares numbers.
    listed = ["__at", *group, "part"]

    def placed(rows: DataFrame, run: Column, *cols: Column | str) -> DataFrame:
        part = F.pmod(F.xxhash64("__id", run), lists).cast("int")
        return rows.select(*group, part.alias("part"), *cols).withColumn("__at", F.xxhash64("__column", "__key", "part"))

    others = F.lit(True)
    if counted is not None:
        others = F.col("__id").isNotNull() & ~F.xxhash64("__id").isin(counted)
    single = placed(members.filter(others), F.lit(0).cast("bigint"), "__id")
    single = (single if dealt else single.repartition("__at")).groupBy(*listed).agg(F.collect_list("__id").alias("ids"))
    if counted is None:
        return single.select(*group, "part", F.sort_array("ids").alias("ids"))
    copies = members.filter(~others).groupBy(*group, "__id").agg(F.count(F.lit(1)).alias("__copies"))
    last_run = F.floor((F.col("__copies") - 1) / per_list)
    runs = copies.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("bigint"), last_run)))
    length = F.least(F.lit(per_list), F.col("__copies") - F.col("__run") * per_list).cast("int")
    spread = placed(runs, F.col("__run"), F.array_repeat("__id", length).alias("ids"))
    both = single.unionByName(spread).groupBy(*listed).agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))
    return both.select(*group, "part", "ids")


def _counted_ids(df: DataFrame, id_col: str, per_list: int, limits: Limits) -> list[int] | None:
    """Hashes of ids with more copies than a list takes, from a sketch; None if there are neither these nor nulls.

    An id that the sketch misses, with fewer than a 2,800th of the rows, gets a longer list instead of several.
    """
    hot = hot_hashes(df, [f"`{id_col}`"], replace(limits, hot_rows=per_list))
    return hot if hot or not df.filter(F.col(f"`{id_col}`").isNull()).isEmpty() else None


def duplicates_report(
    df: DataFrame,
    keys: list[str] | None = None,
    columns: list[str] | None = None,
    id_col: str | None = None,
    case_insensitive: bool = True,
    limit: int | None = None,
    ids_per_list: int = IDS_PER_LIST,
    limits: Limits = DEFAULT_LIMITS,
    infer_keys: bool = False,
) -> DataFrame:
    """Values that occur more than once, for every column that is no key: (column, value, count).

    All of them, or with ``limit`` the so many largest of each column. With ``id_col`` also (part, ids): the ids of the group, in several
    lists for a group of more than ``ids_per_list`` rows; together they are all its ids. With ``infer_keys`` columns that
    prove to be keys are found first, from sketches and short hashes, and left out of both passes over the rows.
    """
    checked = _checked_columns(df, columns, keys or [])
    if checked and infer_keys:
        compared = df.select(*[v.alias(c) for c, v in _values(df, checked, case_insensitive).items()])
        unique = {key[0] for key in minimal_keys(compared, max_columns=1)}
        left = [c for c in checked if c not in unique]
        if left:
            checked = left
        else:
            df = df.limit(0)
    if not checked:
        raise ValueError("no column to check")
    values = _values(df, checked, case_insensitive)
    groups = _groups(df, values, limit)
    report = _with_values(df, values, groups, limits)
    shown = [F.col("__column").alias("column"), F.col("__value").alias("value"), F.col("__count").alias("count")]
    if id_col is None:
        return report.select(*shown)
    require(df, [id_col])
    counted = _counted_ids(df, id_col, ids_per_list, limits)
    parts = _member_parts(df, values, groups, limits, every=limit is None)
    # Those of the first part were dealt out by a shuffle join, if the groups do not fit a broadcast.
    dealt = [i == 0 and not settled_fits(groups, limits) for i in range(len(parts))]
    ids = reduce(DataFrame.unionByName, [_id_lists(m, id_col, ids_per_list, counted, d) for m, d in zip(parts, dealt, strict=True)])
    if groups.measures["long_keys"] == 0:
        return ids.withColumn("__value", F.col("__key")).select(*shown, "part", "ids")
    return report.join(ids.drop("__count"), ["__column", "__key"]).select(*shown, "part", "ids")


def duplicate_groups(
    df: DataFrame, column: str, id_col: str | None = None, case_insensitive: bool = True, limit: int | None = None
) -> DataFrame:
    """The report for one column."""
    return duplicates_report(df, columns=[column], id_col=id_col, case_insensitive=case_insensitive, limit=limit)


def duplicate_records(
    df: DataFrame,
    keys: list[str] | None = None,
    columns: list[str] | None = None,
    id_col: str | None = None,
    case_insensitive: bool = True,
    limit: int | None = None,
    ordered: bool = True,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """The full records of the reported groups: (dup_column, dup_value, dup_count) and the columns of the row.

    Ordered by column, size of the group (largest first), value and id. The id, or without one a hash of the row, is
    part of the sort key, so the sort splits a hot group over many tasks.
    """
    checked = _checked_columns(df, columns, keys or [])
    values = _values(df, checked, case_insensitive)
    members = _members(df, values, _groups(df, values, limit), limits, every=limit is None)
    if ordered:
        by = F.col(f"`{id_col}`") if id_col else F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
        members = members.orderBy("__column", F.col("__count").desc(), "__key", by)
    return members.select(
        F.col("__column").alias("dup_column"),
        _value_of_column(values).alias("dup_value"),
        F.col("__count").alias("dup_count"),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def is_unique(df: DataFrame, cols: list[str]) -> bool:
    """Whether no two rows agree in ``cols`` and none of them is null."""
    require(df, cols)
    some_null = reduce(Column.__or__, [F.col(c).isNull() for c in cols])
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return counted.filter((F.col("__n") > 1) | some_null).isEmpty()


def _distinct(col: Column) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(col)))


def key_columns(df: DataFrame, declared: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """(column_name, is_key) for every column: declared keys first, else found by counting.

    A first pass with fixed-size sketches rules out columns with nulls and those whose distinct count is clearly below
    the row count (by half, many times the sketch error). Only the few left are grouped, in one shuffle of short keys.
    """
    known = set(declared or [])
    names = columns or df.columns
    require(df, [*known, *names])
    open_cols = [c for c in names if c not in known]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(open_cols):
        aggs += [F.count(f"`{c}`").alias(f"__n{i}"), _distinct(F.col(f"`{c}`")).alias(f"__d{i}")]
    seen = df.agg(*aggs).first()
    likely = [
        c
        for i, c in enumerate(open_cols)
        if seen[f"__n{i}"] == seen["__rows"] and seen[f"__d{i}"] >= 0.5 * seen["__rows"]
    ]
    repeated: set[str] = set()
    if likely:
        keyed = df.select(*[short_key(F.col(f"`{c}`").cast("string")).alias(c) for c in likely])
        counts = keyed.unpivot([], likely, "column_name", "__key").groupBy("column_name", "__key").count()
        # One row per column at most comes back.
        found = counts.filter(F.col("count") > 1).select("column_name").distinct().collect()
        repeated = {row["column_name"] for row in found}
    return df.sparkSession.createDataFrame(
        [(c, c in known or (c in likely and c not in repeated)) for c in names], "column_name string, is_key boolean"
    )
