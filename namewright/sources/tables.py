"""Named tables under a base folder: Parquet versions, switched by an append-only log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from namewright.plans.shared import folder_names, path_exists, write_measured

TABLE_LOG = "table_log"
TABLE_LOG_FIELDS = "name string, version bigint, path string, rows bigint, written_at timestamp"

_LOG = logging.getLogger(__name__)


class MissingTable(LookupError):
    """The named table does not exist under the base folder."""


def require(df: DataFrame, cols: Iterable[str], what: str = "table") -> None:
    """Fail with a message, before anything is touched, unless all columns exist."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s): {', '.join(missing)}")


def _read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def table_log(spark: SparkSession, base: str) -> DataFrame:
    """Every version ever written under ``base``."""
    path = f"{base}/{TABLE_LOG}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], TABLE_LOG_FIELDS)
    return spark.read.schema(TABLE_LOG_FIELDS).json(path)


def _latest(spark: SparkSession, base: str, name: str):
    newest = table_log(spark, base).filter(F.col("name") == name).orderBy(F.col("version").desc())
    return newest.select("version", "path").first()


def table_exists(spark: SparkSession, base: str, name: str) -> bool:
    try:
        load_table(spark, base, name)
    except MissingTable:
        return False
    return True


def _load(
    spark: SparkSession, base: str, name: str, version_path: str | None, schema: StructType | None = None
) -> DataFrame:
    for path in [version_path] if version_path else [f"{base}/{name}.parquet", f"{base}/{name}"]:
        found = _read_parquet(spark, path, schema)
        if found is not None:
            return found
    raise MissingTable(f"table {name} does not exist under {base}")


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The current version of a table; without versions, plain Parquet at ``base/name.parquet`` or ``base/name``."""
    entry = _latest(spark, base, name)
    return _load(spark, base, name, entry["path"] if entry else None)


def write_table(
    df: DataFrame, base: str, name: str, hidden: tuple[str, ...] = (), **measures: Column
) -> dict[str, int]:
    """Replace a table and return its row count as ``rows``, with any other measures asked for.

    The rows go to a version folder of their own and become visible by one appended log entry, so readers see the old
    table or the new one, never a mixture, and an input can be rewritten from itself. One writer at a time. Rows are
    measured while they are written; ``hidden`` columns are measured but not kept.
    """
    spark = df.sparkSession
    entry = _latest(spark, base, name)
    version = (entry["version"] if entry else 0) + 1
    path = f"{base}/{name}/version-{version:06d}-{uuid.uuid4().hex[:8]}"
    found = write_measured(df, path, hidden, **measures)
    record = spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(version).cast("bigint").alias("version"),
        F.lit(path).alias("path"),
        F.lit(found["rows"]).cast("bigint").alias("rows"),
        F.current_timestamp().alias("written_at"),
    )
    record.write.mode("append").json(f"{base}/{TABLE_LOG}")
    return found


def table_names(spark: SparkSession, base: str) -> list[str]:
    """Names of the tables under ``base``: those in the log, and what plain Parquet lies there.

    A folder without versions is a table if Parquet files or partition folders (``col=value``) lie directly in it. Two levels are
    listed at most, and none below a table of the log, so the work grows with the tables, not with their files.
    """
    logged = {row["name"] for row in table_log(spark, base).select("name").distinct().collect()}
    names = set(logged)
    for entry in folder_names(spark, base):
        if entry.startswith(("_", ".")) or entry == TABLE_LOG or entry in logged:
            continue
        if entry.endswith(".parquet"):
            names.add(entry.removesuffix(".parquet"))
        elif any(part.endswith(".parquet") or "=" in part for part in folder_names(spark, f"{base}/{entry}")):
            names.add(entry)
    return sorted(names)


def _counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each table from one job over all of them; should that fail, table by table with -1 for a failure."""
    if not tables:
        return {}
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n, df in tables.items()]
    try:
        return {row["name"]: row["rows"] for row in reduce(DataFrame.unionByName, parts).collect()}
    except Exception as exc:
        if len(tables) == 1:
            _LOG.warning("cannot count table %s: %s", *tables, exc)
            return dict.fromkeys(tables, -1)
        return {name: n for single in tables.items() for name, n in _counts(dict([single])).items()}


def list_tables(spark: SparkSession, base: str) -> DataFrame:
    """Tables in name order with their row counts, -1 where a count fails; one failure leaves the others alone.

    Nothing but file footers is read: the counts need no columns, so no schema either.
    """
    current = table_log(spark, base).groupBy("name").agg(F.max_by("path", "version").alias("path"))
    versions = {row["name"]: row["path"] for row in current.collect()}
    names = table_names(spark, base)
    readable = {}
    for name in names:
        try:
            readable[name] = _load(spark, base, name, versions.get(name), StructType([]))
        except Exception as exc:
            _LOG.warning("cannot read table %s: %s", name, exc)
    counts = {**dict.fromkeys(names, -1), **_counts(readable)}
    return spark.createDataFrame(sorted(counts.items()), "name string, rows bigint").orderBy("name")


def describe_columns(df: DataFrame) -> DataFrame:
    """Columns with their types, in table order."""
    if not df.columns:
        raise ValueError("table has no columns")
    described = [(i + 1, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(described, "ordinal int, column_name string, data_type string")


def read_jdbc_table(
    spark: SparkSession, url: str, name: str, split_on: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """Scan a live database table in ``partitions`` parallel ranges of an integer column."""
    return spark.read.jdbc(
        url=url,
        table=name,
        column=split_on,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )
