"""Storage every executor and the driver can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Paths handed out inside the innermost released() block.
_handed_out: ContextVar[list[str] | None] = ContextVar("handed_out", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors must share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path on shared storage nobody has used yet."""
    path = f"{shared_dir(spark)}/namewright/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    paths = _handed_out.get()
    if paths is not None:
        paths.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none for a folder that does not exist."""
    files, at = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(at)] if files.exists(at) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block every folder that fresh_path() and settle() made in it.

    What is built from those folders must be written elsewhere by then.
    """
    paths: list[str] = []
    token = _handed_out.set(paths)
    try:
        yield
    finally:
        _handed_out.reset(token)
        for path in paths:
            delete_folder(spark, path)


def row_width(df: DataFrame) -> Column:
    """Bytes of a row, roughly: text by its length, nested values by their JSON, eight for anything else."""
    total: Column = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            total = total + F.coalesce(F.octet_length(col), F.lit(0)) + 8
        elif field.dataType.typeName() in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
        else:
            total = total + 8
    return total


@dataclass(frozen=True)
class Settled:
    """A written table and what was measured on the way: ``rows``, ``bytes`` and whatever else was asked for."""

    df: DataFrame
    measures: dict[str, int]


def write_measured(df: DataFrame, path: str, hidden: tuple[str, ...] = (), **measures: Column) -> dict[str, int]:
    """Write a new Parquet folder and measure its rows in the same pass; ``hidden`` columns are measured only."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()])
    observed.drop(*hidden).write.parquet(path)
    return seen.get


def settle(df: DataFrame, label: str, **measures: Column) -> Settled:
    """Write once to shared storage and go on from the written table.

    Cuts lineage for good: what was computed survives lost executors, and every later pass sees the same rows. Being
    columnar, it also lets a later pass read only the columns it needs, which ``checkpoint()`` does not.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    size = F.coalesce(F.sum(row_width(df)), F.lit(0))
    found = write_measured(df, path, bytes=size, **measures)
    return Settled(spark.read.schema(df.schema).parquet(path), found)
