"""What the operators of this subpackage share: reading tables, written steps, size-checked semi and anti joins."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.plans.shared import fresh_path

#: A side of at most so many long ids (some 32 MB in memory) may be broadcast; beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
#: The same for keys that hold a digest.
BROADCAST_KEYS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, label: str, batch_rows: int | None = None, few_files: bool = False) -> DataFrame:
    """Write once to the shared folder and go on from there: cuts lineage and survives lost executors.

    ``batch_rows`` bounds the rows that Python workers get at a time while this is written; for rows that hold texts.
    ``few_files`` writes no more files than the cluster has cores; for tables of ids, small against the texts.
    """
    spark = df.sparkSession
    if few_files:
        df = df.coalesce(spark.sparkContext.defaultParallelism)
    path = fresh_path(spark, label)
    before = spark.conf.get(BATCH_ROWS)
    if batch_rows is not None:
        spark.conf.set(BATCH_ROWS, min(batch_rows, int(before)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Compute once and keep on the executors' disks, for steps of a few numbers per row between written tables.

    Lineage stays: what a lost executor held is computed again from the last written table, so the step must give the
    same rows each time. Spares the many small files that writing every step would make.
    """
    spark = df.sparkSession
    before = spark.conf.get(BATCH_ROWS)
    if batch_rows is not None:
        spark.conf.set(BATCH_ROWS, min(batch_rows, int(before)))
    try:
        df = df.persist(StorageLevel.DISK_ONLY)
        df.count()
    finally:
        spark.conf.set(BATCH_ROWS, before)
    return df


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(quoted(text_col).cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_ids(docs: DataFrame, ids: DataFrame, how: str, id_col: str = "doc_id") -> DataFrame:
    """Semi or anti join of ``docs`` with a written one-column table of ids.

    The ids are counted first. Up to ``BROADCAST_IDS`` they are broadcast and the texts stay where they are; beyond,
    Spark shuffles both sides by id.
    """
    key = ids.columns[0]
    own = ids.select(quoted(key).alias("__id")).distinct()
    if own.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        own = F.broadcast(own)
    return docs.join(own, quoted(id_col) == F.col("__id"), how)


def text_sha(text_col: str) -> Column:
    """SHA-256 of a text, a null one counting as empty."""
    return F.unhex(F.sha2(text_or_empty(text_col), 256))


def by_keys(docs: DataFrame, keys: DataFrame, how: str, own: list[Column]) -> DataFrame:
    """Semi or anti join of ``docs`` with a written table of keys, whose columns stand for ``own``; null equals null.

    For verdicts on rows whose ids may be null or repeated. Broadcast up to ``BROADCAST_KEYS``, as in ``by_ids``.
    """
    wanted = keys.toDF(*[f"__key{k}" for k in range(len(own))]).distinct()
    if wanted.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, reduce(and_, [c.eqNullSafe(F.col(f"__key{k}")) for k, c in enumerate(own)]), how)


def one_row_each(docs: DataFrame, gone: DataFrame, tied: DataFrame, own: list[Column], text_col: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``gone``, and one of those that share a key in ``tied``.

    Rows of a tied key have equal texts; the one whose other columns are largest as JSON stays. They are thinned to one
    row per key and task before the shuffle.
    """
    out = by_keys(docs, gone.union(tied), "left_anti", own)
    if tied.isEmpty():
        return out
    same = by_keys(docs, tied, "left_semi", own)
    rest = F.to_json(F.struct(quoted(text_col).isNull().alias("_"), *[quoted(c) for c in docs.columns if c != text_col]))
    row = F.struct(*[quoted(c) for c in docs.columns])
    groups = same.groupBy(*[c.alias(f"__key{k}") for k, c in enumerate(own)]).agg(F.max_by(row, rest).alias("__row"))
    return out.unionByName(groups.select("__row.*"))


def parts(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces whose values in ``column`` have about ``most`` bytes or items together."""
    values = batch.column(column)
    sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    piece = sizes.fill_null(0).to_numpy(zero_copy_only=False).cumsum(dtype=np.int64) // most
    starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
    for begin, end in zip(starts, starts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)
