"""Recurring work as streams: canonicalise arrivals, insert what is missing, live throughput and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from namewright.functions import norm_key
from namewright.operators.mapping import apply_mapping
from namewright.operators.metrics import bucket_counts
from namewright.operators.reconcile import rows_to_insert
from namewright.plans.joins import DEFAULT_LIMITS, Limits
from namewright.plans.shared import path_exists, released, settle
from namewright.sources.tables import require

Trigger = dict[str, object]

# Take what is there and stop. For a recurring run: {"processingTime": "10 minutes"}.
ONCE: Trigger = {"availableNow": True}

# Folder of a target in buckets.
BUCKET = "key_bucket"

BUCKET_FIELDS = "t timestamp, count bigint, errors bigint"


def canonicalise_stream(
    stream: DataFrame,
    mapping: DataFrame,
    col: str,
    out: str,
    checkpoint: str,
    as_of: Column | None = None,
    trigger: Trigger = ONCE,
    history: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> StreamingQuery:
    """Apply the mapping to newly arrived rows and append them to ``out``. Stateless; files appear exactly once.

    Rows already written keep the mapping of their time: remap_changed() brings them up to date when it changes. A mapping
    beyond the broadcast bounds is joined by shuffle; ``history``, such as what arrived before, then tells which names
    are hot, and these are split over tasks.
    """
    mapped = apply_mapping(stream, mapping, col, as_of, limits=limits, history=history)
    writer = mapped.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def _key_bucket(keys: list[str], buckets: int) -> Column:
    """Number of the bucket of a row; keys that are compared as equal share one, and so do equal rows without a key."""
    return F.pmod(F.xxhash64(*[norm_key(F.col(k)) for k in keys]), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows of a target in buckets, without their numbers; none if it does not exist."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())])).parquet(target).drop(BUCKET)


def insert_missing_stream(
    stream: DataFrame,
    target: str,
    keys: list[str],
    checkpoint: str,
    trigger: Trigger = ONCE,
    buckets: int | None = None,
    repeats: tuple[str, str] | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> StreamingQuery:
    """Append the rows of each batch whose key ``target`` (a Parquet folder) lacks.

    A batch that is repeated after a failure finds its rows already there and adds nothing, so no state is kept: the
    target is the state. A batch is read once; what it settles on the way is gone when it is done, and a batch without
    new keys leaves no file.

    With ``buckets`` the target is a folder per hash of the key, and a batch reads the key columns of those buckets only
    that its keys fall into; read the target with read_buckets(). The number is fixed when the target is made: keep to it.

    ``repeats`` is a time column and a delay such as "1 hour": rows sent again, equal in all columns, then stop at the
    source, by Spark's state of the rows seen within that delay, before the target is read at all. Spark drops events
    later than the delay there; dropped_late() tells of them. Without it nothing is dropped. The column must be time
    zone aware, as watermarks are; it is stored with the other columns.
    """
    schema = stream.schema
    require(stream, keys, "stream")
    if buckets is not None and BUCKET in stream.columns:
        raise ValueError(f"a column named {BUCKET} stands in the way of buckets")
    if repeats is not None:
        time_col, delay = repeats
        stream = stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(stream.columns)

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        with released(spark):
            if buckets is None:
                arrived = settle(batch, "batch").df
                there = path_exists(spark, target)
                present = spark.read.schema(schema).parquet(target) if there else spark.createDataFrame([], schema)
            else:
                arrived = settle(batch.withColumn(BUCKET, _key_bucket(keys, buckets)), "batch").df
                present = spark.createDataFrame([], arrived.schema)
                if path_exists(spark, target):
                    # At most as many as there are buckets.
                    touched = [row[0] for row in arrived.select(BUCKET).distinct().collect()]
                    present = spark.read.schema(arrived.schema).parquet(target).filter(F.col(BUCKET).isin(touched))
            missing = settle(rows_to_insert(present, arrived, keys, limits), "missing")
            if missing.measures["rows"] > 0:
                writer = missing.df.write if buckets is None else missing.df.hint("rebalance", BUCKET).write.partitionBy(BUCKET)
                writer.mode("append").parquet(target)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def lag_stream(
    changes: DataFrame,
    indexed: DataFrame,
    key: str,
    changed_col: str,
    indexed_col: str,
    out: str,
    checkpoint: str,
    within: str = "1 hour",
    watermark: str = "10 minutes",
    trigger: Trigger = ONCE,
) -> StreamingQuery:
    """Pair each indexing event with the change it follows, live: (key, changed_at, indexed_at, lag_seconds) in ``out``.

    An interval join of two streams: a change meets the events of its key that come at its time or up to ``within``
    after it. Spark holds either side as state and lets go of a row once the watermarks say that no partner can come,
    so state grows with the rows of ``within`` and ``watermark``, not with the stream. Unlike lag_pairs(), which takes the last
    change of a key, every change of that time counts, as a stream cannot know which will be the last; with one change a
    key both agree. Null keys and times pair with nothing. Rows later than the watermark are dropped (dropped_late()).

    A pair appears in the batch in which its second row arrives. Lags are whole seconds between the stored times. The
    number of shuffle partitions is fixed by the first start; a hot key is one state partition's work, as with any
    stream-stream join.
    """
    require(changes, [key, changed_col], "changes")
    require(indexed, [key, indexed_col], "indexed")
    since = changes.select(
        F.col(key).alias("__key"), F.col(changed_col).alias("changed_at"), F.col(changed_col).cast("timestamp").alias("__changed")
    )
    events = indexed.select(key, F.col(indexed_col).alias("indexed_at"), F.col(indexed_col).cast("timestamp").alias("__indexed"))
    latest = F.col("__changed") + F.expr(f"INTERVAL {within}")
    meets = (F.col(key) == F.col("__key")) & (F.col("__indexed") >= F.col("__changed")) & (F.col("__indexed") <= latest)
    pairs = events.withWatermark("__indexed", watermark).join(since.withWatermark("__changed", watermark), meets)
    lag = (F.col("indexed_at") - F.col("changed_at")).cast("interval second")
    seconds = F.floor(lag.cast("decimal(18, 6)")).cast("bigint").alias("lag_seconds")
    writer = pairs.select(key, "changed_at", "indexed_at", seconds).writeStream.format("parquet").option("path", out)
    return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


def throughput_stream(
    events: DataFrame,
    time_col: str,
    failed: Column,
    out: str,
    checkpoint: str,
    granularity: str = "minute",
    watermark: str = "10 minutes",
    final_only: bool = False,
    trigger: Trigger = ONCE,
) -> StreamingQuery:
    """Keep bucket counts up to date in ``out``; read them with latest_buckets().

    Spark keeps the counts as the state of a streaming aggregation, a row per bucket, without a watermark: every event
    counts, however late. A batch appends the new counts of the buckets it changed, with its number, so the rows of
    ``out`` grow with the buckets touched, not with the events. A repeated batch replaces what it wrote before.

    With ``final_only`` a bucket is written once, to ``out`` as plain Parquet, when the ``watermark`` has passed it, and
    Spark lets go of its state. Only then are events dropped, those later than the watermark; dropped_late() tells of them.
    """
    # A watermark needs a time zone aware column.
    timed = events
    if not isinstance(events.schema[time_col].dataType, TimestampType):
        timed = events.withColumn(time_col, F.col(time_col).cast("timestamp"))

    if final_only:
        counts = bucket_counts(timed.withWatermark(time_col, watermark), time_col, failed, granularity)
        writer = counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        return writer.outputMode("append").trigger(**trigger).start()

    def put(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    counts = bucket_counts(timed, time_col, failed, granularity)
    writer = counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def latest_buckets(spark: SparkSession, out: str) -> DataFrame:
    """The count of every bucket so far: (t, count, errors). Of what was written for a bucket the last batch stands."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], BUCKET_FIELDS)
    written = spark.read.schema(f"{BUCKET_FIELDS}, batch bigint").parquet(out)
    newest = F.max(F.struct("batch", "count", "errors")).alias("newest")
    return written.groupBy("t").agg(newest).select("t", "newest.count", "newest.errors")


def dropped_late(query: StreamingQuery) -> int:
    """Groups of late events that a stream with a watermark left out, in the progress reports that Spark still holds.

    Spark counts them after its partial aggregation, so a group stands for one event or more. It keeps the newest
    ``spark.sql.streaming.numRecentProgressUpdates`` reports; a listener that adds them up as they come sees all.
    """
    return sum(op.numRowsDroppedByWatermark for report in query.recentProgress for op in report.stateOperators)
