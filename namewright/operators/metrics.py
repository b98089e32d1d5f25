"""Counts, lag, throughput, deduplication and errors. All aggregates combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from namewright.plans.joins import DEFAULT_LIMITS, Limits, fits_broadcast, lookup_join
from namewright.plans.shared import settle
from namewright.sources.tables import require

# Lengths of a throughput bucket.
GRANULARITIES = ("second", "minute", "hour", "day")

_HOUR = 3600


def _since(df: DataFrame, time_col: str, since: Column | None) -> DataFrame:
    return df if since is None else df.filter(F.col(time_col) >= since)


def _in_last_minutes(df: DataFrame, time_col: str, minutes: int, until: Column | None) -> DataFrame:
    """Rows of the last minutes before ``until``, by default the newest time in the data."""
    if minutes < 1:
        raise ValueError("window_minutes must be at least 1")
    end = until if until is not None else df.agg(F.max(time_col)).scalar()
    length = F.make_dt_interval(mins=F.lit(minutes))
    return df.filter((F.col(time_col) > end - length) & (F.col(time_col) <= end))


def sync_counts(
    source: DataFrame,
    dedup: DataFrame,
    indexed: DataFrame,
    since: Column | None = None,
    time_cols: tuple[str, str, str] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Rows in source, deduplicated table and index, the two differences, and these in percent of the source."""
    if since is not None and time_cols is None:
        raise ValueError("since needs the time column of each table")
    tagged = []
    for i, (name, df) in enumerate((("source", source), ("dedup", dedup), ("index", indexed))):
        part = _since(df, time_cols[i], since) if time_cols else df
        tagged.append(part.select(F.lit(name).alias("side")))
    counts = (
        tagged[0]
        .unionByName(tagged[1])
        .unionByName(tagged[2])
        .agg(*[F.count_if(F.col("side") == s).alias(f"{s}_count") for s in ("source", "dedup", "index")])
    )
    to_dedup = F.col("source_count") - F.col("dedup_count")
    to_index = F.col("dedup_count") - F.col("index_count")

    def percent(part: Column) -> Column:
        return F.when(F.col("source_count") > 0, F.round(part * 100.0 / F.col("source_count"), 4))

    return counts.select(
        "source_count",
        "dedup_count",
        "index_count",
        to_dedup.alias("delta_source_to_dedup"),
        to_index.alias("delta_dedup_to_index"),
        percent(to_dedup).alias("pct_source_to_dedup"),
        percent(to_index).alias("pct_dedup_to_index"),
        (as_of if as_of is not None else F.current_timestamp()).alias("snapshot_time"),
    )


def lag_pairs(
    changes: DataFrame,
    indexed: DataFrame,
    key: str,
    changed_col: str,
    indexed_col: str,
    window_minutes: int = 60,
    until: Column | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """(key, changed_at, indexed_at, lag_seconds) of what was indexed in the window.

    ``changes`` has one row per key; if not, the last change counts. The window filter runs before the join. Lags are
    differences of the stored times, whatever the session time zone.
    """
    require(changes, [key, changed_col], "changes")
    require(indexed, [key, indexed_col], "indexed")
    recent = _in_last_minutes(indexed.select(key, indexed_col), indexed_col, window_minutes, until)
    last = changes.groupBy(key).agg(F.max(changed_col).alias("__changed"))
    small = fits_broadcast(changes.select(key, changed_col), limits)
    joined = lookup_join(recent, last, [key], small=small, limits=limits).filter(F.col("__changed").isNotNull())
    lag = (F.col(indexed_col) - F.col("__changed")).cast("interval second")
    return joined.select(
        key,
        F.col("__changed").alias("changed_at"),
        F.col(indexed_col).alias("indexed_at"),
        F.floor(lag.cast("decimal(18, 6)")).cast("bigint").alias("lag_seconds"),
    )


def _percentile(counts: DataFrame, share: float) -> DataFrame:
    """Exact interpolated percentile of whole seconds from (lag_seconds, n), as one row (value).

    Hours are summed first; the seconds are then ranked only inside the one or two hours that hold the wanted ranks.
    So the single-task windows see one row per hour of spread, and 7,200 rows, whatever the number of samples.
    """
    hour = F.floor(F.col("lag_seconds") / _HOUR)
    by_hour = counts.groupBy(hour.alias("hour")).agg(F.sum("n").alias("in_hour"))
    before = W.orderBy("hour").rowsBetween(W.unboundedPreceding, -1)
    ranked = by_hour.select(
        "hour",
        "in_hour",
        F.coalesce(F.sum("in_hour").over(before), F.lit(0)).alias("before"),
        ((F.sum("in_hour").over(W.partitionBy()) - 1) * share).alias("rank"),
    )
    wanted = ranked.filter(
        (F.col("before") <= F.ceil("rank")) & (F.col("before") + F.col("in_hour") > F.floor("rank"))
    )
    inside = counts.withColumn("hour", hour).join(F.broadcast(wanted), "hour")
    within = W.orderBy("lag_seconds").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = inside.select(
        "lag_seconds",
        "n",
        "rank",
        (F.min("before").over(W.partitionBy()) + F.sum("n").over(within)).alias("through"),
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("through") - F.col("n") <= rank) & (rank < F.col("through")), F.col("lag_seconds")))

    ends = placed.agg(at(F.floor("rank")).alias("low"), at(F.ceil("rank")).alias("high"), F.max("rank").alias("rank"))
    weight = F.col("rank") - F.floor("rank")
    return ends.select((F.col("low") + (F.col("high") - F.col("low")) * weight).alias("value"))


def sync_lag(
    changes: DataFrame,
    indexed: DataFrame,
    key: str,
    changed_col: str,
    indexed_col: str,
    window_minutes: int = 60,
    until: Column | None = None,
) -> DataFrame:
    """Average, 95th percentile (interpolated, exact), maximum and number of lags, in seconds."""
    pairs = lag_pairs(changes, indexed, key, changed_col, indexed_col, window_minutes, until)
    # One row per distinct second of lag; settled, so that the join runs once for all figures.
    counts = settle(pairs.groupBy("lag_seconds").agg(F.count(F.lit(1)).alias("n")), "lags").df
    total = F.sum("n")
    return counts.agg(
        (F.sum(F.col("lag_seconds") * F.col("n")) / total).alias("avg_lag_seconds"),
        F.max("lag_seconds").cast("double").alias("max_lag_seconds"),
        F.coalesce(total, F.lit(0)).alias("samples"),
    ).select(
        F.round("avg_lag_seconds", 4).alias("avg_lag_seconds"),
        F.round(_percentile(counts, 0.95).scalar(), 4).alias("p95_lag_seconds"),
        "max_lag_seconds",
        "samples",
        F.lit(window_minutes).alias("window_minutes"),
    )


def lag_samples(pairs: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """The newest lags, as examples."""
    return pairs.orderBy(F.col("indexed_at").desc(), F.col(key), F.col("lag_seconds")).limit(limit)


def throughput(
    events: DataFrame,
    time_col: str,
    failed: Column,
    window_minutes: int = 60,
    granularity: str = "minute",
    until: Column | None = None,
) -> DataFrame:
    """Events and failures per bucket of the window: (t, count, errors)."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {', '.join(GRANULARITIES)}")
    recent = _in_last_minutes(events, time_col, window_minutes, until)
    return bucket_counts(recent, time_col, failed, granularity)


def bucket_counts(events: DataFrame, time_col: str, failed: Column, granularity: str) -> DataFrame:
    """Events and failures per bucket, batch or stream."""
    counted = events.groupBy(F.window(time_col, f"1 {granularity}").alias("__bucket")).agg(
        F.count(F.lit(1)).alias("count"), F.count_if(failed).alias("errors")
    )
    return counted.select(F.col("__bucket.start").alias("t"), "count", "errors")


def throughput_summary(buckets: DataFrame, window_minutes: int = 60) -> DataFrame:
    """Total, average per minute and error rate over the buckets of throughput()."""
    total = F.coalesce(F.sum("count"), F.lit(0))
    return buckets.agg(
        F.lit(window_minutes).alias("window_minutes"),
        total.alias("total_indexed"),
        F.round(total / window_minutes, 4).alias("avg_per_minute"),
        F.when(total > 0, F.round(F.sum("errors") / total, 4)).alias("error_rate"),
    )


def dedup_stats(df: DataFrame) -> DataFrame:
    """Rows, deduplicated rows, their rate and the time of the last run."""
    require(df, ["was_deduplicated", "deduplication_timestamp"])
    done = F.count_if("was_deduplicated")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        done.alias("deduplicated_rows"),
        F.when(F.count(F.lit(1)) > 0, F.round(done / F.count(F.lit(1)), 4)).alias("dedup_rate"),
        F.max("deduplication_timestamp").alias("last_dedup_run"),
    )


def dedup_stats_by_country(df: DataFrame, country_col: str = "uuid_country") -> DataFrame:
    """Rows and deduplicated rows per country; rows without one are a line of their own."""
    require(df, [country_col, "was_deduplicated"])
    return df.groupBy(F.col(country_col).alias("country")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("was_deduplicated").alias("deduplicated_rows")
    )


def errors(
    run_log: DataFrame, since: Column | None = None, limit: int = 50, failed: Column | None = None
) -> DataFrame:
    """The newest errors, at most ``limit`` (1 to 1000): (time, component, message, job_id, total_errors)."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must lie between 1 and 1000")
    found = _since(run_log.filter(failed if failed is not None else ~F.col("success")), "time", since)
    total = found.agg(F.count(F.lit(1))).scalar()
    page = found.orderBy(F.col("time").desc(), "component", "job_id").limit(limit)
    return page.select("time", "component", "message", "job_id", total.alias("total_errors"))


def component_status(run_log: DataFrame, target: str = "all", degraded_above: float = 0.1) -> DataFrame:
    """Per component: last success, error rate, and OK or DEGRADED: (component, last_success, error_rate, status)."""
    require(run_log, ["component", "time", "success"])
    chosen = run_log if target == "all" else run_log.filter(F.col("component") == target)
    rate = F.count_if(~F.col("success")) / F.count(F.lit(1))
    status = F.when(F.col("__rate") > degraded_above, "DEGRADED").otherwise("OK")
    return (
        chosen.groupBy("component")
        .agg(F.max(F.when(F.col("success"), F.col("time"))).alias("last_success"), rate.alias("__rate"))
        .select("component", "last_success", F.round("__rate", 4).alias("error_rate"), status.alias("status"))
    )
