import datetime as dt

import numpy as np
import pytest
from helpers import SHUFFLED, TIGHT, plan, rows
from pyspark.sql import functions as F

from namewright.operators import metrics
from namewright.plans.joins import DEFAULT_LIMITS


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 12, 0) + dt.timedelta(minutes=minute, seconds=second)


@pytest.fixture(scope="module")
def events(spark):
    data = [(at(i // 4, i % 60), "error" if i % 10 == 0 else "ok") for i in range(400)]
    return spark.createDataFrame(data, "ts timestamp_ntz, kind string")


def test_throughput(events):
    buckets = metrics.throughput(events, "ts", F.col("kind") == "error", window_minutes=60)
    got = rows(buckets)
    newest = max(r["ts"] for r in events.collect())
    recent = [r for r in events.collect() if r["ts"] > newest - dt.timedelta(minutes=60)]
    assert sum(n for _, n, _ in got) == len(recent)
    assert sum(e for _, _, e in got) == sum(r["kind"] == "error" for r in recent)
    assert all(t.second == 0 for t, _, _ in got)
    summary = metrics.throughput_summary(buckets, 60).first()
    assert summary["total_indexed"] == len(recent) and summary["avg_per_minute"] == round(len(recent) / 60, 4)


def test_throughput_window_ends_where_asked(events):
    until = F.lit("2024-01-01 12:10:00").cast("timestamp_ntz")
    got = metrics.throughput(events, "ts", F.col("kind") == "error", 5, "minute", until)
    assert all(at(4) < t <= at(10) or t == at(5) for t, _, _ in rows(got))


@pytest.mark.parametrize("bad", [{"window_minutes": 0}, {"granularity": "fortnight"}])
def test_throughput_arguments(events, bad):
    with pytest.raises(ValueError):
        metrics.throughput(events, "ts", F.lit(False), **bad)


def test_no_events(spark):
    none = spark.createDataFrame([], "ts timestamp_ntz, kind string")
    buckets = metrics.throughput(none, "ts", F.lit(False))
    assert rows(buckets) == []
    assert rows(metrics.throughput_summary(buckets)) == [(60, 0, 0.0, None)]


@pytest.mark.parametrize(
    ("n", "limits"), [(1, DEFAULT_LIMITS), (2, SHUFFLED), (21, DEFAULT_LIMITS), (1000, SHUFFLED), (1000, TIGHT)]
)
def test_lag_percentile_is_exact(spark, n, limits):
    seconds = [int(x) for x in np.random.default_rng(n).exponential(20_000, n)]
    indexed = at(0)
    changes = [(i, indexed - dt.timedelta(seconds=s)) for i, s in enumerate(seconds)] + [(10_000, at(-5))]
    sent = [(i, indexed) for i in range(n)] + [(20_000, at(0)), (0, at(-100))]
    left = spark.createDataFrame(changes, "key int, changed timestamp_ntz")
    right = spark.createDataFrame(sent, "key int, sent timestamp_ntz")
    pairs = metrics.lag_pairs(left, right, "key", "changed", "sent", 60, limits=limits)
    assert sorted(r["lag_seconds"] for r in pairs.collect()) == sorted(seconds)
    got = metrics.sync_lag(left, right, "key", "changed", "sent", 60).first()
    assert got["samples"] == n and got["max_lag_seconds"] == max(seconds)
    assert got["avg_lag_seconds"] == pytest.approx(np.mean(seconds), abs=1e-3)
    assert got["p95_lag_seconds"] == pytest.approx(np.percentile(seconds, 95), abs=1e-3)


def test_lag_samples_are_the_newest(spark):
    left = spark.createDataFrame([(i, at(0)) for i in range(9)], "key int, changed timestamp")
    right = spark.createDataFrame([(i, at(i, 30)) for i in range(9)], "key int, sent timestamp")
    pairs = metrics.lag_pairs(left, right, "key", "changed", "sent")
    assert [r["lag_seconds"] for r in metrics.lag_samples(pairs, "key", 3).collect()] == [510, 450, 390]


def test_counts(spark):
    frames = [spark.createDataFrame([(at(i),) for i in range(n)], "t timestamp_ntz") for n in (8, 6, 5)]
    got = metrics.sync_counts(*frames).first().asDict()
    assert (got["delta_source_to_dedup"], got["delta_dedup_to_index"]) == (2, 1)
    assert (got["pct_source_to_dedup"], got["pct_dedup_to_index"]) == (25.0, 12.5)
    since = F.lit("2024-01-01 12:04:00").cast("timestamp_ntz")
    later = metrics.sync_counts(*frames, since=since, time_cols=("t", "t", "t")).first()
    assert (later["source_count"], later["dedup_count"], later["index_count"]) == (4, 2, 1)
    with pytest.raises(ValueError):
        metrics.sync_counts(*frames, since=since)
    empty = metrics.sync_counts(*[f.limit(0) for f in frames]).first()
    assert empty["source_count"] == 0 and empty["pct_source_to_dedup"] is None
    assert "CartesianProduct" not in plan(metrics.sync_counts(*frames))


@pytest.fixture(scope="module")
def log(spark):
    data = [(at(i), "api" if i % 2 else "db", f"m{i}", f"j{i}", not (i % 2 and i % 3 == 0)) for i in range(30)]
    return spark.createDataFrame(data, "time timestamp_ntz, component string, message string, job_id string, success boolean")


def test_errors(log):
    page = metrics.errors(log, limit=2).collect()
    assert [r["message"] for r in page] == ["m27", "m21"] and page[0]["total_errors"] == 5
    since = F.lit("2024-01-01 12:20:00").cast("timestamp_ntz")
    assert [r["total_errors"] for r in metrics.errors(log, since).collect()] == [2, 2]
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            metrics.errors(log, limit=limit)
    assert "TakeOrderedAndProject" in plan(metrics.errors(log))


def test_component_status(log):
    assert rows(metrics.component_status(log)) == [("api", at(29), 0.3333, "DEGRADED"), ("db", at(28), 0.0, "OK")]
    assert rows(metrics.component_status(log, "db", 0.5)) == [("db", at(28), 0.0, "OK")]


def test_dedup_stats(spark):
    df = spark.createDataFrame(
        [(True, at(1), "NL"), (False, None, "NL"), (False, None, None)],
        "was_deduplicated boolean, deduplication_timestamp timestamp_ntz, uuid_country string",
    )
    assert rows(metrics.dedup_stats(df)) == [(3, 1, 0.3333, at(1))]
    assert rows(metrics.dedup_stats_by_country(df)) == sorted([("NL", 2, 1), (None, 1, 0)], key=repr)
    assert rows(metrics.dedup_stats(df.limit(0))) == [(0, 0, None, None)]
