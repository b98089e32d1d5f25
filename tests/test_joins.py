import pytest
from helpers import SHUFFLED, TIGHT, plan, rows, same
from pyspark.sql import functions as F

from namewright.plans.joins import DEFAULT_LIMITS, Limits, drop_known, fits_broadcast, hot_hashes, lookup_join

ALL_LIMITS = pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["small", "shuffled", "hot"])


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a sixth without key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 != 1, F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(600).select("id", key.alias("key")).repartition(5)


@pytest.fixture(scope="module")
def lookup(spark):
    values = [("hot", "H"), ("k1", "one"), ("k2", "two"), ("nowhere", "x")]
    return spark.createDataFrame(values, "key string, value string")


def _by_hand(skewed, lookup):
    table = {r["key"]: r["value"] for r in lookup.collect()}
    return [(r["id"], r["key"], table.get(r["key"])) for r in skewed.collect()]


@ALL_LIMITS
def test_left_join_keeps_every_row(skewed, lookup, limits):
    joined = lookup_join(skewed, lookup, ["key"], limits=limits).select("id", "key", "value")
    assert rows(joined) == sorted(_by_hand(skewed, lookup), key=repr)


@ALL_LIMITS
def test_semi_and_anti_join_divide_the_rows(skewed, lookup, limits):
    semi = lookup_join(skewed, lookup, ["key"], "left_semi", limits=limits)
    anti = lookup_join(skewed, lookup, ["key"], "left_anti", limits=limits)
    wanted = _by_hand(skewed, lookup)
    assert {r["id"] for r in semi.collect()} == {i for i, _, v in wanted if v is not None}
    assert {r["id"] for r in anti.collect()} == {i for i, _, v in wanted if v is None}


@ALL_LIMITS
def test_null_safe_join_matches_nulls(spark, skewed, limits):
    lookup = spark.createDataFrame([(None, "N"), ("hot", "H")], "key string, value string")
    joined = lookup_join(skewed, lookup, ["key"], null_safe=True, limits=limits)
    found = {(r["key"], r["value"]) for r in joined.collect() if r["key"] in (None, "hot")}
    assert found == {(None, "N"), ("hot", "H")}


def test_hot_keys_are_found_nulls_included(spark, skewed):
    hot = set(hot_hashes(skewed, ["key"], Limits(hot_rows=90)))
    known = spark.createDataFrame([("hot",), (None,)], "key string").select(F.xxhash64("key").alias("h")).collect()
    assert hot == {r["h"] for r in known}
    assert hot_hashes(skewed, ["key"], DEFAULT_LIMITS) == []


def test_size_decides_the_plan(skewed, lookup):
    assert "BroadcastHashJoin" in plan(lookup_join(skewed, lookup, ["key"]))
    hot = plan(lookup_join(skewed, lookup, ["key"], limits=TIGHT))
    assert "Union" in hot and "BroadcastHashJoin" in hot


def test_measured_size(spark):
    wide = spark.range(10).select(F.lpad(F.lit("x"), 1000, "x").alias("text"))
    assert fits_broadcast(wide, Limits(broadcast_rows=10, broadcast_bytes=11_000))
    assert not fits_broadcast(wide, Limits(broadcast_rows=9))
    assert not fits_broadcast(wide, Limits(broadcast_bytes=9_999))
    nested = spark.range(1).select(F.array(F.lit("abc")).alias("list"), F.lit(1.5).alias("x"))
    assert fits_broadcast(nested)


@ALL_LIMITS
def test_drop_known(spark, skewed, limits):
    existing = spark.createDataFrame([("hot",), ("hot",), (None,), ("k1",)], "key string")
    left = drop_known(skewed, existing, ["key"], limits)
    assert same(left, skewed.filter("key IS NULL OR key NOT IN ('hot', 'k1')"))


@ALL_LIMITS
@pytest.mark.parametrize("left,right", [("int", "bigint"), ("int", "string"), ("date", "timestamp")])
def test_unlike_key_types_find_each_other(spark, left, right, limits):
    number = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("int")
    key = F.date_add(F.lit("2024-01-01").cast("date"), number) if left == "date" else number
    data = spark.range(600).select("id", key.alias("key")).repartition(5)
    values = data.select(F.col("key").cast(right).alias("key")).distinct().withColumn("value", F.lit("v"))
    joined = lookup_join(data, values, ["key"], limits=limits)
    assert joined.count() == 600
    assert joined.where("value = 'v'").count() == 600


def test_hot_keys_are_found_with_empty_partitions(spark):
    rows = spark.range(2_000, numPartitions=3).select((F.col("id") % 4).alias("k"))
    limits = Limits(hot_rows=400)
    found = hot_hashes(rows, ["k"], limits)
    assert len(found) == 4
    with_empty = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in with_empty}
    try:
        for key, value in with_empty.items():
            spark.conf.set(key, value)
        assert sorted(hot_hashes(rows, ["k"], limits)) == sorted(found)
        assert hot_hashes(rows.limit(0), ["k"], limits) == []
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
