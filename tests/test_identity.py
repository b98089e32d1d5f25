import pytest
from helpers import SHUFFLED, TIGHT, plan, rows, same
from pyspark.sql import functions as F

from namewright.operators.identity import assign_ids, audit_trail, enrich, ensure_columns, unify_ids
from namewright.plans.joins import DEFAULT_LIMITS

ALL_LIMITS = pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["small", "shuffled", "hot"])
GROUP = ["name", "country"]
SCHEMA = "row int, name string, country string, uuid string, uuid_old string, mapped boolean"

ROWS = [
    (0, "A", "NL", "u3", None, True),
    (1, "A", "NL", "u1", None, False),
    (2, "A", "NL", "u2", None, False),
    (3, "A", "NL", "u4", "u9", True),
    (4, "A", None, "u6", None, True),
    (5, "A", None, "u5", None, True),
    (6, "A", "US", "u7", None, True),
    (7, None, "NL", "u9", None, True),
    (8, None, "NL", "u8", None, True),
    (9, "B", "NL", None, None, True),
    (10, "B", "NL", "u0", None, None),
    (11, "C", "NL", None, None, True),
]


def _unify(df, **options):
    return unify_ids(df, GROUP, "uuid", "uuid_old", "mapped", **options)


@ALL_LIMITS
def test_unify_ids(spark, limits):
    after = {r["row"]: (r["uuid"], r["uuid_old"]) for r in _unify(spark.createDataFrame(ROWS, SCHEMA), limits=limits).collect()}
    assert after == {
        0: ("u1", "u3"),
        1: ("u1", None),
        2: ("u2", None),
        3: ("u1", "u4"),
        4: ("u5", "u6"),
        5: ("u5", None),
        6: ("u7", None),
        7: ("u9", None),
        8: ("u8", None),
        9: ("u0", None),
        10: ("u0", None),
        11: (None, None),
    }


def test_unify_is_idempotent(spark):
    once = _unify(spark.createDataFrame(ROWS, SCHEMA))
    assert same(once, _unify(once))


@ALL_LIMITS
def test_changed_rows_can_be_told(spark, limits):
    told = _unify(spark.createDataFrame(ROWS, SCHEMA), changed_col="changed", limits=limits)
    assert rows(told.filter("changed").select("row")) == [(0,), (3,), (4,), (9,)]
    assert told.filter("changed IS NULL").isEmpty()
    assert _unify(told.drop("changed"), changed_col="changed", limits=limits).filter("changed").isEmpty()


def test_unmapped_rows_can_be_included(spark):
    after = {r["row"]: r["uuid"] for r in _unify(spark.createDataFrame(ROWS, SCHEMA), include_unmapped=True).collect()}
    assert after[2] == "u1" and after[8] == "u8"


@ALL_LIMITS
def test_unify_equals_brute_force_with_a_hot_group(spark, limits):
    df = spark.range(900).select(
        F.col("id").cast("int").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("name"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 2)).alias("country"),
        F.substring(F.md5(F.col("id").cast("string")), 1, 8).alias("uuid"),
        F.lit(None).cast("string").alias("uuid_old"),
        (F.col("id") % 5 < 2).alias("mapped"),
    )
    lowest = {}
    for r in df.collect():
        key = (r["name"], r["country"])
        lowest[key] = min(lowest.get(key, r["uuid"]), r["uuid"])
    wanted = []
    for r in df.collect():
        low = lowest[(r["name"], r["country"])]
        changed = r["mapped"] and r["uuid"] != low
        wanted.append((r["row"], r["name"], r["country"], low if changed else r["uuid"], r["uuid"] if changed else None, r["mapped"]))
    assert rows(_unify(df.repartition(7), limits=limits)) == sorted(wanted, key=repr)


def test_no_group_meets_in_one_task(spark):
    assert "Window" not in plan(_unify(spark.createDataFrame(ROWS, SCHEMA)))


@ALL_LIMITS
def test_enrich_overwrites_where_found(spark, limits):
    df = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", None), (None, "old"), ("a", None), ("a", "z")], "key string, country string")
    lookup = spark.createDataFrame([("a", "new"), ("b", None), ("d", "x")], "key string, country string")
    assert rows(enrich(df, lookup, "key", "country", limits)) == sorted(
        [("a", "new"), ("b", None), ("c", None), (None, "old"), ("a", "new"), ("a", "new")], key=repr
    )


def test_enrich_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", None)], "key string, country string")
    lookup = spark.createDataFrame([("a", "2"), ("a", "1")], "key string, country string")
    assert rows(enrich(df, lookup, "key", "country")) == [("a", "1")]


def test_ensure_columns_is_repeatable(spark):
    df, report = ensure_columns(spark.range(2).toDF("a"), {"a": "string", "b": "string"})
    assert report == {"executed": ["b"], "skipped": ["a"]}
    assert dict(df.dtypes) == {"a": "bigint", "b": "string"}
    again, report = ensure_columns(df, {"a": "string", "b": "string"})
    assert report["executed"] == [] and again.columns == df.columns


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_ids_are_dense_and_ordered(spark, partitions):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("key")).repartition(partitions)
    numbered = [(r["id"], r["key"]) for r in assign_ids(df, ["key"]).collect()]
    assert sorted(numbered) == list(enumerate(sorted(k for _, k in numbered), start=1))


def test_ids_with_ties_and_copies(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), (F.col("id") % 10).alias("x"))
    assert sorted(r["id"] for r in assign_ids(df, ["key"]).collect()) == list(range(1, 901))


def test_ids_are_kept(spark):
    df = spark.createDataFrame([(7, "a")], "id int, key string")
    assert assign_ids(df, ["key"]) is df
    assert rows(assign_ids(spark.createDataFrame([], "key string"), ["key"])) == []


def test_audit_trail(spark):
    df = spark.createDataFrame(
        [("A", "a", True, "u1", "u2"), ("B", "B", False, "u3", None), ("C", "C", False, "u4", "u5")],
        "name string, original_name string, was_deduplicated boolean, uuid string, uuid_deprecated string",
    ).withColumn("deduplication_timestamp", F.lit(None).cast("timestamp"))
    assert rows(audit_trail(df, "name", "uuid").drop("changed_at")) == [("C", "C", "u5", "u4"), ("a", "A", "u2", "u1")]
