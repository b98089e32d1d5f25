import itertools
import random
from collections import Counter

import pytest
from helpers import SHUFFLED, TIGHT, plan, rows
from pyspark.sql import functions as F

from namewright.operators.duplicates import (
    duplicate_groups,
    duplicate_records,
    duplicates_report,
    is_unique,
    key_columns,
)
from namewright.operators import keys as key_search
from namewright.operators.keys import composite_keys, minimal_keys
from namewright.plans.joins import DEFAULT_LIMITS

LONG = "Long text " * 20


@pytest.fixture(scope="module")
def poc(spark):
    data = [
        (1, "Example", "x"),
        (2, "example", None),
        (3, "Example ", "y"),
        (4, LONG, None),
        (5, LONG.upper(), "y"),
        (6, None, "z"),
        (7, None, "Y"),
    ]
    return spark.createDataFrame(data, "id bigint, text1 string, text2 string")


def test_happy_path(poc):
    assert rows(duplicates_report(poc, keys=["id"], columns=["text1"], id_col="id")) == [
        ("text1", "example", 2, 0, [1, 2]),
        ("text1", LONG.lower(), 2, 0, [4, 5]),
    ]


def test_all_columns_but_keys(poc):
    assert rows(duplicates_report(poc, keys=["id"])) == [
        ("text1", "example", 2),
        ("text1", LONG.lower(), 2),
        ("text2", "y", 3),
    ]


def test_case_sensitive(poc):
    assert rows(duplicates_report(poc, keys=["id"], case_insensitive=False)) == [("text2", "y", 2)]


def test_missing_column_is_an_error(poc):
    with pytest.raises(ValueError, match="lacks column"):
        duplicates_report(poc, columns=["text9"])
    with pytest.raises(ValueError, match="no column"):
        duplicates_report(poc, keys=poc.columns)


def test_records_of_groups(poc):
    found = duplicate_records(poc, keys=["id"], id_col="id")
    assert [(r["dup_column"], r["dup_count"], r["id"], r["text1"]) for r in found.collect()] == [
        ("text1", 2, 1, "Example"),
        ("text1", 2, 2, "example"),
        ("text1", 2, 4, LONG),
        ("text1", 2, 5, LONG.upper()),
        ("text2", 3, 3, "Example "),
        ("text2", 3, 5, LONG.upper()),
        ("text2", 3, 7, None),
    ]


def test_records_without_an_id_column(poc):
    plain = poc.drop("id")
    assert duplicate_records(plain).count() == 7
    assert duplicates_report(plain).columns == ["column", "value", "count"]


def test_column_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b")], "id int, value string, `count` string")
    assert rows(duplicates_report(df, keys=["id"])) == [("value", "a", 2)]
    assert duplicate_records(df, keys=["id"], id_col="id").columns[-3:] == ["id", "value", "count"]


def test_largest_groups_first_ties_by_value(spark):
    df = spark.range(60).select((F.col("id") % 20).alias("v")).union(spark.range(5).select(F.lit(7)))
    top = duplicate_groups(df, "v", limit=4)
    assert rows(top) == sorted([("v", "7", 8), ("v", "0", 3), ("v", "1", 3), ("v", "10", 3)], key=repr)


def test_ids_of_a_hot_group_come_in_several_bounded_lists(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    report = duplicates_report(df.repartition(6), columns=["v"], id_col="id", ids_per_list=50)
    lists = report.collect()
    assert {r["count"] for r in lists} == {1000}
    assert len(lists) > 10 and max(len(r["ids"]) for r in lists) <= 150
    assert sorted(i for r in lists for i in r["ids"]) == list(range(0, 3000, 3))


def test_copies_of_one_id_are_all_there(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("id"), F.lit("v").alias("v"))
    df = df.union(spark.range(30).select(F.lit(None).cast("bigint"), F.lit("v")))
    lists = duplicates_report(df, columns=["v"], id_col="id", ids_per_list=20).collect()
    assert Counter(i for r in lists for i in r["ids"]) == Counter({1: 400, None: 30, **{i: 1 for i in range(400, 500)}})
    assert max(len(r["ids"]) for r in lists) <= 200


@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["small", "shuffled", "hot"])
def test_ids_take_one_shuffle_to_their_list(spark, limits):
    df = spark.range(600).select("id", (F.col("id") % 4).alias("v"), (F.col("id") % 290).alias("w"))
    report = duplicates_report(df, keys=["id"], id_col="id", ids_per_list=20, limits=limits)
    # A row is shuffled once, in the branch of hot values or in the other.
    assert plan(report).count("Exchange hashpartitioning") <= (2 if limits is TIGHT else 1)
    wanted = Counter((c, str(i % m), i) for c, m in (("v", 4), ("w", 290)) for i in range(600))
    assert Counter((r["column"], r["value"], i) for r in report.collect() for i in r["ids"]) == wanted


@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, TIGHT], ids=["small", "hot"])
def test_lists_of_hot_null_and_rare_ids_are_one_a_part(spark, limits):
    ids = F.when(F.col("n") < 200, 1).when(F.col("n") < 260, None).otherwise(F.col("n"))
    df = spark.range(500).toDF("n").select(ids.alias("id"), F.when(F.col("n") % 2 == 0, "long " * 30).otherwise("x").alias("v"))
    lists = duplicates_report(df, columns=["v"], id_col="id", ids_per_list=30, limits=limits).collect()
    assert Counter((r["value"], i) for r in lists for i in r["ids"]) == Counter((r["v"], r["id"]) for r in df.collect())
    assert len({(r["value"], r["part"]) for r in lists}) == len(lists) and max(len(r["ids"]) for r in lists) <= 150


def test_records_equal_brute_force(spark):
    df = spark.range(400).select("id", (F.col("id") % 150).alias("a"), F.lit("same").alias("b"), F.col("id").alias("c"))
    got = Counter((r["dup_column"], r["id"]) for r in duplicate_records(df, keys=["id"], limit=500).collect())
    wanted = Counter({("a", i): 1 for i in range(400)}) + Counter({("b", i): 1 for i in range(400)})
    assert got == wanted


def test_only_checked_columns_are_read(spark, folder):
    spark.range(10).selectExpr("id", "id % 2 AS a", "id % 3 AS b").write.parquet(f"{folder}/t")
    report = plan(duplicates_report(spark.read.parquet(f"{folder}/t"), columns=["a"], id_col="id"))
    assert "b:bigint" not in report


def test_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 1.0), (2, "b", "x", 2.0), (3, "b", "y", 2.5)], "id int, v string, n string, x double"
    )
    assert rows(key_columns(df)) == [("id", True), ("n", False), ("v", False), ("x", True)]
    assert rows(key_columns(df, declared=["v"], columns=["v", "n"])) == [("n", False), ("v", True)]
    assert is_unique(df, ["v", "x"]) and is_unique(df, ["id"])
    assert not is_unique(df, ["v"]) and not is_unique(df, ["n"]) and not is_unique(df, ["id", "n"])


def test_one_repeat_among_many_is_found(spark):
    df = spark.range(20_000).select("id", F.greatest(F.col("id"), F.lit(1)).alias("nearly"))
    assert rows(key_columns(df)) == [("id", True), ("nearly", False)]


@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["small", "shuffled", "hot"])
def test_all_groups_are_reported_by_default(spark, limits):
    value = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("long " * 20), (F.col("id") % 400).cast("string")))
    df = spark.range(2400).select("id", value.alias("v"))
    found = rows(duplicates_report(df, columns=["v"], id_col="id", limits=limits))
    assert len(found) == 401 and sum(len(ids) for *_, ids in found) == 2400
    records = duplicate_records(df, columns=["v"], limits=limits)
    assert records.count() == 2400
    assert [r.dup_value for r in records.limit(800).collect()] == ["hot"] * 800


def _keys_by_brute_force(data, names, most=3):
    found = []
    for size in range(1, most + 1):
        for one in itertools.combinations(range(len(names)), size):
            values = [tuple(row[i] for i in one) for row in data]
            if len(set(values)) == len(data) and None not in itertools.chain(*values) and not any(set(k) <= set(one) for k in found):
                found.append(one)
    return [tuple(names[i] for i in one) for one in found]


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys_by_brute_force(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b b", "c.c", "d", "e", "f"]
    kinds = [4, 5, 6, 7, 40, 3]
    data = list({tuple(rng.randrange(k) for k in kinds) for _ in range(rng.choice([30, 60, 300]))})
    data = [(*row[:5], None if seed == 3 and row[5] == 0 else row[5]) for row in data]
    df = spark.createDataFrame(data, ", ".join(f"`{n}` int" for n in names))
    wanted = _keys_by_brute_force(data, names)
    assert minimal_keys(df) == wanted
    assert rows(composite_keys(df).select("key")) == sorted([(",".join(k),) for k in wanted], key=repr)
    assert minimal_keys(df, max_columns=1) == [k for k in wanted if len(k) == 1]


def test_keys_of_many_rows_are_searched_in_slices_first(spark, monkeypatch):
    df = spark.range(30_000).select(
        (F.col("id") % 300).alias("a"), F.floor(F.col("id") / 300).alias("b"), F.when(F.col("id") == 7, 8).otherwise(F.col("id")).alias("nearly")
    )
    df = df.withColumn("x", F.rand(3)).withColumn("map", F.create_map(F.lit(1), F.lit(2)))
    assert minimal_keys(df, ["a", "b", "nearly"]) == [("a", "b"), ("a", "nearly")]
    assert minimal_keys(df, ["a", "b"], declared=[["b"]]) == [("b",)]
    full = []
    repeated = key_search._repeated
    monkeypatch.setattr(key_search, "_repeated", lambda d, sets, slices: (full.extend(sets) if slices == 1 else None) or repeated(d, sets, slices))
    assert ("x",) in minimal_keys(df, max_columns=2) and ("a",) not in full


def test_rows_send_eight_bytes_a_set(spark):
    df = spark.range(50_000).select("id", F.lit(1).alias("same"), (F.col("id") % 40_000).alias("often"))
    sets = {0: ("id",), 1: ("often",), 2: ("same",), 3: ("id", "same")}
    hashes = key_search._wide_hashes(df.coalesce(1), sets, 2)
    chunks = hashes.mapInArrow(lambda batches: key_search._packed(batches, 16), "bucket int, hashes binary")
    assert chunks.agg(F.sum(F.length("hashes"))).first()[0] == 8 * (3 * 50_000 + 2)
    one_by_one = key_search._hashes(df, sets, 1, 2).select("h")
    assert one_by_one.groupBy("h").count().filter("count > 1").count() == 10_001
    assert key_search._repeated(key_search.Counted(df, 50_000), list(sets.values()), 1) == {("often",), ("same",)}
    assert key_search._repeated(key_search.Counted(df, 50_000), list(sets.values()), 8) >= {("often",)}


def test_unlike_rows_with_one_hash_are_no_repeat(spark, monkeypatch):
    df = spark.range(1000).select("id", F.greatest(F.col("id"), F.lit(1)).alias("nearly"))
    real = key_search._wide_hashes

    def met(*args):
        hashes = real(*args)
        low, high = hashes.agg(F.min("h0"), F.max("h0")).first()
        return hashes.withColumn("h0", F.when(F.col("h0") == low, high).otherwise(F.col("h0")))

    monkeypatch.setattr(key_search, "_wide_hashes", met)
    assert key_search._repeated(key_search.Counted(df, 1000), [("id",), ("nearly",)], 1) == {("nearly",)}
    assert minimal_keys(df) == [("id",)]


def test_keys_of_odd_tables(spark):
    df = spark.createDataFrame([(0.0, "a", 1), (-0.0, "b", 1)], "x double, `s.t` string, n int")
    assert minimal_keys(df) == [("s.t",)]
    assert minimal_keys(df.limit(0)) == [("x",), ("s.t",), ("n",)]
    assert minimal_keys(df.union(df)) == []
    with pytest.raises(ValueError, match="lacks column"):
        minimal_keys(df, ["nowhere"])


def test_columns_that_are_keys_are_left_out_of_the_report(spark, poc):
    for insensitive in (True, False):
        plain = rows(duplicates_report(poc, id_col="id", columns=["text1", "text2"], case_insensitive=insensitive))
        assert rows(duplicates_report(poc, id_col="id", columns=["text1", "text2"], case_insensitive=insensitive, infer_keys=True)) == plain
    unique = spark.createDataFrame([(1, "x", "Same"), (2, "y", "same")], "id int, a string, b string")
    assert rows(duplicates_report(unique, infer_keys=True)) == [("b", "same", 2)]
    none = duplicates_report(unique, columns=["a"], id_col="id", infer_keys=True)
    assert none.count() == 0 and none.schema == duplicates_report(unique, columns=["a"], id_col="id").schema
