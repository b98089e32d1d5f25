from collections import Counter

import pytest
from helpers import SHUFFLED, TIGHT, plan, rows
from pyspark.sql import functions as F

from namewright.functions import stable_id
from namewright.operators.reconcile import compare_tables_by_keys, insert_missing, preview_new_rows, rows_to_insert
from namewright.plans.joins import DEFAULT_LIMITS

ALL_LIMITS = pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["small", "shuffled", "hot"])


def _compare_by_hand(left, right):
    def norm(values):
        return tuple(None if v is None else str(v).lower().strip(" ") for v in values)

    out, matched = Counter(), set()
    for a in left:
        hits = [i for i, b in enumerate(right) if None not in norm(a) and norm(a) == norm(b)]
        matched.update(hits)
        for i in hits:
            out[("match", a[0], right[i][0])] += 1
        if not hits:
            out[("unknown" if a[0] is None else "only_in_left", a[0], None)] += 1
    for i, b in enumerate(right):
        if i not in matched:
            out[("unknown" if b[0] is None else "only_in_right", None, b[0])] += 1
    return sorted([(*k, n) for k, n in out.items()], key=repr)


def test_compare_one_key(spark):
    left = [("Ann",), (" bob",), ("bob",), (None,), ("carl",), ("Ann",)]
    right = [("ANN ",), ("Bob",), ("Bob",), (None,), (None,), ("dora",)]
    got = compare_tables_by_keys(
        spark.createDataFrame(left, "name string"), spark.createDataFrame(right, "kb string"), [("name", "kb")]
    )
    assert rows(got) == _compare_by_hand(left, right)


def test_compare_several_keys_of_other_types(spark):
    left = [("A", 1), ("a ", 2), ("a", None), (None, 1), ("b", 1), ("A", 1)]
    right = [("a", "1"), ("A", "1"), ("a", "2"), ("a", None), ("c", "1"), (None, "1")]
    got = compare_tables_by_keys(
        spark.createDataFrame(left, "name string, n int"),
        spark.createDataFrame(right, "kb string, m string"),
        [("name", "kb"), ("n", "m")],
    )
    assert rows(got) == _compare_by_hand(left, right)


def test_a_hot_key_is_not_paired_row_by_row(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = compare_tables_by_keys(df, df, [("k", "k")])
    assert got.filter("uuid_left = 'hot'").collect()[0]["pairs"] == 66_667**2
    assert got.count() == 133_334


def test_compare_needs_keys(spark):
    with pytest.raises(ValueError):
        compare_tables_by_keys(spark.range(1), spark.range(1), [])


@pytest.fixture(scope="module")
def people(spark):
    hot = [("HOT", f"n{i}") for i in range(5)]
    return spark.createDataFrame([("K1", "a"), (" k2", "b"), (None, "c"), ("k3", "d"), ("k3", "e"), *hot], "kb string, name string")


@ALL_LIMITS
def test_preview(spark, people, limits):
    existing = spark.createDataFrame([("k1",), ("K2 ",), (None,), ("hot",), ("hot",)], "uuid string")
    new = preview_new_rows(
        people, existing, [("kb", "uuid")], {"fullname": F.col("name"), "kb": F.col("kb")}, "id",
        stable_id("p:", F.col("name")), F.lit("2024-01-01"), limits=limits,
    )
    assert new.columns == ["id", "fullname", "kb", "last_update"]
    assert {r["fullname"] for r in new.collect()} == {"c", "d", "e"}
    assert new.select("id").distinct().count() == 3


def test_preview_ids_are_stable_by_default(spark, people):
    existing = spark.createDataFrame([], "uuid string")

    def ids():
        return rows(preview_new_rows(people, existing, [("kb", "uuid")], {}, "id").select("id"))

    assert ids() == ids() and len(set(ids())) == people.count()


@ALL_LIMITS
def test_insert_missing_twice_adds_nothing(spark, people, limits):
    target = spark.createDataFrame([("k1", "kept"), (None, "other")], people.schema)
    once = insert_missing(target, people, ["kb"], limits)
    assert rows(once) == sorted(
        [("k1", "kept"), (None, "other"), (" k2", "b"), (None, "c"), ("k3", "d"), ("HOT", "n0")], key=repr
    )
    assert rows_to_insert(once, people, ["kb"], limits).isEmpty()


def test_hot_keys_are_thinned_before_the_shuffle(spark, people):
    assert "WindowGroupLimit" in plan(rows_to_insert(people.limit(0), people, ["kb"]))
