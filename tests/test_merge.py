import os

import pytest
from helpers import SHUFFLED, TIGHT, rows, same
from pyspark.sql import functions as F

from namewright.operators.mapping import apply_mapping
from namewright.operators.merge import ACTIONS, action_counts, changed_originals, merge, merge_report, remap_changed
from namewright.plans.joins import DEFAULT_LIMITS
from namewright.plans.run import run_mode
from namewright.plans.shared import settle

ALL_LIMITS = pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["broadcast", "full join", "tight"])
FIELDS = "k string, v string, `_ord` int"


@ALL_LIMITS
def test_merge_says_what_it_did(spark, limits):
    target = spark.createDataFrame(
        [("a", "1", 10), ("b", "2", 20), ("c", None, 30), (None, "n", 40), ("d", "4", 50)], "k string, v string, extra int"
    )
    updates = spark.createDataFrame(
        [("a", "old", 1), ("a", "1", 2), ("b", "3", 1), ("c", None, 1), (None, "m", 1), ("e", "5", 1), ("f", None, 1)], FIELDS
    )
    merged = merge(target, updates, ["k"], "_ord", limits)
    assert merged.columns == ["k", "v", "extra", "_action"]
    assert rows(merged) == sorted(
        [
            ("a", "1", 10, "unchanged"),
            ("b", "3", 20, "updated"),
            ("c", None, 30, "unchanged"),
            (None, "m", 40, "updated"),
            ("d", "4", 50, "kept"),
            ("e", "5", None, "inserted"),
            ("f", None, None, "inserted"),
        ],
        key=repr,
    )
    assert rows(merge_report(merged)) == [("inserted", 2), ("kept", 1), ("unchanged", 2), ("updated", 2)]
    measured = settle(merged, "test-merge", **action_counts()).measures
    assert [measured[a] for a in ACTIONS] == [2, 2, 2, 1]
    assert rows(merge(target, updates.limit(0), ["k"], "_ord", limits).select("_action")) == [("kept",)] * 5


def test_merge_into_nothing_and_wrong_columns(spark):
    updates = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], FIELDS)
    assert rows(merge(None, updates, ["k"], "_ord")) == [("a", "2", "inserted")]
    with pytest.raises(ValueError, match="target lacks"):
        merge(updates.select("k"), updates, ["k"], "_ord")


def _written(path):
    return {name: os.stat(f"{path}/{name}").st_mtime_ns for name in os.listdir(path) if name.endswith(".parquet")}


@ALL_LIMITS
def test_only_files_with_changed_names_are_rewritten(spark, folder, limits):
    path = f"{folder}/with blank"
    people = spark.range(400).select("id", F.concat(F.lit("n"), F.floor(F.col("id") / 20)).alias("name"))
    before = spark.createDataFrame([("n0", "A"), ("n1", "B"), ("n2", "C"), ("n9", None)], "original string, normalized string")
    after = spark.createDataFrame([("n0", "A"), ("n1", "X"), ("n9", None), ("n19", "Y"), ("nowhere", "Z")], before.schema)
    assert rows(changed_originals(before, after)) == [("n1",), ("n19",), ("n2",), ("nowhere",)]
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    # Sorted by name into ten files, so each name is in one of them.
    apply_mapping(people, before, "name", stamp).repartitionByRange(10, "id").write.parquet(path)
    files = _written(path)
    found = remap_changed(spark, path, before, after, "name", stamp, limits)
    assert found["names"] == 4 and found["rows"] == 60 and found["files"] <= 4
    left = _written(path)
    assert len([name for name in files if left.get(name) == files[name]]) == len(files) - found["files"]
    assert same(spark.read.parquet(path), apply_mapping(people, after, "name", stamp))
    assert remap_changed(spark, path, after, after, "name", stamp, limits) == {"names": 0, "rows": 0, "files": 0}
    only_new = spark.createDataFrame([("nobody", "Q")], before.schema)
    assert remap_changed(spark, path, after, after.union(only_new), "name", stamp, limits)["files"] == 0


def test_run_report_tells_what_a_load_did(spark, folder):
    def load(lines):
        with open(f"{folder}/m.csv", "w", encoding="utf-8") as out:
            out.write("original,normalized\n" + "\n".join(lines) + "\n")
        report = run_mode(spark, folder, "load-mapping", mapping_csv=f"{folder}/m.csv")
        assert report.success, report.steps
        return report.steps[0].details

    first = load(["a,A", "b,B", '"c, d"C', "bad"])
    assert [first[a] for a in ACTIONS] == [3, 0, 0, 0] and first["rejected"] == 1
    assert first["auto_fixed"] == 1 and first["auto_fixed_examples"] == [{"original": "c, d", "normalized": "C"}]
    second = load(["a,A", "b,B2", "e,E"])
    assert [second[a] for a in ACTIONS] == [1, 1, 1, 1] and second["rejected"] == second["auto_fixed"] == 0
