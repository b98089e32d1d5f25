import datetime as dt

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from namewright.functions import iso_utc, norm_key, not_blank, short_key, stable_id
from namewright.operators.reconcile import compare_tables_by_keys, preview_new_rows
from namewright.plans.sql_functions import register_comparison, register_preview, register_scalars

TEXTS = [" Ab ", "ab", "", "  ", "\t", None, "É ", "x" * 64, "x" * 65, "it's", "back\\slash"]


def test_scalars_agree_with_the_columns(spark):
    register_scalars(spark)
    df = spark.createDataFrame([(t, dt.datetime(2024, 3, 1, 12)) for t in TEXTS], "t string, at timestamp")
    df.createOrReplaceTempView("sql_texts")
    got = spark.sql("SELECT norm_key(t) a, not_blank(t) b, short_key(t) c, iso_utc(at) d, stable_id('p:', t) e, stable_id('p:', t, 8) f, differs(t, 'ab') g FROM sql_texts")
    t = F.col("t")
    wanted = df.select(
        norm_key(t).alias("a"), not_blank(t).alias("b"), short_key(t).alias("c"), iso_utc(F.col("at")).alias("d"),
        stable_id("p:", t).alias("e"), stable_id("p:", t, width=8).alias("f"), (~t.eqNullSafe("ab")).alias("g"),
    )
    assert rows(got) == rows(wanted)


def test_comparison_agrees_and_sees_what_the_tables_hold_now(spark):
    left = spark.createDataFrame([(" A", 1, "x"), ("a", 1, "x"), ("B", 2, "x"), (None, 3, "x"), ("C", None, "x")], "`my key` string, n int, `k0` string")
    right = spark.createDataFrame([("a ", 1), ("a ", 1), ("b", 3), (None, 1), (None, 2), ("d", 4)], "kb string, n bigint")
    for keys in ([("my key", "kb")], [("my key", "kb"), ("n", "n")]):
        left.createOrReplaceTempView("sql_left")
        right.createOrReplaceTempView("sql_right")
        register_comparison(spark, "compare_tables_by_keys", "sql_left", "sql_right", keys)
        wanted = compare_tables_by_keys(left, right, keys)
        assert rows(spark.sql("SELECT * FROM compare_tables_by_keys()")) == rows(wanted)
        assert rows(spark.sql("SELECT * FROM compare_tables_by_keys('match')")) == rows(wanted.filter("match_type = 'match'"))
        right.limit(0).createOrReplaceTempView("sql_right")
        assert rows(spark.sql("SELECT * FROM compare_tables_by_keys()")) == rows(compare_tables_by_keys(left, right.limit(0), keys))
    left.limit(0).createOrReplaceTempView("sql_left")
    assert rows(spark.sql("SELECT * FROM compare_tables_by_keys()")) == []
    with pytest.raises(ValueError):
        register_comparison(spark, "f", "sql_left", "sql_right", [])
    with pytest.raises(Exception, match="nowhere"):
        register_comparison(spark, "f", "sql_left", "sql_right", [("nowhere", "kb")])


def test_preview_agrees(spark):
    incoming = spark.createDataFrame([("A ", 1, 1.5), ("b", 2, None), (None, 3, 2.0), ("c", 4, 0.0)], "kb string, n int, `a.b` double")
    existing = spark.createDataFrame([("a",), ("C",), ("C",), (None,)], "uuid string")
    incoming.createOrReplaceTempView("sql_incoming")
    existing.createOrReplaceTempView("sql_existing")
    register_preview(
        spark, "preview_rows", "sql_incoming", "sql_existing", [("kb", "uuid")], {"Name": "upper(kb)", "n": "CAST(n AS STRING)"}, "uuid"
    )
    projection = {"Name": F.upper("kb"), "n": F.col("n").cast("string")}
    at = F.lit("2024-06-01").cast("timestamp")
    wanted = preview_new_rows(incoming, existing, [("kb", "uuid")], projection, "uuid", as_of=at)
    got = spark.sql("SELECT * FROM preview_rows(at => TIMESTAMP '2024-06-01')")
    assert got.columns == wanted.columns and same(got, wanted) and got.count() == 2
    assert spark.sql("SELECT uuid FROM preview_rows('i:') WHERE uuid LIKE 'i:%'").count() == 2
