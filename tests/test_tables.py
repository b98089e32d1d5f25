import json
import os

import pytest
from helpers import SHUFFLED, TIGHT, plan, rows, same
from pyspark.sql import functions as F

from namewright.functions import (
    differs,
    dup_key,
    iso_utc,
    norm_key,
    not_blank,
    random_id,
    short_key,
    stable_id,
)
from namewright.plans import shared
from namewright.sources import documents, tables
from namewright.sources.documents import flatten_json, index_documents, land_json, write_documents
from namewright.sources.tables import (
    MissingTable,
    describe_columns,
    list_tables,
    load_table,
    require,
    table_exists,
    table_log,
    write_table,
)


def test_replacing_a_table_from_itself(spark, folder):
    assert write_table(spark.range(5), folder, "t") == {"rows": 5}
    before = load_table(spark, folder, "t")
    assert write_table(before.filter("id < 2"), folder, "t", top=F.max("id")) == {"rows": 2, "top": 1}
    assert load_table(spark, folder, "t").count() == 2
    # Whoever opened the old version still reads it.
    assert before.count() == 5
    assert rows(table_log(spark, folder).select("name", "version", "rows")) == [("t", 1, 5), ("t", 2, 2)]


def test_failed_write_leaves_the_table(spark, folder):
    write_table(spark.range(5), folder, "t")
    with pytest.raises(Exception):
        write_table(spark.range(5).select(F.raise_error(F.lit("broken")).cast("string").alias("x")), folder, "t")
    assert load_table(spark, folder, "t").columns == ["id"]


def test_missing_table(spark, folder):
    with pytest.raises(MissingTable, match="nowhere"):
        load_table(spark, folder, "nowhere")
    assert not table_exists(spark, folder, "nowhere")


def test_list_tables_reports_a_broken_one_and_goes_on(spark, folder):
    write_table(spark.range(5), folder, "versioned")
    write_table(spark.range(3), folder, "versioned")
    spark.range(7).write.parquet(f"{folder}/plain")
    spark.range(4).write.parquet(f"{folder}/single.parquet")
    with open(f"{folder}/broken.parquet", "wb") as out:
        out.write(b"no parquet here")
    assert [tuple(r) for r in list_tables(spark, folder).collect()] == [
        ("broken", -1),
        ("plain", 7),
        ("single", 4),
        ("versioned", 3),
    ]
    assert same(list_tables(spark, "file:" + folder + "/"), list_tables(spark, folder))


def test_describe_columns(spark):
    df = spark.createDataFrame([(1, "x", True)], "b int, a string, c boolean")
    assert [tuple(r) for r in describe_columns(df).collect()] == [(1, "b", "int"), (2, "a", "string"), (3, "c", "boolean")]
    with pytest.raises(ValueError):
        describe_columns(df.select())


def test_require(spark):
    require(spark.range(1), ["id"])
    with pytest.raises(ValueError, match="people lacks column.*: a, b"):
        require(spark.range(1), ["a", "id", "b"], "people")


def test_settle_uses_the_named_folder(spark):
    settled = shared.settle(spark.range(10), "probe", top=F.max("id"))
    assert settled.df.count() == 10 and settled.measures == {"rows": 10, "bytes": 80, "top": 9}
    assert all(f"{shared.shared_dir(spark)}/namewright/" in f for f in settled.df.inputFiles())


def test_shared_dir_is_never_local_on_a_cluster(monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session(spark_master="yarn"))
    named = Session(spark_master="yarn", spark_checkpoint_dir="hdfs://x/shared/")
    assert shared.shared_dir(named) == "hdfs://x/shared"


def test_land_and_flatten_json(spark, folder):
    lines = [{"id": 1, "tags": [{"t": "a"}, {"t": "b"}]}, {"id": 2, "tags": []}, {"id": 3}]
    with open(f"{folder}/raw.json", "w", encoding="utf-8") as out:
        out.writelines(json.dumps(line) + "\n" for line in lines)
        out.write("not json\n")
    landed = land_json(spark, f"{folder}/raw.json")
    assert landed.columns == ["data"] and landed.count() == 4
    flat = flatten_json(landed, "data", "id int, tags array<struct<t string>>", explode="tags")
    assert rows(flat) == sorted([(1, "a"), (1, "b"), (2, None), (3, None), (None, None)], key=repr)
    assert flatten_json(landed, "data", "id int").count() == 4
    plain = flatten_json(spark.createDataFrame([(9, '{"v": [1, 2]}')], "k int, j string"), "j", "v array<int>", "v")
    assert rows(plain) == [(9, 1), (9, 2)]


def test_documents_have_one_stable_id_each(spark, folder):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 5)], "uuid string, version int")
    docs = index_documents(df, "uuid", newest="version")
    found = {r["_id"]: json.loads(r["_source"]) for r in docs.collect()}
    assert found["a"] == {"uuid": "a", "version": 2} and found["b"]["version"] == 1
    assert len(found) == 3
    assert same(docs, index_documents(df.repartition(3), "uuid", newest="version"))
    assert "WindowGroupLimit" in plan(docs)
    write_documents(docs, f"{folder}/index")
    write_documents(docs, f"{folder}/index")
    assert spark.read.json(f"{folder}/index").count() == 3


def test_expressions(spark):
    df = spark.createDataFrame([(" Ab ", 5, None), ("\tX", 5, "q")], "s string, n int, z string")
    first = df.filter("z IS NULL").select(
        norm_key(F.col("s")), norm_key(F.col("n")), not_blank(F.col("s")), differs(F.col("z"), F.col("s")),
        differs(F.col("z"), F.col("z")), dup_key(F.col("s"), df.schema["s"].dataType),
        dup_key(F.col("s"), df.schema["s"].dataType, False), dup_key(F.col("n"), df.schema["n"].dataType),
        not_blank(F.lit("  ")), not_blank(F.lit("\t")),
    ).first()
    assert tuple(first) == ("ab", "5", True, True, False, " ab ", " Ab ", "5", False, True)


def test_ids(spark):
    df = spark.range(2000)
    drawn = [r[0] for r in df.select(random_id("p:", seed=3)).collect()]
    assert all(len(i) == 10 and i.startswith("p:") and int(i[2:], 16) >= 0 and i == i.lower() for i in drawn)
    stable = df.select(stable_id("p:", F.col("id"), F.col("id") % 2, width=20))
    assert stable.distinct().count() == 2000 and same(stable, df.repartition(4).select(stable_id("p:", F.col("id"), F.col("id") % 2, width=20).alias(stable.columns[0])))
    apart = spark.createDataFrame([("a", None), (None, "a"), ("aa", None), ("a", "")], "x string, y string")
    assert apart.select(stable_id("", F.col("x"), F.col("y"))).distinct().count() == 4
    with pytest.raises(ValueError):
        stable_id("p:", F.col("id"), width=4)


def test_short_keys_are_equal_when_the_texts_are(spark):
    texts = ["", "x" * 64, "x" * 65, "x" * 5000, "sha256:" + "0" * 57]
    keys = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(short_key(F.col("t"))).collect()]
    assert len(set(keys)) == len(texts) and max(map(len, keys)) == 71
    assert keys[0] == "" and keys[1] == texts[1] and keys[4] == texts[4]


def test_iso_time(spark):
    shown = spark.sql("SELECT TIMESTAMP '2026-01-05 12:00:00' AS t").select(iso_utc(F.col("t"))).first()[0]
    assert shown == "2026-01-05T12:00:00Z"


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_an_index_in_buckets_rewrites_only_what_a_load_touches(spark, folder):
    numbers = spark.range(3_000)
    shape = [F.col("id").cast("string").alias("_id"), F.concat(F.lit('{"v":'), "id", F.lit("}")).alias("_source")]
    docs = numbers.select(*shape)
    assert documents.update_index(spark, folder, "people", docs, buckets=200) == {"rows": 3000, "buckets": 200}
    before = _files(f"{folder}/people")
    few = numbers.filter("id % 100 = 3").select(*shape).withColumn("_source", F.lit('{"v":-1}'))
    new = spark.createDataFrame([("new", "a"), ("new", "c"), ("new", "b"), ("3", '{"v":-2}'), ("3", '{"v":-1}')], "_id string, _source string")
    found = documents.update_index(spark, folder, "people", few.union(new), buckets=7)
    bucket = F.pmod(F.xxhash64("_id"), F.lit(200))
    touched = {r[0] for r in few.union(new).select(bucket).distinct().collect()}
    assert found["buckets"] == len(touched) < 40
    after = _files(f"{folder}/people")
    changed = {int(path.split("bucket=")[1].split("/")[0]) for path, _ in set(before.items()) ^ set(after.items())}
    assert changed == touched
    got = {r._id: r._source for r in documents.load_index(spark, folder, "people").collect()}
    wanted = {str(i): f'{{"v":{-1 if i % 100 == 3 else i}}}' for i in range(3_000)} | {"new": "c", "3": '{"v":-2}'}
    assert got == wanted
    assert documents.update_index(spark, folder, "people", new.limit(0)) == {"rows": 0, "buckets": 0}
    assert _files(f"{folder}/people") == after
    with pytest.raises(tables.MissingTable):
        documents.load_index(spark, folder, "nobody")


@pytest.mark.parametrize("limits", [SHUFFLED, TIGHT], ids=["shuffled", "hot"])
def test_repeated_ids_of_an_index_by_shuffle(spark, folder, limits):
    docs = spark.range(400).select(F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("_id"), F.col("id").cast("string").alias("_source"))
    documents.update_index(spark, folder, "x", docs, 4, limits)
    documents.update_index(spark, folder, "x", docs.filter("_source < 150"), 4, limits)
    got = {r._id: r._source for r in documents.load_index(spark, folder, "x").collect()}
    wanted = {str(i): str(i) for i in range(200, 400)} | {"hot": max(str(i) for i in range(150))}
    assert got == wanted


def test_documents_that_cannot_be_parsed_are_kept_apart(spark, folder):
    lines = ['{"a": 1, "items": [{"n": "x"}, {"n": 2}]}', "", "  ", '{"a": ', "not json", '{"a": "text", "items": []}', "[1, 2]", "7", '{"items": {"n": 1}}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/in")
    assert documents.land_documents(spark, f"{folder}/in", folder, "raw") == {"rows": 5, "rejects": 4}
    bad = tables.load_table(spark, folder, "raw_rejects")
    assert sorted(map(tuple, bad.select("raw", "reason").collect())) == sorted(
        [("", "blank"), ("  ", "blank"), ('{"a": ', "malformed"), ("not json", "malformed")]
    )
    good = tables.load_table(spark, folder, "raw")
    assert good.columns == ["data"]
    fields = documents.variant_fields(good, "data", {"a": ("$.a", "int"), "text": ("$.a", "string"), "items": ("$.items", "variant")})
    assert sorted(map(str, fields.select("a", "text").collect())) == sorted(
        ["Row(a=1, text='1')", "Row(a=None, text='text')"] + ["Row(a=None, text=None)"] * 3
    )
    items = documents.variant_fields(fields, "items", {"n": ("$.n", "string")}, explode="$")
    assert sorted((r.text, r.n) for r in items.filter("text IS NOT NULL").collect() if r.n) == [("1", "2"), ("1", "x")]
    assert items.count() == 6


def test_tables_are_named_from_two_levels_and_reasons_are_logged(spark, folder, caplog):
    data = spark.range(6).select("id", (F.col("id") % 2).alias("half"))
    write_table(data, folder, "logged")
    data.write.parquet(f"{folder}/plain")
    data.write.parquet(f"{folder}/file.parquet")
    data.write.partitionBy("half").parquet(f"{folder}/parted")
    data.write.json(f"{folder}/other")
    data.write.parquet(f"{folder}/deep/below/it")
    spark.createDataFrame([("no parquet",)], "value string").coalesce(1).write.text(f"{folder}/broken.parquet")
    with caplog.at_level("WARNING"):
        listed = [tuple(row) for row in list_tables(spark, folder).collect()]
    assert listed == [("broken", -1), ("file", 6), ("logged", 6), ("parted", 6), ("plain", 6)]
    assert "broken" in caplog.text
    assert list_tables(spark, f"{folder}/nowhere").collect() == []
