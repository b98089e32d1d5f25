import pytest
from helpers import SHUFFLED, TIGHT, rows, same
from pyspark.sql import functions as F

from namewright.operators.mapping import apply_mapping, last_per_key, resolve_chains, upsert
from namewright.plans.joins import DEFAULT_LIMITS
from namewright.sources.mapping_csv import (
    load_mapping,
    read_mapping,
    split_concatenated,
    split_rejects,
    validate_mapping,
)

def stamp():
    return F.lit("2024-01-01").cast("timestamp_ntz")

FILE = """original,normalized
Outer Blank ,Outer Blank
"University of Ambria, Ostwell",Ambria University
Institute of Tides,"Tides, Institute of"
"Society of Maps, North"Society of Maps
"Both, quoted","Quoted, both"
"The ""Old"" College",Old College
Smith &amp; Sons,Smith & Sons
Nobody,None
oddcase,First
ODDCASE,Second
Hop One,Hop Two
Hop Two,Hop Three
alone
,No Original
No Target,
Three,fields,here
Outer Blank ,Changed Later
"""


@pytest.fixture
def mapping_file(folder):
    path = f"{folder}/mapping.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write(FILE)
    return path


def test_read_keeps_fields_verbatim_and_repairs_only_broken_records(spark, mapping_file):
    accepted, rejected = split_rejects(load_mapping(spark, mapping_file))
    assert [(r["original"], r["normalized"]) for r in accepted.orderBy("_ord").collect()] == [
        ("Outer Blank ", "Outer Blank"),
        ("University of Ambria, Ostwell", "Ambria University"),
        ("Institute of Tides", "Tides, Institute of"),
        ("Society of Maps, North", "Society of Maps"),
        ("Both, quoted", "Quoted, both"),
        ('The "Old" College', "Old College"),
        ("Smith &amp; Sons", "Smith & Sons"),
        ("Nobody", "None"),
        ("oddcase", "First"),
        ("ODDCASE", "Second"),
        ("Hop One", "Hop Two"),
        ("Hop Two", "Hop Three"),
        ("Three", "fields"),
        ("Outer Blank ", "Changed Later"),
    ]
    assert [r["original"] for r in accepted.filter("repaired").collect()] == ["Society of Maps, North"]
    assert {r["reason"] for r in rejected.collect()} == {"missing original", "missing normalized"}
    assert rejected.count() == 3


def test_dry_run_counts_only(spark, mapping_file):
    assert rows(validate_mapping(load_mapping(spark, mapping_file))) == [(17, 3)]


def test_line_break_inside_quotes(spark, folder):
    with open(f"{folder}/m.csv", "w", encoding="utf-8") as out:
        out.write('original,normalized\n"two\nlines",One\nplain,Two\n')
    assert rows(read_mapping(spark, f"{folder}/m.csv").select("original", "normalized")) == [
        ("plain", "Two"),
        ("two\nlines", "One"),
    ]


def test_splittable_reading_agrees(spark, mapping_file):
    def load(multi_line):
        return load_mapping(spark, mapping_file, multi_line=multi_line).drop("_ord")

    assert same(load(True), load(False))


def test_pairs_are_split_only_when_asked(spark):
    df = spark.createDataFrame([("oldNameNew Name", None), ("lower only", " "), ("Good", "Kept")], "original string, normalized string")
    assert rows(split_concatenated(df).select("original", "normalized", "auto_fixed")) == [
        ("Good", "Kept", False),
        ("lower only", " ", False),
        ("old", "NameNew Name", True),
    ]


def test_upsert_last_row_wins_and_nothing_is_deleted(spark, mapping_file):
    accepted, _ = split_rejects(load_mapping(spark, mapping_file))
    updates = accepted.select("original", "normalized", "_ord")
    target = spark.createDataFrame([("Nobody", "old"), ("Absent", "stays")], "original string, normalized string")
    once = upsert(target, updates, ["original"], "_ord")
    names = dict(rows(once))
    assert names["Outer Blank "] == "Changed Later"
    assert names["Nobody"] == "None"
    assert names["Absent"] == "stays"
    assert len(names) == once.count() == 14
    assert same(once, upsert(once, updates, ["original"], "_ord"))
    assert same(once, upsert(target, updates, ["original"], "_ord", TIGHT))
    assert same(upsert(None, updates, ["original"], "_ord"), once.filter("original <> 'Absent'"))


def test_last_per_key_with_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    last = last_per_key(df.withColumn("ord", F.col("id")), ["k"], "ord")
    assert last.filter("k = 'hot'").select("id").first()["id"] == 998
    assert last.count() == 335


@pytest.fixture
def institutions(spark):
    names = ["Old A", "old a", "Old A ", "B", "", "   ", None, "\t", "Chain 1", "Old A"]
    return spark.createDataFrame([(i, n, "x") for i, n in enumerate(names)], "id int, name string, extra string")


@pytest.fixture
def corrections(spark):
    pairs = [("Old A", "A"), ("Chain 1", "Chain 2"), ("Chain 2", "Chain 3"), ("B", None)]
    return spark.createDataFrame(pairs, "original string, normalized string")


@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, SHUFFLED, TIGHT], ids=["small", "shuffled", "hot"])
def test_apply_mapping(institutions, corrections, limits):
    mapped = apply_mapping(institutions, corrections, "name", stamp(), limits=limits)
    assert mapped.columns == ["name", "original_name", "was_deduplicated", "deduplication_timestamp", "id", "extra"]
    got = {r["id"]: (r["name"], r["was_deduplicated"], r["deduplication_timestamp"] is not None) for r in mapped.collect()}
    assert got == {
        0: ("A", True, True),
        1: ("old a", False, False),
        2: ("Old A ", False, False),
        3: ("B", False, False),
        7: ("\t", False, False),
        8: ("Chain 2", True, True),
        9: ("A", True, True),
    }


def test_folding_is_optional_and_exact_matches_come_first(spark, institutions, corrections):
    more = corrections.unionByName(spark.createDataFrame([("OLD A", "Z"), ("old a", "Y")], corrections.schema))
    mapped = apply_mapping(institutions, more, "name", stamp(), ["id"], fold=True)
    names = {r["id"]: r["name"] for r in mapped.collect()}
    assert (names[0], names[1], names[2]) == ("A", "Y", "Z")


def test_repeated_originals_do_not_multiply_rows(institutions, corrections):
    doubled = corrections.unionByName(corrections)
    assert same(
        apply_mapping(institutions, doubled, "name", stamp()), apply_mapping(institutions, corrections, "name", stamp())
    )


def test_partitioning_does_not_matter(institutions, corrections):
    one = apply_mapping(institutions.coalesce(1), corrections, "name", stamp())
    many = apply_mapping(institutions.repartition(9), corrections.repartition(4), "name", stamp())
    assert same(one, many)


def test_missing_columns_are_named(institutions, corrections):
    with pytest.raises(ValueError, match="lacks column.*nothing"):
        apply_mapping(institutions, corrections, "nothing", stamp())


@pytest.mark.parametrize("limits", [DEFAULT_LIMITS, TIGHT], ids=["small", "hot"])
def test_chains(spark, limits):
    pairs = [(f"s{i}", "hub") for i in range(20)] + [("hub", "x1"), ("self", "self")]
    pairs += [(f"x{i}", f"x{i + 1}") for i in range(1, 20)]
    ends = dict(rows(resolve_chains(spark.createDataFrame(pairs, "original string, normalized string"), limits=limits)))
    assert len(ends) == len(pairs)
    assert ends.pop("self") == "self"
    assert set(ends.values()) == {"x20"}


@pytest.mark.parametrize("pairs", [[("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a")]])
def test_circles_are_refused(spark, pairs):
    with pytest.raises(ValueError, match="circle"):
        resolve_chains(spark.createDataFrame(pairs, "original string, normalized string"))


def test_long_chains_are_refused(spark):
    links = spark.range(40).selectExpr("concat('n', id) AS original", "concat('n', id + 1) AS normalized")
    with pytest.raises(ValueError, match="more than 16"):
        resolve_chains(links, max_hops=16)
    assert resolve_chains(links, max_hops=64).filter("normalized <> 'n40'").isEmpty()


def test_chains_with_repeated_originals_give_one_end_each(spark):
    links = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "original string, normalized string")
    assert rows(resolve_chains(links)) == [("a", "b"), ("c", "b")]
    assert rows(resolve_chains(links.limit(0))) == []


def test_the_last_file_wins_whatever_its_size(spark, folder):
    for name, lines in (("a", ["x,1"]), ("b", [f"y{i},2" for i in range(50)] + ["x,2"]), ("c", ["x,3"])):
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as out:
            out.write("\n".join(["original,normalized", *lines]))
    for multi_line in (True, False):
        loaded = load_mapping(spark, folder, multi_line=multi_line).select("original", "normalized", "_ord")
        assert dict(rows(upsert(None, loaded, ["original"], "_ord")))["x"] == "3"


def test_null_orders_are_refused_and_ties_go_by_content(spark):
    schema = "original string, normalized string, o int"
    with pytest.raises(Exception, match="o is null"):
        upsert(None, spark.createDataFrame([("a", "b", None), ("a", "c", 1)], schema), ["original"], "o").collect()
    tied = spark.createDataFrame([("a", "c", 1), ("a", "d", 1), ("a", "b", 1)], schema).repartition(3)
    assert rows(upsert(None, tied, ["original"], "o")) == [("a", "d")]
