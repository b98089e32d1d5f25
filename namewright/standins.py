"""Entity tables with realistic dirt, derived row by row from the benchmark tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Load time of every registered query; a fixed value so that results can be compared.
AS_OF = "2024-06-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _uuid() -> Column:
    return F.concat(F.lit("u:"), F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 8))


def _clean_name() -> Column:
    return F.concat_ws(" ", "p_name", "p_brand")


def institution(part: DataFrame) -> DataFrame:
    """Part as a table of institutions: upper-cased, blank-padded and empty names among clean ones."""
    key = F.col("p_partkey")
    name = (
        F.when(key % 97 == 0, F.lit("  "))
        .when(key % 5 == 0, F.upper(_clean_name()))
        .when(key % 5 == 1, F.concat(_clean_name(), F.lit(" ")))
        .otherwise(_clean_name())
    )
    return part.select(
        _uuid().alias("uuid_institution"),
        name.alias("institution"),
        F.col("p_type").alias("english_name"),
        F.col("p_brand").alias("parent_institution"),
    )


def institution_mapping(part: DataFrame) -> DataFrame:
    return part.select(F.upper(_clean_name()).alias("original"), _clean_name().alias("normalized")).distinct()


def institution_country(part: DataFrame) -> DataFrame:
    """Six in seven institutions have a country."""
    key = F.col("p_partkey")
    country = F.concat(F.lit("c:"), (key % 3).cast("string"))
    return part.filter(key % 7 != 0).select(_uuid().alias("uuid_institution"), country.alias("uuid_country"))


def dense_groups(part: DataFrame) -> DataFrame:
    """Few names for many ids, so that unification has much to do."""
    key = F.col("p_partkey")
    return part.select(
        F.lower("p_name").alias("institution"),
        F.when(key % 7 != 0, F.concat(F.lit("c:"), (key % 3).cast("string"))).alias("uuid_country"),
        _uuid().alias("uuid_institution"),
        F.lit(None).cast("string").alias("uuid_deprecated"),
        (key % 2 == 0).alias("was_deduplicated"),
        "p_partkey",
    )


def mapping_lines(part: DataFrame) -> DataFrame:
    """Lines of a name-correction file, some without delimiter, target or second field."""
    key = F.col("p_partkey")
    name, brand, number = F.col("p_name"), F.col("p_brand"), key.cast("string")
    line = (
        F.when(key % 11 == 0, F.concat(F.lit('"'), name, F.lit(", "), number, F.lit('"'), brand))
        .when(key % 13 == 0, F.concat(name, F.lit(" "), number))
        .when(key % 17 == 0, F.concat(name, F.lit(" "), number, F.lit(",")))
        .when(key % 19 == 0, F.concat(F.lit('"'), name, F.lit(' ""'), number, F.lit('""",'), brand))
        .when(key % 5 == 0, F.concat(name, F.lit(" "), number, F.lit(" ,"), brand))
        .otherwise(F.concat(name, F.lit(" "), number, F.lit(',"'), name, F.lit(", "), brand, F.lit('"')))
    )
    return part.select(line.alias("value"))


def joined_pairs(part: DataFrame) -> DataFrame:
    """Corrections of which every third lost the separator between its two names."""
    key = F.col("p_partkey")
    name = F.concat_ws(" ", "p_name", key.cast("string"), F.lit("old"))
    lost = key % 3 == 0
    return part.select(
        F.when(lost, F.concat(name, "p_brand")).otherwise(name).alias("original"),
        F.when(~lost, F.col("p_brand")).alias("normalized"),
    )


def labelled_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders as a relation table that repeats its customer's segment, in several spellings."""
    key = F.col("o_orderkey")
    label = (
        F.when(key % 4 == 0, F.lower("c_mktsegment"))
        .when(key % 4 == 1, F.concat("c_mktsegment", F.lit(" ")))
        .otherwise(F.col("c_mktsegment"))
    )
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.select("o_orderkey", "o_custkey", label.alias("organisation"))


def segment_mapping(customer: DataFrame) -> DataFrame:
    segment = F.col("c_mktsegment")
    return customer.select(F.lower(segment).alias("original"), segment.alias("normalized")).distinct()


def order_names(orders: DataFrame) -> DataFrame:
    """Orders with the name of the buyer; a third share one."""
    buyer = F.concat(F.lit("buyer "), F.col("o_custkey").cast("string"))
    return orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "unknown buyer").otherwise(buyer).alias("name"))


def order_mapping(customer: DataFrame) -> DataFrame:
    """Corrections for three in four buyers and for the name that a third of the orders share."""
    buyer = F.concat(F.lit("buyer "), F.col("c_custkey").cast("string"))
    known = customer.filter(F.col("c_custkey") % 4 != 0).select(buyer.alias("original"), F.col("c_name").alias("normalized"))
    shared = customer.select(F.lit("unknown buyer").alias("original"), F.lit("Unknown").alias("normalized"))
    return known.unionByName(shared.distinct())


def step_log(events: DataFrame) -> DataFrame:
    """Events as a run log: one component per seventh of the users."""
    return events.select(
        F.col("ts").alias("time"),
        F.concat(F.lit("component-"), (F.col("user_id") % 7).cast("string")).alias("component"),
        F.col("props").alias("message"),
        F.col("event_id").cast("string").alias("job_id"),
        (F.col("event_type") != "error").alias("success"),
    )
