"""The registered queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright import standins as st
from namewright.functions import iso_utc, random_id, stable_id
from namewright.operators import duplicates, identity, keys, mapping, merge, metrics, reconcile
from namewright.plans.joins import Limits
from namewright.plans import run, sql_functions
from namewright.plans.shared import fresh_path
from namewright.sources import documents, mapping_csv, tables
from namewright.streaming import jobs

YEAR_MINUTES = 365 * 24 * 60
MONTH_MINUTES = 30 * 24 * 60

# Nothing is broadcast but the rows of hot keys.
HOT = Limits(broadcast_rows=0, broadcast_bytes=0, hot_rows=100)

PASSTHROUGH = ["uuid_institution", "english_name", "parent_institution"]
GROUP = ["institution", "uuid_country"]


# Mapping file ---------------------------------------------------------------------------------------------------------


def _mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "mapping-file")
    st.mapping_lines(st.table(spark, sf_dir, "part")).write.text(path)
    return mapping_csv.load_mapping(spark, path, multi_line=False, header=False)


def mapping_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = mapping_csv.split_rejects(_mapping_rows(spark, sf_dir))
    return accepted.drop("_ord")


def mapping_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = mapping_csv.split_rejects(_mapping_rows(spark, sf_dir))
    return rejected.select("original", "normalized", "reason")


def mapping_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_csv.validate_mapping(_mapping_rows(spark, sf_dir))


def mapping_split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_csv.split_concatenated(st.joined_pairs(st.table(spark, sf_dir, "part")))


def mapping_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and brands are known already; names and brands of parts are loaded in the order of their keys."""
    part = st.table(spark, sf_dir, "part")
    known = st.table(spark, sf_dir, "supplier").select("s_name").union(part.select("p_brand")).toDF("original")
    target = known.distinct().withColumn("normalized", F.lit("old"))
    pairs = F.array(
        F.struct(F.concat_ws(" ", "p_name", "p_type").alias("original"), F.col("p_brand").alias("normalized")),
        F.struct(F.col("p_brand").alias("original"), F.col("p_name").alias("normalized")),
    )
    updates = part.select(F.inline(pairs), F.col("p_partkey").alias("_ord"))
    return mapping.upsert(target, updates, ["original"], "_ord")


def _merged(spark: SparkSession, sf_dir: str, limits: Limits) -> DataFrame:
    """Customers are known with their segment; all of a third, spelled as before or not, and some new ones arrive."""
    customer = st.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    target = customer.select("c_custkey", "c_mktsegment", F.col("c_name").alias("name")).filter(key % 5 != 0)
    segment = F.when(key % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    updates = customer.filter(key % 3 == 0).select("c_custkey", segment.alias("c_mktsegment"), F.lit(2).alias("ord"))
    earlier = updates.select("c_custkey", F.lit("earlier").alias("c_mktsegment"), F.lit(1).alias("ord"))
    return merge.merge(target, updates.union(earlier), ["c_custkey"], "ord", limits)


def merge_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row after a merge with what was done to it; by a full outer join."""
    return _merged(spark, sf_dir, _TIGHT)


def merge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_report(_merged(spark, sf_dir, Limits()))


def remap_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institutions mapped by half of the mapping, then brought to the whole of it where names differ."""
    part = st.table(spark, sf_dir, "part")
    names = st.institution_mapping(part)
    half = names.filter(F.pmod(F.crc32("original"), F.lit(2)) == 0)
    out = fresh_path(spark, "remapped")
    mapping.apply_mapping(st.institution(part), half, "institution", st.as_of(), PASSTHROUGH).write.parquet(out)
    merge.remap_changed(spark, out, half, names, "institution", st.as_of())
    return spark.read.parquet(out)


def mapping_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part stands for the part of half its number, but for those that end a chain."""
    key = F.col("p_partkey")
    target = F.when((key == 0) | (key % 10 == 3), key).otherwise(F.floor(key / 2))
    return mapping.resolve_chains(
        st.table(spark, sf_dir, "part").select(
            F.concat(F.lit("n"), key).alias("original"), F.concat(F.lit("n"), target).alias("normalized")
        )
    )


def mapping_chains_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of up to 100 hops, part to next part; every seventh part is also mapped to itself, which the link outdoes."""
    key = F.col("p_partkey")
    name = F.lpad(key.cast("string"), 12, "0")
    after = F.when(key % 100 == 99, name).otherwise(F.lpad((key + 1).cast("string"), 12, "0"))
    part = st.table(spark, sf_dir, "part")
    links = part.select(name.alias("original"), after.alias("normalized"))
    return mapping.resolve_chains(links.union(part.filter(key % 7 == 0).select(name, name)))


def mapping_load_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files of unlike size with repeated originals; the last line in the order of the files stands."""
    path = fresh_path(spark, "mapping-folder")
    part = st.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    line = F.concat_ws(",", F.concat(F.lit("name "), (key % 50).cast("string")), F.concat(F.lit("to "), key.cast("string")))
    lines = part.select(key, line.alias("value"))
    for name, rows in (("a", key % 10 == 0), ("b", key % 10 < 9), ("c", key % 10 == 9)):
        own = lines.filter(rows & (F.lit(name == "a") | (key % 10 > 0))).repartition(1).sortWithinPartitions("p_partkey")
        own.select("value").write.text(f"{path}/{name}")
    rows = mapping_csv.load_mapping(spark, f"{path}/*", multi_line=False, header=False)
    accepted, _ = mapping_csv.split_rejects(rows)
    return mapping.upsert(None, accepted.select("original", "normalized", "_ord"), ["original"], "_ord")


# Canonicalisation -----------------------------------------------------------------------------------------------------


def canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = st.table(spark, sf_dir, "part")
    names = st.institution_mapping(part)
    return mapping.apply_mapping(st.institution(part), names, "institution", st.as_of(), PASSTHROUGH)


def canonicalise_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = st.table(spark, sf_dir, "part")
    names = st.institution_mapping(part)
    return mapping.apply_mapping(st.institution(part), names, "institution", st.as_of(), PASSTHROUGH, fold=True)


def edge_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = st.table(spark, sf_dir, "customer")
    edges = st.labelled_orders(st.table(spark, sf_dir, "orders"), customer)
    return mapping.apply_mapping(edges, st.segment_mapping(customer), "organisation", st.as_of())


def enrich_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = identity.ensure_columns(
        canonicalise(spark, sf_dir), {"uuid_country": "string", "uuid_deprecated": "string"}
    )
    countries = st.institution_country(st.table(spark, sf_dir, "part"))
    return identity.enrich(rows, countries, "uuid_institution", "uuid_country")


def _hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer, a third of them of customer 1; the key is an int here and a bigint among customers."""
    key = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast("int")
    return st.table(spark, sf_dir, "orders").select("o_orderkey", key.alias("c_custkey"))


def enrich_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hot_orders(spark, sf_dir).withColumn("c_name", F.lit("nobody"))
    known = st.table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 4 != 2)
    return identity.enrich(rows, known, "c_custkey", "c_name", HOT)


def upsert_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stay unless a customer of theirs is updated; customers arrive with two states each."""
    customer = st.table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 4 != 1)
    state = F.col("c_custkey") * 2 + F.lit(1)
    first = customer.select("c_custkey", F.lit(-1).cast("bigint").alias("o_orderkey"), F.lit(1).alias("ord"))
    last = customer.select("c_custkey", (-state).alias("o_orderkey"), F.lit(2).alias("ord"))
    return mapping.upsert(_hot_orders(spark, sf_dir), first.unionByName(last), ["c_custkey"], "ord", HOT)


def unify_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich_country(spark, sf_dir)
    return identity.unify_ids(rows, GROUP, "uuid_institution", "uuid_deprecated", "was_deduplicated")


def unify_ids_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = st.dense_groups(st.table(spark, sf_dir, "part"))
    return identity.unify_ids(rows, GROUP, "uuid_institution", "uuid_deprecated", "was_deduplicated")


def unify_ids_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = st.dense_groups(st.table(spark, sf_dir, "part"))
    return identity.unify_ids(
        rows, GROUP, "uuid_institution", "uuid_deprecated", "was_deduplicated", include_unmapped=True
    )


def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.assign_ids(st.table(spark, sf_dir, "part"), ["p_partkey"])


def audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.audit_trail(unify_ids(spark, sf_dir), "institution", "uuid_institution")


def canonical_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps over a folder of tables, from the mapping file to the unified table."""
    part = st.table(spark, sf_dir, "part")
    base, csv = fresh_path(spark, "tables"), fresh_path(spark, "mapping-file")
    tables.write_table(st.institution(part), base, "institution")
    tables.write_table(st.institution_country(part), base, "institution_country")
    st.institution_mapping(part).write.option("header", True).csv(csv)
    report = run.run_mode(spark, base, "sync-now", mapping_csv=csv, as_of=st.as_of())
    if not report.success:
        raise RuntimeError(str([s.error for s in report.steps if s.error]))
    return tables.load_table(spark, base, "deduplicated_institutions")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log says after two modes."""
    part = st.table(spark, sf_dir, "part")
    base = fresh_path(spark, "tables")
    tables.write_table(st.institution(part), base, "institution")
    tables.write_table(st.institution_mapping(part), base, "institution_mapping")
    run.run_mode(spark, base, "load-mapping")
    run.run_mode(spark, base, "apply-deduplication", as_of=st.as_of())
    return run.run_log(spark, base).select("component", "success", "rows")


def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table rewritten from itself."""
    base = fresh_path(spark, "tables")
    tables.write_table(st.table(spark, sf_dir, "orders"), base, "orders")
    first = tables.load_table(spark, base, "orders")
    tables.write_table(first.withColumn("o_orderpriority", F.lower("o_orderpriority")), base, "orders")
    return tables.load_table(spark, base, "orders")


# Duplicates and keys --------------------------------------------------------------------------------------------------


#: Bounds under which the tables of a test already take the ways of large ones.
_TIGHT = Limits(broadcast_rows=10, broadcast_bytes=1_000, hot_rows=1_000)


def dup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = st.table(spark, sf_dir, "documents")
    groups = duplicates.duplicate_groups(docs, "text", id_col="doc_id", limit=100)
    ids = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return groups.withColumn("ids", ids)


def dup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = st.table(spark, sf_dir, "part")
    return duplicates.duplicates_report(part, columns=["p_name", "p_brand", "p_type", "p_size"], limit=100)


def dup_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group of every column of orders; tight bounds, so groups are joined by shuffle and hot values apart."""
    found = duplicates.duplicates_report(
        st.table(spark, sf_dir, "orders"), keys=["o_orderkey"], id_col="o_orderkey", limits=_TIGHT
    )
    return found.groupBy("column", "value", "count").agg(
        F.sum(F.size("ids")).alias("n_ids"), F.sum(F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("sum_ids")
    )


def dup_records_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose text occurs again, without an id to order by and by shuffle."""
    docs = st.table(spark, sf_dir, "documents")
    return duplicates.duplicate_records(docs, columns=["text"], limits=_TIGHT)


def dup_report_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of orders but its key."""
    return duplicates.duplicates_report(st.table(spark, sf_dir, "orders"), keys=["o_orderkey"], limit=100)


def dup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_records(st.table(spark, sf_dir, "documents"), columns=["text"], id_col="doc_id", limit=100)


def unique_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.key_columns(st.table(spark, sf_dir, "customer"))


def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minimal keys of up to three columns."""
    found = [
        keys.composite_keys(st.table(spark, sf_dir, name)).select(F.lit(name).alias("name"), "key", F.size("columns").alias("n_columns"))
        for name in ("lineitem", "orders")
    ]
    return found[0].union(found[1])


def dup_report_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group of four columns of customer; those that are keys are found and left out."""
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return duplicates.duplicates_report(st.table(spark, sf_dir, "customer"), columns=columns, infer_keys=True)


# Comparing and inserting ----------------------------------------------------------------------------------------------


def compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = st.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    spelled = (
        F.when(key % 4 == 0, F.lit(None))
        .when(key % 3 == 0, F.upper("c_name"))
        .otherwise(F.concat(F.lit(" "), F.col("c_name")))
    )
    left = customer.select(spelled.alias("name"))
    right = customer.select(F.when(key % 5 != 0, F.lower("c_name")).alias("kb_name"))
    return reconcile.compare_tables_by_keys(left, right, [("name", "kb_name")])


def compare_tables_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = st.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    spelled = F.when(key % 3 == 0, F.lower("c_mktsegment")).otherwise(F.concat("c_mktsegment", F.lit(" ")))
    nation = F.when(key % 11 != 0, F.col("c_nationkey"))
    left = customer.select(spelled.alias("segment"), nation.alias("nation"))
    other = F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).otherwise(-1)
    right = customer.select("c_mktsegment", other.alias("c_nationkey"))
    return reconcile.compare_tables_by_keys(left, right, [("segment", "c_mktsegment"), ("nation", "c_nationkey")])


def sql_compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of customers and suppliers, compared by a function called from SQL."""
    customer = st.table(spark, sf_dir, "customer")
    number = F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit(" N"), F.col("c_custkey").cast("string")))
    customer.select(number.alias("number")).createOrReplaceTempView("compared_customers")
    supplier = st.table(spark, sf_dir, "supplier")
    kb = F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("n"), F.col("s_suppkey").cast("string"), F.lit(" ")))
    supplier.select(kb.alias("kb")).createOrReplaceTempView("compared_suppliers")
    sql_functions.register_comparison(
        spark, "compare_tables_by_keys", "compared_customers", "compared_suppliers", [("number", "kb")]
    )
    return spark.sql("SELECT * FROM compare_tables_by_keys()")


def sql_preview_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose number no supplier has, by a function called from SQL."""
    st.table(spark, sf_dir, "customer").select("c_custkey", "c_name").createOrReplaceTempView("website_customers")
    st.table(spark, sf_dir, "supplier").createOrReplaceTempView("known_suppliers")
    sql_functions.register_preview(
        spark,
        "preview_new_customers",
        "website_customers",
        "known_suppliers",
        [("c_custkey", "s_suppkey")],
        {"fullname": "c_name", "kb_uuid": "CAST(c_custkey AS STRING)"},
        "uuid_individual",
    )
    return spark.sql("SELECT uuid_individual, fullname, kb_uuid FROM preview_new_customers('i:')")


def sql_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and ids of parts by scalar functions called from SQL."""
    sql_functions.register_scalars(spark)
    st.institution(st.table(spark, sf_dir, "part")).createOrReplaceTempView("named_parts")
    return spark.sql(
        "SELECT uuid_institution, norm_key(institution) AS norm, not_blank(institution) AS named, "
        "stable_id('n:', institution, 8) AS id FROM named_parts"
    )


def preview_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose number no supplier has."""
    return reconcile.preview_new_rows(
        st.table(spark, sf_dir, "customer"),
        st.table(spark, sf_dir, "supplier"),
        [("c_custkey", "s_suppkey")],
        {
            "fullname": F.col("c_name").cast("string"),
            "country": F.col("c_nationkey").cast("string"),
            "kb_uuid": F.col("c_custkey").cast("string"),
        },
        "uuid_individual",
        stable_id("i:", F.col("c_custkey")),
        st.as_of(),
    )


def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are there under customer names; all customers arrive, twice and spelled differently."""
    customer = st.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    target = st.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("c_name"),
        F.lit("supplier").alias("c_mktsegment"),
    )
    spelled = customer.withColumn("c_name", F.concat(F.lit(" "), F.upper("c_name")))
    again = spelled.withColumn("c_mktsegment", F.lit("ZZZ"))
    return reconcile.insert_missing(target, spelled.unionByName(again), ["c_name"])


def random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form of a drawn id for every customer; the draw itself is random."""
    drawn = st.table(spark, sf_dir, "customer").select("c_custkey", random_id("i:").alias("id"))
    return drawn.select(
        "c_custkey",
        F.substring("id", 1, 2).alias("prefix"),
        F.length("id").alias("id_length"),
        F.col("id").rlike("^i:[0-9a-f]{8}$").alias("is_hex"),
    )


# Metrics --------------------------------------------------------------------------------------------------------------


def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dedup_stats(canonicalise(spark, sf_dir))


def dedup_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dedup_stats_by_country(enrich_country(spark, sf_dir))


def sync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified = unify_ids(spark, sf_dir)
    docs = documents.index_documents(unified, "uuid_institution")
    source = st.institution(st.table(spark, sf_dir, "part"))
    return metrics.sync_counts(source, unified, docs, as_of=st.as_of())


def _lags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = st.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderdate")
    lines = st.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_shipdate")
    return orders, lines


def sync_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _lags(spark, sf_dir)
    return metrics.sync_lag(orders, lines, "key", "o_orderdate", "l_shipdate", YEAR_MINUTES)


def lag_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _lags(spark, sf_dir)
    pairs = metrics.lag_pairs(orders, lines, "key", "o_orderdate", "l_shipdate", YEAR_MINUTES)
    return metrics.lag_samples(pairs, "key", 50)


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return metrics.throughput(st.table(spark, sf_dir, "events"), "ts", failed, MONTH_MINUTES, "hour")


def throughput_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.throughput_summary(throughput(spark, sf_dir), MONTH_MINUTES)


def recent_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return metrics.errors(st.step_log(st.table(spark, sf_dir, "events")), since, 100)


def component_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.component_status(st.step_log(st.table(spark, sf_dir, "events")), degraded_above=0.25)


def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times of orders, taken as UTC, as ISO-8601 text."""
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', o_orderdate)")
    return st.table(spark, sf_dir, "orders").select("o_orderkey", iso_utc(F.timestamp_seconds(seconds)).alias("ordered_at"))


def lag_pairs_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags of lines, a third of which belong to one order; order numbers are int here and bigint there."""
    orders, _ = _lags(spark, sf_dir)
    key = F.when(F.col("l_linenumber") % 3 == 0, 1).otherwise(F.col("l_orderkey"))
    lines = st.table(spark, sf_dir, "lineitem").select(key.cast("int").alias("key"), "l_shipdate")
    return metrics.lag_pairs(orders, lines, "key", "o_orderdate", "l_shipdate", YEAR_MINUTES, limits=HOT)


# Documents and tables -------------------------------------------------------------------------------------------------


def flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = st.table(spark, sf_dir, "events").select("event_id", "props")
    return documents.flatten_json(events, "props", "k bigint")


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the canonical names, the newest part of each; parsed again so that fields can be compared."""
    part = st.table(spark, sf_dir, "part")
    rows = part.select(F.concat_ws(" ", "p_name", "p_brand").alias("institution"), "p_partkey", "p_type", "p_size")
    docs = documents.index_documents(rows, "institution", newest="p_partkey")
    return documents.flatten_json(docs, "_source", "institution string, p_partkey bigint, p_type string, p_size int")


def reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index loaded twice: first all customers, then the suppliers, which share some of the numbers."""
    customer = st.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    supplier = st.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    base = fresh_path(spark, "tables")
    for rows in (customer, supplier.withColumnRenamed("s_name", "c_mktsegment")):
        documents.reindex(spark, base, "customers", documents.index_documents(rows, "c_custkey"))
    index = tables.load_table(spark, base, "customers")
    return documents.flatten_json(index, "_source", "c_custkey bigint, c_mktsegment string")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Properties of events as JSON lines, some of them broken, some nested, some empty; the folder of the two tables."""
    path, base = fresh_path(spark, "json-lines"), fresh_path(spark, "tables")
    key = F.col("event_id")
    nested = F.concat(F.lit('{"id":'), key, F.lit(',"props":'), F.col("props"), F.lit(',"tags":["a",'), key % 3, F.lit("]}"))
    line = F.when(key % 50 == 7, F.concat(F.lit('{"id":'), key, F.lit(',"props":'))).when(key % 97 == 0, " ").otherwise(nested)
    st.table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    documents.land_documents(spark, path, base, "raw")
    return base


def land_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the documents that could be parsed, one row per tag; a tag that is no number is null as one."""
    rows = tables.load_table(spark, _landed(spark, sf_dir), "raw")
    rows = documents.variant_fields(rows, "data", {"id": ("$.id", "bigint"), "k": ("$.props.k", "bigint"), "tags": ("$.tags", "variant")})
    return documents.variant_fields(rows, "tags", {"tag": ("$", "string"), "tag_number": ("$", "int")}, explode="$")


def land_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_table(spark, _landed(spark, sf_dir), "raw_rejects")


def reindex_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index in buckets loaded three times: all customers, suppliers over some of them, a few customers twice."""
    customer = st.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    supplier = st.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_mktsegment"))
    few = customer.filter("c_custkey % 100 = 1")
    base = fresh_path(spark, "tables")
    for rows in (customer, supplier, few.withColumn("c_mktsegment", F.lit("A")).union(few.withColumn("c_mktsegment", F.lit("B")))):
        source = F.to_json(F.struct("c_custkey", "c_mktsegment"))
        docs = rows.select(F.col("c_custkey").cast("string").alias("_id"), source.alias("_source"))
        documents.update_index(spark, base, "customers", docs)
    return documents.flatten_json(documents.load_index(spark, base, "customers"), "_source", "c_custkey bigint, c_mktsegment string")


def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.list_tables(spark, sf_dir)


# Streams --------------------------------------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = st.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def stream_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = st.institution_mapping(st.table(spark, sf_dir, "part"))
    arrivals = st.institution(_stream(spark, sf_dir, "part"))
    out = fresh_path(spark, "stream-canonicalise")
    jobs.canonicalise_stream(
        arrivals, names, "institution", f"{out}/rows", f"{out}/checkpoint", st.as_of()
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_canonicalise_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders have one name; the mapping counts as too large for a broadcast."""
    history = st.order_names(st.table(spark, sf_dir, "orders"))
    names = st.order_mapping(st.table(spark, sf_dir, "customer"))
    out = fresh_path(spark, "stream-canonicalise")
    jobs.canonicalise_stream(
        st.order_names(_stream(spark, sf_dir, "orders")),
        names,
        "name",
        f"{out}/rows",
        f"{out}/checkpoint",
        st.as_of(),
        history=history,
        limits=HOT,
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _stream(spark, sf_dir, "events").select("user_id", "event_type")
    out = fresh_path(spark, "stream-insert")
    jobs.insert_missing_stream(arrivals, f"{out}/rows", ["user_id"], f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_insert_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in six files in the order of time; each file holds the events of the one before again."""
    out = fresh_path(spark, "stream-insert")
    events = st.table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    slice_of = F.floor((F.unix_timestamp("ts") - F.lit(first).cast("timestamp").cast("bigint")) / ((last - first).total_seconds() / 6 + 1))
    twice = events.withColumn("file", F.explode(F.array(slice_of, slice_of + 1)))
    timed = twice.select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "file")
    for number in range(7):
        # One file a batch: Spark takes them in the order of their times.
        timed.filter(F.col("file") == number).drop("file").coalesce(1).write.mode("append").parquet(f"{out}/in")
    schema = timed.drop("file").schema
    arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    delay = f"{int((last - first).total_seconds() / 2)} seconds"
    jobs.insert_missing_stream(
        arrivals, f"{out}/rows", ["user_id", "event_type"], f"{out}/checkpoint", buckets=8, repeats=("ts", delay)
    ).awaitTermination()
    added = jobs.read_buckets(spark, f"{out}/rows", schema)
    return added.select("user_id", "event_type")


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes and their lines as what was indexed, a year after at most."""
    out = fresh_path(spark, "stream-lag")
    orders = _stream(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderdate")
    lines = _stream(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_shipdate")
    jobs.lag_stream(
        orders, lines, "key", "o_orderdate", "l_shipdate", f"{out}/rows", f"{out}/checkpoint", "365 days", "30 days"
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "stream-throughput")
    failed = F.col("event_type") == "error"
    jobs.throughput_stream(
        _stream(spark, sf_dir, "events"), "ts", failed, f"{out}/rows", f"{out}/checkpoint", "hour"
    ).awaitTermination()
    return jobs.latest_buckets(spark, f"{out}/rows").withColumn("t", F.col("t").cast("timestamp_ntz"))


def stream_throughput_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in five files that each span all the time, one a batch: most events come after newer ones."""
    out = fresh_path(spark, "stream-throughput")
    events = st.table(spark, sf_dir, "events")
    events.repartition(5, "event_id").write.parquet(f"{out}/in")
    arrivals = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    failed = F.col("event_type") == "error"
    jobs.throughput_stream(arrivals, "ts", failed, f"{out}/rows", f"{out}/checkpoint", "hour").awaitTermination()
    return jobs.latest_buckets(spark, f"{out}/rows").withColumn("t", F.col("t").cast("timestamp_ntz"))


# Text corpora: these folders may be absent ---------------------------------------------------------------------------


def _registry_there() -> bool:
    """Whether the registry is to be found; a folder left over without modules counts as none."""
    try:
        return find_spec("namewright.llm.registry") is not None
    except ModuleNotFoundError:
        return False


def _corpus():
    """The subpackage and the pipeline, or nothing where they have been taken out; other import errors are raised."""
    try:
        import corpus_pipeline
        from namewright.llm import registry
    except ImportError as error:
        if error.name == "corpus_pipeline" or not _registry_there():
            return None
        raise
    return registry, corpus_pipeline


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _corpus()
    return {} if found is None else {**found[0].QUERIES, "pipeline": found[1].run}


def _corpus_sql() -> dict[str, str]:
    found = _corpus()
    if found is None:
        return {}
    return found[0].ORACLE_SQL | ({"pipeline": found[1].ORACLE_SQL} if found[1].ORACLE_SQL else {})


def entry(spark: SparkSession) -> DataFrame:
    """The unified table: mapping, country, smallest id per group."""
    return unify_ids(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        mapping_load,
        mapping_rejects,
        mapping_validate,
        mapping_split_pairs,
        mapping_upsert,
        merge_tagged,
        merge_report,
        remap_changed,
        mapping_chains,
        mapping_chains_long,
        mapping_load_folder,
        canonicalise,
        canonicalise_folded,
        edge_canonicalise,
        enrich_country,
        enrich_hot,
        upsert_hot,
        unify_ids,
        unify_ids_dense,
        unify_ids_all,
        assign_ids,
        audit_trail,
        canonical_run,
        run_report,
        replace_table,
        dup_documents,
        dup_report,
        dup_report_all,
        dup_records_all,
        dup_report_keys,
        dup_records,
        unique_columns,
        composite_keys,
        dup_report_inferred,
        compare_tables,
        compare_tables_repeated,
        preview_new,
        sql_compare_tables,
        sql_preview_new,
        sql_keys,
        insert_missing,
        random_ids,
        dedup_stats,
        dedup_by_country,
        sync_counts,
        sync_lag,
        lag_samples,
        lag_pairs_hot,
        throughput,
        throughput_summary,
        recent_errors,
        component_status,
        iso_times,
        flatten_props,
        index_documents,
        reindex,
        reindex_buckets,
        land_events,
        land_rejects,
        list_tables,
        stream_canonicalise,
        stream_canonicalise_hot,
        stream_insert_missing,
        stream_insert_repeats,
        stream_lag,
        stream_throughput,
        stream_throughput_late,
    ]
    return {query.__name__: query for query in registered} | _corpus_queries()


# Oracle SQL -----------------------------------------------------------------------------------------------------------

_NAMES = """
institution AS (
    SELECT concat('u:', substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS uuid_institution,
           CASE WHEN p_partkey % 97 = 0 THEN '  '
                WHEN p_partkey % 5 = 0 THEN upper(p_name || ' ' || p_brand)
                WHEN p_partkey % 5 = 1 THEN p_name || ' ' || p_brand || ' '
                ELSE p_name || ' ' || p_brand END AS institution,
           p_type AS english_name, p_brand AS parent_institution
    FROM part),
institution_mapping AS (
    SELECT DISTINCT upper(p_name || ' ' || p_brand) AS original, p_name || ' ' || p_brand AS normalized FROM part),
institution_country AS (
    SELECT concat('u:', substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS uuid_institution,
           concat('c:', CAST(p_partkey % 3 AS VARCHAR)) AS uuid_country
    FROM part WHERE p_partkey % 7 <> 0),
canonical AS (
    SELECT coalesce(m.normalized, i.institution) AS institution, i.institution AS original_institution,
           m.normalized IS NOT NULL AS was_deduplicated,
           CASE WHEN m.normalized IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' END AS deduplication_timestamp,
           i.uuid_institution, i.english_name, i.parent_institution
    FROM institution i LEFT JOIN institution_mapping m ON i.institution = m.original
    WHERE trim(i.institution, ' ') <> ''),
enriched AS (
    SELECT c.*, ic.uuid_country, CAST(NULL AS VARCHAR) AS uuid_deprecated
    FROM canonical c LEFT JOIN institution_country ic ON c.uuid_institution = ic.uuid_institution),
numbered AS (
    SELECT *, row_number() OVER (ORDER BY uuid_institution, original_institution) AS id FROM enriched),
lowest AS (
    SELECT min(uuid_institution) AS lowest_uuid, institution, uuid_country FROM enriched GROUP BY ALL),
updates AS (
    SELECT n.id, n.uuid_institution AS old_uuid, l.lowest_uuid
    FROM numbered n JOIN lowest l ON n.institution = l.institution
     AND n.uuid_country IS NOT DISTINCT FROM l.uuid_country
    WHERE n.was_deduplicated AND n.uuid_institution IS DISTINCT FROM l.lowest_uuid),
unified AS (
    SELECT n.institution, n.original_institution, n.was_deduplicated, n.deduplication_timestamp,
           coalesce(u.lowest_uuid, n.uuid_institution) AS uuid_institution, n.english_name, n.parent_institution,
           n.uuid_country, coalesce(u.old_uuid, n.uuid_deprecated) AS uuid_deprecated, n.id
    FROM numbered n LEFT JOIN updates u ON n.id = u.id)
"""

_DENSE = """
WITH rows_ AS (
    SELECT lower(p_name) AS institution,
           CASE WHEN p_partkey % 7 <> 0 THEN concat('c:', CAST(p_partkey % 3 AS VARCHAR)) END AS uuid_country,
           concat('u:', substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS uuid_institution,
           p_partkey % 2 = 0 AS was_deduplicated, p_partkey
    FROM part),
lowest AS (
    SELECT min(uuid_institution) AS lowest_uuid, institution, uuid_country FROM rows_ GROUP BY ALL),
updates AS (
    SELECT r.p_partkey, r.uuid_institution AS old_uuid, l.lowest_uuid
    FROM rows_ r JOIN lowest l ON r.institution = l.institution
     AND r.uuid_country IS NOT DISTINCT FROM l.uuid_country
    WHERE {which} AND r.uuid_institution IS DISTINCT FROM l.lowest_uuid)
SELECT r.institution, r.uuid_country, coalesce(u.lowest_uuid, r.uuid_institution) AS uuid_institution,
       u.old_uuid AS uuid_deprecated, r.was_deduplicated, r.p_partkey
FROM rows_ r LEFT JOIN updates u ON r.p_partkey = u.p_partkey
"""

_FILE = """
WITH records AS (
    SELECT p_partkey AS k,
           CASE WHEN p_partkey % 11 = 0 THEN p_name || ', ' || CAST(p_partkey AS VARCHAR)
                WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 THEN p_name || ' ' || CAST(p_partkey AS VARCHAR)
                WHEN p_partkey % 19 = 0 THEN p_name || ' "' || CAST(p_partkey AS VARCHAR) || '"'
                WHEN p_partkey % 5 = 0 THEN p_name || ' ' || CAST(p_partkey AS VARCHAR) || ' '
                ELSE p_name || ' ' || CAST(p_partkey AS VARCHAR) END AS original,
           CASE WHEN p_partkey % 11 = 0 THEN p_brand
                WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 THEN NULL
                WHEN p_partkey % 19 = 0 OR p_partkey % 5 = 0 THEN p_brand
                ELSE p_name || ', ' || p_brand END AS normalized
    FROM part)
"""


_ORDER_COLUMNS = [
    ("o_custkey", "CAST(o_custkey AS VARCHAR)"),
    ("o_orderstatus", "lower(o_orderstatus)"),
    ("o_totalprice", "CAST(o_totalprice AS VARCHAR)"),
    ("o_orderdate", "CAST(o_orderdate AS VARCHAR)"),
    ("o_orderpriority", "lower(o_orderpriority)"),
]


_KEY_COLUMNS = {
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
}


def _minimal_keys(table: str, columns: tuple[str, ...]) -> str:
    """Every set of up to three columns counted; those that are keys and hold no smaller one."""
    sets = [one for size in (1, 2, 3) for one in combinations(columns, size)]
    counted = " UNION ALL ".join(
        f"SELECT {list(one)} AS c, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(one)} FROM {table})) AS n" for one in sets
    )
    return f"""
        SELECT '{table}' AS name, array_to_string(c, ',') AS key, CAST(len(c) AS INTEGER) AS n_columns FROM (
            WITH counted AS ({counted}), found AS (SELECT c FROM counted WHERE n = (SELECT count(*) FROM {table}))
            SELECT c FROM found WHERE NOT EXISTS (
                SELECT 1 FROM found AS part WHERE len(part.c) < len(found.c) AND list_has_all(found.c, part.c)))"""


def _dup_columns(table: str, columns: list[str]) -> str:
    """Reported groups of each column, a plain query per column."""
    parts = []
    for column, text in columns:
        parts.append(f"""
            SELECT '{column}' AS "column", v AS value, c AS count FROM (
                SELECT v, c, row_number() OVER (
                    ORDER BY c DESC, CASE WHEN length(v) <= 64 THEN v ELSE concat('sha256:', sha256(v)) END) AS r
                FROM (SELECT {text} AS v, count(*) AS c FROM {table} WHERE {column} IS NOT NULL
                      GROUP BY 1 HAVING count(*) > 1)) WHERE r <= 100""")
    return " UNION ALL ".join(parts)


_MERGED = """
            WITH target AS (SELECT c_custkey, c_mktsegment, c_name AS name FROM customer WHERE c_custkey % 5 <> 0),
            updates AS (
                SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment
                FROM customer WHERE c_custkey % 3 = 0),
            merged AS (
                SELECT coalesce(c_custkey, k) AS c_custkey, coalesce(segment, c_mktsegment) AS c_mktsegment, name,
                       CASE WHEN k IS NULL THEN 'kept' WHEN c_custkey IS NULL THEN 'inserted'
                            WHEN segment <> c_mktsegment THEN 'updated' ELSE 'unchanged' END AS "_action"
                FROM target FULL JOIN updates ON c_custkey = k)"""

_HOURLY = """
            SELECT date_trunc('hour', ts) AS t, count(*) AS count,
                   count(*) FILTER (WHERE event_type = 'error') AS errors
            FROM events GROUP BY 1"""

_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region "
    "supplier"
).split()


def oracle_sql() -> dict[str, str]:
    doc_groups = f"""
        WITH g AS ({_dup_columns("documents", [("text", "lower(text)")])})"""
    return {
        "mapping_load": f"{_FILE} SELECT original, normalized, k % 11 = 0 AS repaired FROM records "
        "WHERE normalized IS NOT NULL",
        "mapping_rejects": f"{_FILE} SELECT original, normalized, 'missing normalized' AS reason FROM records "
        "WHERE normalized IS NULL",
        "mapping_validate": f"{_FILE} SELECT count(*) AS found_rows, "
        "count(*) FILTER (WHERE normalized IS NULL) AS rejected_rows FROM records",
        "mapping_split_pairs": r"""
            WITH pairs AS (
                SELECT p_partkey % 3 = 0 AS lost, p_brand, p_name || ' ' || CAST(p_partkey AS VARCHAR) || ' old' AS name
                FROM part),
            lines AS (
                SELECT lost, CASE WHEN lost THEN name || p_brand ELSE name END AS original,
                       CASE WHEN NOT lost THEN p_brand END AS normalized
                FROM pairs)
            SELECT CASE WHEN lost THEN regexp_extract(original, '^(.*?\p{Ll})(\p{Lu}.*)$', 1) ELSE original END
                       AS original,
                   CASE WHEN lost THEN regexp_extract(original, '^(.*?\p{Ll})(\p{Lu}.*)$', 2) ELSE normalized END
                       AS normalized,
                   lost AS auto_fixed
            FROM lines""",
        "mapping_upsert": """
            WITH target AS (
                SELECT s_name AS original, 'old' AS normalized FROM supplier UNION SELECT p_brand, 'old' FROM part),
            pairs AS (
                SELECT p_name || ' ' || p_type AS original, p_brand AS normalized, p_partkey FROM part
                UNION ALL SELECT p_brand, p_name, p_partkey FROM part),
            updates AS (
                SELECT original, normalized FROM (
                    SELECT *, row_number() OVER (PARTITION BY original ORDER BY p_partkey DESC) AS r FROM pairs)
                WHERE r = 1)
            SELECT * FROM target WHERE original NOT IN (SELECT original FROM updates)
            UNION ALL SELECT * FROM updates""",
        "merge_tagged": f"{_MERGED} SELECT * FROM merged",
        "merge_report": f'{_MERGED} SELECT "_action" AS action, count(*) AS rows FROM merged GROUP BY 1',
        "remap_changed": f"WITH {_NAMES} SELECT * FROM canonical",
        "mapping_chains": """
            WITH RECURSIVE walk AS (
                SELECT p_partkey AS start, p_partkey AS at_ FROM part
                UNION ALL
                SELECT start, at_ // 2 FROM walk WHERE at_ > 0 AND at_ % 10 <> 3)
            SELECT concat('n', CAST(start AS VARCHAR)) AS original, concat('n', CAST(at_ AS VARCHAR)) AS normalized
            FROM walk WHERE at_ = 0 OR at_ % 10 = 3""",
        "mapping_chains_long": """
            WITH keys AS (SELECT p_partkey AS k FROM part), tops AS (
                SELECT k, min(CASE WHEN e % 100 = 99 THEN e ELSE e + 1 END) AS last FROM keys JOIN (
                    SELECT p_partkey AS e FROM part WHERE p_partkey % 100 = 99
                        OR p_partkey + 1 NOT IN (SELECT p_partkey FROM part)) ON e >= k GROUP BY k)
            SELECT lpad(CAST(k AS VARCHAR), 12, '0') AS original, lpad(CAST(last AS VARCHAR), 12, '0') AS normalized
            FROM tops""",
        "mapping_load_folder": """
            SELECT 'name ' || (p_partkey % 50) AS original, 'to ' || max_by(p_partkey, (CASE p_partkey % 10
                WHEN 0 THEN 0 WHEN 9 THEN 2 ELSE 1 END) * 1000000000000 + p_partkey) AS normalized
            FROM part GROUP BY 1""",
        "canonicalise": f"WITH {_NAMES} SELECT * FROM canonical",
        "stream_canonicalise": f"WITH {_NAMES} SELECT * FROM canonical",
        "canonicalise_folded": f"""
            WITH {_NAMES}, folded AS (
                SELECT trim(lower(original)) AS k, max(normalized) AS normalized FROM institution_mapping GROUP BY 1),
            matched AS (
                SELECT i.*, coalesce(m.normalized, f.normalized) AS target
                FROM institution i LEFT JOIN institution_mapping m ON i.institution = m.original
                LEFT JOIN folded f ON trim(lower(i.institution)) = f.k
                WHERE trim(i.institution, ' ') <> '')
            SELECT coalesce(target, institution) AS institution, institution AS original_institution,
                   target IS NOT NULL AS was_deduplicated,
                   CASE WHEN target IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' END AS deduplication_timestamp,
                   uuid_institution, english_name, parent_institution
            FROM matched""",
        "edge_canonicalise": """
            WITH edges AS (
                SELECT o_orderkey, o_custkey,
                       CASE WHEN o_orderkey % 4 = 0 THEN lower(c_mktsegment)
                            WHEN o_orderkey % 4 = 1 THEN c_mktsegment || ' ' ELSE c_mktsegment END AS organisation
                FROM orders JOIN customer ON o_custkey = c_custkey),
            names AS (SELECT DISTINCT lower(c_mktsegment) AS original, c_mktsegment AS normalized FROM customer)
            SELECT coalesce(normalized, organisation) AS organisation, organisation AS original_organisation,
                   normalized IS NOT NULL AS was_deduplicated,
                   CASE WHEN normalized IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' END
                       AS deduplication_timestamp,
                   o_orderkey, o_custkey
            FROM edges LEFT JOIN names ON organisation = original""",
        "enrich_country": f"WITH {_NAMES} SELECT * FROM enriched",
        "unify_ids": f"WITH {_NAMES} SELECT * EXCLUDE (id) FROM unified",
        "unify_ids_dense": _DENSE.format(which="r.was_deduplicated"),
        "unify_ids_all": _DENSE.format(which="true"),
        "assign_ids": "SELECT *, row_number() OVER (ORDER BY p_partkey) AS id FROM part",
        "audit_trail": f"""
            WITH {_NAMES}
            SELECT original_institution AS old_name, institution AS new_name,
                   coalesce(uuid_deprecated, uuid_institution) AS old_id, uuid_institution AS new_id,
                   deduplication_timestamp AS changed_at
            FROM unified WHERE was_deduplicated OR uuid_deprecated IS NOT NULL""",
        "canonical_run": f"WITH {_NAMES} SELECT * FROM unified",
        "run_report": f"""
            WITH {_NAMES}
            SELECT 'load-mapping' AS component, true AS success, count(*) AS rows FROM institution_mapping
            UNION ALL SELECT 'apply-deduplication', true, count(*) FROM canonical""",
        "replace_table": "SELECT * REPLACE (lower(o_orderpriority) AS o_orderpriority) FROM orders",
        "reindex": """
            SELECT CAST(coalesce(s_suppkey, c_custkey) AS VARCHAR) AS _id, coalesce(s_suppkey, c_custkey) AS c_custkey,
                   coalesce(s_name, c_mktsegment) AS c_mktsegment
            FROM customer FULL OUTER JOIN supplier ON c_custkey = s_suppkey""",
        "dup_documents": f"""{doc_groups}
            SELECT g."column", g.value, g.count, 0 AS part,
                   (SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FROM documents
                    WHERE lower(text) = g.value) AS ids
            FROM g""",
        "dup_records": f"""{doc_groups}
            SELECT g."column" AS dup_column, g.value AS dup_value, g.count AS dup_count, d.*
            FROM documents d JOIN g ON lower(d.text) = g.value""",
        "dup_report": _dup_columns(
            "part",
            [
                ("p_name", "lower(p_name)"),
                ("p_brand", "lower(p_brand)"),
                ("p_type", "lower(p_type)"),
                ("p_size", "CAST(p_size AS VARCHAR)"),
            ],
        ),
        "dup_report_keys": _dup_columns(
            "orders",
            _ORDER_COLUMNS,
        ),
        "dup_report_all": " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {text} AS value, count(*) AS count, count(*) AS n_ids, sum(o_orderkey) AS sum_ids
            FROM orders WHERE {c} IS NOT NULL GROUP BY 2 HAVING count(*) > 1"""
            for c, text in _ORDER_COLUMNS
        ),
        "dup_records_all": """
            SELECT 'text' AS dup_column, lower(text) AS dup_value, n AS dup_count, * EXCLUDE (n) FROM (
                SELECT *, count(*) OVER (PARTITION BY lower(text)) AS n FROM documents WHERE text IS NOT NULL)
            WHERE n > 1""",
        "unique_columns": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) = count(*) AS is_key FROM customer"
            for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        ),
        "composite_keys": " UNION ALL ".join(_minimal_keys(name, columns) for name, columns in _KEY_COLUMNS.items()),
        "dup_report_inferred": _dup_columns(
            "customer",
            [
                ("c_custkey", "CAST(c_custkey AS VARCHAR)"),
                ("c_name", "lower(c_name)"),
                ("c_nationkey", "CAST(c_nationkey AS VARCHAR)"),
                ("c_mktsegment", "lower(c_mktsegment)"),
            ],
        ),
        "compare_tables": """
            WITH a AS (
                SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN upper(c_name)
                            ELSE ' ' || c_name END AS name
                FROM customer),
            b AS (SELECT CASE WHEN c_custkey % 5 <> 0 THEN lower(c_name) END AS kb_name FROM customer)
            SELECT CASE WHEN name IS NOT NULL AND kb_name IS NOT NULL THEN 'match'
                        WHEN name IS NOT NULL THEN 'only_in_left'
                        WHEN kb_name IS NOT NULL THEN 'only_in_right' ELSE 'unknown' END AS match_type,
                   name AS uuid_left, kb_name AS uuid_right, count(*) AS pairs
            FROM a FULL OUTER JOIN b ON trim(lower(name)) = trim(lower(kb_name))
            GROUP BY ALL""",
        "compare_tables_repeated": """
            WITH a AS (
                SELECT CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment || ' ' END AS segment,
                       CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS nation
                FROM customer),
            b AS (SELECT c_mktsegment, CASE WHEN c_nationkey < 20 THEN c_nationkey ELSE -1 END AS c_nationkey
                  FROM customer)
            SELECT CASE WHEN segment IS NOT NULL AND c_mktsegment IS NOT NULL THEN 'match'
                        WHEN segment IS NOT NULL THEN 'only_in_left'
                        WHEN c_mktsegment IS NOT NULL THEN 'only_in_right' ELSE 'unknown' END AS match_type,
                   segment AS uuid_left, c_mktsegment AS uuid_right, count(*) AS pairs
            FROM a FULL OUTER JOIN b ON trim(lower(segment)) = trim(lower(c_mktsegment))
                                    AND CAST(nation AS VARCHAR) = CAST(c_nationkey AS VARCHAR)
            GROUP BY ALL""",
        "sql_compare_tables": """
            WITH a AS (SELECT CASE WHEN c_custkey % 4 <> 0 THEN ' N' || c_custkey END AS number FROM customer),
            b AS (SELECT CASE WHEN s_suppkey % 5 <> 0 THEN 'n' || s_suppkey || ' ' END AS kb FROM supplier)
            SELECT CASE WHEN number IS NOT NULL AND kb IS NOT NULL THEN 'match' WHEN number IS NOT NULL THEN 'only_in_left'
                        WHEN kb IS NOT NULL THEN 'only_in_right' ELSE 'unknown' END AS match_type,
                   number AS uuid_left, kb AS uuid_right, count(*) AS pairs
            FROM a FULL OUTER JOIN b ON trim(lower(number)) = trim(lower(kb))
            GROUP BY ALL""",
        "sql_preview_new": """
            SELECT 'i:' || substr(md5(CAST(c_custkey AS VARCHAR) || chr(31) || c_name), 1, 16) AS uuid_individual,
                   c_name AS fullname, CAST(c_custkey AS VARCHAR) AS kb_uuid
            FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
        "sql_keys": f"""
            WITH {_NAMES}
            SELECT uuid_institution, trim(lower(institution)) AS norm, length(trim(institution)) > 0 AS named,
                   'n:' || substr(md5(institution), 1, 8) AS id
            FROM institution""",
        "enrich_hot": """
            SELECT o_orderkey, o.c_custkey, coalesce(c_name, 'nobody') AS c_name
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS c_custkey FROM orders) o
            LEFT JOIN customer c ON c.c_custkey = o.c_custkey AND c.c_custkey % 4 <> 2""",
        "upsert_hot": """
            WITH target AS (
                SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS c_custkey FROM orders),
            updated AS (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 1)
            SELECT o_orderkey, c_custkey FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM updated)
            UNION ALL SELECT -(c_custkey * 2 + 1), c_custkey FROM updated""",
        "lag_pairs_hot": """
            WITH lines AS (
                SELECT CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_orderkey END AS key, l_shipdate FROM lineitem
                WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 525600 MINUTE)
            SELECT key, o_orderdate AS changed_at, l_shipdate AS indexed_at,
                   date_diff('second', o_orderdate, l_shipdate) AS lag_seconds
            FROM lines JOIN orders ON o_orderkey = key""",
        "preview_new": """
            SELECT concat('i:', substr(md5(CAST(c_custkey AS VARCHAR)), 1, 16)) AS uuid_individual,
                   c_name AS fullname, CAST(c_nationkey AS VARCHAR) AS country, CAST(c_custkey AS VARCHAR) AS kb_uuid,
                   TIMESTAMP '2024-06-01 00:00:00' AS last_update
            FROM customer WHERE NOT EXISTS (
                SELECT 1 FROM supplier WHERE CAST(s_suppkey AS VARCHAR) = CAST(c_custkey AS VARCHAR))""",
        "insert_missing": """
            WITH target AS (
                SELECT s_suppkey AS c_custkey, replace(s_name, 'Supplier', 'Customer') AS c_name,
                       'supplier' AS c_mktsegment
                FROM supplier)
            SELECT * FROM target
            UNION ALL
            SELECT c_custkey, ' ' || upper(c_name), c_mktsegment FROM customer
            WHERE lower(c_name) NOT IN (SELECT lower(c_name) FROM target)""",
        "dedup_stats": f"""
            WITH {_NAMES}
            SELECT count(*) AS total_rows, count(*) FILTER (WHERE was_deduplicated) AS deduplicated_rows,
                   round(count(*) FILTER (WHERE was_deduplicated) / count(*), 4) AS dedup_rate,
                   max(deduplication_timestamp) AS last_dedup_run
            FROM canonical""",
        "dedup_by_country": f"""
            WITH {_NAMES}
            SELECT uuid_country AS country, count(*) AS total_rows,
                   count(*) FILTER (WHERE was_deduplicated) AS deduplicated_rows
            FROM enriched GROUP BY 1""",
        "sync_counts": f"""
            WITH {_NAMES},
            counts AS (
                SELECT (SELECT count(*) FROM institution) AS source_count,
                       (SELECT count(*) FROM unified) AS dedup_count,
                       (SELECT count(DISTINCT uuid_institution) FROM unified) AS index_count)
            SELECT *, source_count - dedup_count AS delta_source_to_dedup,
                   dedup_count - index_count AS delta_dedup_to_index,
                   round((source_count - dedup_count) * 100.0::DOUBLE / source_count, 4) AS pct_source_to_dedup,
                   round((dedup_count - index_count) * 100.0::DOUBLE / source_count, 4) AS pct_dedup_to_index,
                   TIMESTAMP '2024-06-01 00:00:00' AS snapshot_time
            FROM counts""",
        "sync_lag": """
            WITH lags AS (
                SELECT date_diff('second', o_orderdate, l_shipdate) AS lag_
                FROM orders JOIN lineitem ON o_orderkey = l_orderkey
                WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 525600 MINUTE)
            SELECT round(avg(lag_), 4) AS avg_lag_seconds, round(quantile_cont(lag_, 0.95), 4) AS p95_lag_seconds,
                   CAST(max(lag_) AS DOUBLE) AS max_lag_seconds, count(*) AS samples, 525600 AS window_minutes
            FROM lags""",
        "lag_samples": """
            SELECT o_orderkey AS key, o_orderdate AS changed_at, l_shipdate AS indexed_at,
                   date_diff('second', o_orderdate, l_shipdate) AS lag_seconds
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 525600 MINUTE
            ORDER BY l_shipdate DESC, o_orderkey, lag_seconds LIMIT 50""",
        "throughput": """
            SELECT date_trunc('hour', ts) AS t, count(*) AS count,
                   count(*) FILTER (WHERE event_type = 'error') AS errors
            FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 43200 MINUTE GROUP BY 1""",
        "throughput_summary": """
            SELECT 43200 AS window_minutes, count(*) AS total_indexed, round(count(*) / 43200, 4) AS avg_per_minute,
                   round(count(*) FILTER (WHERE event_type = 'error') / count(*), 4) AS error_rate
            FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 43200 MINUTE""",
        "recent_errors": """
            WITH found AS (
                SELECT ts AS time, concat('component-', CAST(user_id % 7 AS VARCHAR)) AS component,
                       props AS message, CAST(event_id AS VARCHAR) AS job_id
                FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10 00:00:00')
            SELECT *, (SELECT count(*) FROM found) AS total_errors FROM found
            ORDER BY time DESC, component, job_id LIMIT 100""",
        "component_status": """
            SELECT concat('component-', CAST(user_id % 7 AS VARCHAR)) AS component,
                   max(ts) FILTER (WHERE event_type <> 'error') AS last_success,
                   round(count(*) FILTER (WHERE event_type = 'error') / count(*), 4) AS error_rate,
                   CASE WHEN count(*) FILTER (WHERE event_type = 'error') / count(*) > 0.25 THEN 'DEGRADED'
                        ELSE 'OK' END AS status
            FROM events GROUP BY 1""",
        "iso_times": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ordered_at FROM orders",
        "random_ids": "SELECT c_custkey, 'i:' AS prefix, 10 AS id_length, true AS is_hex FROM customer",
        "flatten_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "index_documents": """
            SELECT p_name || ' ' || p_brand AS _id, p_name || ' ' || p_brand AS institution, p_partkey, p_type, p_size
            FROM part QUALIFY row_number() OVER (PARTITION BY p_name || ' ' || p_brand ORDER BY p_partkey DESC) = 1""",
        "reindex_buckets": """
            SELECT CAST(coalesce(s_suppkey, c_custkey) AS VARCHAR) AS _id, coalesce(s_suppkey, c_custkey) AS c_custkey,
                   CASE WHEN c_custkey % 100 = 1 THEN 'B' ELSE coalesce(s_name, c_mktsegment) END AS c_mktsegment
            FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""",
        "land_events": """
            WITH good AS (
                SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
                WHERE event_id % 50 <> 7 AND event_id % 97 <> 0)
            SELECT id, k, 'a' AS tag, CAST(NULL AS INTEGER) AS tag_number FROM good
            UNION ALL SELECT id, k, CAST(id % 3 AS VARCHAR), CAST(id % 3 AS INTEGER) FROM good""",
        "land_rejects": """
            SELECT CASE WHEN event_id % 50 = 7 THEN 'malformed' ELSE 'blank' END AS reason,
                   CASE WHEN event_id % 50 = 7 THEN '{"id":' || event_id || ',"props":' ELSE ' ' END AS raw
            FROM events WHERE event_id % 50 = 7 OR event_id % 97 = 0""",
        "list_tables": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in _TABLES),
        "stream_canonicalise_hot": """
            WITH named AS (
                SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown buyer' ELSE 'buyer ' || o_custkey END AS name
                FROM orders),
            names AS (
                SELECT 'buyer ' || c_custkey AS original, c_name AS normalized FROM customer WHERE c_custkey % 4 <> 0
                UNION SELECT 'unknown buyer', 'Unknown')
            SELECT o_orderkey, coalesce(normalized, name) AS name, name AS original_name,
                   normalized IS NOT NULL AS was_deduplicated,
                   CASE WHEN normalized IS NOT NULL THEN TIMESTAMP '2024-06-01' END AS deduplication_timestamp
            FROM named LEFT JOIN names ON name = original""",
        "stream_insert_missing": "SELECT user_id, min(event_type) AS event_type FROM events GROUP BY 1",
        "stream_insert_repeats": "SELECT DISTINCT user_id, event_type FROM events",
        "stream_lag": """
            SELECT o_orderkey AS key, o_orderdate AS changed_at, l_shipdate AS indexed_at,
                   date_diff('second', o_orderdate, l_shipdate) AS lag_seconds
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            WHERE l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 365 DAY""",
        "stream_throughput": _HOURLY,
        "stream_throughput_late": _HOURLY,
    } | _corpus_sql()
