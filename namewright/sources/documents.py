"""JSON in and JSON out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType, VariantType

from namewright.operators.mapping import upsert
from namewright.plans.joins import DEFAULT_LIMITS, Limits, lookup_join
from namewright.plans.shared import folder_names, settle
from namewright.sources.tables import MissingTable, load_table, require, table_exists, write_table


def land_json(spark: SparkSession, path: str) -> DataFrame:
    """One raw JSON document per line, untouched, in a single ``data`` column."""
    return spark.read.text(path).withColumnRenamed("value", "data")


def flatten_json(df: DataFrame, col: str, schema: StructType | str, explode: str | None = None) -> DataFrame:
    """Turn a JSON text column into columns; ``explode`` names an array field to unfold, rows with none are kept."""
    require(df, [col])
    parsed = df.withColumn("__json", F.from_json(col, schema)).drop(col)
    flat = parsed.select(*[c for c in parsed.columns if c != "__json"], "__json.*")
    if explode is None:
        return flat
    flat = flat.withColumn(explode, F.explode_outer(explode))
    inner = flat.schema[explode].dataType
    if isinstance(inner, StructType):
        return flat.select(*[c for c in flat.columns if c != explode], f"{explode}.*")
    if isinstance(inner, ArrayType):
        raise ValueError(f"{explode} nests arrays in arrays")
    return flat


def index_documents(df: DataFrame, id_col: str, newest: str | None = None) -> DataFrame:
    """One JSON document per entity: ``_id`` from the key, ``_source`` from the whole row.

    The id does not change between runs, so loading again overwrites. Rows that share a key are one entity: the one
    with the highest ``newest`` value stands, then the greatest document text. The limit of one row per key is applied
    before the shuffle too, so a hot key sends one row per task. A row without key gets an id from its content.
    """
    require(df, [id_col] + ([newest] if newest else []))
    source = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    docs = df.withColumn("_source", source).select(
        F.coalesce(F.col(id_col).cast("string"), F.md5("_source")).alias("_id"),
        "_source",
        (F.col(newest) if newest else F.lit(0)).alias("__newest"),
    )
    best = W.partitionBy("_id").orderBy(F.col("__newest").desc(), F.col("_source").desc())
    return docs.withColumn("__rank", F.row_number().over(best)).filter("__rank = 1").select("_id", "_source")


def reindex(spark: SparkSession, base: str, name: str, docs: DataFrame) -> dict[str, int]:
    """Load documents into a stored index: those with a known ``_id`` replace the old ones, all others stay."""
    stored = load_table(spark, base, name) if table_exists(spark, base, name) else None
    return write_table(upsert(stored, docs.withColumn("__ord", F.lit(0)), ["_id"], "__ord"), base, name)


def write_documents(docs: DataFrame, path: str) -> None:
    """Write documents as JSON lines, a file per task."""
    docs.write.mode("overwrite").json(path)


# Raw documents as VARIANT ----------------------------------------------------------------------------------------------


def parse_documents(lines: DataFrame, col: str = "data") -> DataFrame:
    """JSON text to a VARIANT column of the same name, and ``reason``: null, ``blank`` or ``malformed``.

    Every row is parsed once and none is lost; split_malformed() parts the good from the bad.
    """
    require(lines, [col])
    text = F.col(f"`{col}`")
    parsed = lines.withColumn("__variant", F.try_parse_json(text))
    why = F.when(F.col("__variant").isNotNull(), F.lit(None)).when(F.length(F.trim(F.coalesce(text, F.lit("")))) == 0, "blank")
    others = [F.col(f"`{c}`") for c in lines.columns if c != col]
    return parsed.select(*others, F.col("__variant").alias(col), why.otherwise("malformed").alias("reason"), text.alias("raw"))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows without ``reason`` and ``raw``; the bad ones with their text and without the empty VARIANT."""
    good = parsed.filter(F.col("reason").isNull()).drop("reason", "raw")
    variants = [f.name for f in parsed.schema.fields if isinstance(f.dataType, VariantType)]
    return good, parsed.filter(F.col("reason").isNotNull()).drop(*variants)


def land_documents(spark: SparkSession, path: str, base: str, name: str) -> dict[str, int]:
    """Load a folder of JSON lines into the table ``name``, one VARIANT ``data`` a row, and ``<name>_rejects``.

    The lines are parsed once, while they are settled; both tables are written from that. Returns their row counts.
    """
    parsed = settle(parse_documents(land_json(spark, path)), "landed").df
    good, bad = split_malformed(parsed)
    return {"rows": write_table(good, base, name)["rows"], "rejects": write_table(bad, base, f"{name}_rejects")["rows"]}


def variant_fields(df: DataFrame, col: str, fields: dict[str, tuple[str, str]], explode: str | None = None) -> DataFrame:
    """Columns out of a VARIANT: ``fields`` names each with its path (such as ``$.a.b``) and type.

    A path that is missing, or a value that does not fit the type, gives null. ``explode`` is the path of an array
    whose items the paths then start from, one row each; a document without items there keeps one row.
    """
    require(df, [col])
    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    source = F.col(f"`{col}`")
    if explode is not None:
        array = F.try_variant_get(source, explode, "variant")
        items = F.try_variant_get(source, explode, "array<variant>")
        df = df.select(*others, F.explode_outer(F.when(array.isNotNull(), items)).alias(col))
    return df.select(*others, *[F.try_variant_get(F.col(f"`{col}`"), path, kind).alias(n) for n, (path, kind) in fields.items()])


# Index in buckets -------------------------------------------------------------------------------------------------------


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int").alias("bucket")


def _bucket_folder(spark: SparkSession, base: str, name: str) -> tuple[str, int] | None:
    for folder in folder_names(spark, f"{base}/{name}"):
        if folder.startswith("buckets-"):
            return f"{base}/{name}/{folder}", int(folder.removeprefix("buckets-"))
    return None


def load_index(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The documents of an index in buckets: (_id, _source)."""
    found = _bucket_folder(spark, base, name)
    if found is None:
        raise MissingTable(f"index {name} does not exist under {base}")
    return spark.read.schema("_id string, _source string, bucket int").parquet(found[0]).drop("bucket")


def one_per_id(docs: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """One document per ``_id``, of several the greatest text. Repeated ids are found on the ids alone, so the documents
    of all others are not shuffled; copies are thinned to one per id and task before those that repeat are."""
    repeated = docs.groupBy("_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("_id")
    again = settle(repeated, "repeated-ids")
    if again.measures["rows"] == 0:
        return docs
    single = lookup_join(docs, again, ["_id"], "left_anti", limits=limits)
    several = lookup_join(docs, again, ["_id"], "left_semi", limits=limits)
    return single.unionByName(several.groupBy("_id").agg(F.max("_source").alias("_source")))


def update_index(
    spark: SparkSession, base: str, name: str, docs: DataFrame, buckets: int = 64, limits: Limits = DEFAULT_LIMITS
) -> dict[str, int]:
    """Load documents into an index in buckets: those with a known ``_id`` replace the old ones, all others stay.

    A bucket holds the ids of one hash value, in a folder of its own. Only buckets that get a document are read and
    written again, by dynamic partition overwrite; the files of all others stay untouched. ``buckets`` counts when the index
    is made: choose it so that one bucket is a few hundred MB. The new buckets are settled before any is
    overwritten, so a failed run can be repeated. One writer at a time. Returns the numbers of documents and of
    buckets written.
    """
    require(docs, ["_id", "_source"], "documents")
    found = _bucket_folder(spark, base, name)
    path, buckets = found or (f"{base}/{name}/buckets-{buckets}", buckets)
    fresh = settle(one_per_id(docs.select("_id", "_source"), limits).select("*", _bucket(buckets)), "documents")
    touched = [row["bucket"] for row in fresh.df.select("bucket").distinct().collect()]
    merged = fresh.df
    if found is not None and touched:
        old = spark.read.schema(fresh.df.schema).parquet(path).filter(F.col("bucket").isin(touched))
        merged = lookup_join(old, settle(fresh.df.select("_id"), "ids"), ["_id"], "left_anti", limits=limits).unionByName(merged)
    merged = settle(merged, "buckets")
    if touched:
        # AQE splits a large bucket over several tasks and files and puts small ones together.
        rows = merged.df.hint("rebalance", "bucket")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return {"rows": merged.measures["rows"], "buckets": len(touched)}
