"""The file of name corrections: read, repair, check, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAPPING_FIELDS = "original string, normalized string, _corrupt string"

# A quoted first field followed by text without the delimiter between them.
_MISSING_DELIMITER = r'^"((?:[^"]|"")*)"\s*([^,].*)$'

# An unseparated pair: the first place where a lower case letter meets an upper case one.
_JOINED_PAIR = r"^(.*?\p{Ll})(\p{Lu}.*)$"


def read_mapping(spark: SparkSession, path: str, multi_line: bool = True, header: bool = True) -> DataFrame:
    """Read ``original,normalized`` records verbatim; outer blanks count. A malformed record lands in ``_corrupt``.

    ``_ord`` grows in the order of the file names and, within a file, of its lines: (file, block, position). Spark deals
    files to tasks by size, so a row number alone would not follow that order. With ``multi_line`` (line breaks inside quotes) a file is one task's work, which suits
    curated mappings; switch it off for large files without such breaks, then they are split like any other input.
    """
    raw = (
        spark.read.schema(MAPPING_FIELDS)
        .option("header", header)
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(path)
    )
    place = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return raw.withColumn("_ord", F.struct(*place))


def repair_mapping(df: DataFrame) -> DataFrame:
    """Split corrupt records whose delimiter after the closing quote is missing; leave every good record alone."""
    broken = F.col("normalized").isNull() & F.col("_corrupt").rlike(_MISSING_DELIMITER)
    first = F.regexp_replace(F.regexp_extract("_corrupt", _MISSING_DELIMITER, 1), '""', '"')
    second = F.regexp_extract("_corrupt", _MISSING_DELIMITER, 2)
    return df.select(
        F.when(broken, first).otherwise(F.col("original")).alias("original"),
        F.when(broken, second).otherwise(F.col("normalized")).alias("normalized"),
        F.coalesce(broken, F.lit(False)).alias("repaired"),
        "_ord",
    )


def split_concatenated(df: DataFrame) -> DataFrame:
    """Split an unseparated pair at its first lower-to-upper change where ``normalized`` is blank. Off by default."""
    joined = _missing("normalized") & F.col("original").rlike(_JOINED_PAIR)
    return df.withColumns(
        {
            "auto_fixed": F.coalesce(joined, F.lit(False)),
            "original": F.when(joined, F.regexp_extract("original", _JOINED_PAIR, 1)).otherwise(F.col("original")),
            "normalized": F.when(joined, F.regexp_extract("original", _JOINED_PAIR, 2)).otherwise(F.col("normalized")),
        }
    )


def _missing(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def _reason() -> Column:
    return F.when(_missing("original"), F.lit("missing original")).when(
        _missing("normalized"), F.lit("missing normalized")
    )


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected ones with a reason. A blank target would wipe out a name, so it is rejected."""
    judged = df.withColumn("reason", _reason())
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())


def validate_mapping(df: DataFrame) -> DataFrame:
    """Dry run: how many rows the file holds and how many would be rejected. Writes nothing."""
    return df.select(_reason().alias("reason")).agg(
        F.count(F.lit(1)).alias("found_rows"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected_rows"),
    )


def load_mapping(
    spark: SparkSession, path: str, split_pairs: bool = False, multi_line: bool = True, header: bool = True
) -> DataFrame:
    """Read and repair, with the pair splitting when asked."""
    rows = repair_mapping(read_mapping(spark, path, multi_line, header))
    return split_concatenated(rows) if split_pairs else rows
