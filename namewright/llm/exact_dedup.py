"""Exact duplicates by two passes over a Bloom filter; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.common import one_row_each, quoted, table, text_or_empty, text_sha, written

#: Bits per row of the filter. A row sets two cells, so of the rows with no copy about 1 in 64 passes by accident.
CELLS_PER_ROW = 16
#: Upper bound of the broadcast filter. Beyond 2^28 cells (17 million rows at 16 each) it lets more rows pass that have
#: no copy, up to all of them; those are grouped by digest like the rest, so the result stays the same.
MAX_FILTER_BYTES = 32 << 20

BITMAP_BITS = 32_768


def _cells(n_rows: int, cells_per_row: int, max_filter_bytes: int) -> int:
    wanted = max(BITMAP_BITS, n_rows * cells_per_row)
    return min(1 << (wanted - 1).bit_length(), max(BITMAP_BITS, 1 << (max_filter_bytes * 8).bit_length() - 1))


def _row_cells(digest: Column, cells: int) -> list[Column]:
    mask = F.lit(cells - 1).cast("bigint")
    return [digest.bitwiseAND(mask), F.shiftrightunsigned(digest, 32).bitwiseAND(mask)]


def _bit(bitmap: Column, cell: Column) -> Column:
    """Whether a cell's bit is set in its bitmap; false without a bitmap."""
    position = F.bitmap_bit_position(cell)
    byte = F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))
    bits = F.lpad(F.conv(F.hex(byte), 16, 2), 8, "0")
    return F.coalesce(F.substring(bits, F.lit(8) - (position % 8).cast("int"), F.lit(1)) == "1", F.lit(False))


def repeated_cells(
    texts: DataFrame, cells_per_row: int = CELLS_PER_ROW, max_filter_bytes: int = MAX_FILTER_BYTES
) -> tuple[DataFrame, int]:
    """First pass over ``(id, text)``: bitmaps of the cells that two or more rows set, and the number of cells.

    Cells are counted with map-side sums, so neither texts nor hot keys are shuffled. The bitmaps (4 KB for 32,768
    cells, none for ranges without a repeated cell) hold at most ``max_filter_bytes`` in all.
    """
    cells = _cells(texts.count(), cells_per_row, max_filter_bytes)
    hashed = texts.select(F.xxhash64("text").alias("h"))
    each = hashed.select(F.explode(F.array_distinct(F.array(*_row_cells(F.col("h"), cells)))).alias("cell"))
    often = each.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    bitmaps = often.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )
    return written(bitmaps, "repeated-cells"), cells


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    cells_per_row: int = CELLS_PER_ROW,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical. The row with the largest id of a group stays. The first pass finds the
    filter cells that several rows set; in the second a row whose two cells are both such cells is possibly repeated and
    is grouped by its SHA-256. All others pass straight through. Only digests and ids are shuffled, never texts, and a
    group's rows are counted before the shuffle and told the result by a join that adaptive execution can split.

    A null text counts as empty. Rows that repeat an id with equal text are all in the group; all rows with the largest
    id count as kept. A null id is never the largest, but stays when all ids of its group are null. An empty table gives
    an empty result; columns other than the two named are not read.
    """
    texts = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    bitmaps, cells = repeated_cells(texts, cells_per_row, max_filter_bytes)
    marked = texts.select("id", F.unhex(F.sha2("text", 256)).alias("sha"), F.xxhash64("text").alias("h"))
    for i, cell in enumerate(_row_cells(F.col("h"), cells)):
        own = F.broadcast(bitmaps.select(F.col("bucket").alias(f"bucket{i}"), F.col("bits").alias(f"bits{i}")))
        marked = marked.withColumn(f"cell{i}", cell)
        marked = marked.join(own, F.bitmap_bucket_number(f"cell{i}") == F.col(f"bucket{i}"), "left")
    maybe = _bit(F.col("bits0"), F.col("cell0")) & _bit(F.col("bits1"), F.col("cell1"))
    marked = written(marked.select("id", "sha", maybe.alias("maybe")), "marked")

    alone = marked.where("not maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"), "sha")
    several = marked.where("maybe").select("id", "sha")
    groups = several.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = written(groups, "copies")
    joined = several.join(groups, "sha").select("id", "keep_id", "n", "sha")
    return alone.union(joined).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each group of equal texts, with all its columns: one with the largest id.

    Rows are told by text and id together, so null and repeated ids are settled like others; of rows that agree in both
    one stays.
    """
    result = exact_dedup(docs, id_col, text_col).where("group_size > 1")
    rows = result.groupBy(F.unhex("text_sha256").alias("sha"), quoted(id_col).alias("id"), "kept")
    rows = written(rows.agg(F.count(F.lit(1)).alias("n")).where("not kept OR n > 1"), "copied-rows")
    gone, tied = (rows.where(which).select("sha", "id") for which in ("not kept", "kept"))
    return one_row_each(docs, gone, tied, [text_sha(text_col), quoted(id_col)], text_col)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op6_exact_dedup": op6_exact_dedup}
ORACLE_SQL = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
