"""Repeated passages across a corpus, found by hashing normalised lines, paragraphs or parts of lines."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewright.llm.common import parts, quoted, table, text_or_empty, unused, written
from namewright.plans.joins import Limits, hot_hashes, lookup_join

#: What a unit is: a line, or lines up to an empty one; a passage is a part of a line, cut as text_units says.
UNITS = {"line": re.compile(r"[^\n]+"), "paragraph": re.compile(r"[^\n]+(?:\n[^\n]+)*"), "passage": re.compile(r"[^\n]+")}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Repeated units are removed where they and their repeated neighbours have this many words together.
MIN_WORDS = 20
#: Bytes of text that are hashed together.
TEXT_BYTES = 1_000_000
#: A digest with more than one in so many of all units is hot; the sketch that looks for them finds all such.
HOT_SHARE = 500
HOT_LEAST = 1_000


class Marks(dict):
    """Whether a word is marked: it ends a sentence, or its MD5 begins with the digit 0 or 8 (one word in eight)."""

    def __missing__(self, word: str) -> bool:
        if len(self) > 200_000:
            self.clear()
        self[word] = marked = word[-1] in ".!?" or hashlib.md5(word.encode()).hexdigest()[0] in "08"
        return marked


def text_units(text: str, unit: str, marks: Marks | None = None) -> Iterator[tuple[int, int, int, bytes]]:
    """``start, end, words, digest`` of each unit that has a word; A-Z lower-cased, white space as one blank.

    A passage ends with a marked word that does not stand right after another, or with its line, so equal words
    are cut alike wherever they stand, but for the first and last few of a repeated piece of text. The white space
    between two passages of a line belongs to the first.
    """
    lowered = text.translate(LOWER)
    digest = lambda words: hashlib.blake2b(" ".join(words).encode(), digest_size=12).digest()
    for match in UNITS[unit].finditer(lowered):
        words = WORD.findall(match[0])
        if not words:
            continue
        if unit != "passage":
            yield match.start(), match.end(), len(words), digest(words)
            continue
        marked = list(map((Marks() if marks is None else marks).__getitem__, words))
        ends = [i + 1 for i, (before, here) in enumerate(zip([False, *marked], marked, strict=False)) if here and not before]
        if not ends or ends[-1] < len(words):
            ends.append(len(words))
        begin, at, last = 0, match.start(), None
        for end in ends:
            own = words[begin:end]
            start = lowered.index(own[0], at)
            if last is not None:
                yield last[0], start, *last[1:]
            at = start
            for word in own:
                at = lowered.index(word, at) + len(word)
            last = (start, end - begin, digest(own))
            begin = end
        yield last[0], at, *last[1:]


def units(docs: DataFrame, id_col: str, text_col: str, unit: str, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs`` that has units: ``row, id, start, end, words, high, low``, the last five as arrays.

    ``row`` is the row's own number, that in ``row_col`` or else its partition and place in it; ``high`` and ``low`` are
    the digest.
    """
    row = F.monotonically_increasing_id() if row_col is None else quoted(row_col)
    source = docs.select(row.alias("row"), quoted(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    kinds = {"start": pa.int32(), "end": pa.int32(), "words": pa.int32(), "high": pa.int64(), "low": pa.int32()}
    arrays = {n: T.ArrayType(T.LongType() if n == "high" else T.IntegerType(), False) for n in kinds}
    fields = {"row": T.LongType(), "id": T.LongType(), **arrays}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks()
        for batch in batches:
            for piece in parts(batch, "text", TEXT_BYTES):
                found = [list(text_units(text, unit, marks)) for text in piece.column("text").to_pylist()]
                has = np.array([len(own) for own in found])
                start, end, words, digests = zip(*(one for own in found for one in own), strict=True) if has.any() else ((),) * 4
                digest = np.frombuffer(b"".join(digests), np.dtype([("high", "<i8"), ("low", "<i4")]))
                offsets = pa.array(np.concatenate([[0], np.cumsum(has)]), pa.int32())
                values = (start, end, words, digest["high"], digest["low"])
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v, k)) for v, k in zip(values, kinds.values(), strict=True)]
                columns = [piece.column("row"), piece.column("id"), *lists]
                yield pa.RecordBatch.from_arrays(columns, list(fields)).filter(pa.array(has > 0))

    return source.mapInArrow(run, T.StructType([T.StructField(n, t, n == "id") for n, t in fields.items()]))


def hot_firsts(each: DataFrame, hot: list[int], rank: list[Column]) -> dict[int, Column]:
    """The first unit of each hot digest, by its upper part; fewer than HOT_SHARE of them, aggregated before a shuffle.

    Should two digests share the upper part, both are left to the others.
    """
    if not hot:
        return {}
    found = each.where(F.col("high").isin(hot)).groupBy("high", "low").agg(F.min(F.struct(*rank)).alias("first")).collect()
    alone = Counter(r.high for r in found)
    place = lambda f: F.struct(F.lit(f.id).cast("long").alias("id"), F.lit(f.row).alias("row"), F.lit(f.start).alias("start"))
    return {r.high: place(r.first) for r in found if alone[r.high] == 1}


def repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    min_words: int = MIN_WORDS,
    row_col: str | None = None,
) -> DataFrame:
    """One row per repeated unit: ``row, id, start, end, words, keep_id, keep_start, run, run_words, removed``.

    Units equal after normalising are grouped by a 96-bit digest over the whole corpus. The one of the smallest id, and
    in it the first, stays; all others are repeats, also within one document. ``run`` numbers the unbroken runs of
    repeats in a row of ``docs``, ``run_words`` counts the words of the run. A repeat is ``removed`` if these are
    ``min_words`` or more, so short pieces that agree by chance stay. Offsets count code points of the original text,
    the end excluded; ``keep_*`` name the occurrence that stays.

    Texts are hashed once, to a written table of a row per document. Units are then shuffled once, by digest, and
    each finds the first of its digest in the order of the sort. The few digests that own a large share of all units are
    found by a sketch first; their first occurrences are aggregated before a shuffle and told to the units, which
    stay where they are. Only repeats are shuffled again, by row.

    Rows of ``docs`` are told apart by ``row`` (a number that ``row_col`` may give), so null and repeated ids are documents of their own: rows of one id go by
    the order in which they are read, null ids come after all others. A null or empty text, or one of white space
    only, has no units. An empty table gives no rows; other columns are not read.
    """
    by_row = written(units(docs, id_col, text_col, unit, row_col), "units", 2000)
    total = by_row.agg(F.sum(F.size("high"))).first()[0] or 0
    limits = Limits(hot_rows=max(HOT_LEAST, total // HOT_SHARE))
    digests = by_row.select(F.explode("high").alias("high"))
    hot = hot_hashes(digests, ["high"], limits, F.col("high")) if total >= limits.hot_rows else []
    zipped = F.posexplode(F.arrays_zip("start", "end", "words", "high", "low")).alias("no", "u")
    each = by_row.select("row", "id", zipped).select("row", "id", "no", "u.*")
    rank = [F.col("id").isNull().alias("none"), F.col("id"), F.col("row"), F.col("start")]
    columns = ["row", "id", "no", "start", "end", "words", "keep"]

    firsts = hot_firsts(each, hot, rank)
    is_hot = F.col("high").isin(list(firsts))

    order = Window.partitionBy("high", "low").orderBy(*rank)
    found = each.where(~is_hot) if firsts else each
    found = found.withColumn("k", F.row_number().over(order))
    found = found.withColumn("keep", F.first(F.struct("id", "start")).over(order)).where("k > 1").select(*columns)
    if firsts:
        known = F.create_map(*[F.lit(x) if i % 2 == 0 else x for one in firsts.items() for i, x in enumerate(one)])
        same = each.where(is_hot).withColumn("first", known[F.col("high")])
        same = same.where((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
        found = found.union(same.withColumn("keep", F.struct("first.id", "first.start")).select(*columns))
    place = Window.partitionBy("row").orderBy("no")
    runs = found.withColumn("run", F.col("no") - F.row_number().over(place))
    runs = runs.withColumn("run_words", F.sum("words").over(Window.partitionBy("row", "run")))
    return runs.select(
        "row",
        F.col("id").alias(id_col),
        "start",
        "end",
        "words",
        F.col("keep.id").alias("keep_id"),
        F.col("keep.start").alias("keep_start"),
        "run",
        "run_words",
        (F.col("run_words") >= min_words).alias("removed"),
    )


def repeated_units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", min_words: int = MIN_WORDS
) -> DataFrame:
    """The repeats that are removed: ``id, start, end, words, keep_id, keep_start``, as ``repeats`` finds them."""
    found = repeats(docs, id_col, text_col, unit, min_words).where("removed")
    return found.select(quoted(id_col), "start", "end", "words", "keep_id", "keep_start")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with the removed repeats cut out of the texts; where a cut lies the text closes up. Other columns stay.

    The rows are numbered and written first, so a cut is made in its own row, whatever the ids are.
    """
    row, spans = unused(docs, "__row"), unused(docs, "__spans")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = repeats(numbered, id_col, text_col, unit, min_words, row).where("removed")
    cuts = found.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(spans))
    joined = lookup_join(numbered, cuts, [row])
    text = quoted(text_col).cast("string")
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    kept = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substr(text, a + 1, b - a)), "")
    cut = F.when(F.col(spans).isNull(), text).otherwise(kept)
    return joined.select(*[cut.alias(c) if c == text_col else quoted(c) for c in docs.columns])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages that are removed from the documents, with the document and place of the one that stays."""
    return repeated_units(table(spark, sf_dir, "documents"), unit="passage")


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLE_SQL = {
    "op1_substring_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents),
        tokens AS (SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS i FROM texts),
        placed AS (
            SELECT doc_id, i, token, sum(length(token)) OVER here - length(token) AS start,
                   sum(length(token) - length(replace(token, chr(10), ''))) OVER here AS line
            FROM tokens WINDOW here AS (PARTITION BY doc_id ORDER BY i)),
        marked AS (
            SELECT *, right(token, 1) IN ('.', '!', '?') OR md5(token)[1] IN ('0', '8') AS mark
            FROM placed WHERE regexp_matches(token, '^[^\x20\x09-\x0D]')),
        ending AS (
            SELECT *, mark AND NOT coalesce(lag(mark) OVER (PARTITION BY doc_id, line ORDER BY i), false) AS ends
            FROM marked),
        numbered AS (
            SELECT *, coalesce(sum(CAST(ends AS INTEGER)) OVER (PARTITION BY doc_id, line ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM ending),
        passages AS (
            SELECT doc_id, line, min(start) AS start, max(start + length(token)) AS last, count(*) AS words,
                   string_agg(token, ' ' ORDER BY i) AS unit
            FROM numbered GROUP BY doc_id, line, part),
        units AS (
            SELECT doc_id, CAST(start AS INTEGER) AS start, CAST(words AS INTEGER) AS words, unit,
                   CAST(coalesce(lead(start) OVER (PARTITION BY doc_id, line ORDER BY start), last) AS INTEGER) AS "end",
                   row_number() OVER (PARTITION BY doc_id ORDER BY start) AS no
            FROM passages),
        ranked AS (
            SELECT *, row_number() OVER same AS r, first_value(doc_id) OVER same AS keep_id,
                   first_value(start) OVER same AS keep_start
            FROM units WINDOW same AS (PARTITION BY unit ORDER BY doc_id, start)),
        runs AS (
            SELECT *, no - row_number() OVER (PARTITION BY doc_id ORDER BY no) AS run FROM ranked WHERE r > 1)
        SELECT doc_id, start, "end", words, keep_id, keep_start FROM (
            SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS total FROM runs) WHERE total >= 20""",
}
