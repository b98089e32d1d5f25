"""URL rules looked up in cascades of Bloom filters, exact for every key of the corpus."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.common import quoted, table, written
from namewright.llm.shingles import mixed

#: (verdict, host, path): fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

HASHES = 4
BITS_PER_KEY = 8
#: A level has at most so many bits (32 MB); with more keys it lets more false positives on to the next level, which is
#: built from those alone, so a level can be too small to be of use but never wrong. Levels are tried up to MAX_LEVELS.
MAX_BITS = 1 << 28
MAX_LEVELS = 64
BLOCK_BITS = 32_768


def positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """A row of ``HASHES`` bit numbers for each 64-bit hash; every level draws others."""
    seeds = np.arange(1, HASHES + 1, dtype=np.uint64) + np.uint64(level * HASHES)
    salted = mixed(hashes.astype(np.uint64)[:, None] ^ mixed(seeds * np.uint64(0x9E3779B97F4A7C15)))
    return (salted & np.uint64(bits - 1)).astype(np.int64)


@dataclass
class Cascade:
    """Levels of bits; odd ones hold listed keys, even ones the keys that pass all before without being listed."""

    levels: list[np.ndarray] = field(default_factory=list)

    def depth(self, hashes: np.ndarray) -> np.ndarray:
        """How many levels each key passes before the first that it fails."""
        depth = np.zeros(len(hashes), np.int64)
        alive = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = positions(hashes[alive], level, len(bits) * 8)
            alive = alive[(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(1)]
            depth[alive] = level + 1
        return depth

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        return self.depth(hashes) % 2 == 1


def level_bits(keys: DataFrame, level: int, n: int) -> np.ndarray:
    """The bits of one level over a table of hashes ``h``; tasks make 4 KB pieces, which are joined and collected."""
    bits = max(BLOCK_BITS, min(MAX_BITS, 1 << (n * BITS_PER_KEY - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(positions(batch.column("h").to_numpy(), level, bits))
            blocks, pieces = at // BLOCK_BITS, []
            for block in np.unique(blocks):
                flags = np.zeros(BLOCK_BITS, np.uint8)
                flags[at[blocks == block] % BLOCK_BITS] = 1
                pieces.append(np.packbits(flags, bitorder="little").tobytes())
            columns = [pa.array(np.unique(blocks), pa.int64()), pa.array(pieces, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "piece"])

    pieces = keys.select("h").mapInArrow(run, "block long, piece binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in pieces.groupBy("block").agg(F.bitmap_or_agg("piece").alias("piece")).toLocalIterator():
        out[row.block * 4096 : (row.block + 1) * 4096] = np.frombuffer(row.piece, np.uint8)
    return out


def passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = cascade.depth(batch.column("h").to_numpy()) >= level
            yield batch.filter(pa.array(keep))

    return keys.mapInArrow(run, "h long")


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the hashes ``listed`` that answers right for every hash of ``universe`` and every listed one.

    Level 1 holds the listed keys. What passes it without being listed makes up level 2, the listed keys that pass that
    one level 3, and so on until nothing passes. Only at this stage, when it is built, is the list compared with the
    universe by a join; later look-ups need the bits alone.
    """
    cascade = Cascade()
    inside = written(listed.select("h").distinct(), "listed-keys", few_files=True)
    outside = universe.select("h").distinct().join(inside, "h", "left_anti")
    for level in range(MAX_LEVELS):
        keys, others = (inside, outside) if level % 2 == 0 else (outside, inside)
        n = keys.count()
        if not n:
            return cascade
        cascade.levels.append(level_bits(keys, level, n))
        others = written(passing(others, cascade, level + 1), "passing", few_files=True)
        inside, outside = (keys, others) if level % 2 == 0 else (others, keys)
    if (outside if len(cascade.levels) % 2 else inside).isEmpty():
        return cascade
    raise ValueError(f"{MAX_LEVELS} levels of {MAX_BITS} bits do not tell these keys apart; allow larger levels")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a url; both empty without ``://`` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)"))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(lengths: Sequence[int], labels: int) -> Column:
    """All keys that a rule fitting ``host`` and ``path`` can have, longest first, each with its hash.

    No rule's path has another length, and no rule's host more ``labels``, so a host of thousands of labels has few keys.
    """
    suffixes = f"array_distinct(transform(sequence(1, {labels}), n -> substring_index(host, '.', -n)))"
    prefixes = f"transform(filter(array({', '.join(map(str, lengths))}), n -> n <= length(path)), n -> substring(path, 1, n))"
    keys = f"flatten(transform({suffixes}, s -> transform({prefixes}, p -> concat(s, p))))"
    ranked = f"array_sort(transform({keys}, k -> struct(-length(k) AS rank, k AS key, xxhash64(k) AS h)))"
    return F.expr(f"CASE WHEN host = '' THEN slice({ranked}, 1, 0) ELSE {ranked} END")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", unlisted: str = "allow") -> DataFrame:
    """One row per page: ``id, host, path, rule, verdict``.

    ``rules`` are ``(verdict, host, path)``. A rule fits its host and all subdomains where the url's path starts with the
    rule's; the longest wins. The keys of a url are its host's suffixes of whole labels, up to as many as the longest rule
    has, each with the starts of its path that are as long as some rule's path. One cascade holds the rules' keys against all keys of the corpus, another those
    that block against those that allow. Urls are judged by look-ups in the two, without a join. A url none of whose keys
    is listed has rule null and the verdict ``unlisted``.

    A null url, or one without ``://``, has an empty host and path and fits no rule. Repeated rows are judged alike. Of
    contradicting rules with one key, allowing wins. Without rules all is unlisted.
    """
    shapes = rules.select(F.length("path").alias("n"), F.size(F.split("host", "[.]")).alias("labels")).distinct().collect()
    lengths, labels = sorted({shape.n for shape in shapes} or {0}), max((shape.labels for shape in shapes), default=1)
    source = pages.select(quoted(id_col).alias("id"), quoted(url_col).cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    parsed = source.select("id", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("keys", candidate_keys(lengths, labels))
    keyed = rules.select("verdict", F.xxhash64(F.concat("host", "path")).alias("h")).groupBy("h").agg(F.min("verdict").alias("verdict"))
    universe = parsed.select(F.explode("keys.h").alias("h"))
    listed = build_cascade(keyed.select("h"), universe)
    blocking = build_cascade(keyed.where("verdict = 'block'").select("h"), keyed.select("h"))
    shared = pages.sparkSession.sparkContext.broadcast((listed, blocking))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema.fields[:3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, blocking = shared.value
        for batch in batches:
            keys = batch.column("keys")
            each = keys.flatten()
            owner = np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))
            hashes = each.field("h").to_numpy()
            hits = np.flatnonzero(listed.contains(hashes))
            row, first = np.unique(owner[hits], return_index=True)
            found = hits[first]
            rule = np.full(len(keys), None, object)
            rule[row] = each.field("key").take(pa.array(found)).to_pylist()
            verdict = np.full(len(keys), unlisted, object)
            verdict[row] = np.where(blocking.contains(hashes[found]), "block", "allow")
            columns = [*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "host", "path", "rule", "verdict"])

    judged = parsed.mapInArrow(run, ", ".join([*fields, "rule string", "verdict string"]))
    return judged.withColumnRenamed("id", id_col)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


QUERIES = {"op5_url_filter": op5_url_filter}
ORACLE_SQL = {
    "op5_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
        parsed AS (
            SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
        ruled AS (
            SELECT *, CASE
                WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM parsed)
        SELECT *, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
}
