"""Ranked lexical search by scanning the documents with one automaton of all items' terms; there is no index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.llm.common import parts, quoted, table, text_or_empty, written

#: A term: ASCII letters and digits and all characters beyond ASCII, the longest stretch of them.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between terms becomes a blank, and A-Z lower case.
NORMAL = {c: " " for c in range(128) if not chr(c).isalnum()} | str.maketrans(UPPER, LOWER)
#: Documents in an item's result.
TOP = 50
#: Length correction: a document's m is 100 - LENGTH_PERCENT + LENGTH_PERCENT * its terms / the average.
LENGTH_PERCENT = 50
#: Bytes of terms (each with some for itself) in one automaton; items with more are searched in several scans.
SCAN_BYTES = 16 << 20
TERM_BYTES = 64
#: Bytes of text that are scanned together, items scored together, additions made together.
TEXT_BYTES = 1_000_000
SCORED_ITEMS = 1_000
ADDITIONS = 2_000_000


class Queries(NamedTuple):
    """Items with the terms of one scan; the items of term t are ``items[starts[t] : starts[t + 1]]``, as places in ``ids``."""

    ids: list[int | None]
    terms: list[str]
    starts: np.ndarray
    items: np.ndarray


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item, term)``, each once; rows that share an id are one item, whose terms are those of all its texts."""
    found = F.regexp_extract_all(F.translate(text_or_empty(text_col), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(quoted(id_col).cast("bigint").alias("item"), F.explode(F.array_distinct(found)).alias("term")).distinct()


def _queries(pairs: DataFrame) -> Queries:
    """A scan's pairs, whose number the caller has bounded, as arrays."""
    rows = sorted(((r.term, r.item) for r in pairs.collect()), key=lambda p: (p[0], p[1] is None, p[1] or 0))
    ids = list(dict.fromkeys(item for _, item in rows))
    place = {item: k for k, item in enumerate(ids)}
    terms = list(dict.fromkeys(term for term, _ in rows))
    number = {term: k for k, term in enumerate(terms)}
    counts = np.bincount([number[term] for term, _ in rows], minlength=len(terms))
    starts = np.concatenate([[0], np.cumsum(counts)])
    return Queries(ids, terms, starts, np.array([place[item] for _, item in rows], np.int64))


class Scanner:
    """Counts terms in batches of texts. Every term stands in the automaton between blanks, so only whole terms are found."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.size = len(terms)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(terms):
            self.automaton.add_word(f" {term} ", k)
        self.automaton.make_automaton()

    def scan(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All terms of each text; and ``text, term, tf`` of the automaton's terms, by text and term."""
        normal = [text.translate(NORMAL) for text in texts]
        lengths = np.array([_count_terms(text) for text in normal], np.int64)
        ends = np.cumsum([len(text) + 1 for text in normal])  # each text is followed by a blank
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(f" {' '.join(normal)} ")), np.int64).reshape(-1, 2)
        text = np.searchsorted(ends, hits[:, 0], "left")
        code, tf = np.unique(text * self.size + hits[:, 1], return_counts=True)
        return lengths, code // self.size, code % self.size, tf.astype(np.int64)


def _count_terms(normal: str) -> int:
    raw = np.frombuffer(f" {normal}".encode("utf-8"), np.uint8) == 32
    return int(np.count_nonzero(raw[:-1] & ~raw[1:]))


def term_counts(docs: DataFrame, text_col: str, terms: list[str]) -> DataFrame:
    """First scan: ``(term, n)`` with the number of documents that hold each term, by its place; -1 counts the documents
    with any term and -2 all their terms. A task sends one row per term it has met."""
    source = docs.select(text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        holding, documents, all_terms = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for piece in parts(batch, "text", TEXT_BYTES):
                lengths, _, term, _ = scanner.scan(piece.column("text").to_pylist())
                holding += np.bincount(term, minlength=len(terms))
                documents += np.count_nonzero(lengths)
                all_terms += lengths.sum()
        met = np.flatnonzero(holding)
        columns = [np.concatenate([met, [-1, -2]]), np.concatenate([holding[met], [documents, all_terms]])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "n"])

    return source.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def best_scores(
    docs: DataFrame, id_col: str, text_col: str, queries: Queries, holding: dict[int, int], documents: int, all_terms: int, top: int
) -> DataFrame:
    """Second scan: ``(item, doc, score)``, for each task the ``top`` best documents of every item."""
    source = docs.select(quoted(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    weights = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(k, 0) + 1))) for k in range(len(queries.terms))], np.int64
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(queries.terms)
        leaders = [Leaders(min(SCORED_ITEMS, len(queries.ids) - k), top) for k in range(0, len(queries.ids), SCORED_ITEMS)]
        for batch in batches:
            for piece in parts(batch, "text", TEXT_BYTES):
                lengths, text, term, tf = scanner.scan(piece.column("text").to_pylist())
                m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * lengths * documents) // max(1, all_terms)
                worth = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[text]))
                ids = piece.column("id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                for k, own in enumerate(leaders):
                    scores = summed(queries, k * SCORED_ITEMS, own.items, len(lengths), text, term, worth)
                    own.add(scores, ids.fill_null(0).to_numpy(), known)
        for k, own in enumerate(leaders):
            item, score, doc, known = own.rows()
            columns = [
                pa.array([queries.ids[k * SCORED_ITEMS + i] for i in item.tolist()], pa.int64()),
                pa.array(doc, pa.int64(), mask=~known),
                pa.array(score, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc", "score"])

    return source.mapInArrow(run, "item long, doc long, score long")


def summed(queries: Queries, first: int, items: int, texts: int, text: np.ndarray, term: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """Scores of ``texts`` by ``items`` items from the ``first`` on: each found term adds its worth to the items it is of."""
    scores = np.zeros(texts * items, np.int64)
    counts = queries.starts[term + 1] - queries.starts[term]
    piece = np.cumsum(counts) // ADDITIONS
    starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
    for begin, end in zip(starts, starts[1:], strict=False):
        own = counts[begin:end]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        item = queries.items[np.arange(total) + np.repeat(queries.starts[term[begin:end]] - ends + own, own)] - first
        of = np.repeat(np.arange(begin, end), own)
        if first or items < len(queries.ids):
            inside = (item >= 0) & (item < items)
            item, of = item[inside], of[inside]
        np.add.at(scores, text[of] * items + item, worth[of])
    return scores.reshape(texts, items)


class Leaders:
    """The best documents of each item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.least = np.ones(items, np.int64)  # a document with a smaller score has no place
        self.best = tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        text, item = np.nonzero(scores >= self.least)
        if not len(text):
            return
        new = (item, scores[text, item], ids[text], known[text])
        item, score, doc, known = (np.concatenate(pair) for pair in zip(self.best, new, strict=True))
        order = np.lexsort((doc, ~known, -score, item))
        item = item[order]
        starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        stays = rank < self.top
        order = order[stays]
        self.best = (item[stays], score[order], doc[order], known[order])
        last = rank[stays] == self.top - 1
        self.least[self.best[0][last]] = self.best[1][last]

    def rows(self) -> tuple[np.ndarray, ...]:
        return self.best


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` documents of each item: ``item, rank, doc, score``, ranks from 1.

    N counts the documents with a term, L all their terms, df the documents that hold a term; a term weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))). With tf occurrences in a document of n terms it adds, in whole numbers,
    weight * (10^9 tf div (1000 tf + 20 m)), where m = 50 + (50 n N) div L. Documents with score 0 are left out, equal
    scores go by ascending id.

    The items' terms form one Aho-Corasick automaton, each guarded by a blank on either side; it reads every text from
    end to end, and its outputs are terms, which lead to items. One scan counts df, N and L, a second scores; a task keeps
    ``top`` documents of every item, and only these are shuffled. The terms are collected and sent to all tasks, so they
    are measured first: items whose terms take more than SCAN_BYTES are dealt by hash to several scans of their own.

    Ids must be whole numbers. Rows that share an item id are one item, the null id too; an item without terms has no
    rows. A null or empty text has no terms; documents are rows, so a repeated row counts again and takes a rank of its
    own, and of equal scores null ids come last. Empty tables give no rows; other columns are not read.
    """
    pairs = written(item_terms(items, item_col, item_text_col), "item-terms")
    size = pairs.agg(F.sum(F.octet_length("term") + TERM_BYTES)).first()[0] or 0
    scans = -(-size // SCAN_BYTES)
    found = None
    for scan in range(scans):
        own = pairs if scans == 1 else pairs.where(F.pmod(F.xxhash64("item"), F.lit(scans)) == scan)
        queries = _queries(own)
        if not queries.terms:
            continue
        counts = {r.term: r.n for r in term_counts(docs, text_col, queries.terms).collect()}
        documents, all_terms = counts.get(-1, 0), counts.get(-2, 0)
        best = best_scores(docs, id_col, text_col, queries, counts, documents, all_terms, top)
        found = best if found is None else found.union(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, doc long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op12_lexical_search": op12_lexical_search}
ORACLE_SQL = {
    "op12_lexical_search": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        docs AS (SELECT doc_id, t, len(t) AS n FROM texts WHERE len(t) > 0),
        totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
        items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        found AS (
            SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM docs)
            WHERE term IN (SELECT term FROM items) GROUP BY ALL),
        holding AS (SELECT term, count(*) AS df FROM found GROUP BY term),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(
                CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
                * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM found JOIN holding USING (term) JOIN items USING (term) CROSS JOIN totals GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 50""",
}
