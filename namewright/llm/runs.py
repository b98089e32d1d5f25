"""Periodic stretches of words: Lyndon arrays from the groups of a suffix sorter's first phase, extended to runs."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewright.llm.common import parts, quoted, table, text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run is reported when it has so many words, and so many times its smallest period.
MIN_LENGTH = 6
MIN_PERIODS = 4
#: Characters of text, and words of stretches, that are worked on together.
TEXT_CHARS = 4_000_000
SORTED_WORDS = 200_000

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that begins there, by the first phase of Baier's sorter.

    Places are in groups by a word that they begin with, at first one symbol, and the groups are in the order of their
    words. From the highest group down, a group's word is final: no longer Lyndon word begins at its places. Each of them
    points to the nearest place before it that is still open, which is in a lower group. That one's word ends where the
    first of those pointing to it begins, so it grows by one copy of the group's word for each, and the place moves to a
    new group right above its old one, the higher the more copies. Each place points once, so but for finding the open
    place (path halving) the work is linear.
    """
    by_symbol: dict[int, list[int]] = defaultdict(list)
    for place, symbol in enumerate(symbols, 1):
        by_symbol[symbol].append(place)
    members = [by_symbol[symbol] for symbol in sorted(by_symbol)]
    size = [len(places) for places in members]
    word = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    group = [0] * (len(symbols) + 1)
    for k, places in enumerate(members):
        for place in places:
            group[place] = k
    final = [0] * (len(symbols) + 1)
    open_at = list(range(len(symbols) + 1))  # a place while it is open, else one before it; 0 is always open

    current = len(members) - 1
    while current >= 0:
        length = word[current]
        here = [place for place in members[current] if group[place] == current]
        members[current] = []
        for place in here:
            final[place] = length
            open_at[place] = place - 1
        copies: dict[int, int] = {}
        for place in here:
            while open_at[place] != place:
                open_at[place] = place = open_at[open_at[place]]
            copies[place] = copies.get(place, 0) + 1
        copies.pop(0, None)
        moves: dict[int, dict[int, list[int]]] = {}
        for place, n in copies.items():
            moves.setdefault(n, {}).setdefault(group[place], []).append(place)
        for n in sorted(moves, reverse=True):
            for old, places in moves[n].items():
                if len(places) == size[old]:
                    word[old] += n * length
                    continue
                new, up = len(members), above[old]
                members.append(places)
                size.append(len(places))
                size[old] -= len(places)
                word.append(word[old] + n * length)
                below.append(old)
                above.append(up)
                above[old] = new
                below[up] = new
                for place in places:
                    group[place] = new
        current = below[current]
    return final[1:]


class Extensions:
    """How far two places of an array agree, forwards or backwards, from names of all blocks of 2^k symbols."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.names = [np.unique(symbols, return_inverse=True)[1]]
        while 2 << (len(self.names) - 1) <= min(longest, len(symbols)):
            half, last = 1 << (len(self.names) - 1), self.names[-1]
            code = last[:-half] * (last.max() + 1) + last[half:]
            self.names.append(np.unique(code, return_inverse=True)[1])

    def forwards(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal symbols from places ``x`` and ``y`` on; none at the end of the array."""
        done = np.zeros(len(x), np.int64)
        for k in reversed(range(len(self.names))):
            names = self.names[k]
            a, b = x + done, y + done
            inside = np.flatnonzero(np.maximum(a, b) < len(names))
            same = inside[names[a[inside]] == names[b[inside]]]
            done[same] += 1 << k
        return done

    def backwards(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal symbols that end at ``x`` and ``y``, these included."""
        done = np.zeros(len(x), np.int64)
        for k in reversed(range(len(self.names))):
            names = self.names[k]
            a, b = x - done - (1 << k) + 1, y - done - (1 << k) + 1
            inside = np.flatnonzero(np.minimum(a, b) >= 0)
            same = inside[names[a[inside]] == names[b[inside]]]
            done[same] += 1 << k
        return done


def runs_of(pieces: list[np.ndarray], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each piece, by start and period.

    By the runs theorem every run holds a longest Lyndon word of one of the two orders (of symbols, or reversed) as its
    root, so the Lyndon arrays under both name all periods; each root is extended as far as it repeats, both ways.
    Pieces are worked on together, each after a separator that is smaller than all symbols under both orders.
    """
    sizes = np.array([len(piece) for piece in pieces])
    if not len(pieces) or not sizes.sum():
        return [[] for _ in pieces]
    at = np.cumsum(sizes + 1) - sizes  # first place of each piece
    values = np.unique(np.concatenate(pieces), return_inverse=True)[1] + 1
    total = len(values) + len(pieces)
    rising = np.zeros(total, np.int64)
    inside = np.ones(total, bool)
    inside[at - 1] = False
    rising[inside] = values
    falling = np.where(inside, values.max() + 1 - rising, 0)
    apart = rising.copy()
    apart[at - 1] = values.max() + 1 + np.arange(len(pieces))
    same = Extensions(apart, int(sizes.max()))
    found = []
    for order in (rising, falling):
        period = np.array(lyndon_lengths(order.tolist()), np.int64)
        start = np.flatnonzero(inside)
        period = period[start]
        ahead = same.forwards(start, np.minimum(start + period, total - 1)) * (start + period < total)
        behind = same.backwards(start - 1, start + period - 1)
        first, length = start - behind, behind + period + ahead
        long = length >= np.maximum(min_length, min_periods * period)
        found.append(np.stack([first[long], period[long], length[long]], 1))
    out: list[list[tuple[int, int, int]]] = [[] for _ in pieces]
    rows = np.unique(np.concatenate(found), axis=0)
    for (first, period, length), piece in zip(rows.tolist(), (np.searchsorted(at, rows[:, 0], "right") - 1).tolist(), strict=True):
        out[piece].append((first - int(at[piece]), length, period))
    return out


def least_windows(min_length: int, min_periods: int) -> int:
    """How often, at least, a run of the given size holds each of its windows of three words."""
    return min((max(min_length, min_periods * q) - 2) // q for q in range(1, min_length + 3))


def stretches(numbers: np.ndarray, min_length: int, least: int) -> list[tuple[int, int]]:
    """Stretches ``(begin, end)`` of words outside of which no run lies, and whose own runs are those of the text.

    All windows of three words of a run are in it ``least`` times. A stretch is cut where a window occurs less often
    in it, until nothing is cut any more. A run lies in one stretch with all its windows, so it is found there as
    a whole, and what is found there is no part of a longer one.
    """
    if least < 2 or min_length < 3:
        return [(0, len(numbers))] if len(numbers) >= min_length else []
    out, todo = [], [(0, len(numbers))]
    kinds = int(numbers.max(initial=0)) + 1
    while todo:
        begin, end = todo.pop()
        if end - begin < min_length:
            continue
        own = numbers[begin:end]
        if kinds < 2_000_000:
            windows = (own[:-2] * kinds + own[1:-1]) * kinds + own[2:]
        else:
            windows = np.unique(own[:-2] * kinds + own[1:-1], return_inverse=True)[1] * kinds + own[2:]
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        often = counts[which] >= least
        if often.all():
            out.append((begin, end))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]])))
        todo += [(begin + a, begin + b + 2) for a, b in edges.reshape(-1, 2).tolist()]
    return out


def text_runs(texts: list[list[str]], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    least = least_windows(min_length, min_periods)
    pieces: list[np.ndarray] = []
    owners: list[tuple[int, int]] = []

    def settle() -> None:
        for (text, begin), found in zip(owners, runs_of(pieces, min_length, min_periods), strict=True):
            out[text] += [(begin + start, length, period) for start, length, period in found]
        pieces.clear()
        owners.clear()

    size = 0
    for text, words in enumerate(texts):
        if len(words) < min_length:
            continue
        known: dict[str, int] = {}
        numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        for begin, end in stretches(numbers, min_length, least):
            pieces.append(numbers[begin:end])
            owners.append((text, begin))
            size += end - begin
        if size >= SORTED_WORDS:
            settle()
            size = 0
    settle()
    return [sorted(own, key=lambda run: (run[0], run[2])) for own in out]


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words, joined by one space, without what any run holds after its first period."""
    if not runs:
        return " ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return " ".join(w for w, stays in zip(words, kept.tolist(), strict=True) if stays)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_words, runs, collapsed``.

    Words are `[^\\x20\\x09-\\x0D]+`, compared as they stand. A run ``(start, length, period)`` is a stretch of words with
    the smallest period ``period`` that no neighbouring word prolongs, of at least ``min_length`` words and
    ``min_periods`` (2 or more) periods; ``start`` counts words from 0. ``collapsed`` is the text with each run cut to
    its first period, words joined by one space.

    Nothing is shuffled: a task holds a batch of texts and the words of a few million characters. The work is linear in
    the words of a text but for sorting. A null or empty text, or one of white space, has no words, no runs and an empty
    ``collapsed``. Repeated rows and ids are each taken for themselves, null ids too; an empty table gives no rows; other
    columns are not read.
    """
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    source = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    run_type = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    fields = [("n_words", T.LongType()), ("runs", T.ArrayType(run_type)), ("collapsed", T.StringType())]
    schema = T.StructType([source.schema["id"]] + [T.StructField(n, t) for n, t in fields])
    arrow_runs = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch, "text", TEXT_CHARS):
                texts = [WORD.findall(text) for text in piece.column("text").to_pylist()]
                found = text_runs(texts, min_length, min_periods)
                columns = [
                    piece.column("id"),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in found], arrow_runs),
                    pa.array([collapsed(words, own) for words, own in zip(texts, found, strict=True)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def made_periodic(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text`` with one text in ten (h % 10 = 0, h the CRC-32 of the id) periodic from some word on.

    With g = floor(h / 10) and n words, word i from a = g % n on becomes word a + (i - a) % p of the original, where
    p = 1 + floor((n - a) / (3 + g % 8)). A null id or a text without words is left as it is.
    """
    h = F.crc32(quoted(id_col).cast("string"))
    words = F.regexp_extract_all(text_or_empty(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    own = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    own = own.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    own = own.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))

    def word(i: Column) -> Column:
        return F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))

    periodic = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    return own.select(quoted("id").alias(id_col), F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias(text_col))


def op11_baier_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, one in ten made periodic, with the run of the greatest exact length / period."""
    found = periodic_runs(made_periodic(table(spark, sf_dir, "documents")))
    better = "best.length IS NULL OR r.length * best.period > best.length * r.period"
    none = "CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>)"
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", F.expr(f"aggregate(runs, {none}, (best, r) -> CASE WHEN {better} THEN r ELSE best END)")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_baier_runs": op11_baier_runs}
ORACLE_SQL: dict[str, str] = {}
