"""Near duplicates by an inverted join over the coordinates of MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewright.llm.common import by_ids, by_keys, held, one_row_each, quoted, table, text_or_empty, written
from namewright.llm.components import components
from namewright.llm.shingles import WORDS_PER_SHINGLE, mixed, shingle_sets

#: Coordinates of a signature, and how many must agree. A pair of similarity 0.85 has 14 agreeing coordinates of 32 but
#: for one case in 10^8 (binomial); pairs above are safer still. A pair of similarity 0.80 has 11 but for 3 cases in 10^9.
COORDINATES = 32
LEAST_MATCHES = 14
#: Two documents are linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Members of a group that are compared with each other in one piece.
BLOCK = 512
#: Rows with texts or full sets that a Python worker gets at a time.
TEXT_ROWS = 500

_SEED = 7


def _multipliers(k: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(_SEED)).integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature_keys(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row per non-empty set: for each coordinate k the number k * 2^32 + smallest 32-bit hash."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), coordinates), np.int64)
    for k, a in enumerate(_multipliers(coordinates)):
        least = np.minimum.reduceat(mixed(joined * a), starts) >> np.uint64(32)
        out[:, k] = least.astype(np.int64) + (k << 32)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, coordinates: int, words: int) -> DataFrame:
    """``id, n_shingles, digest, sig`` per row; the digest names the set, and empty sets have no signature."""
    source = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").cast("binary").alias("text"))
    fields = [("n_shingles", T.LongType()), ("digest", T.BinaryType()), ("sig", T.ArrayType(T.LongType(), False))]
    schema = T.StructType([source.schema["id"]] + [T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            done, sets = 0, []

            def flush(done: int, sets: list[np.ndarray], ids=ids) -> pa.RecordBatch:
                sizes = np.array([len(s) for s in sets])
                full = [s for s in sets if len(s)]
                keys = signature_keys(full, coordinates) if full else np.zeros((0, coordinates), np.int64)
                offsets = np.concatenate([[0], np.cumsum((sizes > 0) * coordinates)]).astype(np.int32)
                names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                columns = [ids.slice(done, len(sets)), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), lists]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            size = 0
            for one in shingle_sets(batch.column("text").to_pylist(), words):
                sets.append(one)
                size += len(one)
                if size > 200_000:
                    yield flush(done, sets)
                    done, size, sets = done + len(sets), 0, []
            if sets:
                yield flush(done, sets)

    return source.mapInArrow(run, schema)


def posting_lists(reps: DataFrame, least_matches: int) -> DataFrame:
    """``(rep, key, shared)``: each signature under the rarest of its coordinate values (prefix filter).

    Values that only one signature has can match nothing. Of the others a signature needs as many as must agree, or it
    has no partner at all; two signatures that agree on enough share one of the rarest in the global order by frequency
    when each leaves out all but ``least_matches - 1`` of its most frequent ones. Values that a large share of the
    documents have, such as those of a passage found everywhere, so rarely get a list. ``shared`` is how many others
    have a value of the signature, over all of them.
    """
    postings = reps.select("rep", F.explode("sig").alias("key"))
    counts = postings.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c >= 2")
    shared = postings.join(held(counts), "key")
    own = shared.groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct("c", "key"))).alias("l"), F.sum("c").alias("shared")
    )
    own = own.where(F.size("l") >= least_matches)
    prefix = F.slice("l", F.lit(1), F.size("l") - (least_matches - 1))
    return own.select("rep", "shared", F.explode(prefix).alias("p")).select("rep", F.col("p.key").alias("key"), "shared")


def differences(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Adds ``n_a, n_b`` (sizes of the full shingle sets) and ``apart`` (the shingles in one set only) to ``(a, b)``.

    Only documents in a pair are shingled again, found by a semi join that moves no texts while ids are few. Each pair
    then meets its two sets, which a join deals by document; a document in very many pairs is split.
    """
    ids = held(pairs.select("a").union(pairs.select("b")).distinct())
    texts = by_ids(docs, ids, "left_semi", id_col).select(
        quoted(id_col).cast("bigint").alias("id"), quoted(text_col).cast("string").cast("binary").alias("text")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (one.tobytes() for one in shingle_sets(batch.column("text").to_pylist(), words))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, apart = [], [], []
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (x, y))
                n_a.append(len(x))
                n_b.append(len(y))
                apart.append(np.setxor1d(x, y, assume_unique=True).tobytes())
            columns = [batch.column("a"), batch.column("b"), pa.array(n_a), pa.array(n_b), pa.array(apart, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n_a", "n_b", "apart"])

    sets = texts.mapInArrow(hashed, "id long, shingles binary")
    of_a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    of_b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    full = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "of_a", "of_b")
    return full.mapInArrow(compared, "a long, b long, n_a long, n_b long, apart binary")


def similar(n_a, n_b, apart, percent: int):
    """100 * intersection >= percent * union, from the sizes of two sets and of their symmetric difference."""
    return 100 * (n_a + n_b - apart) >= percent * (n_a + n_b + apart)


def cross_links(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Links ``(a, b)`` between labels among members ``(pivot, rep, label, n, apart)`` of one pivot's group.

    ``apart`` holds the shingles in which a member differs from the pivot. Members x and y differ in the shingles that
    are in just one of their two differences, so their exact similarity follows from these alone.

    Every group is dealt into cells of about ``block`` by ``block`` members, so that a group of any size is spread over
    many tasks. Members with a group's most frequent label are not compared with each other. A cell gives links that
    join the labels in it, one less than there are labels at most, however many pairs are similar.
    """
    labels = members.groupBy("pivot", "label").agg(F.count(F.lit(1)).alias("c"))
    groups = labels.groupBy("pivot").agg(
        F.sum("c").alias("c_all"), F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("kinds")
    )
    groups = groups.where("kinds > 1").select("pivot", "c_all", F.col("top.c").alias("c_top"), F.col("top.label").alias("main"))
    found = members.join(held(groups), "pivot")
    blocks = F.ceil(F.col("c_all") / block).cast("int")
    probe_blocks = F.ceil((F.col("c_all") - F.col("c_top")) / block).cast("int")
    row = ["pivot", "rep", "label", "n", "apart"]
    base = found.select(
        *row,
        F.lit(False).alias("probe"),
        F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), probe_blocks - 1)).alias("j"),
    )
    probes = found.where("label <> main").select(
        *row,
        F.lit(True).alias("probe"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"),
        F.pmod(F.xxhash64("rep"), probe_blocks).cast("int").alias("j"),
    )
    cells = base.unionByName(probes).repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    cells = cells.select("pivot", "i", "j", "probe", "rep", "label", "n", "apart")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []

        def result() -> Iterator[pa.RecordBatch]:
            found = cell_links(rows, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if row[:3] != cell:
                    yield from result()
                    cell, rows = row[:3], []
                rows.append(row[3:])
        yield from result()

    return cells.mapInArrow(run, "a long, b long").distinct()


def cell_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links between rows ``(probe, rep, label, n, apart)``, probes against the others, that join further labels."""
    base = [row for row in rows if not row[0]]
    probes = [row for row in rows if row[0]]
    if not base or not probes:
        return []
    _, rep, label, n, apart = zip(*base, strict=True)
    n = np.array(n)
    apart = [np.frombuffer(x, np.uint64) for x in apart]
    sizes = np.array([len(x) for x in apart])
    owners = np.repeat(np.arange(len(base)), sizes)
    every = np.concatenate(apart)
    order = np.argsort(every, kind="stable")
    every, owners = every[order], owners[order]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    out = []
    for _, own, own_label, own_n, own_apart in probes:
        own_apart = np.frombuffer(own_apart, np.uint64)
        first, last = np.searchsorted(every, own_apart, "left"), np.searchsorted(every, own_apart, "right")
        counts = last - first
        at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(owners[at], minlength=len(base))
        for k in np.flatnonzero(similar(n, own_n, sizes + len(own_apart) - 2 * both, percent)):
            x, y = root(own_label), root(label[k])
            if x != y:
                parent[x] = y
                out.append((max(own, rep[k]), min(own, rep[k])))
    return out


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    least_matches: int = LEAST_MATCHES,
    words: int = WORDS_PER_SHINGLE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= percent * union of their sets of distinct word shingles; a component
    is what links reach, named by its smallest id; the document of that id is kept.

    1. Documents with the same set are one class, represented by the smallest id.
    2. Each class is posted under the rarest of its coordinate values (``posting_lists``).
    3. Of each list the member that shares the most with others is the pivot, and every member is compared with it on
       full sets: for a text and its edited copies that is one comparison per copy. Links give components.
    4. The lists of one pivot are one group. Where its members still lie in several components, they are compared
       across components by what sets them apart from the pivot (``cross_links``). Two classes in one component need no
       more comparing, as components are what is asked for.

    The only loss is chance: a linked pair whose signatures agree on fewer than ``least_matches`` coordinates.

    Ids must be whole numbers and identify a text; a row that repeats is in the class of its text. A null id is linked
    with nothing and stays. A null or empty text has no shingles and is linked with nothing.
    """
    sig = held(signatures(docs, id_col, text_col, coordinates, words), TEXT_ROWS)
    linkable = sig.where("n_shingles > 0 AND id IS NOT NULL")
    classes = linkable.groupBy("digest").agg(
        F.min("id").cast("bigint").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")
    )
    classes = held(classes)
    posted = held(posting_lists(classes, least_matches))
    lists = posted.groupBy("key").agg(
        F.max(F.struct("shared", -F.col("rep"))).alias("top"), F.count(F.lit(1)).alias("c")
    )
    lists = held(lists.where("c >= 2").select("key", (-F.col("top.col2")).alias("b")))
    stars = posted.join(lists, "key").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    stars = written(stars, "stars", few_files=True)
    stars = written(differences(stars, docs, id_col, text_col, words), "differences", TEXT_ROWS, few_files=True)
    linked = similar(F.col("n_a"), F.col("n_b"), F.octet_length("apart") / 8, percent)
    first = components(stars.where(linked))

    members = stars.select(F.col("b").alias("pivot"), F.col("a").alias("rep"), F.col("n_a").alias("n"), "apart")
    pivots = stars.groupBy(F.col("b").alias("pivot")).agg(F.min("n_b").alias("n"))
    pivots = pivots.select("pivot", F.col("pivot").alias("rep"), "n", F.lit(b"").alias("apart"))
    members = members.union(pivots).join(first.withColumnRenamed("node", "rep"), "rep", "left")
    members = members.select("pivot", "rep", F.coalesce("root", "rep").alias("label"), "n", "apart")
    more = written(cross_links(members, percent, block), "links", TEXT_ROWS, few_files=True)
    for end in ("a", "b"):
        own = first.select(F.col("node").alias("of"), F.col("root").alias("to"))
        more = more.join(own, F.col(end) == F.col("of"), "left")
        more = more.withColumn(end, F.coalesce("to", end)).drop("of", "to")
    second = components(more)

    top = classes.select("digest", "rep").join(first.withColumnRenamed("node", "rep"), "rep", "left")
    top = top.select("digest", F.coalesce("root", "rep").alias("root"))
    top = top.join(second.toDF("of", "to"), F.col("root") == F.col("of"), "left")
    top = held(top.select("digest", F.coalesce("to", "root").alias("component")))
    linked = sig.join(top, (sig.digest == top.digest) & (sig.n_shingles > 0) & sig.id.isNotNull(), "left")
    component = F.coalesce(F.col("component"), F.col("id")).cast("bigint")
    return linked.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _text_hash(text: Column, other: bool = False) -> Column:
    return F.xxhash64(F.lit(1), text) if other else F.xxhash64(text)


def text_keys(docs: DataFrame, text_col: str) -> Column:
    """A number that equal texts share and no others, for use in place of an id; a null text counts as empty.

    It is a 64-bit hash. Texts whose hashes agree are told apart by a second one, so 128 bits stand for a text; where
    one hash stands for several texts, these take their second hash. Such hashes are collected: of 10^10 texts some
    three are expected, of 10^11 some three hundred.
    """
    text = text_or_empty(text_col)
    both = docs.select(_text_hash(text).alias("key"), _text_hash(text, other=True).alias("other"))
    shared = both.groupBy("key").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b").select("key").collect()
    if not shared:
        return _text_hash(text)
    return F.when(_text_hash(text).isin([r.key for r in shared]), _text_hash(text, other=True)).otherwise(_text_hash(text))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, exactly one row of each component, with all their columns.

    That is one with the smallest id; a row with a null id stays where no other has one. Ids may be null or repeated, as
    documents are compared under a number of their text (``text_keys``). Equal texts are first reduced to one row, which costs
    nothing where there are none. Texts without a word are linked with nothing; of such rows with the same id and text
    one stays.
    """
    key, id_, text = text_keys(docs, text_col), quoted(id_col), text_or_empty(text_col)
    blank = ~text.rlike(r"[^ \t-\r]")
    each = docs.select(key.alias("key"), id_.alias("id"), blank.alias("blank"), F.when(blank, id_).alias("own"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least")
    groups = each.groupBy("key", "blank", "own").agg(least, F.count(F.lit(1)).alias("c")).where("c > 1")
    groups = written(groups.select(F.col("key").alias("of"), "blank", "own", "least.id"), "equal-texts")
    if not groups.isEmpty():
        groups = groups.toDF("of", "of_blank", "of_own", "least")
        same = (F.col("key") == F.col("of")) & (F.col("blank") == F.col("of_blank")) & F.col("own").eqNullSafe(F.col("of_own"))
        rows = each.join(groups, same).groupBy("key", "id", F.col("id").eqNullSafe(F.col("least")).alias("kept"))
        rows = written(rows.agg(F.count(F.lit(1)).alias("n")).where("not kept OR n > 1"), "equal-rows")
        gone, tied = (rows.where(which).select("key", "id") for which in ("not kept", "kept"))
        docs = one_row_each(docs, gone, tied, [key, id_], text_col)

    result = near_duplicates(docs.select(key.alias("key"), quoted(text_col).alias("text")), "key", "text", **options)
    linked = written(result.where("not kept").select("key", "component_id"), "linked")
    members = linked.union(linked.select(F.col("component_id").alias("key"), "component_id")).distinct()
    named = written(docs.select(key.alias("key"), id_.alias("id")).join(members, "key"), "members")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best")
    best = named.groupBy("component_id").agg(best).select("component_id", F.col("best.key").alias("stays"))
    gone = written(named.join(best, "component_id").where("key <> stays").select("key"), "gone")
    return by_keys(docs, gone, "left_anti", [key])


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op2_minhash_near_dedup": op2_minhash_near_dedup}
ORACLE_SQL = {
    "op2_minhash_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
                FROM words)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b USING (s)
            WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON other = a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n""",
}
