"""Quality rules whose cutoffs come with a guarantee; built-in functions only.

A rule rejects a document when a statistic of its text is above a cutoff. Cutoffs are chosen per stratum (language) on
labelled documents, none of which any rule was fitted on: a cutoff is admitted only if an exact binomial test shows that
it rejects less than the allowed share of good documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.common import by_keys, quoted, table, text_or_empty, text_sha, written

#: The rules: a statistic and its candidate cutoffs, from the most lenient to the strictest.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05)),
    "bangs": ("n_bangs / n_words", (2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05)),
    "capitals": ("n_capitals / word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2)),
    "repeats": ("n_repeat_words / n_words", (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "same_lines": ("n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15)),
    "long_words": ("word_chars / n_words", (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
}

#: Of a stratum's good documents, all rules together reject more than ``RISK`` with probability ``DELTA`` at most, over
#: all strata at once.
RISK = 0.02
DELTA = 0.05

MIN_WORDS = 50
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_capitals")


def _repeat_words(texts: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` to rows with ``words``: words inside windows of three that occur twice or more.

    Windows are compared by 64-bit hashes. To find where the repeated ones stand, hash and position are packed into one
    long, whose array sorts as plain numbers; the positions displace low bits of the hash, so where that makes two
    different windows look alike the row takes the other branch, which sorts pairs. No array is evaluated within a
    lambda: each is a column that several expressions read.
    """
    out = texts.withColumn(
        "hashes",
        F.expr(
            "CASE WHEN size(words) < 4 THEN CAST(array() AS ARRAY<BIGINT>) ELSE "
            "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) END"
        ),
    )
    out = out.withColumn("n_windows", F.size("hashes")).withColumn("n_kinds", F.size(F.array_distinct("hashes")))
    out = out.withColumn("bits", F.expr("64 - length(regexp_replace(lpad(bin(n_windows), 64, '0'), '1.*$', ''))"))
    out = out.withColumn("low", F.expr("shiftleft(1L, bits) - 1"))
    out = out.withColumn(
        "packed",
        F.expr(
            "CASE WHEN n_kinds = n_windows THEN CAST(array() AS ARRAY<BIGINT>) ELSE "
            "sort_array(transform(hashes, (h, i) -> (h & ~low) | i)) END"
        ),
    )
    starts = """
        sort_array(array_compact(transform(packed, (p, i) -> CASE
            WHEN i > 0 AND shiftrightunsigned(p ^ packed[i - 1], bits) = 0 THEN p & low
            WHEN i < size(packed) - 1 AND shiftrightunsigned(p ^ packed[i + 1], bits) = 0 THEN p & low END)))"""
    out = out.withColumn("packed_kinds", F.expr("size(array_distinct(transform(packed, p -> p & ~low)))"))
    out = out.withColumn(
        "pairs",
        F.expr(
            "CASE WHEN n_kinds < n_windows AND packed_kinds < n_kinds THEN "
            "array_sort(transform(hashes, (h, i) -> struct(h AS h, CAST(i AS BIGINT) AS i))) END"
        ),
    )
    exact_starts = """
        sort_array(array_compact(transform(pairs, (p, i) -> CASE
            WHEN i > 0 AND p.h = pairs[i - 1].h THEN p.i
            WHEN i < size(pairs) - 1 AND p.h = pairs[i + 1].h THEN p.i END)))"""
    out = out.withColumn("starts", F.expr(f"CASE WHEN pairs IS NOT NULL THEN {exact_starts} ELSE {starts} END"))
    covered = """
        aggregate(transform(starts, (x, i) -> CASE WHEN i < size(starts) - 1 THEN least(3L, starts[i + 1] - x)
            ELSE 3L END), 0L, (a, b) -> a + b)"""
    return out.withColumn("n_repeat_words", F.expr(covered))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id, stratum`` and the counts named in ``STATS``, over the whole text.

    Words are runs of anything but blank and the control characters 9 to 13. A null text has no words; a text with fewer
    than four words has no repeated window. Nothing is shuffled.
    """
    where = F.lit("") if stratum is None else F.coalesce(stratum.cast("string"), F.lit(""))
    out = docs.select(quoted(id_col).alias("id"), where.alias("stratum"), text_or_empty(text_col).alias("text"))
    out = out.withColumn("words", F.array_remove(F.split("text", r"[ \t-\r]+"), ""))
    out = out.withColumn("lines", F.expr(r"filter(split(text, '\n'), l -> l RLIKE r'[^ \t-\r]')"))
    out = out.select(
        "id",
        "stratum",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.regexp_count("text", F.lit("!")).cast("bigint").alias("n_bangs"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
    )
    return _repeat_words(out).select("id", "stratum", *STATS)


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")


def _statistic(rule: str) -> Column:
    return F.coalesce(F.expr(f"try_divide({RULES[rule][0].replace(' / ', ', ')})"), F.lit(0.0))


def choose_cutoffs(
    stats: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    delta: float = DELTA,
    id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """One row per stratum and rule that got a cutoff: ``stratum, rule, cutoff, n_good, good_lost, bad_caught, p_value``.

    Only labelled documents that pass the base rules count. For each stratum, rule and candidate cutoff let k of n good
    documents be rejected. The cutoff is admitted if P(Binomial(n, a) <= k) <= d, the exact test of "rejects a share of a
    or more" with a = risk / rules. Corrections: d = delta / (strata x rules) by Bonferroni; the cutoffs of one rule are
    tested in a fixed order, lenient to strict, up to the first that fails, which needs no further correction. Any choice
    among the admitted ones keeps the guarantee; taken is the one that catches the most bad documents, a lost good one
    weighing ten times as much, the more lenient at ties, and none that catches nothing.

    ``stats`` is read several times and should be a written table, as in ``quality_rules``.

    Labels: several for one id count as good if any is; null ids or labels count for nothing. Without labels, or in a
    stratum too small to prove anything, there is no cutoff. Copies are counted as independent draws. The counts are
    summed before any shuffle; the sums are some 60 rows per stratum.
    """
    by_id = labels.select(quoted(id_col).alias("label_id"), quoted(label_col).alias("label")).dropna()
    by_id = by_id.groupBy("label_id").agg(F.max(F.col("label").cast("int")).alias("good"))
    known = stats.where(~base_failed()).join(by_id, F.col("id") == F.col("label_id"))
    passed = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum((F.when(_statistic(rule) > c, 1).otherwise(0) for c in cutoffs), F.lit(0)).alias("above"),
        )
        for rule, (_, cutoffs) in RULES.items()
    ]
    each = known.select("stratum", "good", F.explode(F.array(*passed)).alias("r")).select("stratum", "good", "r.*")
    sums = each.groupBy("stratum", "rule", "above").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    sums = written(sums, "rule-sums")
    n_strata = max(1, sums.select("stratum").distinct().count())
    allowed, level = risk / len(RULES), delta / (n_strata * len(RULES))

    # ``above`` counts the candidates below a statistic, which are the strictest ones, so the last in the order.
    ladder = F.create_map(*[x for r, (_, cs) in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, cs)))])
    tables = sums.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.collect_list(F.struct("above", "good", "bad")).alias("parts")
    )
    tables = tables.withColumn("cutoffs", ladder[F.col("rule")])
    steps = tables.select("stratum", "rule", "n_good", "parts", F.posexplode("cutoffs").alias("step", "cutoff"))
    sizes = F.create_map(*[x for r, (_, cs) in RULES.items() for x in (F.lit(r), F.lit(len(cs)))])
    steps = steps.withColumn("n_steps", sizes[F.col("rule")])
    steps = steps.withColumn("over", F.expr("filter(parts, p -> p.above >= n_steps - step)"))
    steps = steps.select(
        "stratum",
        "rule",
        "step",
        "cutoff",
        "n_good",
        F.expr("aggregate(over, 0L, (a, p) -> a + p.good)").alias("good_lost"),
        F.expr("aggregate(over, 0L, (a, p) -> a + p.bad)").alias("bad_caught"),
    )
    steps = steps.withColumn("p_value", binomial_tail(F.col("n_good"), F.col("good_lost"), allowed))
    tested = steps.groupBy("stratum", "rule").agg(
        F.min(F.when(F.col("p_value") > level, F.col("step"))).alias("failed_at"),
        F.collect_list(F.struct("step", "cutoff", "n_good", "good_lost", "bad_caught", "p_value")).alias("steps"),
    )
    admitted = tested.withColumn(
        "steps", F.expr("filter(steps, s -> s.step < coalesce(failed_at, 1000) AND s.bad_caught > 10 * s.good_lost)")
    )
    best = F.expr(
        "array_max(transform(steps, s -> struct(s.bad_caught - 10 * s.good_lost AS gain, -s.step AS lenient, s.cutoff, "
        "s.n_good, s.good_lost, s.bad_caught, s.p_value)))"
    )
    chosen = admitted.where(F.size("steps") > 0).withColumn("best", best)
    return chosen.select("stratum", "rule", "best.cutoff", "best.n_good", "best.good_lost", "best.bad_caught", "best.p_value")


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """P(Binomial(n, share) <= k), exact, summed down from k in logarithms; 1 where k is above the mean."""
    n, k = n.cast("bigint"), k.cast("bigint")
    whole = F.struct(n.alias("n"), k.alias("k"))
    held = F.transform(
        F.array(whole),
        lambda x: F.when(x["k"] > x["n"] * share, F.lit(1.0)).otherwise(_tail(x["n"], x["k"], share)),
    )
    return held[0]


def _tail(n: Column, k: Column, share: float) -> Column:
    up = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    ways = F.aggregate(up, F.lit(0.0), lambda a, j: a + F.log((n - j + 1) / j))
    odds = (1 - share) / share
    down = F.reverse(up)
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        term = a["term"] * j * odds / (n - j + 1)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    total = F.aggregate(down, zero, step, lambda a: a["sum"])
    return F.exp(ways + k * F.log(F.lit(share)) + (n - k) * F.log(F.lit(1 - share)) + F.log(total))


def judge(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds ``base_failed``, ``broken`` (the rules broken, sorted) and ``kept`` to statistics.

    The cutoffs are one small row per stratum with any. They are broadcast while there are 10,000 strata at most;
    beyond that Spark joins by shuffle, splitting large strata.
    """
    limits = cutoffs.groupBy(F.col("stratum").alias("of")).pivot("rule", list(RULES)).agg(F.min("cutoff"))
    limits = written(limits.toDF("of", *[f"most_{rule}" for rule in RULES]), "cutoffs")
    if limits.limit(10_001).count() <= 10_000:
        limits = F.broadcast(limits)
    joined = stats.join(limits, F.col("stratum") == F.col("of"), "left")
    broken = F.array_sort(
        F.array_compact(F.array(*[F.when(_statistic(r) > F.col(f"most_{r}"), F.lit(r)) for r in RULES]))
    )
    out = joined.withColumn("base_failed", base_failed()).withColumn("broken", broken)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop("of", *[f"most_{r}" for r in RULES])


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """One row per row of ``docs``: the id, its statistics, ``base_failed``, ``broken`` rules and ``kept``.

    The statistics are computed once and written (a few numbers a row), then read for the choice of cutoffs and for the
    verdicts. A null stratum is the stratum "". See ``statistics`` and ``choose_cutoffs`` for empty texts and labels.
    """
    stats = written(statistics(docs, id_col, text_col, quoted(stratum_col)), "quality")
    cutoffs = choose_cutoffs(stats, labels, risk, delta, id_col, label_col)
    return judge(stats, cutoffs).withColumnRenamed("id", id_col)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    A verdict follows from text and stratum alone, so rows are told by these; ids may be null or repeated. They serve
    only to find a row's label.
    """
    whole = docs.select(
        F.struct(quoted(id_col).alias("id"), text_sha(text_col).alias("sha")).alias("row"),
        quoted(text_col).alias("text"),
        quoted(stratum_col).alias("stratum"),
    )
    stats = statistics(whole, "row", "text", F.col("stratum"))
    stats = written(stats.select("id.id", "id.sha", *[c for c in stats.columns if c != "id"]), "quality")
    judged = judge(stats, choose_cutoffs(stats, labels, risk, delta, id_col, label_col))
    gone = written(judged.where("not kept").select("sha", "stratum").distinct(), "gone")
    own = [text_sha(text_col), F.coalesce(quoted(stratum_col).cast("string"), F.lit(""))]
    return by_keys(docs, gone, "left_anti", own)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {"op10_quality_rules": op10_quality_rules}
ORACLE_SQL: dict[str, str] = {}
