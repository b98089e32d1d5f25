"""Replies and what they quote: conversations in reply order without quotations; built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.common import quoted, table, text_or_empty, written


def _normalised(text: str) -> str:
    return rf"lower(trim(regexp_replace({text}, r'[ \t-\r]+', ' ')))"


def passages(messages: DataFrame) -> DataFrame:
    """Adds ``own``, the text without quotations, and ``units``, an array of ``(level, run, size, pos, h, chars)``.

    A line's level is the number of ``>`` before its text, with blanks between or not. A run is an unbroken run of lines
    of one level; lines without text break none. Units are each run (size 0), its paragraphs, which a line without text
    ends (1), and its lines (2); those without text are left out. Of a unit's text, lower-cased and with white space as
    one blank, the hash and the length are kept. ``own`` has all lines of level 0, blank ones too, but is empty if there
    are quotations only. A message is split on its own, run by run, in time linear in its length; nothing is shuffled.
    """
    # Possessive, so that a line of very many marks takes no deep recursion.
    lines = F.expr(r"""
        transform(split(text, '\n'), l -> struct(
            length(regexp_replace(regexp_extract(l, r'^(?:[ \t]*+>)*+', 0), '[^>]', '')) AS level,
            regexp_replace(l, r'^(?:[ \t]*+>)++ ?', '') AS line))""")
    out = messages.withColumn("every", lines)
    out = out.withColumn("said", F.expr(r"filter(transform(every, (x, i) -> struct(x.level, x.line, i)), x -> x.line RLIKE r'[^ \t-\r]')"))
    out = out.withColumn("n", F.size("said"))
    out = out.withColumn("runs", F.expr("filter(sequence(0, n), i -> i < n AND (i = 0 OR said[i].level <> said[i - 1].level))"))

    def unit(size: int, pos: str, text: str) -> str:
        return f"struct(r.level AS level, r.run AS run, {size} AS size, {pos} AS pos, {_normalised(text)} AS text)"

    def joined(start: str, end: str) -> str:
        return rf"array_join(transform(slice(said, {start} + 1, {end} - {start}), x -> x.line), '\n')"

    # An array of one item gives a name to a value that is used many times.
    starts = "filter(sequence(r.first, r.end - 1), i -> i = r.first OR said[i].i > said[i - 1].i + 1)"
    paragraphs = f"transform(array({starts}), ps -> transform(ps, (p, m) -> {unit(1, 'p', joined('p', 'coalesce(get(ps, m + 1), r.end)'))}))[0]"
    each = f"transform(slice(said, r.first + 1, r.end - r.first), (x, j) -> {unit(2, 'r.first + j', 'x.line')})"
    spans = "transform(runs, (s, k) -> struct(said[s].level AS level, k + 1 AS run, s AS first, coalesce(get(runs, k + 1), n) AS end))"
    out = out.withColumn("spans", F.expr(spans))
    parts = f"transform(spans, r -> concat(array({unit(0, 'r.first', joined('r.first', 'r.end'))}), {paragraphs}, {each}))"
    hashed = f"transform(flatten({parts}), u -> struct(u.level, u.run, u.size, u.pos, xxhash64(u.text) AS h, length(u.text) AS chars))"
    out = out.withColumn("units", F.expr(hashed))
    own = r"""
        CASE WHEN exists(every, x -> x.level > 0) AND NOT exists(said, x -> x.level = 0) THEN ''
        ELSE array_join(transform(filter(every, x -> x.level = 0), x -> x.line), '\n') END"""
    return out.withColumn("own", F.expr(own)).drop("every", "said", "n", "runs", "spans")


def reply_order(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per message, in reply order: ``conv, turn, role, parent_turn, thread, depth, text``.

    A message's parent is the earliest message of its conversation that says, in its own words, the first passage it
    quotes at level 1, if that message comes before it. Passages, that is runs, paragraphs and lines, are compared by a
    hash of the lower-cased text with white space as one blank. First counts a quoted run that is a whole run of the
    original, or any part that one message alone says; then, the longest first, parts that several messages say. A
    quoted passage without an original gives the next one its chance, then those at deeper levels. ``thread`` is the turn of the message at the end of the chain of parents and ``depth`` its length.
    Ordered by ``thread, depth, turn`` in a conversation, a message stands after the one it answers; ``text`` holds its
    own lines without quotations, blank ones included.

    Originals are reduced to one row per run, paragraph or line before the shuffle, so a phrase said a million times costs a row per
    task. Chains are followed by doubling, each round written. Nothing gathers a conversation in one place; the order is
    a sort by range. Messages with a null conversation or turn are kept, without parent. A null or empty text, or one
    of quotations only, has an empty text. Rows with the same conversation and turn get the same parent, and answer as
    one message: the parent of the pair is the smallest found.
    """
    source = messages.select(
        quoted(conv_col).alias("conv"),
        quoted(turn_col).cast("bigint").alias("turn"),
        quoted(role_col).alias("role"),
        text_or_empty(text_col).alias("text"),
    )
    split = passages(source)
    split = written(split.select("conv", "turn", "role", F.col("own").alias("text"), "units"), "messages")

    units = split.select("conv", "turn", F.explode("units").alias("p"))
    units = units.select("conv", "turn", "p.*")
    whole = F.min(F.when(F.col("size") == 0, F.col("turn"))).alias("whole")
    originals = units.where("level = 0").groupBy("conv", "h").agg(F.min("turn").alias("first"), F.max("turn").alias("last"), whole)
    originals = written(originals, "originals")
    found = units.where("level > 0").join(originals, ["conv", "h"]).where("first < turn")
    is_whole = (F.col("size") == 0) & F.coalesce(F.col("whole") < F.col("turn"), F.lit(False))
    found = found.withColumn("origin", F.when(is_whole, F.col("whole")).otherwise(F.col("first")))
    found = found.withColumn("weak", ~(is_whole | (F.col("first") == F.col("last"))))
    rank = F.when(F.col("weak"), -F.col("chars")).otherwise(0).alias("rank")
    best = F.min(F.struct("level", "weak", rank, "run", "size", "pos", "origin")).alias("best")
    parents = found.groupBy("conv", "turn").agg(best).select("conv", "turn", F.col("best.origin").alias("parent"))
    parents = written(parents, "parents")

    chain = parents.select("conv", "turn", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("depth"))
    while True:
        above = chain.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        step = chain.join(above, ["conv", "up"], "left")
        step = step.select(
            "conv",
            "turn",
            F.coalesce("next", "up").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        step = written(step, "chains")
        chain = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    links = chain.join(parents, ["conv", "turn"])
    out = split.select("conv", "turn", "role", "text").join(links, ["conv", "turn"], "left")
    out = out.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("parent").alias("parent_turn"),
        F.coalesce("up", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0).cast("bigint")).alias("depth"),
        F.col("text").alias(text_col),
    )
    return out.orderBy(quoted(conv_col), "thread", "depth", quoted(turn_col))


def quoting_view(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: each message but the first quotes an earlier one, and what that one answers.

    The given texts have no quotations, so this view adds them: message t answers message crc32('conv:t') mod t. A third
    quotes all of it, a third its last line, and a third its first line, says its own first line, and quotes the last
    line before the rest.
    """
    answered = F.expr("pmod(crc32(encode(concat(conv_id, ':', turn), 'UTF-8')), turn)")
    base = conversations.select("conv_id", "turn", "role", "text").withColumn("to", F.when(F.col("turn") > 0, answered))
    up = base.select("conv_id", F.col("turn").alias("to"), F.col("text").alias("up_text"), F.col("to").alias("to2"))
    up2 = base.select("conv_id", F.col("turn").alias("to2"), F.col("text").alias("up2_text"))
    out = base.join(up, ["conv_id", "to"], "left").join(up2, ["conv_id", "to2"], "left")
    quote = lambda text, mark: F.concat(F.lit(mark), F.regexp_replace(text, "\n", "\n" + mark), F.lit("\n"))
    nothing = F.lit("")
    text, above = F.col("text"), F.col("up_text")
    first, last = F.substring_index(above, "\n", 1), F.substring_index(above, "\n", -1)
    how = F.expr("pmod(crc32(encode(concat(turn, ':', conv_id), 'UTF-8')), 3)")
    between = (how == 2) & above.contains("\n") & text.contains("\n")
    direct = F.when(how == 1, quote(last, "> ")).when(between, quote(first, "> ")).otherwise(quote(above, "> "))
    own_first = F.concat(F.substring_index(text, "\n", 1), F.lit("\n"))
    own = F.when(between, F.concat(own_first, quote(last, "> "), F.expr("substring(text, instr(text, '\n') + 1)"))).otherwise(text)
    mail = F.concat(F.coalesce(quote(F.col("up2_text"), "> > "), nothing), F.coalesce(direct, nothing), own)
    return out.select("conv_id", "turn", "role", mail.alias("text"))


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_order(quoting_view(table(spark, sf_dir, "conversations")))


QUERIES = {"op9_quotation_linking": op9_quotation_linking}
ORACLE_SQL: dict[str, str] = {}
