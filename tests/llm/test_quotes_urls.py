"""Units of messages and keys of urls against plain Python, and what very long or empty input gives."""

import random
import re
import time

from pyspark.sql import functions as F

from namewright.llm import quotes, url_filter

MESSAGE = "conv_id long, turn long, role string, text string"
RULES = "verdict string, host string, path string"


def _plain_units(text):
    said = []
    for i, line in enumerate(text.split("\n")):
        mark = re.match(r"([ \t]*>)*", line).group()
        rest = re.sub(r"^([ \t]*>)+ ?", "", line)
        if re.search(r"[^ \t-\r]", rest):
            said.append((mark.count(">"), rest, i))
    spans, run = [], 0
    for at, (level, _, i) in enumerate(said):
        new_run = at == 0 or said[at - 1][0] != level
        run += new_run
        spans.append((run, new_run, new_run or i > said[at - 1][2] + 1))
    units = []
    for at, (level, line, _) in enumerate(said):
        run, starts_run, starts_paragraph = spans[at]
        units.append((level, run, 2, at, line))
        for size, starts in ((0, starts_run), (1, starts_paragraph)):
            if starts:
                ends = [j for j in range(at + 1, len(said)) if spans[j][1 + size]]
                lines = [line for _, line, _ in said[at : ends[0] if ends else len(said)]]
                units.append((level, run, size, at, "\n".join(lines)))
    return sorted((*unit[:4], len(re.sub(r"[ \t-\r]+", " ", unit[4]).strip(" "))) for unit in units)


def test_units_by_plain_python(spark):
    draw = random.Random(3)
    parts = ["a b", "  c", "", "> d", ">> e", " > > f  g", ">", "> ", "\t", ">\th", "é x"]
    texts = ["\n".join(draw.choice(parts) for _ in range(draw.randrange(0, 14))) for _ in range(200)] + [""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for row in quotes.passages(df).collect():
        got = sorted((u.level, u.run, u.size, u.pos, u.chars) for u in row.units)
        assert got == _plain_units(texts[row.i]), texts[row.i]


def test_long_messages_take_linear_time(spark):
    lines = [("> " if i % 3 == 0 else "") + f"line {i}" + ("\n" if i % 5 == 0 else "") for i in range(100_000)]
    long = "\n".join(lines)
    df = spark.createDataFrame([(long,), (">" * 200_000 + " a",)], "text string")
    units = quotes.passages(df).select(F.size("units").alias("n"))
    units.collect()
    start = time.time()
    assert sorted(row.n for row in units.collect()) == [3, 240_000]
    assert time.time() - start < 10


def test_reply_order_of_odd_rows(spark):
    assert quotes.reply_order(spark.createDataFrame([], MESSAGE)).collect() == []
    rows = [(1, 0, "u", "hello there"), (1, 1, "a", "> hello there\nyes"), (1, 1, "a", "> hello there\nyes"), (None, 0, "u", "> x"), (1, None, None, None)]
    got = sorted((tuple(row) for row in quotes.reply_order(spark.createDataFrame(rows, MESSAGE)).collect()), key=repr)
    wanted = [(1, 0, "u", None, 0, 0, "hello there"), (1, 1, "a", 0, 0, 1, "yes"), (1, 1, "a", 0, 0, 1, "yes"), (1, None, None, None, None, 0, ""), (None, 0, "u", None, 0, 0, "")]
    assert got == sorted(wanted, key=repr)


def test_long_hosts_empty_tables_and_repeated_rows(spark):
    rules = spark.createDataFrame(list(url_filter.RULES), RULES)
    deep = "http://" + ".".join(["a"] * 8000)
    urls = [(1, deep + ".www.example.com/en/x"), (2, deep + ".net/fr/"), (3, deep), (4, "ftp://x..com"), (4, "ftp://x..com/"), (4, "ftp://x..com/"), (5, "http://com./")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = sorted((row.page_id, row.rule or "", row.verdict) for row in url_filter.judge_urls(pages, rules).collect())
    assert got == [
        (1, "www.example.com/en/", "allow"), (2, "net/fr/", "block"), (3, "", "allow"), (4, "", "allow"),
        (4, "com/", "allow"), (4, "com/", "allow"), (5, "", "allow"),
    ]
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []
    assert {row.verdict for row in url_filter.judge_urls(pages, rules.limit(0), unlisted="block").collect()} == {"block"}
