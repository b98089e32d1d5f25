"""Personal data: spans by rules, and more by a character BiLSTM with CRF transitions trained on them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namewright.llm.common import quoted, table, text_or_empty
from namewright.llm.tagger import Tagger, train_tagger

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")

#: Windows of so many characters, each beginning so many after the one before.
WINDOW = 96
STRIDE = 64
#: Documents, and characters of each around its first digit or @, that the model is trained on; read by hash order of ids.
TRAIN_DOCS = 400
TRAIN_CHARS = 960


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [x * 2 - 9 * (x > 4) for x in values[1::2]]) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain, found from each @ so that long words cost no repeated scans."""
    done = 0
    at = text.find("@")
    while at >= 0:
        low = at
        while low > done and (text[low - 1] in "._%+-" or text[low - 1].isascii() and text[low - 1].isalnum()):
            low -= 1
        domain = DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield low, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind: leftmost non-overlapping matches of each kind that pass its check."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(_small(x) for x in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2], s[1]))]


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def plausible(kind: str, text: str) -> bool:
    """What a span found by the model must look like to be kept; each form has a digit or an @."""
    digits = len(_digits(text))
    if kind == "email":
        return text.count("@") == 1 and bool(re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+( ?\. ?[^\s@]+)+", text))
    if kind == "ip":
        return bool(re.fullmatch(r"([0-9]{1,3} ?\. ?){3}[0-9]{1,3}", text)) and all(map(_small, re.split(r" ?\. ?", text)))
    if kind == "card":
        return 14 <= digits <= 19 and luhn(_digits(text)) and not re.search(r"[^0-9 ./-]", text)
    return 10 <= digits <= 15 and not re.search(r"[^0-9 ().+/-]", text) and bool(re.search(r"[ ().+/-]", text))


def variants(text: str, spans: list[tuple[int, int, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its spans written in ways that the rules miss: blanks in addresses, no plus, dots in cards."""
    out, marks, done, size = [], [], 0, 0
    for start, end, kind in spans:
        if start < done:
            continue
        span = text[start:end]
        if kind == "email":
            span = span.replace("@", " @ ", 1)
        elif kind == "ip":
            span = span.replace(".", " . ")
        elif kind == "card":
            digits = _digits(span)
            span = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            span = span.lstrip("+")
        out += [text[done:start], span]
        size += start - done
        marks.append((size, size + len(span), kind))
        size += len(span)
        done = end
    return "".join(out) + text[done:], marks


def training_texts(docs: DataFrame, id_col: str, text_col: str, n_docs: int, chars: int) -> list[str]:
    """Bounded pieces of texts around the first digit or @, from the documents whose hashed ids are smallest."""
    near = docs.select(F.xxhash64(F.to_json(F.struct(quoted(id_col)))).alias("h"), text_or_empty(text_col).alias("text"))
    near = near.withColumn("at", F.regexp_instr("text", F.lit("[0-9@]"))).where("at > 0")
    smallest = [r.h for r in near.select("h").orderBy("h").limit(n_docs).collect()]
    if not smallest:
        return []
    piece = F.substring("text", F.greatest(F.lit(1), F.col("at") - 160), F.lit(chars)).alias("piece")
    rows = near.where(F.col("h") <= smallest[-1]).select("h", piece).limit(2 * n_docs).collect()
    rows = sorted(set(rows))[:n_docs]
    return [r.piece for r in rows]


def train(texts: list[str], steps: int = 160, seed: int = 3) -> Tagger | None:
    """A tagger trained on the spans of the rules, as they are and as ``variants``; None if there are none."""
    labelled = [(t, base_spans(t)) for t in texts]
    labelled = [(t, s) for t, s in labelled if s]
    if not labelled:
        return None
    labelled += [variants(t, s) for t, s in labelled]
    windows = []
    for text, spans in labelled:
        tags = np.zeros(len(text), np.int64)
        for start, end, kind in spans:
            if not tags[start:end].any():
                k = KINDS.index(kind)
                tags[start:end] = 2 + 2 * k
                tags[start] = 1 + 2 * k
        codes = code_points(text)
        for at in range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE):
            if TRIGGER.search(text, at, at + WINDOW):
                windows.append((codes[at : at + WINDOW], tags[at : at + WINDOW]))
    return train_tagger(windows, 1 + 2 * len(KINDS), WINDOW, steps, seed)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def model_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """Spans of each text, whole texts: windows are decoded in batches and put together into one row of tags per text.

    Decoded are the windows with a digit or @, and for spans that reach over these the windows next to them. Where two
    windows with a digit or @ overlap, a tag of either holds, and of two tags that of the window whose middle is nearer:
    a window may see too little of a span to tag its part. Where only one has any, it decides all it sees, as the other
    cannot know what the characters before or after belong to.
    """
    where, codes, triggered = [], [], []
    for k, text in enumerate(texts):
        points = code_points(text)
        own: set[int] = set()
        last = -1
        for found in TRIGGER.finditer(text):
            # the windows over a position are the one beginning at a multiple of STRIDE at or before it, and maybe one more
            own.update(range(max(last + 1, 0, -(-(found.start() - WINDOW + 1) // STRIDE)), found.start() // STRIDE + 1))
            last = found.start() // STRIDE
        triggered.append(own)
        beside = {w + d for w in own for d in (-1, 1) if 0 <= w + d <= (len(text) - 1) // STRIDE} - own
        for w in [*sorted(beside), *sorted(own)]:  # what a window with a digit or @ says comes over what its neighbours say
            where.append((k, w))
            codes.append(points[w * STRIDE : w * STRIDE + WINDOW])
    tags = [np.zeros(len(text) if own else 0, np.int8) for text, own in zip(texts, triggered, strict=True)]
    both = np.arange(WINDOW) < WINDOW - STRIDE
    nearer = np.arange(WINDOW) < (WINDOW - STRIDE) // 2
    for begin in range(0, len(codes), 1024):
        decoded = tagger.decode(codes[begin : begin + 1024], WINDOW)
        for (k, w), row in zip(where[begin : begin + 1024], decoded, strict=True):
            here = tags[k][w * STRIDE : w * STRIDE + WINDOW]
            n = len(here)
            if w not in triggered[k] or w - 1 in triggered[k]:
                earlier = both[:n] & (here > 0) & (nearer[:n] | (row[:n] == 0))
                here[:] = np.where(earlier, here, row[:n])
            else:
                here[:] = row[:n]
            at = w * STRIDE
            if at and here[0] % 2 == 1 and (tags[k][at - 1] + 1) // 2 == (here[0] + 1) // 2:
                here[0] += 1  # goes on with the span that the window before ends in; a window has to begin one
    return [list(_spans(text, row)) for text, row in zip(texts, tags, strict=True)]


def _spans(text: str, tags: np.ndarray) -> Iterator[tuple[int, int, str]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (tags + 1) // 2, [0]])) | np.append(tags % 2 == 1, False))
    for start, end in zip(edges, edges[1:], strict=False):
        if tags[start]:
            start, end = int(start), int(end)
            kind = KINDS[(tags[start] - 1) // 2]
            while start < end and text[start].isspace():
                start += 1
            while end > start and text[end - 1].isspace():
                end -= 1
            if plausible(kind, text[start:end]):
                yield start, end, kind


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_docs: int = TRAIN_DOCS,
    train_chars: int = TRAIN_CHARS,
    with_text: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``, an array of ``(kind, start, end, base)`` by start, then kind.

    Spans of the rules have ``base`` true. The model adds spans that overlap none of them. It is trained on a bounded
    sample (``train_docs`` pieces of ``train_chars`` characters) on the driver and sent to the tasks, a few KB. Whole
    texts are searched; offsets count code points, the end excluded. With ``with_text`` the redacted text comes along as
    ``redacted``: every span, or chain of overlapping ones, replaced by the first kind's name in angle brackets.

    A null text counts as empty and has no spans; in ``redacted`` it stays null. Nothing is shuffled, repeated rows are
    treated alike, and without any span to learn from the rules work alone.
    """
    tagger = train(training_texts(docs, id_col, text_col, train_docs, train_chars))
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    source = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    kinds = {"kind": T.StringType(), "start": T.LongType(), "end": T.LongType(), "base": T.BooleanType()}
    spans_type = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in kinds.items()]))
    schema = T.StructType([source.schema["id"], T.StructField("spans", spans_type)])
    if with_text:
        schema = schema.add("redacted", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                yield found(batch.slice(begin, 500))

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        spans = [[] for _ in texts]
        some = [k for k, text in enumerate(texts) if text and TRIGGER.search(text)]
        for k in some:
            spans[k] = [(*s, True) for s in base_spans(texts[k])]
        if shared.value is not None:
            for k, more in zip(some, model_spans(shared.value, [texts[k] for k in some]), strict=True):
                base = spans[k]
                spans[k] = base + [(*s, False) for s in more if all(s[1] <= b[0] or s[0] >= b[1] for b in base)]
                spans[k].sort(key=lambda s: (s[0], KINDS.index(s[2])))
        rows = [[{"kind": c, "start": a, "end": b, "base": base} for a, b, c, base in one] for one in spans]
        columns = [batch.column("id"), pa.array(rows, pa.list_(span))]
        names = ["id", "spans"]
        if with_text:
            columns.append(pa.array([redacted(t, s) for t, s in zip(texts, spans, strict=True)], pa.string()))
            names.append("redacted")
        return pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redacted(text: str | None, spans: list[tuple]) -> str | None:
    if not spans:
        return text
    out, done = [], 0
    for start, end, kind, *_ in spans:
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in the texts replaced and, if there is such a column, the length set anew.

    All columns pass through the task that searches the text, so rows need no id to be matched again.
    """
    rest = [c for c in docs.columns if c != text_col]
    whole = docs.select(F.struct(F.lit(0).alias("_"), *[quoted(c) for c in rest]).alias("row"), quoted(text_col).alias("text"))
    found = find_pii(whole, "row", "text", with_text=True)
    columns = []
    for name in docs.columns:
        if name == text_col:
            columns.append(F.col("redacted").alias(name))
        elif name == length_col:
            size = F.coalesce(F.length("redacted"), F.lit(0)).cast(docs.schema[name].dataType)
            columns.append(F.when(F.size("spans") > 0, size).otherwise(F.col("row").getField(name)).alias(name))
        else:
            columns.append(F.col("row").getField(name).alias(name))
    return found.select(*columns)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {"op3_pii": op3_pii}
ORACLE_SQL: dict[str, str] = {}
