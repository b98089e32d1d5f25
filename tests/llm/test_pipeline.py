"""Quality verdicts, personal data and the pipeline against plain Python over whole tables."""

import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from namewright.llm import packing, pii, quality
from namewright.llm.common import table, written
from namewright.llm.vocab import byte_bpe

from .test_minhash import _brute

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _rows(sf_dir, sql):
    return duckdb.sql(sql.format(documents=f"'{sf_dir}/documents.parquet'", labels=f"'{sf_dir}/labels.parquet'")).fetchall()


def _counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_bangs": text.count("!"),
        "n_capitals": sum(unicodedata.category(c) == "Lu" for c in text),
    }


def _value(rule, counts):
    above, below = quality.RULES[rule][0].split(" / ")
    return counts[above] / counts[below] if counts[below] else 0.0


def _failed(counts):
    return counts["n_words"] < 50 or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]


def _cutoffs(counts, langs, labels):
    """Every cutoff of the fixed order tested with exact sums, until the first failure."""
    by_lang = defaultdict(list)
    for doc, good in labels.items():
        if doc in counts and not _failed(counts[doc]):
            by_lang[langs[doc]].append((good, counts[doc]))
    risk, level = quality.RISK / len(quality.RULES), quality.DELTA / (max(1, len(by_lang)) * len(quality.RULES))
    chosen = {}
    for lang, known in by_lang.items():
        n = sum(good for good, _ in known)
        for rule, (_, ladder) in quality.RULES.items():
            best = None
            for cutoff in ladder:
                over = Counter(good for good, c in known if _value(rule, c) > cutoff)
                p = math.fsum(math.comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(over[1] + 1))
                if p > level:
                    break
                gain = over[0] - 10 * over[1]
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, cutoff
            if best:
                chosen[lang, rule] = best[1]
    return chosen


def _judged(sf_dir):
    docs = _rows(sf_dir, "SELECT doc_id, text, lang FROM {documents}")
    labels = dict(_rows(sf_dir, "SELECT doc_id, max(quality) FROM {labels} WHERE quality IS NOT NULL GROUP BY 1"))
    counts, langs = {i: _counts(t) for i, t, _ in docs}, {i: lang or "" for i, _, lang in docs}
    cutoffs = _cutoffs(counts, langs, labels)
    kept = {
        i: not _failed(c) and not any(_value(r, c) > most for (lang, r), most in cutoffs.items() if lang == langs[i])
        for i, c in counts.items()
    }
    return counts, cutoffs, kept


def test_quality_by_brute_force(spark):
    counts, cutoffs, kept = _judged(MEDIUM)
    stats = written(quality.statistics(table(spark, MEDIUM, "documents"), stratum=F.col("lang")), "test-quality")
    chosen = quality.choose_cutoffs(stats, table(spark, MEDIUM, "labels")).collect()
    assert {(r.stratum, r.rule): r.cutoff for r in chosen} == cutoffs
    for r in quality.op10_quality_rules(spark, MEDIUM).collect():
        own = counts[r.doc_id]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [
            own[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ]
        assert (r.base_failed, r.kept) == (_failed(own), kept.pop(r.doc_id))
    assert not kept


@pytest.mark.parametrize(("n", "k", "share"), [(0, 0, 0.01), (300, 0, 0.01), (1000, 2, 0.005), (20_000, 40, 0.0033)])
def test_binomial_tail_is_exact(spark, n, k, share):
    row = spark.createDataFrame([(n, k)], "n long, k long")
    got = row.select(quality.binomial_tail(F.col("n"), F.col("k"), share)).first()[0]
    wanted = math.fsum(
        math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(share) + (n - j) * math.log1p(-share))
        for j in range(k + 1)
    )
    assert got == pytest.approx(wanted, rel=1e-6)


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _matches(pattern, text):
    """finditer, but runs of an address's characters without "@" are not tried from each of their places."""
    runs = re.finditer(r"[A-Za-z0-9._%+@-]+", text) if "@" in pattern else [re.match("(?s).*", text)]
    for run in runs:
        if "@" in run[0] or "@" not in pattern:
            yield from ((run.start() + m.start(), run.start() + m.end()) for m in re.finditer(pattern, run[0]))


def _base(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for start, end in _matches(pattern, text or ""):
            found = text[start:end]
            digits = re.sub("[^0-9]", "", found)
            if kind == "ip" and any(int(part) > 255 for part in found.split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((start, order, end, kind))
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def test_base_spans_by_brute_force(spark):
    texts = dict(_rows(MEDIUM, "SELECT doc_id, text FROM {documents}"))
    found = pii.op3_pii(spark, MEDIUM).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        base = _base(texts[r.doc_id])
        joined = [f"{kind}:{start}:{end}" for kind, start, end in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        kinds = Counter(kind for kind, _, _ in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert set(joined) <= set(r.spans.split(","))


def test_pipeline_stage_by_stage_and_as_a_whole(spark):
    docs = table(spark, SMALL, "documents")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    _, _, kept = _judged(SMALL)
    wanted = {i for i, good in kept.items() if good}
    last = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        if name == "exact_dedup":
            newest = {}
            for i in sorted(last):
                newest[last[i] or ""] = i
            wanted = set(newest.values())
        elif name == "near_dedup":
            wanted = {i for i, _, _, stays in _brute(sorted(last.items()), 80) if stays}
        got = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(got) and set(got) == wanted
        if name == "pii":
            for i, text in got.items():
                assert (text == last[i]) or re.search("<(EMAIL|IP|CARD|PHONE)>", text)
                assert not any(last[i][start:end] in text for kind, start, end in _base(last[i]) if kind == "email")
        else:
            assert all(text == texts[i] for i, text in got.items())
        last = got
    assert len(last) < len(texts)
    pieces = defaultdict(list)
    rows = corpus_pipeline.run(spark, SMALL).collect()
    for r in rows:
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert set(pieces) == set(last)
    encode = byte_bpe()
    for i, text in last.items():
        assert sum((ids for _, ids in sorted(pieces[i])), []) == [*encode(text or "").tolist(), packing.END_ID]
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    assert all(n <= 2048 and (n == 2048 or n.bit_count() == 1) for n in sizes.values())
