"""Toxicity by compression distance: is a window shorter with a dictionary of toxic or of ordinary text?"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm.common import BROADCAST_IDS, quoted, table

WINDOW = 128  # bytes
LEVEL = 6
#: Bytes of each class's own dictionary, and of the part that both share.
OWN_BYTES, SHARED_BYTES = 824, 32_768
#: Labelled documents that the dictionaries, and as many again that the thresholds are fitted on, per class; only
#: documents of at most SAMPLE_CHARS characters are taken, in the order of their hashed ids.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 1500, 4500, 20_000
#: Documents of a sample at least, and share of it, in which a word must occur to tell its class from the other, and how
#: many times as often as there.
LEAST_DOCS, LEAST_SHARE, RATIO = 3, 0.008, 4
THRESHOLD = 0.3


def windows(text: str) -> list[bytes]:
    data = text.lower().encode()
    return [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)]


def _words(text: str) -> list[str]:
    return [w.strip(".,;:!?") for w in text.lower().split()]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


@dataclass
class Model:
    """Two dictionaries and the weights that turn a document's window differences into a score."""

    toxic: bytes
    ordinary: bytes
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scorer(self):
        toxic, ordinary = _compressor(self.toxic), _compressor(self.ordinary)

        def score(text: str) -> float:
            x = (features(text, toxic, ordinary) - self.center) / self.scale
            return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30))))

        return score


def features(text: str, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> np.ndarray:
    """Of the bytes that the toxic dictionary saves per window: the mean, the mean of savings, the mean of the top tenth."""
    saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)] or [0])
    top = np.sort(saved)[-max(1, len(saved) // 10) :]
    return np.array([saved.mean(), np.maximum(saved, 0).mean(), top.mean()])


def _trained(pieces: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the joined pieces where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, pieces, k=24 if size < 4096 else 64, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(pieces)[-size:]


def _telling(texts: list[str], own: Counter, other: Counter, n_other: int) -> list[bytes]:
    """What is left of texts when only words remain that are far more frequent in their class; in windows."""
    n = len(texts)
    least = max(LEAST_DOCS, LEAST_SHARE * n)
    keep = {w for w, c in own.items() if c >= least and c * n_other >= RATIO * n * (other[w] + 0.5)}
    rest = " ".join(w for t in texts for w in _words(t) if w in keep).encode()
    return [rest[i : i + WINDOW] for i in range(0, len(rest), WINDOW)][:30_000]


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """A dictionary of each class: trained on what tells its texts from the other's, before a part that both share.

    The shared part, trained on windows of ordinary text, cancels what all texts have in common out of the difference.
    Equal texts count once.
    """
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    in_toxic, in_ordinary = (Counter(w for t in texts for w in set(_words(t))) for texts in (toxic, ordinary))
    every = [w for t in ordinary for w in windows(t)]
    random.Random(0).shuffle(every)
    shared = _trained(every[:30_000], SHARED_BYTES)
    own = _trained(_telling(toxic, in_toxic, in_ordinary, len(ordinary)), OWN_BYTES)
    other = _trained(_telling(ordinary, in_ordinary, in_toxic, len(toxic)), OWN_BYTES)
    return own + shared, other + shared


def fit(train: list[tuple[str, int]], calibrate: list[tuple[str, int]]) -> Model | None:
    """Dictionaries from one sample, weights (ridge logistic regression by Newton steps) from the other.

    None without texts of both classes in each.
    """
    if any({y for _, y in rows} != {0, 1} for rows in (train, calibrate)):
        return None
    own, other = train_dictionaries([t for t, y in train if y], [t for t, y in train if not y])
    toxic, ordinary = _compressor(own), _compressor(other)
    x = np.array([features(t, toxic, ordinary) for t, _ in calibrate])
    y = np.array([y for _, y in calibrate], float)
    center, scale = x.mean(0), x.std(0) + 1e-9
    x = np.column_stack([np.ones(len(x)), (x - center) / scale])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + 0.1 * weights
        weights -= np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(weights)), slope)
    return Model(own, other, center, scale, weights)


def fold(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(quoted(id_col).cast("string").cast("binary")), F.lit(4)), F.lit(0))


def samples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[list[tuple[str, int]]]:
    """Two bounded samples of labelled texts, folds 0 and 3, and fold 1; ids are chosen first, then texts looked up."""
    by_id = labels.select(quoted(id_col).alias("l"), quoted(label_col).cast("int").alias("y")).dropna()
    by_id = by_id.groupBy("l").agg(F.max("y").alias("y")).withColumn("fold", fold("l")).where("fold <> 2")
    chosen = None
    for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        for part in ("fold <> 1", "fold = 1"):
            some = by_id.where(f"y = {y} AND {part}").orderBy(F.xxhash64("l"), "l").limit(n)
            chosen = some if chosen is None else chosen.union(some)
    assert 2 * (SAMPLE_TOXIC + SAMPLE_ORDINARY) <= BROADCAST_IDS
    rows = docs.join(F.broadcast(chosen), quoted(id_col) == F.col("l")).where(F.length(quoted(text_col)) <= SAMPLE_CHARS)
    rows = rows.select("l", quoted(text_col).cast("string").alias("t"), "y", "fold").collect()
    rows.sort(key=lambda r: (r.l, r.t))
    return [[(r.t, r.y) for r in rows if (r.fold == 1) == held] for held in (False, True)]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """One row per row of ``docs``: ``id, held_out, score, predicted``.

    Whole texts are cut into windows and compressed with either dictionary; the differences of the lengths, summed up
    as in ``features``, give the score. ``predicted`` is 1 from a score of ``THRESHOLD``. Rows with crc32(id) mod 4 = 2
    are held out: no label of theirs is read. The model is fitted on the driver, on at most 12,000 texts, and broadcast
    (70 KB). Nothing is shuffled but labels and the choice of ids.

    A null or empty text scores as one without any difference. Several labels of an id count as their greatest, null
    ones as none; without labels of both classes every score is 0. Repeated rows are scored alike.
    """
    train, calibrate = samples(docs, labels, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit(train, calibrate))
    held_out = (fold(id_col) == 2).alias("held_out")
    source = docs.select(quoted(id_col).alias("id"), held_out, quoted(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer() if shared.value is not None else lambda text: 0.0
        for batch in batches:
            scores = [score(text.as_py() or "") for text in batch.column("text")]
            predicted = [int(s >= THRESHOLD) for s in scores]
            columns = [*batch.columns[:2], pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "score", "predicted"])

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE_SQL: dict[str, str] = {}
