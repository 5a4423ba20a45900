"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

A text becomes counts of hashed unigrams and bigrams, scaled to length one; its
score is the logistic function of a sparse dot product with the weights.  Words
are runs of letters and digits, and runs of other marks; a word that repeats
the one before it is the token ``REPEAT``, so runs of any word look alike.

Training reads labelled rows only, at most ``max_rows`` of them in the order of
a hash of their id (a documented bound, so one task can stream them); features
are computed in parallel, then one task runs the updates in a fixed order, one
pass an epoch.  Scoring covers every row without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import text_of, without

DIMENSIONS = 1 << 18
BIAS = 0
REPEAT = "\x00repeat"
_WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_MULTIPLIER = 0x9E3779B1


class Hasher:
    """Word hashes, remembered for one worker (the memory is emptied when full)."""

    def __init__(self, keep: int = 500_000):
        self._known: dict[str, int] = {}
        self._keep = keep

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(index, value) of the text's n-grams: counts scaled to length one, and the constant."""
        words = _WORD.findall(text.lower())
        known = self._known
        if len(known) > self._keep:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = zlib.crc32(w.encode())
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(hashes) > 1:
            again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
            hashes[again] = zlib.crc32(REPEAT.encode())
        pairs = (hashes[:-1] * np.uint64(_MULTIPLIER) + hashes[1:]) % np.uint64(2**32) if len(hashes) else hashes
        grams = np.concatenate([hashes % np.uint64(DIMENSIONS - 1), (pairs ^ pairs >> np.uint64(15)) % np.uint64(DIMENSIONS - 1)])
        index, count = np.unique(grams.astype(np.int32) + 1, return_counts=True)
        value = count / np.sqrt(np.square(count, dtype=np.float64).sum()) if len(count) else count
        return np.append(index, BIAS).astype(np.int32), np.append(value, 1.0)


@dataclass(frozen=True)
class Ftrl:
    """Settings of the update: step size, smoothing, and the two penalties."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.01

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, z: np.ndarray, n: np.ndarray, index: np.ndarray, value: np.ndarray, label: int) -> None:
        """Follow the regularised leader by one example (``z`` and ``n`` change in place)."""
        w = self.weights(z[index], n[index])
        g = (_logistic(w @ value) - label) * value
        old = n[index]
        n[index] = old + g * g
        z[index] += g - (np.sqrt(n[index]) - np.sqrt(old)) / self.alpha * w


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def held_out(id_col: str = "doc_id"):
    """The fold that is never learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = 20_000,
    epochs: int = 3,
    settings: Ftrl | None = None,
) -> np.ndarray:
    """Weights (float64, ``DIMENSIONS`` long) learned from labelled rows outside the held-out fold.

    Labels other than 0 and 1 and NULL ids are passed over; an id labelled both
    ways counts as 0; without a labelled row all weights are zero.
    """
    rule = settings or Ftrl()
    sample = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_qid"))
        .agg(F.min(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("_qid"), "_qid")
        .limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text")).join(
        F.broadcast(sample), F.col("_id") == F.col("_qid")  # at most max_rows rows of two numbers
    )
    wide = T.StructType(
        [T.StructField("turn", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("i", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.DoubleType()))]
    )

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            found = [hasher.features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("turn"), b.column("label"), pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.list_(pa.float64()))],
                names=wide.names,
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
        for b in batches:
            for label, i, x in zip(b.column("label").to_pylist(), b.column("i"), b.column("x"), strict=True):
                rule.update(z, n, i.values.to_numpy(), x.values.to_numpy(), label)
        w = rule.weights(z, n)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], names=["at", "w"])

    examples = rows.select(F.xxhash64("_id").alias("turn"), "label", "text").mapInArrow(featurise, wide)
    in_turn = (
        examples.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
        .repartition(1)
        .sortWithinPartitions("epoch", "turn", F.xxhash64("i"))
        .select("label", "i", "x")
    )
    weights = np.zeros(DIMENSIONS)
    for at, w in in_turn.mapInArrow(learn, "at long, w double").toPandas().itertuples(index=False):  # at most DIMENSIONS rows
        weights[int(at)] = w
    return weights


def score(
    docs: DataFrame,
    weights: np.ndarray,
    threshold: float = 0.7,
    text_col: str = "text",
    score_col: str = "score",
    predicted_col: str = "predicted",
) -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1) and ``predicted_col`` (1 from ``threshold`` on).

    Every row is scored on its whole text; a NULL or empty text has the score
    of the constant alone; columns named like the results give way to them.
    """
    kept = without(docs, [score_col, predicted_col])
    out = T.StructType([*kept.schema, T.StructField(score_col, T.DoubleType()), T.StructField(predicted_col, T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = [c.lower() for c in kept.columns].index(text_col.lower())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(), shared.value
        for b in batches:
            s = np.empty(b.num_rows)
            for k, t in enumerate(b.column(at)):
                i, x = hasher.features(t.as_py() or "")
                s[k] = w[i] @ x
            s = _logistic(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array(s >= threshold).cast(pa.int32())], names=out.names)

    return kept.mapInArrow(rows, out)
