"""Correlated features: a blockwise Gram matrix and a rank-ordered independent set, both on the data's side (M8).

* Gram.  Rows are packed into binary blocks once; every task multiplies its blocks and hands on one row of the
  product for each feature, which are added up by feature.  The p x p matrix is never whole anywhere: features are
  worked on in stripes of at most ``STRIPE_BYTES`` of products a task, a row of the sum becomes its strong pairs where
  it is added up, and only means and variances (two vectors of length p) reach the driver.
* Choice.  Features claim their place from the strongest on, and none is kept beside a stronger kept one that it
  correlates with.  That is an independent set in rank order: in each round every feature without an undecided
  stronger rival is kept and its weaker rivals are dropped, which takes as many rounds as the longest chain of
  ever weaker undecided rivals.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.operators.partials import add_up, sum_vectors
from riskfold.session import materialise

#: Rows of a block, tasks that hold products, and bytes of products a task holds at once.
BLOCK_ROWS, GRAM_TASKS, STRIPE_BYTES = 1_024, 512, 64 << 20


def _blocks(filled: DataFrame) -> DataFrame:
    """(n, x): the rows of the only column of ``filled`` (arrays without NULL), up to ``BLOCK_ROWS`` together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.column(0).slice(at, BLOCK_ROWS)
                data = np.ascontiguousarray(part.flatten().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([data.tobytes()], pa.binary())], names=["n", "x"])

    return filled.mapInArrow(pack, "n int, x binary")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        for n, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            yield np.frombuffer(x.as_buffer()).reshape(n, -1)


def _sums(blocks: DataFrame, of) -> np.ndarray:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _arrays(batches):
            v = of(x)
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    return sum_vectors(blocks.mapInArrow(part, "v binary"))


def strong_pairs(rows: DataFrame, features: Sequence[str], threshold: float, fill: Sequence[float | None]) -> DataFrame:
    """(feature_a, feature_b, abs_corr) for all pairs of ``features`` with |Pearson| of ``threshold`` or more.

    ``feature_a`` comes before ``feature_b`` in ``features``; a NULL (or NaN) value reads as its feature's ``fill``
    (0 where that is None).  Constant features correlate with nothing; no rows or one feature give no pairs.
    """
    spark, p = rows.sparkSession, len(features)
    empty = spark.createDataFrame([], "feature_a string, feature_b string, abs_corr double")
    if p < 2:
        return empty
    value = lambda f, v: F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")), F.lit(float(v or 0.0)))
    filled = rows.select(F.array(*[value(f, v) for f, v in zip(features, fill, strict=True)]).alias("x"))
    blocks = materialise(_blocks(filled), "gram-blocks")
    blocks = blocks.coalesce(min(GRAM_TASKS, max(blocks.rdd.getNumPartitions(), 1)))
    sums = _sums(blocks, lambda x: np.append(x.sum(axis=0), len(x)))
    if not len(sums):
        return empty
    mean = sums[:p] / sums[p]
    spread = _sums(blocks, lambda x: ((x - mean) ** 2).sum(axis=0))
    # the rounding of a constant column's mean is no spread
    live = spread > (np.abs(mean) * 1e-12) ** 2 * sums[p]
    scale = np.where(live, 1.0 / np.sqrt(np.where(live, spread, 1.0)), 0.0)
    width = max(1, STRIPE_BYTES // (8 * p))
    found = empty
    for first in range(0, p - 1, width):
        found = found.unionByName(_stripe(blocks, features, first, min(first + width, p), mean, scale, threshold))
    return found


def _stripe(blocks: DataFrame, features: Sequence[str], first: int, end: int, mean: np.ndarray, scale: np.ndarray, threshold: float) -> DataFrame:
    """The strong pairs whose first feature has a number from ``first`` to ``end``."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _arrays(batches):
            z = (x - mean) * scale
            part = z[:, first:end].T @ z
            total = part if total is None else total + part
        if total is not None:
            at = pa.array(np.arange(first, end), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([row.tobytes() for row in total], pa.binary())], names=["i", "v"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, corr in add_up(batches):
            corr = np.abs(corr)
            for j in np.flatnonzero(corr >= threshold):
                if j > i:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([features[i]]), pa.array([features[j]]), pa.array([min(float(corr[j]), 1.0)])], names=["feature_a", "feature_b", "abs_corr"]
                    )

    rows = blocks.mapInArrow(products, "i int, v binary")
    return rows.repartition("i").sortWithinPartitions("i").mapInArrow(pairs, "feature_a string, feature_b string, abs_corr double")


def rank_ordered_choice(strengths: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Which features stay when no two kept ones may correlate by ``threshold`` or more.

    ``strengths``: (candidate_feature, strength), a row a feature; ``pairs``: (feature_a, feature_b, abs_corr).
    The stronger of two goes first (ties: the smaller name; NULL is the weakest).  A dropped feature names the
    strongest kept one that rules it out.
    """
    strength = F.coalesce(F.col("strength"), F.lit(float("-inf")))
    nodes = materialise(strengths.select("candidate_feature", strength.alias("strength")), "choice-nodes")
    side = lambda s: nodes.select(F.col("candidate_feature").alias(f"feature_{s}"), F.col("strength").alias(f"strength_{s}"))
    sized = pairs.filter(F.col("abs_corr") >= threshold).join(side("a"), "feature_a").join(side("b"), "feature_b")
    a_first = (F.col("strength_a") > F.col("strength_b")) | ((F.col("strength_a") == F.col("strength_b")) & (F.col("feature_a") < F.col("feature_b")))
    pick = lambda x, y, name: F.when(a_first, F.col(x)).otherwise(F.col(y)).alias(name)
    rivals = materialise(
        sized.select(pick("feature_a", "feature_b", "strong"), pick("feature_b", "feature_a", "weak"), pick("strength_a", "strength_b", "strength"), "abs_corr"),
        "choice-rivals",
    )
    # features without a rival are kept at once; rounds run over the rest
    open_ = materialise(rivals.select(F.col("weak").alias("f")).unionByName(rivals.select(F.col("strong").alias("f"))).distinct(), "choice-open")
    dropped = None
    while not open_.isEmpty():
        live = rivals.join(open_.withColumnRenamed("f", "weak"), "weak", "left_semi").join(open_.withColumnRenamed("f", "strong"), "strong", "left_semi")
        kept = materialise(open_.join(live.select(F.col("weak").alias("f")).distinct(), "f", "left_anti"), "choice-kept")
        gone = materialise(live.join(kept.withColumnRenamed("f", "strong"), "strong", "left_semi").select(F.col("weak").alias("f")).distinct(), "choice-gone")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        open_ = materialise(open_.join(kept, "f", "left_anti").join(gone, "f", "left_anti"), "choice-open")
    if dropped is None:
        dropped = open_
    out = nodes.join(dropped.select(F.col("f").alias("candidate_feature"), F.lit(True).alias("_gone")), "candidate_feature", "left")
    keepers = out.filter("_gone IS NULL").select(F.col("candidate_feature").alias("strong"))
    # the strongest keeper; of equally strong ones the smaller name
    first = rivals.join(keepers, "strong", "left_semi").groupBy("weak").agg(
        F.min(F.struct((-F.col("strength")).alias("less"), "strong", "abs_corr")).alias("first")
    )
    joined = out.join(first, out["candidate_feature"] == first["weak"], "left")
    keep = F.col("_gone").isNull()
    return joined.select(
        "candidate_feature",
        keep.alias("corr_keep"),
        F.when(~keep, F.col("first.strong")).otherwise("").alias("corr_drop_with"),
        F.when(~keep, F.col("first.abs_corr")).alias("corr_drop_abs_corr"),
        F.when(~keep, F.concat(F.lit(f"corr>={threshold} with stronger feature "), F.col("first.strong"))).otherwise("").alias("corr_drop_reason"),
    )
