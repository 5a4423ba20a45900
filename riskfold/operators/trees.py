"""Boosted trees as node tables: staged margins, best round, exact additive contributions.

A fitted ensemble is a small table (tree, node, feature, threshold, left, right, value, cover, gain): rounds x nodes
of a tree, bounded by the fit's parameters (2,500 trees of depth 5 hold at most 157,500 nodes).  It is read once,
shipped to the tasks as arrays, and every batch of rows is scored, evaluated round by round or explained with
array operations.  Leaf values are on the log-odds scale, so margins, contributions and bias add up in log-odds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.functions.core import PROB_CLIP
from riskfold.session import ensure_checkpoint_dir

#: Rows that are worked on at once: bounds rows x features in memory.
CHUNK = 4_096
#: Log-odds bins of the staged AUC: equal widths between the ends, ties within a bin averaged.
AUC_BINS, AUC_ENDS = 1_024, (-8.0, 8.0)


@dataclass(frozen=True)
class Trees:
    """Node arrays: row t, column i is node i of tree t; ``feature`` is -1 at leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @property
    def rounds(self) -> int:
        return len(self.feature)

    def head(self, rounds: int) -> Trees:
        """The ensemble of the first ``rounds`` trees."""
        return Trees(**{f.name: getattr(self, f.name)[:rounds] for f in fields(self)})

    def values(self, t: int, columns: np.ndarray) -> np.ndarray:
        """Tree ``t``'s value for each row of ``columns``, whose columns should lie together in memory."""
        kind = np.min_scalar_type(self.feature.shape[1])

        def below(i: int) -> np.ndarray:
            if self.feature[t, i] < 0:
                return kind.type(i)
            left = (columns[:, self.feature[t, i]] <= self.threshold[t, i]).astype(kind)
            low, high = below(self.left[t, i]), below(self.right[t, i])
            return high ^ ((low ^ high) & np.negative(left))  # low where left is 1

        return self.value[t][np.broadcast_to(below(0), len(columns))]

    def staged(self, x: np.ndarray) -> np.ndarray:
        """(rows, rounds): each tree's value for each row of ``x``."""
        columns = np.asfortranarray(x)
        return np.array([self.values(t, columns) for t in range(self.rounds)]).reshape(self.rounds, len(x)).T

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row of ``x``."""
        columns, total = np.asfortranarray(x), np.zeros(len(x))
        for t in range(self.rounds):
            total += self.values(t, columns)
        return total

    def leaf_games(self) -> tuple[float, list[list[LeafGame]]]:
        """(expected value, the leaves of every tree with what each path gives to its features)."""
        bias, games = 0.0, []
        for t in range(self.rounds):
            games.append([])
            stack = [(0, 1.0, [])]
            while stack:
                i, share, path = stack.pop()
                f = int(self.feature[t, i])
                if f < 0:
                    bias += share * float(self.value[t, i])
                    if path:
                        games[t].append(LeafGame.of(path, float(self.value[t, i])))
                    continue
                l, r = int(self.left[t, i]), int(self.right[t, i])
                total = self.cover[t, l] + self.cover[t, r]
                for child, low in ((l, True), (r, False)):
                    part = float(self.cover[t, child] / total)
                    stack.append((child, share * part, [*path, (f, float(self.threshold[t, i]), low, part)]))
        return bias, games


@dataclass(frozen=True)
class LeafGame:
    """One leaf's share of the contributions.

    Knowing a set of features, a row reaches the leaf with the product of 0 or 1 for the known ones (does the row
    follow the path) and of the cover shares for the others.  The Shapley values of that product depend only on
    which of the path's features the row follows: ``gives[pattern]`` has them, a bit of ``pattern`` a feature.
    """

    features: list[int]
    steps: list[list[tuple[float, bool]]]
    gives: np.ndarray

    @staticmethod
    def of(path: list[tuple[int, float, bool, float]], value: float) -> LeafGame:
        names = list(dict.fromkeys(f for f, _, _, _ in path))
        steps = [[(thr, low) for f, thr, low, _ in path if f == name] for name in names]
        unknown = np.array([np.prod([part for f, _, _, part in path if f == name]) for name in names])
        d = len(names)
        # weight of a coalition of s others: s! (d - s - 1)! / d!
        weight = np.ones(d)
        for s in range(1, d):
            weight[s] = weight[s - 1] * s / (d - s)
        weight /= d
        known = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
        gives = np.zeros((1 << d, d))
        for j in range(d):
            # coalitions of the others by size: product over them of (unknown + known * z), for every pattern
            sizes = np.ones((1 << d, 1))
            for k in range(d):
                if k != j:
                    before, sizes = sizes, np.zeros((1 << d, sizes.shape[1] + 1))
                    sizes[:, :-1] = before * unknown[k]
                    sizes[:, 1:] += before * known[:, [k]]
            gives[:, j] = value * (known[:, j] - unknown[j]) * (sizes @ weight)
        return LeafGame(names, steps, gives)


def contributions_of(bias_and_games: tuple[float, list[list[LeafGame]]], x: np.ndarray) -> np.ndarray:
    """(rows, features): path-dependent contributions; with the bias they sum to the margin."""
    columns = np.asfortranarray(x)
    out = np.zeros(x.shape[::-1])
    for leaves in bias_and_games[1]:
        sides: dict[tuple[int, float, bool], np.ndarray] = {}  # a tree's conditions, each compared once
        for game in leaves:
            kind = np.min_scalar_type(len(game.gives))
            pattern = np.zeros(len(x), kind)
            for j, (f, steps) in enumerate(zip(game.features, game.steps, strict=True)):
                follows = None
                for threshold, low in steps:
                    if (f, threshold, low) not in sides:
                        below = columns[:, f] <= threshold
                        sides[f, threshold, True], sides[f, threshold, False] = below.view(np.uint8), (~below).view(np.uint8)
                    side = sides[f, threshold, low]
                    follows = side if follows is None else follows & side
                pattern |= follows.astype(kind, copy=False) << j
            at = pattern.astype(np.int64)
            for f, gives in zip(game.features, np.ascontiguousarray(game.gives.T), strict=True):
                out[f] += gives[at]
    return out.T


# ---------------------------------------------------------------------------
# The node table
# ---------------------------------------------------------------------------


def node_table(spark: SparkSession, model) -> DataFrame:
    """(tree, node, feature, threshold, left, right, value, cover, gain) of a fitted ``GBTClassificationModel``.

    ``value`` is the leaf's share of the log-odds (twice the weighted prediction), ``gain`` the split's drop in
    impurity times the rows it parted, ``cover`` the training rows at the node.
    """
    path = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    weight = F.get(F.array(*[F.lit(float(w)) for w in model.treeWeights]), F.col("treeID"))
    inner = node["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).otherwise(-1).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        (F.lit(2.0) * weight * node["prediction"]).alias("value"),
        node["rawCount"].alias("cover"),
        F.when(inner, node["gain"] * node["rawCount"]).alias("gain"),
    )


def read_trees(nodes: DataFrame) -> Trees:
    """The arrays of a node table (rounds x nodes of a tree rows reach the driver, see the module)."""
    rows = nodes.select("tree", "node", "feature", F.coalesce("threshold", F.lit(0.0)).alias("threshold"), "left", "right", "value", "cover").toPandas()
    shape = (int(rows["tree"].max()) + 1, int(rows["node"].max()) + 1) if len(rows) else (0, 1)
    kinds = {"feature": np.int64, "threshold": float, "left": np.int64, "right": np.int64, "value": float, "cover": float}
    arrays = {}
    for name, kind in kinds.items():
        arrays[name] = np.full(shape, -1 if name in ("feature", "left", "right") else 0, kind)
        arrays[name][rows["tree"], rows["node"]] = rows[name]
    return Trees(**arrays)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# ---------------------------------------------------------------------------
# Distributed passes
# ---------------------------------------------------------------------------


def add_margin(design: DataFrame, trees: Trees, features_col: str = "features", name: str = "margin") -> DataFrame:
    """``design`` with the ensemble's log-odds; the feature vector itself is not carried on."""
    rest = [c for c in design.columns if c != features_col]
    out = T.StructType([*[design.schema[c] for c in rest], T.StructField(name, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                x = part.column(len(rest))
                margin = trees.margin(_matrix(x, len(x[0])))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(margin)], names=out.names)

    return design.select(*[F.col(f"`{c}`") for c in rest], vector_to_array(features_col).alias(features_col)).mapInArrow(score, out)


def staged_metrics(design: DataFrame, trees: Trees, split: str = "screening_split", label: str = "TARGET", features_col: str = "features",
                   every: int = 10) -> DataFrame:
    """(split, round, rows, logloss, auc) after every tree, in one pass over the labelled rows.

    ``auc`` (every ``every`` rounds, else NULL) counts ``AUC_BINS`` equal bins of the log-odds, ties within a bin
    averaged: its error is at most half the share of good-bad pairs that fall in one bin.  A task hands on one row
    for each split, round and filled bin, whatever its rows.
    """
    rounds = trees.rounds
    looked_at = np.arange(every - 1, rounds, every)
    out = T.StructType(
        [T.StructField(split, T.StringType()), T.StructField("round", T.IntegerType()), T.StructField("bin", T.IntegerType()),
         T.StructField("rows", T.LongType()), T.StructField("bad", T.DoubleType()), T.StructField("loss", T.DoubleType())]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, tuple[np.ndarray, np.ndarray, list[float]]] = {}
        for b in batches:
            names = np.array(b.column(0).to_pylist(), object)
            y_all = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            width = len(b.column(2)[0]) if b.num_rows else 0
            for at in range(0, b.num_rows, CHUNK):
                columns = np.asfortranarray(_matrix(b.column(2).slice(at, CHUNK), width))
                y, of = y_all[at : at + CHUNK], names[at : at + CHUNK]
                bad = y > 0
                parts = []
                for name in set(of.tolist()):
                    rows = np.flatnonzero(np.array([n == name for n in of]))
                    if name not in held:
                        held[name] = (np.zeros(rounds), np.zeros((2, len(looked_at), AUC_BINS), np.int64), [0.0, 0.0])
                    parts.append((rows, *held[name][:2]))
                    held[name][2][0] += len(rows)
                    held[name][2][1] += y[rows].sum()
                margin = np.zeros(len(y))
                low, high = AUC_ENDS
                for i in range(rounds):
                    margin += trees.values(i, columns)
                    p = np.clip(1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))), PROB_CLIP, 1 - PROB_CLIP)
                    loss = -np.log(np.where(bad, p, 1 - p))
                    k, look = divmod(i + 1, every)
                    if not look:
                        bins = np.clip((margin - low) / (high - low) * AUC_BINS, 0, AUC_BINS - 1).astype(np.int64)
                    for rows, losses, counts in parts:
                        losses[i] += loss[rows].sum()
                        if not look:
                            counts[0, k - 1] += np.bincount(bins[rows], minlength=AUC_BINS)
                            counts[1, k - 1] += np.bincount(bins[rows][bad[rows]], minlength=AUC_BINS)
        for name, (losses, counts, size) in held.items():
            k, bin_ = np.nonzero(counts[0])
            cells = [
                [name] * (rounds + len(k)), [*range(1, rounds + 1), *(looked_at[k] + 1).tolist()], [-1] * rounds + bin_.tolist(),
                [int(size[0])] * rounds + counts[0][k, bin_].tolist(), [size[1]] * rounds + counts[1][k, bin_].astype(float).tolist(), losses.tolist() + [0.0] * len(k),
            ]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cells, kinds, strict=True)], names=out.names)

    rows = design.filter(F.col(label).isNotNull()).select(split, F.col(label).cast("double").alias("y"), vector_to_array(features_col).alias("x"))
    cells = rows.mapInArrow(measure, out).groupBy(split, "round", "bin").agg(F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), F.sum("loss").alias("loss"))
    base = cells.filter("bin < 0").select(split, "round", "rows", "bad", (F.col("loss") / F.col("rows")).alias("logloss"))
    # at most AUC_BINS rows for each split and round
    below = Window.partitionBy(split, "round").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    good = F.col("rows") - F.col("bad")
    pairs = cells.filter("bin >= 0").withColumn("_won", F.col("bad") * (F.coalesce(F.sum(good).over(below), F.lit(0.0)) + good / 2))
    won = pairs.groupBy(split, "round").agg(F.sum("_won").alias("_won"))
    both = F.col("bad") * (F.col("rows") - F.col("bad"))
    return base.join(won, [split, "round"], "left").select(split, "round", "rows", "logloss", F.when(both > 0, F.col("_won") / both).alias("auc"))


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round from 1, whether ``patience`` rounds without a lower loss follow it); the first of equals is best.

    The search ends at the first round that has waited ``patience`` rounds, as training by rounds would.
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def add_contributions(design: DataFrame, trees: Trees, names: Sequence[str], shift: float = 0.0, features_col: str = "features",
                      indicator: str = "missing__") -> tuple[DataFrame, list[str]]:
    """``design`` with ``contrib`` (array), ``bias`` and ``log_odds``, and the features that ``contrib`` follows.

    Exact path-dependent contributions: ``bias`` plus the sum of ``contrib`` is ``log_odds`` (margin + ``shift``).
    What an indicator of a missing value contributes is its feature's.
    """
    own = [n for n in names if not n.startswith(indicator)]
    target = np.array([own.index(n.removeprefix(indicator)) for n in names])
    game = trees.leaf_games()
    rest = [c for c in design.columns if c != features_col]
    added = [T.StructField("contrib", T.ArrayType(T.DoubleType(), False)), T.StructField("bias", T.DoubleType()), T.StructField("log_odds", T.DoubleType())]
    out = T.StructType([*[design.schema[c] for c in rest], *added])

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                x = _matrix(part.column(len(rest)), len(names))
                folded = np.zeros((len(own), len(x)))
                for f, given in zip(target, contributions_of(game, x).T, strict=True):
                    folded[f] += given
                contrib = np.ascontiguousarray(folded.T)
                bias = np.full(len(x), game[0] + shift)
                ends = pa.array(np.arange(0, contrib.size + 1, len(own)), pa.int32())
                arrays = [pa.ListArray.from_arrays(ends, pa.array(contrib.ravel())), pa.array(bias), pa.array(bias + contrib.sum(axis=1))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *arrays], names=out.names)

    x = vector_to_array(features_col).alias(features_col)
    return design.select(*[F.col(f"`{c}`") for c in rest], x).mapInArrow(explain, out), own
