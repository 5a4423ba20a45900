"""Gradient boosting over binned blocks that the executors hold (L2).

The trees are those of Spark's ``GBTClassifier`` (log loss, variance gain, 32 bins a feature; equal to its trees where
nothing is drawn, see the tests).  The library shuffles one statistics object for each node and partition and starts
several jobs of wide plans a tree; here rows are binned once (see ``pack``), and a level of a tree is one job:
every task adds up (rows, residuals) by node, feature and bin, only for the smaller child of each split (the larger
one is the parent less the smaller).  Only these sums reach the driver, whose size does not depend on the rows.  Which
rows a tree sees is decided by a hash of the row and the tree, so it does not depend on how rows are partitioned.
"""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.operators.partials import GATHERED
from riskfold.session import materialise

BINS = 32
#: Bits of a table's code; its cells are counted together.
CODE_BITS = 10
#: Rows (in expectation) that the bins' bounds are read off, as in the library; all are binned.
BIN_SAMPLE = 10_000
#: Trees after which the held blocks are renewed with their margins; a pass walks at most that many trees.
RENEW = 4
#: Rows of a held block at most.
BLOCK_ROWS = 65_536

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, cover double, gain double"


@dataclass
class Tree:
    """One tree in heap order (children of i: 2i + 1, 2i + 2); ``feature`` is -1 at leaves, ``cut`` the last bin of the left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n))

    def leaves(self, block: Block, layout: Layout) -> np.ndarray:
        """The node where each row of ``block`` ends."""
        kind = np.min_scalar_type(len(self.feature))

        def below(i: int) -> np.ndarray:
            if self.feature[i] < 0:
                return kind.type(i)
            right = layout.above(block, int(self.feature[i]), int(self.cut[i])).astype(kind)
            low, high = below(2 * i + 1), below(2 * i + 2)
            return low ^ ((low ^ high) & np.negative(right))  # high where right is 1

        return np.broadcast_to(below(0), len(block.y))


class Block(NamedTuple):
    """Row hashes, labels of -1 and 1, the codes of the tables (8 low bits; 2 high bits of four tables a byte), margins."""

    h: np.ndarray
    y: np.ndarray
    low: np.ndarray
    high: np.ndarray
    margin: np.ndarray

    def codes(self, table: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        high = (self.high[table // 4][rows] >> 2 * (table % 4) & 3).astype(np.uint16)
        high <<= 8
        high |= self.low[table][rows]
        return high


@dataclass(frozen=True)
class Layout:
    """Where the bins of the features stand: ``bits`` of them from ``shift`` on in the code of a ``table``.

    Counted together, the features of a table cost one pass over the rows; their sums are the margins of its cells.
    Features share a table while their bits fit, so those of few values cost little.
    """

    width: np.ndarray
    bits: np.ndarray
    table: np.ndarray
    shift: np.ndarray
    tables: int

    @staticmethod
    def of(width: np.ndarray) -> Layout:
        bits = np.array([int(w - 1).bit_length() for w in width], np.int64)
        table, shift, used = np.zeros(len(width), np.int64), np.zeros(len(width), np.int64), []
        for f in np.argsort(-bits, kind="stable"):
            t = next((t for t, taken in enumerate(used) if taken + bits[f] <= CODE_BITS), len(used))
            used += [0] * (t == len(used))
            table[f], shift[f] = t, used[t]
            used[t] += int(bits[f])
        return Layout(width, bits, table, shift, len(used))

    def above(self, block: Block, feature: int, cut: int) -> np.ndarray:
        """Whether the rows' bins of ``feature`` are above ``cut``."""
        t, shift, bits = int(self.table[feature]), int(self.shift[feature]), int(self.bits[feature])
        code = block.low[t] if shift + bits <= 8 else block.codes(t)
        return (code >> shift & (1 << bits) - 1) > cut

    def margins(self, cells: np.ndarray) -> np.ndarray:
        """(node, bin of all features, [rows, residuals]) from (table, [rows, residuals], node, cell)."""
        starts = np.concatenate([[0], np.cumsum(self.width)])
        out = np.zeros((cells.shape[2], starts[-1], 2))
        for f, (t, shift, bits) in enumerate(zip(self.table, self.shift, self.bits, strict=True)):
            by_bin = cells[t].reshape(2, cells.shape[2], -1, 1 << bits, 1 << shift).sum(axis=(2, 4))
            out[:, starts[f] : starts[f + 1]] = by_bin[:, :, : self.width[f]].transpose(1, 2, 0)
        return out


@dataclass(frozen=True)
class Level:
    """What a pass needs: the trees since the blocks were renewed, the tree in work and the nodes to add up."""

    done: list[tuple[float, Tree]]
    tree: Tree
    nodes: list[int]
    number: int
    rate: float
    seed: int
    layout: Layout = field(repr=False)


def bin_bounds(sample: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Thresholds of every column of ``sample``: halfway between values, about equally many rows apart."""
    out = []
    for x in sample.T:
        values, counts = np.unique(x, return_counts=True)
        middle = (values[:-1] + values[1:]) / 2.0
        if len(middle) >= bins:
            stride, below = len(x) / bins, np.cumsum(counts)
            both = (below[:-1] + below[1:]).astype(float)
            chosen, after, target = [], 0, stride
            while (i := max(int(np.searchsorted(both, 2 * target, side="right")), after)) < len(middle):
                chosen.append(i)
                after, target = i + 1, target + stride
            middle = middle[chosen]
        out.append(middle)
    return out


def pack(rows: DataFrame, bounds: list[np.ndarray], layout: Layout) -> DataFrame:
    """(h, y, low, high): blocks of the rows (h, y, x), see ``Block``; y is 1 for bad rows, else 0."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(bounds))
            codes = np.zeros((layout.tables, b.num_rows), np.uint16)
            for f, cuts in enumerate(bounds):
                codes[layout.table[f]] |= (np.searchsorted(cuts, x[:, f], side="left") << layout.shift[f]).astype(np.uint16)
            high = np.zeros((-(-layout.tables // 4), b.num_rows), np.uint8)
            for t in range(layout.tables):
                high[t // 4] |= (codes[t] >> 8 << 2 * (t % 4)).astype(np.uint8)
            h, y = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            cells = [h, (y > 0).astype(np.int8), codes.astype(np.uint8), high]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["h", "y", "low", "high"])

    return rows.mapInArrow(blocks, "h binary, y binary, low binary, high binary")


def _blocks(packed: Iterable) -> Iterator[Block]:
    """The packed blocks, several in one while they have ``BLOCK_ROWS`` together."""

    def joined(held: list) -> Block:
        h, y = (np.concatenate([np.frombuffer(r[c], kind) for r in held]) for c, kind in (("h", np.int64), ("y", np.int8)))
        low, high = (np.concatenate([np.frombuffer(r[c], np.uint8).reshape(-1, len(r["y"])) for r in held], axis=1) for c in ("low", "high"))
        return Block(h, 2 * y - 1, low, high, np.zeros(len(y)))

    held, rows = [], 0
    for r in packed:
        if held and rows + len(r["y"]) > BLOCK_ROWS:
            yield joined(held)
            held, rows = [], 0
        held.append(r)
        rows += len(r["y"])
    if held:
        yield joined(held)


def _advance(block: Block, done: list[tuple[float, Tree]], layout: Layout) -> Block:
    margin = block.margin
    for weight, tree in done:
        margin = margin + weight * tree.value[tree.leaves(block, layout)]
    return block._replace(margin=margin)


def drawn(h: np.ndarray, number: int, rate: float, seed: int) -> np.ndarray:
    """Whether tree ``number`` sees the rows: a share of ``rate``, drawn anew for each tree by a mix of the hash."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((seed * 1_000_003 + number + 1) * 0x9E3779B97F4A7C15 % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)) * 2.0**-53 < rate


@cache
def _settle() -> None:
    """Once a worker: a worker collects garbage after every task, which is long for its loaded modules and short without them."""
    gc.freeze()


def _residuals(block: Block, number: int, rows: np.ndarray | slice) -> np.ndarray:
    """The first tree is fitted to the labels, the others to the log loss's residuals."""
    y = block.y[rows].astype(float)
    return y if number == 0 else 4.0 * y / (1.0 + np.exp(np.clip(2.0 * y * block.margin[rows], -700, 700)))


def _sums(blocks: Iterable[Block], level: Level) -> Iterator[np.ndarray]:
    """One vector a task: (node, bin of all features, [rows, residuals]) over its blocks.

    At the root the rows are those that the tree does not see, which are fewer.
    """
    k, layout = len(level.nodes), level.layout
    cells = None
    place = np.full(len(level.tree.feature), -1, np.int64)
    place[level.nodes] = np.arange(k)
    for block in blocks:
        if cells is None:
            cells = np.zeros((layout.tables, 2, k << CODE_BITS))
        seen = drawn(block.h, level.number, level.rate, level.seed) if level.rate < 1 else np.ones(len(block.y), bool)
        if level.nodes == [0]:
            rows, at = slice(None), None
            target = np.where(seen, _residuals(_advance(block, level.done, layout), level.number, rows), 0.0)
            unseen = np.flatnonzero(~seen)
        else:
            at = place[level.tree.leaves(block, layout)]
            rows = np.flatnonzero(seen & (at >= 0))
            at = at[rows] << CODE_BITS
            target = _residuals(_advance(block, level.done, layout), level.number, rows)
        for t in range(layout.tables):
            if at is None:
                cell = block.codes(t).astype(np.int64)
                counted = cell[unseen]
            else:
                cell = counted = at + block.codes(t, rows)
            cells[t, 0] += np.bincount(counted, minlength=k << CODE_BITS)
            cells[t, 1] += np.bincount(cell, weights=target, minlength=k << CODE_BITS)
    if cells is not None:
        yield layout.margins(cells.reshape(layout.tables, 2, k, -1))


def _level_sums(held: RDD, level: Level) -> np.ndarray:
    def part(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        _settle()
        return _sums(blocks, level)

    parts = held.mapPartitions(part)
    if held.getNumPartitions() > GATHERED:
        return parts.treeReduce(np.add)
    return np.sum(parts.collect(), axis=0)


def _best_split(sums: np.ndarray, width: np.ndarray, allowed: np.ndarray, min_rows: int) -> tuple[float, int, int, np.ndarray] | None:
    """(gain, feature, cut, [rows, residuals] of the left) of the split with the greatest drop in variance; the first of equals."""
    starts = np.cumsum(width) - width
    own = np.repeat(np.arange(len(width)), width)
    left = np.cumsum(sums, axis=0)
    left -= np.concatenate([np.zeros((1, 2)), left])[starts][own]
    whole = sums[: width[0]].sum(axis=0)
    n, s = left[:, 0], left[:, 1]
    rest, others = whole[0] - n, whole[1] - s
    # the last bin of a feature has nothing to its right
    fits = allowed[own] & (n >= max(min_rows, 1)) & (rest >= max(min_rows, 1))
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, (s * s / n + others * others / rest - whole[1] ** 2 / whole[0]) / whole[0], -np.inf)
    i = int(np.argmax(gain))
    return (float(gain[i]), int(own[i]), int(i - starts[own[i]]), left[i]) if gain[i] > 1e-15 else None


def _grow(held: RDD, counts: np.ndarray, done: list[tuple[float, Tree]], number: int, layout: Layout, depth: int, min_rows: int, rate: float,
          feature_rate: float, seed: int) -> Tree:
    """One tree, level by level; ``counts`` are all rows by bin."""
    tree, width = Tree.empty(depth), layout.width
    features = int(np.ceil(feature_rate * len(width)))
    sums = {0: _level_sums(held, Level(done, tree, [0], number, rate, seed, layout))[0]}
    sums[0][:, 0] = counts - sums[0][:, 0]
    root = sums[0][: width[0]].sum(axis=0)
    tree.cover[0], tree.value[0] = root[0], root[1] / root[0] if root[0] else 0.0
    for at_depth in range(depth):
        small = {}
        for i, own in sums.items():
            allowed = np.ones(len(width), bool)
            if features < len(width):
                allowed[np.random.default_rng([seed, number, i]).permutation(len(width))[features:]] = False
            split = _best_split(own, width, allowed, min_rows)
            if split is None:
                continue
            gain, tree.feature[i], tree.cut[i], low = split
            tree.gain[i] = gain * tree.cover[i]
            high = np.array([tree.cover[i], own[: width[0], 1].sum()]) - low
            for child, (n, s) in ((2 * i + 1, low), (2 * i + 2, high)):
                tree.cover[child], tree.value[child] = n, s / n
            # children with less than two leaves' rows cannot be parted
            if max(low[0], high[0]) >= 2 * min_rows:
                small[i] = 2 * i + 1 if low[0] <= high[0] else 2 * i + 2
        if at_depth == depth - 1 or not small:
            break
        found = _level_sums(held, Level(done, tree, list(small.values()), number, rate, seed, layout))
        below = {}
        for (i, child), part in zip(small.items(), found, strict=True):
            sibling = 4 * i + 3 - child
            below |= {child: part, sibling: sums[i] - part}
        sums = {c: below[c] for c in sorted(below) if tree.cover[c] >= 2 * min_rows}
    return tree


class Booster:
    """A boosted fit to the labelled rows of ``dev`` that can go on: the binned blocks stay with the executors until ``release``."""

    def __init__(self, dev: DataFrame, step: float, depth: int, min_rows: int, rate: float, feature_rate: float, seed: int, key: str, label: str,
                 features_col: str = "features") -> None:
        self.spark: SparkSession = dev.sparkSession
        self.step, self.settings = step, (depth, min_rows, rate, feature_rate, seed)
        x = vector_to_array(features_col)
        rows = dev.filter(F.col(label).isNotNull()).select(F.xxhash64(F.col(key), x).alias("h"), F.col(label).cast("double").alias("y"), x.alias("x"))
        n = rows.count()
        if not n:
            raise ValueError("The development split has no labelled rows.")
        share = BIN_SAMPLE / n
        seen = rows if share >= 1 else rows.filter(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = seen.select("x").toArrow().column("x").combine_chunks()  # about BIN_SAMPLE rows at most
        self.bounds = bin_bounds(sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1))
        self.layout = Layout.of(np.array([len(b) + 1 for b in self.bounds]))
        packed = materialise(pack(rows, self.bounds, self.layout), "tree-blocks")
        # a task hands on the sums of all its rows: as many tasks as can run at once
        tasks = max(self.spark.sparkContext.defaultParallelism, 1)
        self.held = packed.rdd.coalesce(tasks).mapPartitions(_blocks).persist(StorageLevel.MEMORY_AND_DISK)
        # a tree that draws no row leaves all unseen
        self.counts = _level_sums(self.held, Level([], Tree.empty(depth), [0], 0, 0.0, seed, self.layout))[0][:, 0]
        self.trees: list[Tree] = []
        self.done: list[tuple[float, Tree]] = []

    def grow(self, rounds: int) -> DataFrame:
        """The node table (see ``trees``) of the first ``rounds`` trees; those not grown yet are."""
        for number in range(len(self.trees), rounds):
            before = None
            if len(self.done) == RENEW:
                walked, before = self.done, self.held
                self.held = before.map(lambda b, walked=walked, layout=self.layout: _advance(b, walked, layout)).persist(StorageLevel.MEMORY_AND_DISK)
                self.done = []
            tree = _grow(self.held, self.counts, list(self.done), number, self.layout, *self.settings)
            if before is not None:  # the tree's first pass has read it
                before.unpersist()
            self.done.append((self._weight(number), tree))
            self.trees.append(tree)
        table = [row for t, tree in enumerate(self.trees[:rounds]) for row in _rows(t, tree, self.bounds, self._weight(t))]
        return materialise(self.spark.createDataFrame(table, NODE_SCHEMA), "tree-nodes-grown")

    def release(self) -> None:
        self.held.unpersist()

    def _weight(self, number: int) -> float:
        return 1.0 if number == 0 else self.step


def boost(dev: DataFrame, rounds: int, *settings, **columns) -> DataFrame:
    """The node table of ``rounds`` trees."""
    fit = Booster(dev, *settings, **columns)
    try:
        return fit.grow(rounds)
    finally:
        fit.release()


def _rows(number: int, tree: Tree, bounds: list[np.ndarray], weight: float) -> Iterator[tuple]:
    """The tree's rows of the node table (2^(depth + 1) - 1 at most)."""
    stack = [0]
    while stack:
        i = stack.pop()
        f = int(tree.feature[i])
        value, cover = 2.0 * weight * float(tree.value[i]), float(tree.cover[i])
        if f < 0:
            yield number, i, -1, None, -1, -1, value, cover, None
        else:
            yield number, i, f, float(bounds[f][tree.cut[i]]), 2 * i + 1, 2 * i + 2, value, cover, float(tree.gain[i])
            stack += [2 * i + 2, 2 * i + 1]
