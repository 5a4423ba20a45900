"""Boosting over binned blocks: the library's trees where nothing is drawn, draws that do not depend on partitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskfold.operators import boost as B
from riskfold.operators import models as M
from riskfold.operators import trees as R

KEY, LABEL = "SK_ID_CURR", "TARGET"


def _dev(spark, n=2500, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    x[:, 3] = np.round(x[:, 3])  # few values
    x[:, 4] = rng.random(n) < 0.1  # an indicator
    x[:, 5] = 1.5  # constant
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1] * x[:, 2] + x[:, 4])))).astype(int)
    names = list("abcdef")
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(SK_ID_CURR=np.arange(n), TARGET=y)).repartition(3)
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).select(KEY, LABEL, "features").cache()


def _table(nodes):
    """{(tree, path of the node): (feature, threshold, value, cover, gain)}"""
    rows = {(r["tree"], r["node"]): r for r in nodes.collect()}
    out = {}
    for t in {t for t, _ in rows}:
        stack = [(0, "")]
        while stack:
            i, path = stack.pop()
            r = rows[t, i]
            out[t, path] = (r["feature"], r["threshold"] or 0.0, r["value"], r["cover"], r["gain"] or 0.0)
            if r["feature"] >= 0:
                stack += [(r["left"], path + "l"), (r["right"], path + "r")]
    return out


@pytest.mark.parametrize("depth,leaf", [(3, 1), (5, 40)])
def test_without_draws_the_trees_are_the_librarys(spark, depth, leaf):
    dev, rounds = _dev(spark), 13  # past a renewal of the blocks
    model = GBTClassifier(labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=0.3, minInstancesPerNode=leaf, seed=1).fit(dev)
    want = _table(R.node_table(spark, model))
    got = _table(B.boost(dev, rounds, 0.3, depth, leaf, 1.0, 1.0, 1, KEY, LABEL))
    assert set(got) == set(want)
    for k, cells in want.items():
        assert got[k][0] == cells[0], k
        np.testing.assert_allclose(got[k][1:], cells[1:], rtol=1e-7, atol=1e-9)


def test_draws_follow_the_rows_not_the_partitions(spark):
    dev = _dev(spark, 900)
    a, b = (_table(B.boost(d, 3, 0.3, 3, 20, 0.85, 0.85, 7, KEY, LABEL)) for d in (dev, dev.repartition(7)))
    assert set(a) == set(b)
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=1e-9, atol=1e-12)
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20000)
    first, second = B.drawn(h, 0, 0.85, 7), B.drawn(h, 1, 0.85, 7)
    assert abs(first.mean() - 0.85) < 0.01 and abs((first & second).mean() - 0.85**2) < 0.01
    assert (a[0, ""][3], a[1, ""][3]) == (pytest.approx(765, abs=45),) * 2


def test_unlabelled_rows_are_left_out_and_no_rows_refused(spark):
    dev = _dev(spark, 300)
    more = dev.unionByName(dev.withColumn(LABEL, F.lit(None).cast("long")))
    args = (2, 0.3, 2, 10, 1.0, 1.0, 1, KEY, LABEL)
    got, want = _table(B.boost(more, *args)), _table(B.boost(dev, *args))
    assert set(got) == set(want)
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9, atol=1e-12)
    with pytest.raises(ValueError):
        B.boost(dev.filter("TARGET > 1"), *args)


def test_a_fit_starts_few_jobs_a_tree(spark):
    """A tree takes one job a level: the library took more, each of a wide plan."""
    dev = _dev(spark, 400).withColumn(M.SPLIT, F.when(F.col(KEY) % 3 == 0, "validation").otherwise("development"))
    sc = spark.sparkContext
    sc.setJobGroup("boost-test", "jobs of a fit")
    try:
        M.fit_gbt(dev, max_rounds=20, patience=5, min_leaf_rows=20, step=0.3)
        jobs = len(sc.statusTracker().getJobIdsForGroup("boost-test"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20 * M.GBT_DEPTH + 40


def _blocks(bins, width, h, y, parts=1):
    """Blocks as the fit holds them, from bins (features x rows)."""
    layout = B.Layout.of(width)
    codes = np.zeros((layout.tables, bins.shape[1]), np.uint16)
    for f, b in enumerate(bins):
        codes[layout.table[f]] |= (b << layout.shift[f]).astype(np.uint16)
    high = np.zeros((-(-layout.tables // 4), bins.shape[1]), np.uint8)
    for t in range(layout.tables):
        high[t // 4] |= (codes[t] >> 8 << 2 * (t % 4)).astype(np.uint8)
    rows = np.array_split(np.arange(bins.shape[1]), parts)
    return layout, [B.Block(h[r], y[r], codes[:, r].astype(np.uint8), high[:, r], np.zeros(len(r))) for r in rows]


def test_sums_against_plain_counting():
    rng, n = np.random.default_rng(4), 700
    width = np.array([1, 2, 32, 3, 9, 2, 17, 32, 5, 31, 2, 16, 16, 4])
    bins = np.array([rng.integers(0, w, n) for w in width])
    h, y = rng.integers(-(2**63), 2**63 - 1, n), np.where(rng.random(n) < 0.3, 1, -1).astype(np.int8)
    layout, blocks = _blocks(bins, width, h, y, 3)
    first, tree = B.Tree.empty(3), B.Tree.empty(3)
    first.feature[[0, 2]], first.cut[[0, 2]], first.value[:] = (7, 11), (12, 5), rng.normal(size=15)
    tree.feature[[0, 1, 2]], tree.cut[[0, 1, 2]] = (9, 4, 1), (20, 3, 0)

    def ends(t):
        at = np.zeros(n, int)
        for _ in range(3):
            inner = t.feature[at] >= 0
            at = np.where(inner, 2 * at + 1 + (bins[t.feature[at], np.arange(n)] > t.cut[at]), at)
        return at

    assert [b.tolist() for b in (ends(first), ends(tree))] == [np.concatenate([t.leaves(b, layout) for b in blocks]).tolist() for t in (first, tree)]
    margin = 0.3 * first.value[ends(first)]
    residual = 4 * y / (1 + np.exp(2 * y * margin))
    seen = B.drawn(h, 1, 0.85, 7)
    starts = np.cumsum(width) - width
    for nodes, of in (([3, 6], tree), ([0], B.Tree.empty(3))):
        (got,) = B._sums(blocks, B.Level([(0.3, first)], of, nodes, 1, 0.85, 7, layout))
        for k, node in enumerate(nodes):
            mine = seen & (ends(of) == node)
            for f in range(len(width)):
                own = got[k, starts[f] : starts[f] + width[f]]
                # the root counts the rows that the tree does not see
                assert own[:, 0].tolist() == np.bincount(bins[f][mine if node else ~seen], minlength=width[f]).tolist()
                np.testing.assert_allclose(own[:, 1], np.bincount(bins[f][mine], residual[mine], width[f]), atol=1e-10)


def test_features_of_few_values_share_a_table(spark):
    """The held bytes follow the bits of the bins: indicators took a byte each."""
    names = [f"c{i}" for i in range(40)]
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame((rng.random((300, 40)) < 0.2).astype(float), columns=names).assign(SK_ID_CURR=np.arange(300), TARGET=rng.integers(0, 2, 300))
    dev = VectorAssembler(inputCols=names, outputCol="features").transform(spark.createDataFrame(pdf))
    fit = B.Booster(dev, 0.3, 2, 10, 0.85, 0.85, 1, KEY, LABEL)
    try:
        sizes = fit.held.map(lambda b: (len(b.y), b.low.nbytes + b.high.nbytes)).collect()
    finally:
        fit.release()
    assert sum(n for n, _ in sizes) == 300 and sum(size for _, size in sizes) <= 300 * 5


def test_held_blocks_join_small_ones():
    def packed(n):
        return {"h": np.arange(n).tobytes(), "y": np.ones(n, np.int8).tobytes(), "low": np.full((3, n), n % 251, np.uint8).tobytes(), "high": np.ones((1, n), np.uint8).tobytes()}

    sizes = [10_000] * 14 + [7]
    blocks = list(B._blocks(packed(n) for n in sizes))
    assert [len(b.y) for b in blocks] == [60_000, 60_000, 20_007] and list(B._blocks([])) == []
    assert blocks[2].low.shape == (3, 20_007) and set(blocks[2].low[1, -7:]) == {7} and set(blocks[2].y) == {1}
