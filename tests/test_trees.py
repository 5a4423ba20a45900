"""Trees as node tables: margins, staged metrics, best round, contributions against brute force."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskfold.operators import trees as R


def random_trees(rng, rounds, depth, features):
    """Trees whose inner nodes carry covers that add up."""
    n = 2 ** (depth + 1) - 1
    a = {k: np.full((rounds, n), -1, np.int64) for k in ("feature", "left", "right")}
    a |= {k: np.zeros((rounds, n)) for k in ("threshold", "value", "cover")}
    for t in range(rounds):
        a["cover"][t, 0] = 1000
        for i in range(n):
            if a["cover"][t, i] and i < n // 2 and (i == 0 or rng.random() < 0.8):
                a["feature"][t, i], a["threshold"][t, i] = rng.integers(features), rng.normal()
                a["left"][t, i], a["right"][t, i] = 2 * i + 1, 2 * i + 2
                part = rng.uniform(0.1, 0.9)
                a["cover"][t, 2 * i + 1], a["cover"][t, 2 * i + 2] = a["cover"][t, i] * part, a["cover"][t, i] * (1 - part)
            else:
                a["value"][t, i] = rng.normal()
    return R.Trees(**a)


def known(trees, t, i, x, subset):
    """Expected value of tree t below node i when only the features of ``subset`` are known."""
    f = trees.feature[t, i]
    if f < 0:
        return trees.value[t, i]
    l, r = trees.left[t, i], trees.right[t, i]
    if f in subset:
        return known(trees, t, l if x[f] <= trees.threshold[t, i] else r, x, subset)
    return sum(trees.cover[t, c] * known(trees, t, c, x, subset) for c in (l, r)) / (trees.cover[t, l] + trees.cover[t, r])


def brute_force(trees, x):
    """Shapley values over all subsets of the features."""
    p, out = len(x), np.zeros(len(x))
    value = {s: sum(known(trees, t, 0, x, set(s)) for t in range(trees.rounds)) for k in range(p + 1) for s in combinations(range(p), k)}
    for j in range(p):
        for s in value:
            if j not in s:
                w = math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p)
                out[j] += w * (value[tuple(sorted((*s, j)))] - value[s])
    return value[()], out


@pytest.mark.parametrize("seed", range(4))
def test_contributions_against_all_subsets(seed):
    rng = np.random.default_rng(seed)
    trees = random_trees(rng, 3, 4, 4)
    x = rng.normal(size=(12, 4))
    game = trees.leaf_games()
    got = R.contributions_of(game, x)
    for row, c in zip(x, got, strict=True):
        bias, want = brute_force(trees, row)
        np.testing.assert_allclose(c, want, atol=1e-12)
        assert abs(bias - game[0]) < 1e-12
    np.testing.assert_allclose(got.sum(axis=1) + game[0], trees.staged(x).sum(axis=1), atol=1e-12)


def _design(spark, n=1200, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1] * x[:, 2])))).astype(int)
    split = np.where(rng.random(n) < 0.6, "development", "validation")
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(SK_ID_CURR=np.arange(n), screening_split=split, TARGET=y)
    df = spark.createDataFrame(pdf).repartition(3)
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df).select("SK_ID_CURR", "screening_split", "TARGET", "features")


@pytest.fixture(scope="module")
def fitted(spark):
    design = _design(spark).cache()
    model = GBTClassifier(labelCol="TARGET", maxIter=12, maxDepth=3, stepSize=0.3, seed=1).fit(design.filter("screening_split = 'development'"))
    return design, model, R.read_trees(R.node_table(spark, model))


def test_margins_are_the_fitted_models(fitted):
    design, model, trees = fitted
    want = {r[0]: 2 * r[1] for r in model.transform(design).select("SK_ID_CURR", vector_to_array("rawPrediction")[1]).collect()}
    got = R.add_margin(design, trees).collect()
    assert len(got) == len(want) and max(abs(r["margin"] - want[r["SK_ID_CURR"]]) for r in got) < 1e-9


def test_contributions_add_up_and_indicators_fold(fitted):
    design, _, trees = fitted
    names = ["a", "b", "c", "missing__a"]
    df, own = R.add_contributions(design, trees, names, shift=0.25)
    assert own == ["a", "b", "c"]
    margin = {r["SK_ID_CURR"]: r["margin"] for r in R.add_margin(design, trees).collect()}
    for r in df.collect():
        assert len(r["contrib"]) == 3
        assert abs(r["bias"] + sum(r["contrib"]) - r["log_odds"]) < 1e-9
        assert abs(r["log_odds"] - margin[r["SK_ID_CURR"]] - 0.25) < 1e-9


def test_staged_metrics_after_every_tree(fitted):
    design, _, trees = fitted
    rows = {(r["screening_split"], r["round"]): r for r in R.staged_metrics(design, trees, every=4).collect()}
    assert sorted(rows) == [(s, i) for s in ("development", "validation") for i in range(1, 13)]
    for k in (1, 4, 12):
        scored = R.add_margin(design, trees.head(k)).toPandas()
        for s, part in scored.groupby("screening_split"):
            y, m = part["TARGET"].to_numpy(), part["margin"].to_numpy()
            p = 1 / (1 + np.exp(-m))
            row = rows[s, k]
            assert row["rows"] == len(part)
            assert abs(row["logloss"] + np.mean(np.where(y > 0, np.log(p), np.log(1 - p)))) < 1e-9
            pairs = (m[y > 0][:, None] > m[y == 0][None, :]) + 0.5 * (m[y > 0][:, None] == m[y == 0][None, :])
            assert (row["auc"] is None) == (k % 4 != 0)
            if row["auc"] is not None:
                assert abs(row["auc"] - pairs.mean()) < 0.01


def test_best_round_waits_out_a_rise():
    falls, rises = [1 - i / 100 for i in range(30)], [0.71 + i / 100 for i in range(20)]
    again = [0.6 - i / 1000 for i in range(5)]
    losses = falls + rises + again + [0.9] * 200
    assert R.best_round(losses, 100) == (55, True)
    assert R.best_round(losses, 20) == (30, True)  # 20 rounds of waiting are over with the last round of the rise
    assert R.best_round(losses, 21) == (55, True) and R.best_round(losses[:100], 100) == (55, False)
    assert R.best_round([0.5, 0.5, 0.5], 2) == (1, True)


def test_staged_losses_that_rise_for_20_rounds_and_fall_again(spark):
    # stumps on one feature: right ones, then 20 wrong ones, then right ones again
    steps = [0.05] * 30 + [-0.05] * 20 + [0.06] * 30
    n = len(steps)
    a = {"feature": np.tile([0, -1, -1], (n, 1)), "left": np.tile([1, -1, -1], (n, 1)), "right": np.tile([2, -1, -1], (n, 1)),
         "threshold": np.zeros((n, 3)), "cover": np.tile([2.0, 1.0, 1.0], (n, 1)), "value": np.array([[0, -s, s] for s in steps])}
    design = _design(spark, 400).withColumn("TARGET", (vector_to_array("features")[0] > 0).cast("int"))
    rows = R.staged_metrics(design, R.Trees(**a)).filter("screening_split = 'validation'").orderBy("round").collect()
    losses = [r["logloss"] for r in rows]
    assert np.argmin(losses[:50]) == 29 and losses[49] > losses[29]
    assert R.best_round(losses, 100) == (n, False) and R.best_round(losses, 20) == (30, True)


def test_null_labels_and_empty_design(fitted):
    design, _, trees = fitted
    none = design.withColumn("TARGET", F.lit(None).cast("int"))
    assert R.staged_metrics(none, trees).count() == 0
    assert R.add_margin(design.limit(0), trees).count() == 0


def test_margins_tree_by_tree():
    rng = np.random.default_rng(9)
    trees = random_trees(rng, 6, 4, 3)
    trees.feature[2, 0] = -1  # a tree of one leaf
    trees.value[2, 0] = 0.4
    x = rng.normal(size=(50, 3))
    x[7, 1] = np.nan  # is at no threshold or below it: goes right

    def walk(t, row):
        i = 0
        while trees.feature[t, i] >= 0:
            i = trees.left[t, i] if row[trees.feature[t, i]] <= trees.threshold[t, i] else trees.right[t, i]
        return trees.value[t, i]

    want = np.array([[walk(t, row) for t in range(6)] for row in x])
    assert trees.staged(x).tolist() == want.tolist()
    np.testing.assert_allclose(trees.margin(x), want.sum(axis=1), atol=1e-14)
    assert trees.staged(x[:0]).shape == (0, 6) and trees.margin(x[:0]).shape == (0,)
    assert R.contributions_of(trees.leaf_games(), x[:0]).shape == (0, 3)


def test_a_path_that_asks_a_feature_twice():
    a = {k: np.full((1, 7), -1, np.int64) for k in ("feature", "left", "right")} | {k: np.zeros((1, 7)) for k in ("threshold", "value", "cover")}
    a["feature"][0, :2], a["left"][0, :2], a["right"][0, :2], a["threshold"][0, :2] = 0, (1, 3), (2, 4), (1.0, -1.0)
    a["cover"][0, :5], a["value"][0, 2:5] = (10, 6, 4, 1, 5), (3.0, -2.0, 0.5)
    trees, x = R.Trees(**a), np.array([[-2.0, 0], [0.0, 0], [2.0, 0]])
    game = trees.leaf_games()
    assert [[len(g.features) for g in leaves] for leaves in game[1]] == [[1, 1, 1]]  # by tree
    for row, c in zip(x, R.contributions_of(game, x), strict=True):
        np.testing.assert_allclose(c, brute_force(trees, row)[1], atol=1e-12)


@pytest.mark.parametrize("best,patience,bound,looks", [(233, 100, 400, [200, 300, 333]), (100, 100, 400, [200]), (30, 100, 400, [200]), (399, 100, 400, [200, 300, 400]),
                                                       (900, 100, 2500, [200, 300, 400, 500, 625, 781, 976, 1144])])
def test_a_fit_grows_no_further_than_its_best_round_needs(best, patience, bound, looks):
    from riskfold.operators import models as M

    losses, seen, rounds = [1 - i / 1e4 if i < best else 1 - (best - 1) / 1e4 + (i - best + 1) / 1e4 for i in range(bound)], [], 2 * patience
    while True:
        seen.append(rounds)
        at, waited = R.best_round(losses[:rounds], patience)
        if waited or rounds >= bound:
            break
        rounds = M.next_rounds(rounds, at, patience, bound)
    assert seen == looks and (at == best)
