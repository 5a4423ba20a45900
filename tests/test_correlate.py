"""Gram pairs against numpy, the rounds of the choice against the driver's walk."""

import numpy as np
import pandas as pd
import pytest

from riskfold.operators import correlate as C
from riskfold.operators.models import correlation_prune


def _frame(spark, seed, n=400, p=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) @ rng.normal(size=(4, p)) + rng.normal(size=(n, p)) * rng.choice([0.05, 0.5, 3.0], p)
    x[rng.random((n, p)) < 0.05] = np.nan
    x[:, 3] = 7.1
    x[:, 5] = x[:, 6] * -2
    names = [f"f {i}" for i in range(p)]
    fill = [float(np.nanmedian(x[:, i])) for i in range(p)]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"`{c}` double" for c in names)).repartition(3)
    filled = np.where(np.isnan(x), fill, x)
    with np.errstate(invalid="ignore"):
        return df, names, fill, np.nan_to_num(np.abs(np.corrcoef(filled, rowvar=False)))


@pytest.mark.parametrize("stripe", [1, 24 * 8 * 5, C.STRIPE_BYTES])
def test_pairs_against_numpy(spark, monkeypatch, stripe):
    monkeypatch.setattr(C, "STRIPE_BYTES", stripe)
    df, names, fill, corr = _frame(spark, 1, p=24 if stripe > 1 else 9)
    got = {(r["feature_a"], r["feature_b"]): r["abs_corr"] for r in C.strong_pairs(df, names, 0.5, fill).collect()}
    p = len(names)
    want = {(names[i], names[j]): corr[i, j] for i in range(p) for j in range(i + 1, p) if corr[i, j] >= 0.5 and i != 3 and j != 3}
    assert got.keys() == want.keys() and len(want) > 3
    assert all(abs(got[k] - want[k]) < 1e-10 for k in want)


@pytest.mark.parametrize("seed", range(3))
def test_choice_against_the_drivers_walk(spark, seed):
    _, names, _, corr = _frame(spark, seed + 10, p=40)
    np.fill_diagonal(corr, 1.0)
    scores = np.round(np.random.default_rng(seed).random(len(names)), 1).tolist()  # ties
    nodes = spark.createDataFrame(list(zip(names, scores, strict=True)), "candidate_feature string, strength double")
    pairs = [(names[i], names[j], float(corr[i, j])) for i in range(len(names)) for j in range(i + 1, len(names))]
    got = C.rank_ordered_choice(nodes, spark.createDataFrame(pairs, "feature_a string, feature_b string, abs_corr double"), 0.6)
    want = {r["candidate_feature"]: r for r in correlation_prune(names, scores, corr, 0.6)}
    rows = got.collect()
    assert len(rows) == len(names) and any(r["corr_keep"] for r in rows) and not all(r["corr_keep"] for r in rows)
    for r in rows:
        row, plain = r.asDict(), want[r["candidate_feature"]]
        assert row.pop("corr_drop_abs_corr") == pytest.approx(plain.pop("corr_drop_abs_corr"), abs=1e-12)
        assert row == plain


def test_chain_of_rivals(spark):
    # each rules out the next: every second one stays
    names = [f"f{i}" for i in range(9)]
    nodes = spark.createDataFrame([(n, float(-i) if i < 8 else None) for i, n in enumerate(names)], "candidate_feature string, strength double")
    pairs = spark.createDataFrame([(b, a, 0.97) for a, b in zip(names, names[1:], strict=False)], "feature_a string, feature_b string, abs_corr double")
    kept = {r["candidate_feature"] for r in C.rank_ordered_choice(nodes, pairs, 0.95).collect() if r["corr_keep"]}
    assert kept == set(names[::2])


def test_nothing_to_compare(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert C.strong_pairs(df, ["a", "b"], 0.5, [None, None]).count() == 0
    assert C.strong_pairs(df, ["a"], 0.5, [None]).count() == 0
    nodes = spark.createDataFrame([("a", 1.0)], "candidate_feature string, strength double")
    rows = C.rank_ordered_choice(nodes, spark.createDataFrame([], "feature_a string, feature_b string, abs_corr double"), 0.5).collect()
    assert [(r["candidate_feature"], r["corr_keep"], r["corr_drop_with"]) for r in rows] == [("a", True, "")]
