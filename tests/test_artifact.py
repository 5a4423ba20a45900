"""Boosted fit, artefact and explanations as one chain."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskfold.operators import artifact as A
from riskfold.operators import explain as X
from riskfold.operators import models as M
from riskfold.operators.trees import add_margin

FEATURES = ["x1", "x2", "odd name"]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(8)
    n = 900
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(-1 + 1.5 * x[:, 0] * (x[:, 1] > 0))))).astype(int)
    x[rng.random(n) < 0.2, 1] = np.nan
    split = rng.choice(["development", "validation", "final_holdout", "external_unlabeled"], n, p=[0.5, 0.2, 0.2, 0.1])
    pdf = pd.DataFrame(x, columns=FEATURES).assign(SK_ID_CURR=np.arange(n), screening_split=split)
    pdf["TARGET"] = [None if s == "external_unlabeled" else int(v) for s, v in zip(split, y, strict=True)]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x1 double, x2 double, `odd name` double, SK_ID_CURR long, screening_split string, TARGET int")
    return df.repartition(4).cache()


@pytest.fixture(scope="module")
def chain(spark, wide, tmp_path_factory):
    fit_rows = M.design_fit(wide, FEATURES)
    design, names = M.apply_design(wide, FEATURES, fit_rows, with_raw=True)
    fit, scored = M.fit_gbt(design.drop("raw"), max_rounds=40, patience=5, min_leaf_rows=20, step=0.3)
    path = str(tmp_path_factory.mktemp("artifact"))
    A.save_artifact(path, FEATURES, fit_rows, fit, A.fit_artifact(add_margin(design.drop("raw"), fit.trees), fit.shift))
    return fit, scored, names, path


def test_best_round_is_the_least_validation_loss(chain):
    fit, _, _, _ = chain
    rows = fit.history.filter("screening_split = 'validation'").orderBy("round").collect()
    losses = [r["logloss"] for r in rows]
    assert fit.trees.rounds == fit.best_round == int(np.argmin(losses)) + 1
    assert [r["round"] for r in rows if r["best"]] == [fit.best_round]
    assert len(rows) <= fit.best_round + 5 and fit.nodes.agg(F.max("tree")).first()[0] == fit.best_round - 1


def test_loaded_files_score_as_the_session_did(spark, wide, chain):
    fit, scored, _, path = chain
    other = spark.newSession()
    loaded = A.load_artifact(other, path)
    got = {r["SK_ID_CURR"]: r for r in loaded.score(wide).collect()}
    want = {r["SK_ID_CURR"]: r["pred"] for r in scored.collect()}
    assert got.keys() == want.keys() and max(abs(got[k]["pd"] - want[k]) for k in want) < 1e-12
    assert {r["strategy_action"] for r in got.values()} == {"approve", "manual_review", "decline"}
    external = [r for r in got.values() if r["screening_split"] == "external_unlabeled"]
    assert external and all(r["TARGET"] is None and r["score_grade"].startswith("G") for r in external)
    val = sorted(r["pd"] for r in got.values() if r["screening_split"] == "validation")
    assert abs(loaded.card["decline_cutoff"] - np.quantile(val, 0.9)) < 1e-12
    scale = A.score_scale(spark, loaded).first()
    assert scale["decline_score_cutoff"] < scale["manual_score_cutoff"] and scale["base_score"] == 600.0


def test_reasons_come_from_exact_contributions(spark, wide, chain):
    _, scored, _, path = chain
    loaded = A.load_artifact(spark, path)
    rows, own = loaded.explain(wide)
    assert own == FEATURES
    pd_of = {r["SK_ID_CURR"]: r["pred"] for r in scored.collect()}
    values = {r["SK_ID_CURR"]: r for r in wide.collect()}
    for r in rows.collect():
        assert abs(r["bias"] + sum(r["contrib"]) - r["log_odds"]) < 1e-9
        assert abs(1 / (1 + np.exp(-r["log_odds"])) - pd_of[r["SK_ID_CURR"]]) < 1e-9
        assert r["value"] == [values[r["SK_ID_CURR"]][f] for f in FEATURES]
    decided = rows.join(loaded.score(wide).select("SK_ID_CURR", "pd", "a_card_score", "strategy_action"), "SK_ID_CURR")
    found = X.reason_rows(decided, own, ["SK_ID_CURR", "screening_split", "strategy_action", "TARGET", "pd"]).collect()
    contrib = {r["SK_ID_CURR"]: dict(zip(own, r["contrib"], strict=True)) for r in rows.collect()}
    assert found and all(r["strategy_action"] != "approve" and r["contribution_log_odds"] > 0 for r in found)
    assert all(r["contribution_log_odds"] == contrib[r["SK_ID_CURR"]][r["candidate_feature"]] for r in found)


def test_importance_with_evidence(spark, chain):
    fit, _, names, _ = chain
    table = M.importance_table(fit.nodes, names)
    assert abs(table.agg(F.sum("importance_gain_pct")).first()[0] - 1) < 1e-9
    evidence = spark.createDataFrame([(f, f, "numeric_original", "g", 0.5, 0.1, 0.1, 0.0, 0.0) for f in FEATURES[:2]], list(M.EVIDENCE_COLUMNS))
    rows = {r["candidate_feature"]: r for r in M.importance_by_feature(table, evidence).collect()}
    parts = {r["model_feature"]: r for r in table.collect()}
    assert set(rows) == set(FEATURES) and rows["odd name"]["encoding"] is None and rows["x1"]["feature_group"] == "g"
    assert rows["x2"]["importance_split"] == parts["x2"]["importance_split"] + parts["missing__x2"]["importance_split"]


def test_coefficients_with_evidence(spark):
    table = M.coefficient_table(spark, [0.5, -0.25, 0.0], -1.0, ["x1", "missing__x2", "x3"])
    evidence = spark.createDataFrame([("x1", "x1", "numeric_original", "g", 0.5, 0.1, 0.1, 0.0, 0.0), ("x2", "x2", "numeric_original", "h", 0.5, 0.1, 0.1, 0.0, 0.0)], list(M.EVIDENCE_COLUMNS))
    rows = {r["model_feature"]: r for r in M.coefficient_evidence(table, evidence).collect()}
    assert len(rows) == 4 and rows["missing__x2"]["feature_group"] == "h" and rows["missing__x2"]["is_missing_indicator"]
    assert rows["x1"]["direction"] == "raises_risk" and rows["(intercept)"]["feature_group"] is None
