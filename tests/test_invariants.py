"""Invariants of SURVEY §5.1 on small synthetic frames."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskfold.operators.blocks import PREVIOUS, build_block
from riskfold.operators.encode import encode_categoricals
from riskfold.operators.evaluate import score_psi
from riskfold.operators.grids import cost_curve
from riskfold.operators.scorecard import add_grades, add_points, assign_strategy, grade_edges, score_band_metrics, strategy_cutoffs, strategy_metrics
from riskfold.operators.screen import statistics


def _scored(spark, n=2000, seed=3):
    rng = np.random.default_rng(seed)
    pd_ = rng.beta(2, 12, n)
    y = (rng.random(n) < pd_).astype(int)
    split = rng.choice(["development", "validation", "final_holdout"], n, p=[0.6, 0.2, 0.2])
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "screening_split": split, "TARGET": y, "pd": pd_,
                        "AMT_CREDIT": rng.uniform(1e4, 1e6, n)})
    df = add_points(spark.createDataFrame(pdf))
    df = add_grades(df, grade_edges(df))
    m, d = strategy_cutoffs(df)
    return pdf, assign_strategy(df, m, d)


def test_grade_and_action_counts_sum_to_split_rows(spark):
    pdf, df = _scored(spark)
    rows = pdf.groupby("screening_split").size().to_dict()
    g = score_band_metrics(df).groupBy("screening_split").agg(F.sum("rows"), F.sum("bad_capture")).collect()
    for r in g:
        assert r[1] == rows[r[0]] and abs(r[2] - 1.0) < 1e-9
    a = strategy_metrics(df).groupBy("screening_split").agg(F.sum("rows"), F.sum("population_pct"), F.sum("good_capture")).collect()
    for r in a:
        assert r[1] == rows[r[0]] and abs(r[2] - 1.0) < 1e-9 and abs(r[3] - 1.0) < 1e-9


def test_cost_grid_partitions_rows(spark):
    _, df = _scored(spark)
    c = cost_curve(df).select("screening_split", "rows", "direct_decline_rows", "manual_review_rows", "auto_approve_rows").collect()
    assert all(r[1] == r[2] + r[3] + r[4] for r in c)
    per_split = {}
    for r in c:
        per_split.setdefault(r[0], set()).add(r[1])
    assert all(len(v) == 1 for v in per_split.values())  # totals constant across grid points


def test_psi_of_reference_is_zero(spark):
    _, df = _scored(spark)
    ref = df.filter(F.col("screening_split") == "development")
    dup = ref.withColumn("screening_split", F.lit("validation")).unionByName(ref)
    out = {r["screening_split"]: r["psi"] for r in score_psi(dup, "pd").collect()}
    assert abs(out["validation"]) < 1e-12 and abs(out["development"]) < 1e-12


def test_iv_non_negative(spark):
    rng = np.random.default_rng(9)
    n = 800
    y = (rng.random(n) < 0.2).astype(int)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "screening_split": "development", "TARGET": y,
                        "a": rng.normal(size=n) + y, "b": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))})
    iv = statistics(spark.createDataFrame(pdf), ["a", "b"]).collect()
    assert all(r["iv"] >= 0 for r in iv) and len(iv) == 2


def test_encoder_ignores_validation_rows(spark):
    base = pd.DataFrame({"SK_ID_CURR": range(8), "screening_split": ["development"] * 4 + ["validation"] * 4,
                         "cat": ["x", "x", "y", None, "z", "z", "z", "x"]})
    other = base.copy()
    other.loc[other.screening_split == "validation", "cat"] = "w"
    e1, r1 = encode_categoricals(spark.createDataFrame(base), ["cat"])
    e2, r2 = encode_categoricals(spark.createDataFrame(other), ["cat"])
    assert r1 == r2  # levels and names fitted on development only
    dev1 = e1.filter("screening_split = 'development'").orderBy("SK_ID_CURR").drop("screening_split").collect()
    dev2 = e2.filter("screening_split = 'development'").orderBy("SK_ID_CURR").drop("screening_split").collect()
    assert dev1 == dev2


def test_block_of_entity_independent_of_others(spark):
    cols = ("SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, NAME_CONTRACT_TYPE string, AMT_ANNUITY double, "
            "AMT_APPLICATION double, AMT_CREDIT double, AMT_DOWN_PAYMENT double, AMT_GOODS_PRICE double, RATE_DOWN_PAYMENT double, "
            "DAYS_DECISION int, CNT_PAYMENT double, CODE_REJECT_REASON string, NAME_CLIENT_TYPE string, CHANNEL_TYPE string, "
            "NAME_YIELD_GROUP string, NFLAG_INSURED_ON_APPROVAL double")
    rows = [
        (1, 10, "Approved", "Cash loans", 10.0, 100.0, 90.0, None, 100.0, None, -30, 12.0, "XAP", "New", "Stone", "middle", 1.0),
        (1, 11, "Refused", "Revolving loans", 5.0, 0.0, 50.0, 5.0, None, None, -400, 6.0, "HC", "XNA", "Stone", "high", None),
        (2, 20, "Canceled", "XNA", 1.0, 10.0, 0.0, 1.0, 10.0, None, 365243, 6.0, "XAP", "New", "Country-wide", "low_normal", None),
    ]
    full = {r["SK_ID_CURR"]: r for r in build_block(PREVIOUS, spark.createDataFrame(rows, cols)).collect()}
    alone = build_block(PREVIOUS, spark.createDataFrame(rows[:2], cols)).collect()[0]
    assert alone == full[1]
    assert full[1]["previous_credit_to_application_mean"] == 0.9  # zero application amount -> NULL ratio skipped
    assert full[2]["previous_days_decision_max"] is None  # sentinel
