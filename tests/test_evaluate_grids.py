import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskfold.operators.evaluate import lift_table, topk_table
from riskfold.operators.scorecard import bucket_cumulative, cutoff_buckets


def _scored(spark, n=1003, seed=11):
    rng = np.random.default_rng(seed)
    pd_ = np.round(rng.random(n), 2)  # heavy ties
    y = (rng.random(n) < pd_).astype(int)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "screening_split": np.where(rng.random(n) < 0.5, "validation", "development"),
                        "TARGET": y, "pred": pd_})
    return pdf, spark.createDataFrame(pdf)


def test_lift_bands_equal_count(spark):
    pdf, df = _scored(spark)
    out = lift_table(df).toPandas()
    for s, part in out.groupby("screening_split"):
        n = (pdf["screening_split"] == s).sum()
        exp = np.bincount(np.floor(np.arange(n) * 10 / n).astype(int) + 1)[1:]
        assert list(part.sort_values("score_band")["rows"]) == list(exp)
        assert abs(part["bad_capture"].sum() - 1.0) < 1e-9
        assert abs(part["cumulative_bad_capture"].max() - 1.0) < 1e-9


def test_topk_rows_ceil(spark):
    pdf, df = _scored(spark)
    out = topk_table(df).toPandas()
    for (s, k), row in out.set_index(["screening_split", "topk_pct"]).iterrows():
        n = (pdf["screening_split"] == s).sum()
        assert row["rows"] == math.ceil(n * k)
        top = pdf[pdf["screening_split"] == s].sort_values(["pred", "SK_ID_CURR"], ascending=[False, True]).head(int(row["rows"]))
        assert row["bad_count"] == top["TARGET"].sum()


def test_one_pass_grid_equals_direct_filter(spark):
    pdf, df = _scored(spark)
    cuts = [0.1, 0.35, 0.5, 0.77, 0.9]
    b = cutoff_buckets(df, cuts, "pred")
    cum = bucket_cumulative(b, "screening_split", {"n": F.lit(1.0), "bad": F.col("TARGET").cast("double")}, len(cuts) + 1)
    got = {(r["screening_split"], r["cut_bucket"]): (r["ge_n"], r["ge_bad"]) for r in cum.collect()}
    for s, part in pdf.groupby("screening_split"):
        for k, c in enumerate(cuts, start=1):
            sel = part[part["pred"] >= c]
            assert got[(s, k)] == (len(sel), sel["TARGET"].sum())
        assert got[(s, 0)] == (len(part), part["TARGET"].sum())
        assert got[(s, len(cuts) + 1)] == (0, 0)


def test_weighted_logloss_and_assumptions(spark):
    from riskfold.operators.evaluate import weighted_logloss
    from riskfold.operators.grids import amount_assumptions, scenario_assumptions

    df = spark.createDataFrame([(1, 0.5, 1.0), (0, 0.5, 3.0)], "TARGET int, pred double, sample_weight double")
    assert abs(weighted_logloss(df).first()[0] - math.log(2.0)) < 1e-12
    assert scenario_assumptions(spark).count() == 4 and amount_assumptions(spark).count() == 4
