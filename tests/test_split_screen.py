import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskfold.operators.encode import assign_split, class_weights
from riskfold.operators.screen import statistics


def test_split_sizes_exact(spark):
    n = 1237
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "SK_ID_CURR": np.arange(n),
        "dataset": np.where(rng.random(n) < 0.1, "test", "train"),
        "TARGET": (rng.random(n) < 0.08).astype(int),
    })
    out = assign_split(spark.createDataFrame(pdf)).toPandas()
    assert len(out) == n
    assert (out[pdf.set_index("SK_ID_CURR").loc[out["SK_ID_CURR"], "dataset"].to_numpy() == "test"]["screening_split"] == "external_unlabeled").all()
    train = out[out["screening_split"] != "external_unlabeled"]
    for t, part in train.groupby("TARGET"):
        k = len(part)
        sizes = part["screening_split"].value_counts()
        assert sizes.get("final_holdout", 0) == round(k * 0.2)
        assert sizes.get("validation", 0) == round(k * 0.2)


def test_auc_symmetry_and_ks(spark):
    rng = np.random.default_rng(5)
    n = 600
    y = (rng.random(n) < 0.3).astype(int)
    x = np.round(rng.normal(size=n) + y, 1)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "screening_split": "development", "TARGET": y, "x": x, "neg": -x,
                        "const": 1.0})
    r = {row["feature"]: row for row in statistics(spark.createDataFrame(pdf), ["x", "neg", "const"]).collect()}
    assert abs(r["x"]["auc"] + r["neg"]["auc"] - 1.0) < 1e-12
    # reference AUC with average ranks
    ranks = pd.Series(x).rank(method="average")
    npos = y.sum()
    exp = (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * (n - npos))
    assert abs(r["x"]["auc"] - exp) < 1e-12
    assert r["const"]["auc"] is None and r["const"]["ks"] is None  # single distinct value
    assert 0 < r["x"]["ks"] <= 1


def test_binary_feature_collapses_to_one_bin(spark):
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(100), "screening_split": "development", "TARGET": 0, "flag": [0.0] * 95 + [1.0] * 5})
    assert statistics(spark.createDataFrame(pdf), ["flag"]).collect()[0]["edges"] == [float("-inf"), float("inf")]


def test_statistics_against_pandas(spark):
    """Every figure of a feature with ties, a hot value, missing and infinite values and rows without label."""
    rng = np.random.default_rng(11)
    n = 2_000
    x = np.where(rng.random(n) < 0.35, 0.0, np.round(rng.normal(size=n), 2))
    x[rng.random(n) < 0.1] = np.nan
    x[:3] = [np.inf, -np.inf, -0.0]
    split = rng.choice(["development", "validation", "final_holdout"], n, p=[0.6, 0.3, 0.1])
    y = (rng.random(n) < 0.2).astype(float)
    y[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"screening_split": split, "x": x, "TARGET": y})
    df = spark.createDataFrame(pdf).withColumn("TARGET", F.when(~F.isnan("TARGET"), F.col("TARGET").cast("int"))).repartition(5)
    r = statistics(df.withColumn("odd `name", F.lit(None).cast("double")), ["x"]).collect()[0]
    x = np.where(np.isfinite(x), x, np.nan)
    dev, val = split == "development", split == "validation"
    assert abs(r["development_missing_rate"] - np.isnan(x[dev]).mean()) < 1e-12 and abs(r["validation_missing_rate"] - np.isnan(x[val]).mean()) < 1e-12
    assert r["development_nunique"] == pd.Series(x[dev]).nunique() and r["validation_nunique"] == pd.Series(x[val]).nunique()
    cuts = np.unique(np.quantile(x[dev & ~np.isnan(x)], np.arange(11) / 10))
    edges = np.concatenate([[-np.inf], cuts[1:-1], [np.inf]])
    np.testing.assert_allclose(r["edges"], edges)
    ok = dev & ~np.isnan(x) & ~np.isnan(y)
    ranks, pos = pd.Series(x[ok]).rank(), y[ok] == 1
    assert abs(r["auc"] - (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())) < 1e-12
    bucket = np.where(np.isnan(x), 0, np.searchsorted(edges, x, side="left"))
    cell = pd.DataFrame({"b": bucket, "dev": dev, "val": val, "bad": np.where(dev, np.nan_to_num(y), 0)}).groupby("b").sum()
    bd, gd = cell["bad"] / cell["bad"].sum(), (cell["dev"] - cell["bad"]) / (cell["dev"] - cell["bad"]).sum()
    assert abs(r["iv"] - ((bd - gd) * np.log((bd + 1e-6) / (gd + 1e-6))).sum()) < 1e-9
    da, va = cell["dev"] / cell["dev"].sum(), cell["val"] / cell["val"].sum()
    assert abs(r["psi_development_validation"] - ((va - da) * np.log((va + 1e-6) / (da + 1e-6))).sum()) < 1e-9


def test_features_without_values_and_empty_matrix(spark):
    pdf = pd.DataFrame({"screening_split": ["development"] * 4 + ["validation"] * 2, "TARGET": [0, 1, 0, 1, 0, 1], "a": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    df = spark.createDataFrame(pdf).withColumn("gone", F.lit(None).cast("double"))
    rows = {r["feature"]: r for r in statistics(df, ["a", "gone"]).collect()}
    assert rows["gone"]["development_missing_rate"] == 1.0 and rows["gone"]["auc"] is None and rows["gone"]["edges"] is None
    assert rows["a"]["development_nunique"] == 4 and rows["a"]["validation_missing_rate"] == 0.0
    empty = statistics(df.limit(0), ["a", "gone"]).collect()
    assert [r["feature"] for r in empty] == ["a", "gone"] and all(r["auc"] is None and r["development_nunique"] is None for r in empty)


def test_class_weights_mean_one(spark):
    pdf = pd.DataFrame({"TARGET": [1, 0, 0, 0]})
    w = class_weights(spark.createDataFrame(pdf)).toPandas()["sample_weight"]
    assert abs(w.mean() - 1.0) < 1e-12 and abs(w[0] / w[1] - 3.0) < 1e-12


def test_approx_distinct_option_close_to_exact(spark):
    from riskfold.operators.profile import column_profile

    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(3000), "screening_split": np.where(np.arange(3000) % 2 == 0, "development", "validation"),
                        "TARGET": 0, "v": rng.integers(0, 500, 3000).astype(float)})
    df = spark.createDataFrame(pdf)
    prof = {r["column"]: r["nunique"] for r in column_profile({"t": df.select("v")}, approx_distinct=True).collect()}
    assert abs(prof["v"] - pdf["v"].nunique()) <= 0.05 * pdf["v"].nunique()
