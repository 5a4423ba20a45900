import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskfold.operators.rank import exact_quantiles, global_rank, prefix_sums


def _frame(spark, n=2000, seed=7):
    rng = np.random.default_rng(seed)
    # one hot group holding most rows, heavy ties in the value
    g = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))
    v = np.round(rng.normal(size=n), 1)
    pdf = pd.DataFrame({"k": np.arange(n), "g": g, "v": v, "w": rng.integers(0, 3, n).astype(float)})
    return pdf, spark.createDataFrame(pdf)


def test_global_rank_matches_sort(spark):
    pdf, df = _frame(spark)
    got = global_rank(df, [F.col("v").desc(), F.col("k")], ["g"], "r", num_partitions=7).toPandas()
    exp = pdf.sort_values(["g", "v", "k"], ascending=[True, False, True])
    exp["r"] = exp.groupby("g").cumcount() + 1
    m = got.merge(exp[["k", "r"]], on="k", suffixes=("", "_e"))
    assert len(m) == len(pdf) and (m["r"] == m["r_e"]).all()


def test_prefix_sums(spark):
    pdf, df = _frame(spark)
    got = prefix_sums(df, [F.col("v"), F.col("k")], {"cw": F.col("w")}, ["g"], num_partitions=5).toPandas()
    exp = pdf.sort_values(["g", "v", "k"]).copy()
    exp["cw"] = exp.groupby("g")["w"].cumsum()
    m = got.merge(exp[["k", "cw"]], on="k", suffixes=("", "_e"))
    assert np.allclose(m["cw"], m["cw_e"])


def test_exact_quantiles_match_numpy(spark):
    pdf, df = _frame(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs, ["g"], key_col="k").toPandas()
    for g, part in pdf.groupby("g"):
        exp = np.quantile(part["v"].to_numpy(), probs)
        q = got[got["g"] == g].sort_values("prob_idx")["value"].to_numpy()
        assert np.allclose(q, exp)


def test_sketch_quantiles_within_the_stated_error(spark):
    from riskfold.operators.rank import SKETCH_ERROR, sketch_quantiles

    rng = np.random.default_rng(4)
    n = 40_000
    x = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 10)  # one value holds two rows in five
    g = np.where(rng.random(n) < 0.9, "hot", "cold")
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x})).repartition(16).unionByName(spark.createDataFrame([("none", None)], "g string, x double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for k in (200, 800):
        rows = sketch_quantiles(df, "x", probs, ["g"], k).collect()
        assert sorted({r["g"] for r in rows}) == ["cold", "hot"] and len(rows) == 12
        for r in rows:
            own = np.sort(x[g == r["g"]])
            low, high = np.searchsorted(own, r["value"], "left") / len(own), np.searchsorted(own, r["value"], "right") / len(own)
            assert low - SKETCH_ERROR[k] <= r["prob"] <= high + SKETCH_ERROR[k], (k, r)
        ends = {(r["g"], r["prob"]): r["value"] for r in rows}
        assert ends["hot", 0.0] == x[g == "hot"].min() and ends["cold", 1.0] == x[g == "cold"].max()


def test_sketched_edges_are_near_the_exact_ones(spark):
    from riskfold.operators.rank import SKETCH_ERROR
    from riskfold.operators.screen import sketched_edges

    rng = np.random.default_rng(6)
    x = rng.normal(size=20_000)
    df = spark.createDataFrame(pd.DataFrame({"screening_split": "development", "x": x, "flag": (rng.random(20_000) < 0.05).astype(float), "one": 1.0})).repartition(4)
    rows = {r["f"]: r["edges"] for r in sketched_edges(df, ["x", "flag", "one"]).collect()}
    assert rows[1] == [float("-inf"), float("inf")] and 2 not in rows and len(rows[0]) == 11
    ranks = np.searchsorted(np.sort(x), rows[0][1:-1]) / len(x)
    assert np.abs(ranks - np.arange(1, 10) / 10).max() <= SKETCH_ERROR[800]
