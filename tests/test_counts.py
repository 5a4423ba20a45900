"""Packed value counts against pandas, over several ranges and tasks; the queries that read them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskfold.operators import counts as CC
from riskfold.operators.encode import fit_design, fit_design_counts
from riskfold.operators.screen import statistics


@pytest.fixture
def table():
    rng = np.random.default_rng(5)
    n = 900
    x = np.round(rng.normal(0, 1, n), 2)
    x[::7] = np.nan
    split = rng.choice(["development", "validation", "final_holdout"], n, p=[0.5, 0.3, 0.2])
    return pd.DataFrame({"k": range(n), "screening_split": split, "TARGET": rng.integers(0, 2, n), "x": x, "hot": np.where(rng.random(n) < 0.9, 1.0, rng.random(n)), "gone": np.nan})


def spark_frame(spark, table):
    df = spark.createDataFrame(table).repartition(5)
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("x", "hot", "gone")})


@pytest.mark.parametrize("range_rows", [CC.RANGE_ROWS, 100])
def test_counts_quantiles_and_fit_are_exact_whatever_the_ranges(spark, table, monkeypatch, range_rows):
    monkeypatch.setattr(CC, "RANGE_ROWS", range_rows)
    df, names = spark_frame(spark, table), ["x", "hot", "gone"]
    counts = CC.column_counts(df, names)
    rows = counts.ranges.filter("r >= 0").orderBy("f", "r").collect()
    assert range_rows > 100 or max(r["r"] for r in rows) > 2
    seen = table[table["screening_split"].isin(["development", "validation"])]
    for f, name in enumerate(names):
        got = np.concatenate([np.frombuffer(r["value"]) for r in rows if r["f"] == f] or [np.zeros(0)])
        want = seen[name].dropna().value_counts().sort_index()
        assert got.tolist() == want.index.tolist()
        both = [np.frombuffer(r["counts"]).reshape(4, -1) for r in rows if r["f"] == f]
        assert not both or (np.concatenate(both, axis=1)[[0, 3]].sum(axis=0) == want.to_numpy()).all()
    dev = seen[seen["screening_split"] == "development"]
    probs = [0, 0.01, 0.37, 0.5, 1]
    q = {(r["f"], r["i"]): r["value"] for r in counts.quantiles(probs).collect()}
    for i, p in enumerate(probs):
        assert q[0, i] == pytest.approx(np.quantile(dev["x"].dropna(), p), abs=1e-14) and q[1, i] == pytest.approx(np.quantile(dev["hot"], p), abs=1e-14)
    assert (2, 0) not in q
    long = df.filter("screening_split = 'development'").select("k", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])).alias("e")).select("k", "e.*")
    a, b = (d.toPandas().sort_values("feature").reset_index(drop=True) for d in (fit_design(long), fit_design_counts(counts)))
    pd.testing.assert_frame_equal(a, b, rtol=1e-12)


def test_statistics_are_the_same_in_one_range_and_in_many(spark, table, monkeypatch):
    df = spark_frame(spark, table)
    one = statistics(df, ["x", "hot", "gone"]).toPandas().sort_values("feature").reset_index(drop=True)
    monkeypatch.setattr(CC, "RANGE_ROWS", 50)
    monkeypatch.setattr(CC, "CHUNK_CELLS", 60)
    many = statistics(df, ["x", "hot", "gone"]).toPandas().sort_values("feature").reset_index(drop=True)
    pd.testing.assert_frame_equal(one, many, rtol=1e-12)


def test_encodings_do_not_build_the_candidate_matrix(spark, monkeypatch):
    from riskfold.plans import q_screen as QN

    monkeypatch.setattr(QN, "candidate_wide", lambda *a: pytest.fail("the whole candidate matrix was built"))
    rows = QN.encoded_long(spark, "/root/testdata/sf0.001", "catfreq__")
    assert rows.count() == 300 and {r["feature"] for r in rows.select("feature").distinct().collect()} == {"catfreq__NAME_CONTRACT_TYPE", "catfreq__OCCUPATION_TYPE"}
