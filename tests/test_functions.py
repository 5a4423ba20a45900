import math

from pyspark.sql import functions as F

from riskfold.functions.core import (
    bucket_left,
    bucket_right,
    clip_lower,
    level_score,
    pd_to_points,
    row_mean,
    row_std,
    row_sum_fill0,
    safe_div,
    sanitize_token,
    sigmoid,
)


def test_safe_div_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0), (-3.0, 1.0)], "a double, b double")
    out = df.select(safe_div("a", "b").alias("r"), clip_lower("a").alias("c")).collect()
    assert [r["r"] for r in out] == [None, 0.5, None, -3.0]
    # NULL stays NULL (a bare greatest(NULL, 0) would give 0)
    assert [r["c"] for r in out] == [1.0, 1.0, None, 0.0]


def test_points_goldens(spark):
    # Published cutoff pairs of the reference scorecard (PDO 50, 600 at odds 20).
    df = spark.createDataFrame([(0.11686200,), (0.19159978,), (0.0,), (1.0,)], "p double")
    pts = [r[0] for r in df.select(pd_to_points("p")).collect()]
    assert abs(pts[0] - 529.795) < 1e-3
    assert abs(pts[1] - 487.752) < 1e-3
    assert math.isfinite(pts[2]) and math.isfinite(pts[3])


def test_sigmoid_clip(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,), (-1000.0,)], "z double")
    v = [r[0] for r in df.select(sigmoid("z")).collect()]
    assert v[0] == 0.5 and v[1] < 1.0 and v[2] > 0.0


def test_bucket_conventions(spark):
    edges = F.array(F.lit(-math.inf), F.lit(1.0), F.lit(2.0), F.lit(math.inf))
    df = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (5.0,), (None,)], "x double")
    out = df.select(bucket_right("x", edges).alias("r"), bucket_left("x", edges).alias("l")).collect()
    # right-closed: 1.0 belongs to (-inf, 1]; left-closed: 1.0 belongs to [1, 2)
    assert [r["r"] for r in out] == [1, 2, 2, 3, None]
    assert [r["l"] for r in out] == [2, 2, 3, 3, None]


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (2.0, None, None)], "a double, b double, c double")
    out = df.select(
        row_mean(["a", "b", "c"]).alias("m"), row_std(["a", "b", "c"]).alias("s"), row_sum_fill0(["a", "b", "c"]).alias("t")
    ).collect()
    assert out[0]["m"] == 2.0 and abs(out[0]["s"] - math.sqrt(2.0)) < 1e-12 and out[0]["t"] == 4.0
    assert out[1]["m"] is None and out[1]["s"] is None and out[1]["t"] == 0.0
    assert out[2]["s"] is None  # one value: ddof=1 std undefined


def test_level_score_and_sanitize(spark):
    df = spark.createDataFrame([(None,), (0.1,), (0.3,), (0.5,)], "x double")
    up = [r[0] for r in df.select(level_score("x", 0.25, 0.35)).collect()]
    down = [r[0] for r in df.select(level_score("x", 0.5, 0.35, reverse=True)).collect()]
    assert up == [0, 0, 1, 2]
    assert down == [0, 2, 2, 1]
    s = spark.createDataFrame([("  Cash loans!! ",), ("***",)], "s string")
    assert [r[0] for r in s.select(sanitize_token("s")).collect()] == ["Cash_loans", "blank"]
