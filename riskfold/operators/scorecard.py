"""Scorecard points, grades and the three-way decision.

Cut points are a handful of exact validation quantiles (at most 11 numbers),
brought to the driver as literals; every row-level step is a projection and
every report a ``groupBy`` on (split, grade/action).  The scenario grid is
evaluated in one pass: rows are bucketed once against all distinct cutoffs,
counted per (split, bucket), and each grid point reads cumulative sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfold.functions.core import bucket_right, pd_to_points
from riskfold.operators.rank import exact_quantiles

DECLINE_PCT = 0.10
MANUAL_REVIEW_PCT = 0.10
SCENARIO_DECLINE = (0.03, 0.05, 0.10, 0.15, 0.20)
SCENARIO_REVIEW = (0.05, 0.10, 0.15, 0.20)
SCENARIO_MAX_TOTAL = 0.70


def add_points(df: DataFrame, pd_col: str = "pd", out: str = "a_card_score") -> DataFrame:
    return df.withColumn(out, pd_to_points(F.col(pd_col)))


def quantile_values(df: DataFrame, col: str, probs: Sequence[float], key: str = "SK_ID_CURR") -> list[float]:
    """Exact interpolated quantiles as driver literals (bounded: len(probs) numbers)."""
    q = exact_quantiles(df, col, probs, key_col=key).orderBy("prob_idx").collect()
    return [r["value"] for r in q]


def grade_edges(scored: DataFrame, score: str = "a_card_score", split: str = "screening_split",
                reference: str = "validation", key: str = "SK_ID_CURR") -> list[float]:
    vals = quantile_values(scored.filter(F.col(split) == reference), score, [i / 10 for i in range(11)], key)
    uniq = sorted(set(vals))
    if len(uniq) < 3:
        raise ValueError("Not enough unique score cutoffs to create grades.")
    return [float("-inf")] + uniq[1:-1] + [float("inf")]


def add_grades(scored: DataFrame, edges: Sequence[float], score: str = "a_card_score") -> DataFrame:
    """Right-closed bins over the edges, labelled G01 (lowest score) upward."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    b = bucket_right(F.col(score), arr)
    return scored.withColumn("score_grade", F.when(b.isNotNull(), F.format_string("G%02d", b)))


def strategy_cutoffs(scored: DataFrame, pd_col: str = "pd", split: str = "screening_split",
                     reference: str = "validation", decline: float = DECLINE_PCT, review: float = MANUAL_REVIEW_PCT,
                     key: str = "SK_ID_CURR") -> tuple[float, float]:
    """(manual_cutoff, decline_cutoff) = reference PD quantiles at 1-d-r and 1-d."""
    manual, dec = quantile_values(scored.filter(F.col(split) == reference), pd_col, [1 - decline - review, 1 - decline], key)
    return manual, dec


def assign_strategy(scored: DataFrame, manual_cutoff: float, decline_cutoff: float, pd_col: str = "pd",
                    out: str = "strategy_action") -> DataFrame:
    p = F.col(pd_col)
    return scored.withColumn(
        out,
        F.when(p >= F.lit(decline_cutoff), "decline").when(p >= F.lit(manual_cutoff), "manual_review").otherwise("approve"),
    )


def score_band_metrics(scored: DataFrame, split: str = "screening_split", label: str = "TARGET",
                       pd_col: str = "pd", score: str = "a_card_score") -> DataFrame:
    lab = scored.filter(F.col(label).isNotNull())
    y = F.col(label).cast("double")
    per = lab.groupBy(split, "score_grade").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).cast("bigint").alias("bad_count"),
        F.avg(y).alias("bad_rate"),
        F.avg(pd_col).alias("avg_pd"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    tot = lab.groupBy(split).agg(F.greatest(F.sum(y), F.lit(1.0)).alias("_tb"))
    return per.join(F.broadcast(tot), split).withColumn("bad_capture", F.col("bad_count") / F.col("_tb")).drop("_tb")


def strategy_metrics(scored: DataFrame, split: str = "screening_split", label: str = "TARGET",
                     pd_col: str = "pd", score: str = "a_card_score", action: str = "strategy_action") -> DataFrame:
    lab = scored.filter(F.col(label).isNotNull())
    y = F.col(label).cast("double")
    per = lab.groupBy(split, action).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).cast("bigint").alias("bad_count"),
        F.avg(y).alias("bad_rate"),
        F.avg(pd_col).alias("avg_pd"),
        F.avg(score).alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    tot = lab.groupBy(split).agg(F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_b"))
    j = per.join(F.broadcast(tot), split)
    good = F.col("rows") - F.col("bad_count")
    return j.select(
        split,
        action,
        "rows",
        (F.col("rows") / F.col("_n")).alias("population_pct"),
        "bad_count",
        good.cast("bigint").alias("good_count"),
        "bad_rate",
        (F.col("bad_count") / F.greatest(F.col("_b"), F.lit(1.0))).alias("bad_capture"),
        (good / F.greatest(F.col("_n") - F.col("_b"), F.lit(1.0))).alias("good_capture"),
        "avg_pd",
        "avg_score",
        "min_score",
        "max_score",
    )


def cutoff_buckets(scored: DataFrame, cutoffs: Sequence[float], pd_col: str = "pd") -> DataFrame:
    """Bucket = number of sorted distinct cutoffs <= pd, so ``pd >= cut_k`` <=> bucket >= k."""
    arr = F.array(*[F.lit(float(c)) for c in cutoffs])
    p = F.col(pd_col)
    return scored.withColumn("cut_bucket", F.size(F.filter(arr, lambda c: c <= p)))


def bucket_cumulative(scored_b: DataFrame, split: str, values: dict, n_cuts: int) -> DataFrame:
    """Per (split, k): totals of rows with bucket >= k for k = 0..n_cuts (the '>= cutoff k' sums)."""
    cells = scored_b.groupBy(split, "cut_bucket").agg(*[F.sum(v).alias(f"_c_{k}") for k, v in values.items()])
    # Densify k = 0..n (bounded by the number of cutoffs) so every grid point finds its row.
    dense_keys = cells.select(split).distinct().select(split, F.explode(F.sequence(F.lit(0), F.lit(n_cuts))).alias("cut_bucket"))
    dense = dense_keys.join(cells, [split, "cut_bucket"], "left").fillna(0)
    # Suffix sums over at most n_cuts + 2 rows a split.
    above = Window.partitionBy(split).orderBy(F.col("cut_bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return dense.select(split, "cut_bucket", *[F.sum(f"_c_{k}").over(above).alias(f"ge_{k}") for k in values])


def strategy_scenarios(scored: DataFrame, split: str = "screening_split", label: str = "TARGET", pd_col: str = "pd",
                       reference: str = "validation", key: str = "SK_ID_CURR") -> DataFrame:
    """K5: decline x review grid, cutoffs from reference quantiles, one pass over the rows."""
    grid = [(d, m) for d in SCENARIO_DECLINE for m in SCENARIO_REVIEW if d + m < SCENARIO_MAX_TOTAL]
    probs = sorted({1 - d for d, _ in grid} | {1 - d - m for d, m in grid})
    qv = quantile_values(scored.filter(F.col(split) == reference), pd_col, probs, key)
    qmap = dict(zip(probs, qv))
    cuts = sorted(set(qv))
    idx = {c: i + 1 for i, c in enumerate(cuts)}  # pd >= c  <=>  bucket >= idx[c]
    lab = scored.filter(F.col(label).isNotNull())
    y = F.col(label).cast("double")
    b = cutoff_buckets(lab, cuts, pd_col)
    cum = bucket_cumulative(b, split, {"n": F.lit(1.0), "bad": y}, len(cuts))
    spark = scored.sparkSession
    g = spark.createDataFrame(
        [(d, m, idx[qmap[1 - d]], idx[qmap[1 - d - m]]) for d, m in grid],
        "decline_pct_target double, manual_review_pct_target double, k_dec int, k_man int",
    )
    dec = cum.select(split, F.col("cut_bucket").alias("k_dec"), F.col("ge_n").alias("dn"), F.col("ge_bad").alias("db"))
    man = cum.select(split, F.col("cut_bucket").alias("k_man"), F.col("ge_n").alias("mn"), F.col("ge_bad").alias("mb"))
    tot = cum.filter(F.col("cut_bucket") == 0).select(split, F.col("ge_n").alias("tn"), F.col("ge_bad").alias("tb"))
    # Every (split, grid point) finds its two cumulative rows by equi-joins on the bucket index.
    j = dec.join(F.broadcast(g), "k_dec").join(man, [split, "k_man"]).join(tot, split)
    rn, rb = F.col("mn") - F.col("dn"), F.col("mb") - F.col("db")
    an, ab = F.col("tn") - F.col("mn"), F.col("tb") - F.col("mb")
    tb = F.greatest(F.col("tb"), F.lit(1.0))
    return j.select(
        split,
        "decline_pct_target",
        "manual_review_pct_target",
        F.col("dn").cast("bigint").alias("decline_rows"),
        rn.cast("bigint").alias("manual_review_rows"),
        an.cast("bigint").alias("approve_rows"),
        F.when(F.col("dn") > 0, F.col("db") / F.col("dn")).alias("decline_bad_rate"),
        F.when(rn > 0, rb / rn).alias("manual_review_bad_rate"),
        F.when(an > 0, ab / an).alias("approve_bad_rate"),
        (F.col("db") / tb).alias("decline_bad_capture"),
        (rb / tb).alias("manual_review_bad_capture"),
        (F.col("mb") / tb).alias("decline_plus_review_bad_capture"),
    )


def score_distribution(scored: DataFrame, split: str = "screening_split", label: str = "TARGET", pd_col: str = "pd",
                       score: str = "a_card_score", key: str = "SK_ID_CURR") -> DataFrame:
    """K6: per split (labelled or not) mean and 5/50/95 % quantiles of PD and points."""
    base = scored.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.col(label)) > 0).alias("target_available"),
        F.avg(pd_col).alias("avg_pd"),
        F.avg(score).alias("avg_score"),
    )
    probs = [0.05, 0.50, 0.95]
    out = base
    for col, prefix in ((pd_col, "pd"), (score, "score")):
        q = exact_quantiles(scored, col, probs, [split], key_col=key)
        w = q.groupBy(split).pivot("prob_idx", [0, 1, 2]).agg(F.first("value"))
        w = w.select(split, F.col("0").alias(f"{prefix}_p05"), F.col("1").alias(f"{prefix}_p50"), F.col("2").alias(f"{prefix}_p95"))
        out = out.join(w, split, "left")
    return out
