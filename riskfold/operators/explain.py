"""Additive explanations and reason codes.

For a linear log-odds model the per-row contribution of feature j is exactly
``beta_j * z_ij`` (z = the development-standardised value), and the
contributions plus the bias reproduce the log-odds.  Contributions are an
array column per row; ranking the top reasons is a per-row array sort (no
shuffle).  Global summaries explode the array and aggregate per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_N = 5
SAMPLE_PER_ACTION = 100
REVIEW_ACTIONS = ("decline", "manual_review")
EXPLAIN_SPLITS = ("validation", "final_holdout")

# Reason-label rules (ordered substring tests on the lower-cased
# feature name, first match wins) and their labels, as the reference states them.
REASON_RULES = (
    (("ext_source",), "外部综合评分/外部数据风险信号"),
    (("utilization",), "近期信用卡额度使用率偏高"),
    (("debt_to_credit", "total_debt_to_credit"), "征信负债相对授信额度偏高"),
    (("late", "dpd", "past_due"), "近期还款延迟或逾期行为"),
    (("refusal", "refused"), "历史申请被拒记录较多"),
    (("annuity_to_income", "credit_to_income", "payment_to_income"), "还款压力相对收入偏高"),
    (("employment", "days_employed"), "就业稳定性相关风险"),
    (("days_birth", "age"), "年龄段相关风险"),
    (("bureau",), "外部征信历史风险信号"),
    (("installment",), "历史分期还款表现风险"),
    (("previous",), "历史申请与授信表现风险"),
    (("credit_card",), "信用卡历史使用表现风险"),
    (("pos_",), "POS/现金贷历史表现风险"),
)
DEFAULT_REASON = "模型识别的申请资料风险信号"


def reason_label(feature: Column) -> Column:
    name = F.lower(feature)
    expr = None
    for needles, label in REASON_RULES:
        cond = None
        for n in needles:
            c = name.contains(n)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(DEFAULT_REASON)


def contributions(df: DataFrame, features: Sequence[str], betas: Sequence[float]) -> DataFrame:
    """Add ``contrib`` (array<double>: beta_j * z_j) and ``value`` (array of raw values)."""
    zs = [F.coalesce(F.col(f"z_{f}"), F.lit(0.0)) * F.lit(float(b)) for f, b in zip(features, betas)]
    return df.withColumn("contrib", F.array(*zs)).withColumn("value", F.array(*[F.col(f).cast("double") for f in features]))


def global_importance(explained: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean |c|, mean c, mean max(c,0), share of c > 0 per feature (explode, one group-by)."""
    names = F.array(*[F.lit(f) for f in features])
    z = explained.select(F.explode(F.arrays_zip(names.alias("feature"), F.col("contrib").alias("c"))).alias("e"))
    z = z.select("e.feature", "e.c")
    n = explained.count()
    return z.groupBy("feature").agg(
        (F.sum(F.abs("c")) / F.lit(float(max(n, 1)))).alias("mean_abs_contribution"),
        (F.sum("c") / F.lit(float(max(n, 1)))).alias("mean_contribution"),
        (F.sum(F.greatest(F.col("c"), F.lit(0.0))) / F.lit(float(max(n, 1)))).alias("mean_positive_contribution"),
        (F.sum((F.col("c") > 0).cast("double")) / F.lit(float(max(n, 1)))).alias("positive_contribution_rate"),
    ).withColumn("reason_label", reason_label(F.col("feature")))


def reason_rows(explained: DataFrame, features: Sequence[str], keys: Sequence[str], top_n: int = TOP_N) -> DataFrame:
    """Top-n contributions per reviewed row (positive ones only), ranked 1..n."""
    names = F.array(*[F.lit(f) for f in features])
    rev = explained.filter(F.col("strategy_action").isin(*REVIEW_ACTIONS))
    zipped = F.arrays_zip(F.col("contrib").alias("c"), names.alias("feature"), F.col("value").alias("v"))
    # Sort by contribution desc, then feature name for a stable tie rule.
    ordered = F.array_sort(
        zipped,
        lambda a, b: F.when(a["c"] > b["c"], -1).when(a["c"] < b["c"], 1)
        .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0),
    )
    top = rev.select(*keys, F.posexplode(F.slice(ordered, 1, top_n)).alias("pos", "e"))
    return top.filter(F.col("e.c") > 0).select(
        *keys,
        (F.col("pos") + 1).alias("reason_rank"),
        F.col("e.feature").alias("candidate_feature"),
        reason_label(F.col("e.feature")).alias("reason_label"),
        F.col("e.c").alias("contribution_log_odds"),
        F.col("e.v").alias("feature_value"),
    )


def reason_summary(reasons: DataFrame, explained: DataFrame) -> DataFrame:
    """Applicants per reason within each (split, action), with averages and shares."""
    sizes = explained.filter(F.col("strategy_action").isin(*REVIEW_ACTIONS)).groupBy("screening_split", "strategy_action").agg(
        F.count_distinct("SK_ID_CURR").alias("action_applicant_count")
    )
    s = reasons.groupBy("screening_split", "strategy_action", "candidate_feature", "reason_label").agg(
        F.count_distinct("SK_ID_CURR").alias("applicant_count"),
        F.avg("reason_rank").alias("avg_reason_rank"),
        F.avg("contribution_log_odds").alias("avg_contribution"),
        F.avg("pd").alias("avg_pd"),
        F.avg(F.col("TARGET").cast("double")).alias("bad_rate"),
        F.avg("feature_value").alias("avg_feature_value"),
    )
    out = s.join(F.broadcast(sizes), ["screening_split", "strategy_action"], "left")
    return out.withColumn(
        "applicant_share_in_action", F.col("applicant_count") / F.greatest(F.col("action_applicant_count"), F.lit(1))
    )


def reason_sample(reasons: DataFrame, per_action: int = SAMPLE_PER_ACTION) -> DataFrame:
    """The highest-PD applicants per (split, action) among rank-1 rows, with all their reasons.

    ``row_number() <= n`` is planned with a partial window-group limit, so
    each partition forwards at most n rows per group before the shuffle.
    """
    w = Window.partitionBy("screening_split", "strategy_action").orderBy(F.col("pd").desc(), F.col("SK_ID_CURR"))
    base = reasons.filter(F.col("reason_rank") == 1).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_action)
    keys = base.select("SK_ID_CURR", "screening_split", "strategy_action")
    return reasons.join(keys, ["SK_ID_CURR", "screening_split", "strategy_action"], "left_semi")
