"""Repayment-capacity segmentation and case picks.

Row-level scores are ``greatest`` over 0/1/2 level scores; the summary is one
``groupBy(strategy_action)``; case picks are ``max_by``/``min_by`` aggregates
(no sort, no window), so every step is a projection or a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.functions.core import level_score
from riskfold.operators.rank import exact_quantiles

ACTION_ORDER = ("approve", "manual_review", "decline")
LEVELS = ("low", "medium", "high")

# Fixed values: (dimension, [(column, medium, high, reverse), ...]).
DIMENSIONS = (
    ("repayment_pressure", (("annuity_to_income_ratio", 0.25, 0.35, False), ("credit_to_income_ratio", 4.0, 6.0, False))),
    ("external_debt", (("bureau_total_debt_to_credit_ratio", 0.45, 0.75, False),
                       ("bureau_active_total_debt_to_credit_ratio", 0.45, 0.75, False),
                       ("bureau_recent_24m_total_debt_to_credit_ratio", 0.45, 0.75, False))),
    ("credit_card", (("credit_card_recent_6m_utilization_max", 0.75, 0.95, False),
                     ("credit_card_recent_12m_utilization_max", 0.75, 0.95, False))),
    ("repayment_history", (("installment_recent_12m_late_ratio", 0.08, 0.18, False),
                           ("installment_recent_12m_total_payment_ratio", 0.98, 0.92, True),
                           ("installment_recent_12m_shortfall_ratio", 0.08, 0.15, False))),
    ("application_history", (("previous_refusal_rate", 0.20, 0.50, False),
                             ("previous_recent_12m_refusal_rate", 0.20, 0.50, False))),
    ("external_score", (("ext_source_mean", 0.50, 0.35, True),)),
)
CAPACITY_COLUMNS = tuple(c for _, cols in DIMENSIONS for c, *_ in cols)


def score_col(dim: str) -> str:
    return f"capacity_{dim}_score"


def add_capacity_dimensions(df: DataFrame) -> DataFrame:
    """G1: six 0/1/2 dimension scores, their max, high / medium-plus counts and level label."""
    scores = {}
    for dim, cols in DIMENSIONS:
        parts = [level_score(F.col(c), m, h, rev) for c, m, h, rev in cols]
        scores[score_col(dim)] = F.greatest(*parts) if len(parts) > 1 else parts[0]
    out = df.withColumns(scores)
    sc = [F.col(score_col(d)) for d, _ in DIMENSIONS]
    out = out.withColumns(
        {
            "capacity_max_score": F.greatest(*sc),
            "capacity_high_dimension_count": sum(((c >= 2).cast("int") for c in sc), F.lit(0)),
            "capacity_medium_plus_dimension_count": sum(((c >= 1).cast("int") for c in sc), F.lit(0)),
        }
    )
    labels = F.array(*[F.lit(x) for x in LEVELS])
    return out.withColumn("capacity_level", F.element_at(labels, F.least(F.greatest(F.col("capacity_max_score"), F.lit(0)), F.lit(2)) + 1))


def add_proxies(df: DataFrame) -> DataFrame:
    """NULL-skipping row maxima and the external-score risk proxy."""
    return df.withColumns(
        {
            "bureau_debt_ratio_proxy": F.greatest("bureau_total_debt_to_credit_ratio", "bureau_active_total_debt_to_credit_ratio",
                                                  "bureau_recent_24m_total_debt_to_credit_ratio"),
            "credit_card_utilization_proxy": F.greatest("credit_card_recent_6m_utilization_max", "credit_card_recent_12m_utilization_max"),
            "previous_refusal_proxy": F.greatest("previous_refusal_rate", "previous_recent_12m_refusal_rate"),
            "external_score_risk_proxy": F.lit(1.0) - F.col("ext_source_mean"),
        }
    )


def with_capacity(scored: DataFrame, features: DataFrame, key: str = "SK_ID_CURR", also: Sequence[str] = ()) -> DataFrame:
    """Scored rows with their applicant's capacity features, dimensions and proxies (and the columns ``also``).

    ``features`` has a row an applicant; its other columns are not read.  A scored row without features stays: no
    dimension is flagged for it (its level is low) and its features are NULL.  Columns that ``scored`` has already
    are taken from there.
    """
    taken = set(scored.columns)
    wanted = [c for c in dict.fromkeys([*CAPACITY_COLUMNS, *also]) if c not in taken]
    joined = scored.join(features.select(key, *wanted), key, "left")
    return add_proxies(add_capacity_dimensions(joined))


def segment_summary(df: DataFrame) -> DataFrame:
    """Per strategy action (fixed order), means that skip NULLs and two dimension shares."""
    order = F.create_map(*[x for i, a in enumerate(ACTION_ORDER) for x in (F.lit(a), F.lit(i + 1))])
    return df.groupBy("strategy_action").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col("TARGET").cast("double")).alias("bad_rate"),
        F.avg("pd").alias("avg_pd"),
        F.avg("a_card_score").alias("avg_score"),
        F.avg("annuity_to_income_ratio").alias("annuity_to_income_mean"),
        F.avg("credit_to_income_ratio").alias("credit_to_income_mean"),
        F.avg("bureau_debt_ratio_proxy").alias("bureau_debt_ratio_proxy_mean"),
        F.avg("credit_card_utilization_proxy").alias("credit_card_utilization_proxy_mean"),
        F.avg("installment_recent_12m_late_ratio").alias("installment_recent_12m_late_ratio_mean"),
        F.avg("previous_refusal_proxy").alias("previous_refusal_proxy_mean"),
        F.avg("external_score_risk_proxy").alias("external_score_risk_proxy_mean"),
        F.avg((F.col("capacity_high_dimension_count") >= 2).cast("double")).alias("high_capacity_dimension_share"),
        F.avg((F.col("capacity_medium_plus_dimension_count") >= 1).cast("double")).alias("medium_plus_capacity_dimension_share"),
    ).withColumn("action_order", order[F.col("strategy_action")])


def case_picks(df: DataFrame) -> DataFrame:
    """Decline -> highest PD, manual review -> PD nearest the median, approve -> lowest PD.

    Ties go to the smaller key.  The median is one exact aggregate per action.
    """
    q = exact_quantiles(df.filter(F.col("strategy_action") == "manual_review"), "pd", [0.5], key_col="SK_ID_CURR").collect()
    med = q[0]["value"] if q else None  # one scalar
    key = F.col("SK_ID_CURR")
    dist = F.abs(F.col("pd") - F.lit(med))
    picks = df.groupBy("strategy_action").agg(
        F.max_by(key, F.struct(F.col("pd"), -key)).alias("_max_pd"),
        F.min_by(key, F.struct(F.col("pd"), key)).alias("_min_pd"),
        F.min_by(key, F.struct(dist, key)).alias("_near"),
    )
    chosen = picks.select(
        "strategy_action",
        F.when(F.col("strategy_action") == "decline", F.col("_max_pd"))
        .when(F.col("strategy_action") == "manual_review", F.col("_near"))
        .otherwise(F.col("_min_pd")).alias("SK_ID_CURR"),
        F.when(F.col("strategy_action") == "decline", "highest_risk_decline")
        .when(F.col("strategy_action") == "manual_review", "borderline_manual_review")
        .otherwise("lowest_risk_approve").alias("case_type"),
    )
    return df.join(chosen, ["strategy_action", "SK_ID_CURR"])


def dimension_text(top: int = 4) -> Column:
    """Top dimensions by score (stable on the fixed order) as ``name:level`` joined by '; '."""
    items = F.array(*[
        F.struct(F.col(score_col(d)).alias("s"), F.lit(i).alias("o"), F.lit(d).alias("n")) for i, (d, _) in enumerate(DIMENSIONS)
    ])
    ordered = F.array_sort(items, lambda a, b: F.when(a["s"] > b["s"], -1).when(a["s"] < b["s"], 1)
                           .when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0))
    labels = F.array(*[F.lit(x) for x in LEVELS])
    return F.array_join(F.transform(F.slice(ordered, 1, top), lambda x: F.concat(x["n"], F.lit(":"), F.element_at(labels, x["s"] + 1))), "; ")
