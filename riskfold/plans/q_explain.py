"""Catalogue: linear explanations, reason codes and capacity segments.

The applicant-level population is the feature store, scored by a fixed
linear log-odds model on development-standardised features, so every
contribution is exact and the DuckDB oracle can recompute it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.functions.core import sigmoid
from riskfold.operators import encode as E
from riskfold.operators import explain as X
from riskfold.operators import scorecard as K
from riskfold.operators import segments as G
from riskfold.plans import q_store as QS
from riskfold.plans.q_eval import DECILES, KEY, SPLIT, _dbl, points_sql
from riskfold.plans.q_screen import _split_sql, memo
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round, npq, npq_list
from riskfold.session import materialise

# Fixed linear scorer: (feature, coefficient on the standardised value) and bias.
LINEAR = (
    ("annuity_to_income_ratio", 0.8),
    ("credit_to_income_ratio", 0.4),
    ("bureau_total_debt_to_credit_ratio", 0.5),
    ("installment_late_ratio", 0.6),
    ("previous_refusal_rate", 0.5),
    ("ext_source_mean", -0.9),
    ("applicant_age_years", -0.3),
    ("credit_card_utilization_mean", 0.4),
    ("bureau_overdue_loan_ratio", 0.3),
    ("pos_dpd_month_ratio", 0.3),
)
BIAS = -2.2
FEATURES = [f for f, _ in LINEAR]
BETAS = [b for _, b in LINEAR]
EXTRA = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY"]
KEEP = list(dict.fromkeys(FEATURES + list(G.CAPACITY_COLUMNS) + EXTRA))
REASON_KEYS = [KEY, SPLIT, "strategy_action", "TARGET", "pd", "a_card_score"]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def applicant_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        fs = QS.feature_store(spark, sf_dir)
        split = E.assign_split(fs.select(KEY, "dataset", "TARGET"))
        base = fs.select(KEY, "dataset", "TARGET", *KEEP).join(split.select(KEY, SPLIT), KEY)
        base = materialise(base, "q_explain")
        dev = base.filter(F.col(SPLIT) == "development")
        st = dev.agg(*[x for f in FEATURES for x in (F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]).first()
        z = {}
        for f in FEATURES:
            s = st[f"s_{f}"]
            s = 1.0 if s is None or s < 1e-8 else s
            z[f"z_{f}"] = (F.col(f) - F.lit(st[f"m_{f}"] if st[f"m_{f}"] is not None else 0.0)) / F.lit(s)
        pop = base.withColumns(z)
        logit = F.lit(BIAS)
        for f, b in LINEAR:
            logit = logit + F.lit(b) * F.coalesce(F.col(f"z_{f}"), F.lit(0.0))
        pop = materialise(K.add_points(pop.withColumn("pd", sigmoid(logit))), "q_explain")
        pop = K.add_grades(pop, K.grade_edges(pop))
        manual, decline = K.strategy_cutoffs(pop)
        return materialise(K.assign_strategy(pop, manual, decline), "q_explain")

    return memo("applicant_scored", spark, sf_dir, build)


def explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    pop = applicant_scored(spark, sf_dir).filter(F.col(SPLIT).isin(*X.EXPLAIN_SPLITS))
    return X.contributions(pop, FEATURES, BETAS)


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.reason_rows(explained(spark, sf_dir), FEATURES, REASON_KEYS)


@register("linear_contributions_global", lambda: global_oracle())
def q_global(spark, sf_dir):
    return X.global_importance(explained(spark, sf_dir), FEATURES)


@register("reason_codes", lambda: duck_round(_reason_sql() + "\nSELECT * FROM reasons", ["pd", "a_card_score", "contribution_log_odds", "feature_value"]))
def q_reason_codes(spark, sf_dir):
    return reasons(spark, sf_dir)


@register("reason_summary", lambda: reason_summary_oracle())
def q_reason_summary(spark, sf_dir):
    return X.reason_summary(reasons(spark, sf_dir), explained(spark, sf_dir))


@register("reason_sample", lambda: reason_sample_oracle())
def q_reason_sample(spark, sf_dir):
    return X.reason_sample(reasons(spark, sf_dir))


def holdout_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pop = applicant_scored(spark, sf_dir).filter(F.col(SPLIT) == "final_holdout")
    return G.add_proxies(G.add_capacity_dimensions(pop))


@register("capacity_segments", lambda: segments_oracle())
def q_capacity_segments(spark, sf_dir):
    return G.segment_summary(holdout_capacity(spark, sf_dir))


CASE_COLS = [
    "case_type", KEY, "strategy_action", "pd", "a_card_score", "TARGET", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
    "annuity_to_income_ratio", "credit_to_income_ratio", "capacity_level", "capacity_high_dimension_count",
]


@register("case_picks", lambda: cases_oracle(False))
def q_case_picks(spark, sf_dir):
    return G.case_picks(holdout_capacity(spark, sf_dir)).select(*CASE_COLS)


@register("case_texts", lambda: cases_oracle(True))
def q_case_texts(spark, sf_dir):
    cases = G.case_picks(holdout_capacity(spark, sf_dir)).withColumn("risk_dimensions", G.dimension_text())
    r = reasons(spark, sf_dir).filter(F.col("reason_rank") <= 3)
    txt = r.groupBy(KEY).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("reason_rank", "reason_label", "candidate_feature"))),
                lambda s: F.concat(s["reason_rank"].cast("string"), F.lit("."), s["reason_label"], F.lit("("), s["candidate_feature"], F.lit(")")),
            ),
            "; ",
        ).alias("top_reasons")
    )
    out = cases.join(txt, KEY, "left").withColumn("top_reasons", F.coalesce("top_reasons", F.lit("no_major_risk_reason")))
    return out.select("case_type", KEY, "strategy_action", "capacity_level", "risk_dimensions", "top_reasons")


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

def _pop_sql() -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    stats = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES)
    zs = ", ".join(
        f"({f} - coalesce(st.m_{f}, 0.0)) / CASE WHEN st.s_{f} IS NULL OR st.s_{f} < 1e-8 THEN 1.0 ELSE st.s_{f} END AS z_{f}"
        for f in FEATURES
    )
    logit = " + ".join([_dbl(BIAS)] + [f"{_dbl(b)} * coalesce(z_{f}, 0.0)" for f, b in LINEAR])
    return f"""WITH {_split_sql()},
pb AS (SELECT fs.{KEY}, fs.TARGET, {', '.join('fs.' + c for c in KEEP)}, split.{SPLIT} FROM fs JOIN split USING ({KEY})),
st AS (SELECT {stats} FROM pb WHERE {SPLIT} = 'development'),
pz AS (SELECT pb.*, {zs} FROM pb, st),
p1 AS (SELECT *, 1.0 / (1.0 + exp(-least(greatest({logit}, -35.0), 35.0))) AS pd FROM pz),
pop AS (SELECT *, {points_sql('pd')} AS a_card_score FROM p1),
gq AS (SELECT list_sort(list_distinct({npq_list('a_card_score', DECILES)})) AS q FROM pop WHERE {SPLIT} = 'validation'),
ge AS (SELECT list_concat([CAST('-inf' AS DOUBLE)], q[2:len(q) - 1], [CAST('inf' AS DOUBLE)]) AS edges FROM gq),
cut AS (SELECT {npq('pd', 0.8)} AS manual_cut, {npq('pd', 0.9)} AS decline_cut FROM pop WHERE {SPLIT} = 'validation'),
scored AS (SELECT pop.*,
  'G' || lpad(CAST(len(list_filter(ge.edges, lambda e: e < a_card_score)) AS VARCHAR), 2, '0') AS score_grade,
  CASE WHEN pd >= decline_cut THEN 'decline' WHEN pd >= manual_cut THEN 'manual_review' ELSE 'approve' END AS strategy_action
  FROM pop, ge, cut),
ex AS (SELECT * FROM scored WHERE {SPLIT} IN ('validation', 'final_holdout'))"""


def _label_sql(col: str) -> str:
    parts = []
    for needles, label in X.REASON_RULES:
        cond = " OR ".join(f"contains(lower({col}), '{n}')" for n in needles)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{X.DEFAULT_REASON}' END"


def _cl_cte() -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT {', '.join(REASON_KEYS)}, '{f}' AS feature, {_dbl(b)} * coalesce(z_{f}, 0.0) AS c, CAST({f} AS DOUBLE) AS v FROM ex"
        for f, b in LINEAR
    )
    return f"cl AS ({rows})"


def _contrib_sql() -> str:
    return f"{_pop_sql()},\n{_cl_cte()}"


def global_oracle() -> str:
    sql = f"""{_contrib_sql()}
SELECT feature, sum(abs(c)) / n AS mean_abs_contribution, sum(c) / n AS mean_contribution,
  sum(greatest(c, 0.0)) / n AS mean_positive_contribution, sum(CAST(c > 0 AS DOUBLE)) / n AS positive_contribution_rate,
  {_label_sql('feature')} AS reason_label
FROM cl, (SELECT CAST(greatest(count(*), 1) AS DOUBLE) AS n FROM ex) nn GROUP BY feature, n"""
    return duck_round(sql, ["mean_abs_contribution", "mean_contribution", "mean_positive_contribution", "positive_contribution_rate"])


def _reason_ctes() -> str:
    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY c DESC, feature) AS reason_rank FROM cl
  WHERE strategy_action IN ('decline', 'manual_review')),
reasons AS (SELECT {', '.join(REASON_KEYS)}, CAST(reason_rank AS INTEGER) AS reason_rank, feature AS candidate_feature,
  {_label_sql('feature')} AS reason_label, c AS contribution_log_odds, v AS feature_value
  FROM rk WHERE reason_rank <= {X.TOP_N} AND c > 0)"""


def _reason_sql() -> str:
    return f"{_contrib_sql()},\n{_reason_ctes()}"


def reason_summary_oracle() -> str:
    sql = f"""{_reason_sql()},
sizes AS (SELECT {SPLIT}, strategy_action, count(DISTINCT {KEY}) AS action_applicant_count FROM ex
  WHERE strategy_action IN ('decline', 'manual_review') GROUP BY ALL),
s AS (SELECT {SPLIT}, strategy_action, candidate_feature, reason_label, count(DISTINCT {KEY}) AS applicant_count,
  avg(reason_rank) AS avg_reason_rank, avg(contribution_log_odds) AS avg_contribution, avg(pd) AS avg_pd,
  avg(TARGET) AS bad_rate, avg(feature_value) AS avg_feature_value FROM reasons GROUP BY ALL)
SELECT s.*, sizes.action_applicant_count, s.applicant_count / greatest(sizes.action_applicant_count, 1) AS applicant_share_in_action
FROM s LEFT JOIN sizes USING ({SPLIT}, strategy_action)"""
    return duck_round(sql, ["avg_reason_rank", "avg_contribution", "avg_pd", "bad_rate", "avg_feature_value", "applicant_share_in_action"])


def reason_sample_oracle() -> str:
    sql = f"""{_reason_sql()},
b AS (SELECT {KEY}, {SPLIT}, strategy_action, row_number() OVER (PARTITION BY {SPLIT}, strategy_action ORDER BY pd DESC, {KEY}) AS r
  FROM reasons WHERE reason_rank = 1)
SELECT reasons.* FROM reasons SEMI JOIN (SELECT * FROM b WHERE r <= {X.SAMPLE_PER_ACTION}) k USING ({KEY}, {SPLIT}, strategy_action)"""
    return duck_round(sql, ["pd", "a_card_score", "contribution_log_odds", "feature_value"])


def _level_sql(col: str, m: float, h: float, rev: bool) -> str:
    if rev:
        return f"(CASE WHEN {col} IS NULL THEN 0 WHEN {col} <= {_dbl(h)} THEN 2 WHEN {col} <= {_dbl(m)} THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {col} IS NULL THEN 0 WHEN {col} >= {_dbl(h)} THEN 2 WHEN {col} >= {_dbl(m)} THEN 1 ELSE 0 END)"


def _capacity_sql() -> str:
    dims = []
    for d, cols in G.DIMENSIONS:
        parts = [_level_sql(c, m, h, r) for c, m, h, r in cols]
        dims.append(f"{'greatest(' + ', '.join(parts) + ')' if len(parts) > 1 else parts[0]} AS {G.score_col(d)}")
    sc = [G.score_col(d) for d, _ in G.DIMENSIONS]
    return f"""{_pop_sql()},
ho AS (SELECT scored.*, {', '.join(dims)} FROM scored WHERE {SPLIT} = 'final_holdout'),
cap AS (SELECT *, greatest({', '.join(sc)}) AS capacity_max_score,
  {' + '.join(f'CAST({c} >= 2 AS INTEGER)' for c in sc)} AS capacity_high_dimension_count,
  {' + '.join(f'CAST({c} >= 1 AS INTEGER)' for c in sc)} AS capacity_medium_plus_dimension_count,
  greatest(bureau_total_debt_to_credit_ratio, bureau_active_total_debt_to_credit_ratio, bureau_recent_24m_total_debt_to_credit_ratio)
    AS bureau_debt_ratio_proxy,
  greatest(credit_card_recent_6m_utilization_max, credit_card_recent_12m_utilization_max) AS credit_card_utilization_proxy,
  greatest(previous_refusal_rate, previous_recent_12m_refusal_rate) AS previous_refusal_proxy,
  1.0 - ext_source_mean AS external_score_risk_proxy FROM ho),
capl AS (SELECT *, ['low', 'medium', 'high'][least(greatest(capacity_max_score, 0), 2) + 1] AS capacity_level FROM cap)"""


def segments_oracle() -> str:
    sql = f"""{_capacity_sql()}
SELECT strategy_action, count(*) AS rows, avg(TARGET) AS bad_rate, avg(pd) AS avg_pd, avg(a_card_score) AS avg_score,
  avg(annuity_to_income_ratio) AS annuity_to_income_mean, avg(credit_to_income_ratio) AS credit_to_income_mean,
  avg(bureau_debt_ratio_proxy) AS bureau_debt_ratio_proxy_mean, avg(credit_card_utilization_proxy) AS credit_card_utilization_proxy_mean,
  avg(installment_recent_12m_late_ratio) AS installment_recent_12m_late_ratio_mean,
  avg(previous_refusal_proxy) AS previous_refusal_proxy_mean, avg(external_score_risk_proxy) AS external_score_risk_proxy_mean,
  avg(CAST(capacity_high_dimension_count >= 2 AS DOUBLE)) AS high_capacity_dimension_share,
  avg(CAST(capacity_medium_plus_dimension_count >= 1 AS DOUBLE)) AS medium_plus_capacity_dimension_share,
  CASE strategy_action WHEN 'approve' THEN 1 WHEN 'manual_review' THEN 2 WHEN 'decline' THEN 3 END AS action_order
FROM capl GROUP BY strategy_action"""
    return duck_round(sql, ["bad_rate", "avg_pd", "avg_score", "annuity_to_income_mean", "credit_to_income_mean",
                            "bureau_debt_ratio_proxy_mean", "credit_card_utilization_proxy_mean",
                            "installment_recent_12m_late_ratio_mean", "previous_refusal_proxy_mean",
                            "external_score_risk_proxy_mean", "high_capacity_dimension_share",
                            "medium_plus_capacity_dimension_share"])


def cases_oracle(texts: bool) -> str:
    dims = ", ".join(
        f"{{'s': {G.score_col(d)}, 'o': {i}, 'n': '{d}'}}" for i, (d, _) in enumerate(G.DIMENSIONS)
    )
    sql = f"""{_capacity_sql()},
med AS (SELECT {npq('pd', 0.5)} AS m FROM capl WHERE strategy_action = 'manual_review'),
o AS (SELECT capl.*, row_number() OVER (PARTITION BY strategy_action ORDER BY
  CASE WHEN strategy_action = 'decline' THEN -pd WHEN strategy_action = 'manual_review' THEN abs(pd - med.m) ELSE pd END, {KEY}) AS r
  FROM capl, med),
cases AS (SELECT *, CASE strategy_action WHEN 'decline' THEN 'highest_risk_decline' WHEN 'manual_review' THEN 'borderline_manual_review'
  ELSE 'lowest_risk_approve' END AS case_type FROM o WHERE r = 1)"""
    if not texts:
        sql += f"\nSELECT {', '.join(CASE_COLS)} FROM cases"
        return duck_round(sql, ["pd", "a_card_score", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "annuity_to_income_ratio",
                                "credit_to_income_ratio"])
    return f"""{sql},
{_cl_cte()},
{_reason_ctes()},
rt AS (SELECT {KEY}, string_agg(CAST(reason_rank AS VARCHAR) || '.' || reason_label || '(' || candidate_feature || ')', '; '
  ORDER BY reason_rank) AS top_reasons FROM reasons WHERE reason_rank <= 3 GROUP BY {KEY}),
dt AS (SELECT {KEY}, array_to_string(list_transform(list_slice(list_sort(list_transform([{dims}],
  lambda x: {{'k': (2 - x.s) * 10 + x.o, 'n': x.n, 's': x.s}})), 1, 4),
  lambda x: x.n || ':' || ['low', 'medium', 'high'][x.s + 1]), '; ') AS risk_dimensions FROM cases)
SELECT case_type, cases.{KEY}, strategy_action, capacity_level, dt.risk_dimensions,
  coalesce(rt.top_reasons, 'no_major_risk_reason') AS top_reasons
FROM cases JOIN dt USING ({KEY}) LEFT JOIN rt USING ({KEY})"""
