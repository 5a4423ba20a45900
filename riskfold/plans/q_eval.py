"""Catalogue: scoring population, rank metrics, scorecard and strategy (E*, K1-K7, M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.functions.core import POINTS_FACTOR, POINTS_OFFSET, PROB_CLIP
from riskfold.operators import encode as E
from riskfold.operators import evaluate as EV
from riskfold.operators import scorecard as K
from riskfold.plans import bindings as BD
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round, npq, npq_list

DECILES = [i / 10 for i in range(11)]
from riskfold.session import materialise

KEY, SPLIT = "SK_ID_CURR", "screening_split"


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def scored_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score once: split, points, grades, action; materialised for reuse."""
    from riskfold.plans.q_screen import memo

    def build():
        base = BD.spark_role(spark, sf_dir, "scoring")
        split = E.assign_split(base.select(KEY, "dataset", "TARGET"))
        pop = K.add_points(base.join(split.select(KEY, SPLIT), KEY))
        pop = materialise(pop, "q_eval")
        pop = K.add_grades(pop, K.grade_edges(pop))
        manual, decline = K.strategy_cutoffs(pop)
        return materialise(K.assign_strategy(pop, manual, decline), "q_eval")

    return memo("scored_population", spark, sf_dir, build)


def ranked_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled population with its ranks, sorted once for all rank metrics."""
    from riskfold.plans.q_screen import memo

    return memo("ranked_population", spark, sf_dir, lambda: materialise(EV.ranked_rows(scored_population(spark, sf_dir), score="pd"), "ranked-population"))


@register("scorecard_points", lambda: duck_round(
    f"WITH {scored_sql()} SELECT {KEY}, {SPLIT}, pd, a_card_score, score_grade, strategy_action FROM scored", ["pd", "a_card_score"]))
def q_scorecard_points(spark, sf_dir):
    return scored_population(spark, sf_dir).select(KEY, SPLIT, "pd", "a_card_score", "score_grade", "strategy_action")


@register("score_grades", lambda: grades_oracle())
def q_score_grades(spark, sf_dir):
    return K.score_band_metrics(scored_population(spark, sf_dir))


@register("three_way_strategy", lambda: strategy_oracle())
def q_three_way_strategy(spark, sf_dir):
    return K.strategy_metrics(scored_population(spark, sf_dir))


@register("strategy_scenarios", lambda: scenarios_oracle())
def q_strategy_scenarios(spark, sf_dir):
    return K.strategy_scenarios(scored_population(spark, sf_dir))


@register("score_distribution", lambda: distribution_oracle())
def q_score_distribution(spark, sf_dir):
    return K.score_distribution(scored_population(spark, sf_dir))


@register("split_metrics", lambda: split_metrics_oracle())
def q_split_metrics(spark, sf_dir):
    pop = scored_population(spark, sf_dir)
    return EV.split_metrics(pop, score="pd", extra_means=["a_card_score"], ranked=ranked_population(spark, sf_dir))


@register("lift_table", lambda: lift_oracle())
def q_lift_table(spark, sf_dir):
    return EV.lift_table(scored_population(spark, sf_dir), score="pd", ranked=ranked_population(spark, sf_dir))


@register("topk_precision_recall", lambda: topk_oracle())
def q_topk(spark, sf_dir):
    return EV.topk_table(scored_population(spark, sf_dir), score="pd", ranked=ranked_population(spark, sf_dir))


@register("average_precision", lambda: ap_oracle())
def q_average_precision(spark, sf_dir):
    return EV.average_precision(scored_population(spark, sf_dir), score="pd", ranked=ranked_population(spark, sf_dir))


@register("score_psi", lambda: psi_oracle())
def q_score_psi(spark, sf_dir):
    pop = scored_population(spark, sf_dir)
    a = EV.score_psi(pop, "pd").withColumnRenamed("psi", "psi_pd")
    b = EV.score_psi(pop, "a_card_score").withColumnRenamed("psi", "psi_points")
    return a.join(b, SPLIT, "full")


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def points_sql(p: str) -> str:
    q = f"least(greatest({p}, {_dbl(PROB_CLIP)}), {_dbl(1.0 - PROB_CLIP)})"
    return f"({_dbl(POINTS_OFFSET)} + {_dbl(POINTS_FACTOR)} * ln((1.0 - {q}) / {q}))"


def scored_sql() -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    return f"""
base AS {BD.duckdb_role('scoring')},
sp AS (SELECT {KEY}, TARGET,
  row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST({KEY} AS VARCHAR) || '{E.RANDOM_SEED}'), {KEY}) AS rk,
  count(*) OVER (PARTITION BY TARGET) AS n FROM base WHERE dataset = 'train'),
split AS (
  SELECT {KEY}, CASE WHEN rk <= round_even(n * 0.2, 0) THEN 'final_holdout'
    WHEN rk <= 2 * round_even(n * 0.2, 0) THEN 'validation' ELSE 'development' END AS {SPLIT} FROM sp
  UNION ALL SELECT {KEY}, 'external_unlabeled' FROM base WHERE dataset IS DISTINCT FROM 'train'),
pop AS (SELECT base.*, split.{SPLIT}, {points_sql('pd')} AS a_card_score FROM base JOIN split USING ({KEY})),
gq AS (SELECT list_sort(list_distinct({npq_list('a_card_score', DECILES)})) AS q FROM pop WHERE {SPLIT} = 'validation'),
ge AS (SELECT list_concat([CAST('-inf' AS DOUBLE)], q[2:len(q) - 1], [CAST('inf' AS DOUBLE)]) AS edges FROM gq),
cut AS (SELECT {npq('pd', 0.8)} AS manual_cut, {npq('pd', 0.9)} AS decline_cut FROM pop WHERE {SPLIT} = 'validation'),
scored AS (SELECT pop.*,
  'G' || lpad(CAST(len(list_filter(ge.edges, lambda e: e < a_card_score)) AS VARCHAR), 2, '0') AS score_grade,
  CASE WHEN pd >= decline_cut THEN 'decline' WHEN pd >= manual_cut THEN 'manual_review' ELSE 'approve' END AS strategy_action
  FROM pop, ge, cut)"""


def grades_oracle() -> str:
    sql = f"""WITH {scored_sql()},
lab AS (SELECT * FROM scored WHERE TARGET IS NOT NULL)
SELECT {SPLIT}, score_grade, count(*) AS rows, CAST(sum(TARGET) AS BIGINT) AS bad_count, avg(TARGET) AS bad_rate,
  avg(pd) AS avg_pd, min(a_card_score) AS min_score, max(a_card_score) AS max_score,
  sum(TARGET) / greatest(any_value(tb), 1.0) AS bad_capture
FROM lab JOIN (SELECT {SPLIT}, CAST(sum(TARGET) AS DOUBLE) AS tb FROM lab GROUP BY {SPLIT}) t USING ({SPLIT})
GROUP BY {SPLIT}, score_grade"""
    return duck_round(sql, ["bad_rate", "avg_pd", "min_score", "max_score", "bad_capture"])


def strategy_oracle() -> str:
    sql = f"""WITH {scored_sql()},
lab AS (SELECT * FROM scored WHERE TARGET IS NOT NULL),
t AS (SELECT {SPLIT}, count(*) AS n, CAST(sum(TARGET) AS DOUBLE) AS b FROM lab GROUP BY {SPLIT})
SELECT {SPLIT}, strategy_action, count(*) AS rows, count(*) / any_value(n) AS population_pct,
  CAST(sum(TARGET) AS BIGINT) AS bad_count, CAST(count(*) - sum(TARGET) AS BIGINT) AS good_count, avg(TARGET) AS bad_rate,
  sum(TARGET) / greatest(any_value(b), 1.0) AS bad_capture,
  (count(*) - sum(TARGET)) / greatest(any_value(n) - any_value(b), 1.0) AS good_capture,
  avg(pd) AS avg_pd, avg(a_card_score) AS avg_score, min(a_card_score) AS min_score, max(a_card_score) AS max_score
FROM lab JOIN t USING ({SPLIT}) GROUP BY {SPLIT}, strategy_action"""
    return duck_round(sql, ["population_pct", "bad_rate", "bad_capture", "good_capture", "avg_pd", "avg_score", "min_score", "max_score"])


def scenarios_oracle() -> str:
    grid = [(d, m) for d in K.SCENARIO_DECLINE for m in K.SCENARIO_REVIEW if d + m < K.SCENARIO_MAX_TOTAL]
    q = lambda p: f"(SELECT {npq('pd', p)} FROM scored WHERE {SPLIT} = 'validation')"
    vals = ", ".join(f"({_dbl(d)}, {_dbl(m)}, {q(1 - d)}, {q(1 - d - m)})" for d, m in grid)
    sql = f"""WITH {scored_sql()},
gc(decline_pct_target, manual_review_pct_target, dcut, mcut) AS (VALUES {vals}),
lab AS (SELECT * FROM scored WHERE TARGET IS NOT NULL),
x AS (SELECT lab.{SPLIT}, gc.decline_pct_target, gc.manual_review_pct_target,
  CASE WHEN pd >= dcut THEN 'd' WHEN pd >= mcut THEN 'm' ELSE 'a' END AS act, TARGET FROM lab, gc)
SELECT {SPLIT}, decline_pct_target, manual_review_pct_target,
  count(*) FILTER (WHERE act = 'd') AS decline_rows, count(*) FILTER (WHERE act = 'm') AS manual_review_rows,
  count(*) FILTER (WHERE act = 'a') AS approve_rows,
  avg(TARGET) FILTER (WHERE act = 'd') AS decline_bad_rate, avg(TARGET) FILTER (WHERE act = 'm') AS manual_review_bad_rate,
  avg(TARGET) FILTER (WHERE act = 'a') AS approve_bad_rate,
  coalesce(sum(TARGET) FILTER (WHERE act = 'd'), 0) / greatest(sum(TARGET), 1.0) AS decline_bad_capture,
  coalesce(sum(TARGET) FILTER (WHERE act = 'm'), 0) / greatest(sum(TARGET), 1.0) AS manual_review_bad_capture,
  coalesce(sum(TARGET) FILTER (WHERE act IN ('d', 'm')), 0) / greatest(sum(TARGET), 1.0) AS decline_plus_review_bad_capture
FROM x GROUP BY {SPLIT}, decline_pct_target, manual_review_pct_target"""
    return duck_round(sql, ["decline_pct_target", "manual_review_pct_target", "decline_bad_rate", "manual_review_bad_rate",
                            "approve_bad_rate", "decline_bad_capture", "manual_review_bad_capture", "decline_plus_review_bad_capture"])


def distribution_oracle() -> str:
    sql = f"""WITH {scored_sql()}
SELECT {SPLIT}, count(*) AS rows, count(TARGET) > 0 AS target_available, avg(pd) AS avg_pd, avg(a_card_score) AS avg_score,
  {npq('pd', 0.05)} AS pd_p05, {npq('pd', 0.5)} AS pd_p50, {npq('pd', 0.95)} AS pd_p95,
  {npq('a_card_score', 0.05)} AS score_p05, {npq('a_card_score', 0.5)} AS score_p50,
  {npq('a_card_score', 0.95)} AS score_p95
FROM scored GROUP BY {SPLIT}"""
    return duck_round(sql, ["avg_pd", "avg_score", "pd_p05", "pd_p50", "pd_p95", "score_p05", "score_p50", "score_p95"])


def _ranked_sql() -> str:
    return f"""{scored_sql()},
lab AS (SELECT * FROM scored WHERE TARGET IS NOT NULL),
rk AS (SELECT *, row_number() OVER (PARTITION BY {SPLIT} ORDER BY pd DESC, {KEY}) AS rnk,
  count(*) OVER (PARTITION BY {SPLIT}) AS n FROM lab)"""


def split_metrics_oracle() -> str:
    tops = []
    for pct in EV.TOP_PCTS:
        k = int(pct * 100)
        cut = f"greatest(ceil(n * {pct}), 1)"
        tb = f"coalesce(sum(CASE WHEN rnk <= {cut} THEN TARGET END), 0)"
        tops += [
            f"{tb} / any_value({cut}) AS top_{k}pct_bad_rate",
            f"{tb} / greatest(CAST(sum(TARGET) AS DOUBLE), 1.0) AS top_{k}pct_bad_capture",
            f"({tb} / any_value({cut})) / greatest(avg(TARGET), 1e-9) AS top_{k}pct_lift",
        ]
    sql = f"""WITH {_ranked_sql()},
avgr AS (SELECT {SPLIT}, TARGET, (rank() OVER w + rank() OVER w + count(*) OVER (PARTITION BY {SPLIT}, pd) - 1) / 2.0 AS ar
  FROM lab WINDOW w AS (PARTITION BY {SPLIT} ORDER BY pd)),
auc AS (SELECT {SPLIT}, sum(TARGET) AS P, count(*) - sum(TARGET) AS G, sum(CASE WHEN TARGET = 1 THEN ar ELSE 0 END) AS R
  FROM avgr GROUP BY {SPLIT}),
vt AS (SELECT {SPLIT}, pd, count(*) AS c, sum(TARGET) AS b FROM lab GROUP BY {SPLIT}, pd),
vc AS (SELECT *, sum(c) OVER (PARTITION BY {SPLIT} ORDER BY pd) AS cn, sum(b) OVER (PARTITION BY {SPLIT} ORDER BY pd) AS cb,
  sum(c) OVER (PARTITION BY {SPLIT}) AS NN, sum(b) OVER (PARTITION BY {SPLIT}) AS BB FROM vt),
ks AS (SELECT {SPLIT}, max(abs(cb / BB - (cn - cb) / (NN - BB))) AS ks FROM vc GROUP BY {SPLIT}),
m AS (SELECT {SPLIT}, count(*) AS rows, CAST(sum(TARGET) AS BIGINT) AS bad_count, avg(TARGET) AS bad_rate,
  avg(-(TARGET * ln(least(greatest(pd, 1e-6), 1 - 1e-6)) + (1 - TARGET) * ln(1 - least(greatest(pd, 1e-6), 1 - 1e-6)))) AS logloss,
  avg((pd - TARGET) * (pd - TARGET)) AS brier, avg(pd) AS avg_pred, avg(a_card_score) AS avg_a_card_score,
  {', '.join(tops)}
  FROM rk GROUP BY {SPLIT})
SELECT m.*, CASE WHEN P > 0 AND G > 0 THEN (R - P * (P + 1) / 2.0) / (P * G) END AS auc,
  CASE WHEN P > 0 AND G > 0 THEN ks.ks END AS ks
FROM m JOIN auc USING ({SPLIT}) JOIN ks USING ({SPLIT})"""
    dbl = ["bad_rate", "logloss", "brier", "avg_pred", "avg_a_card_score", "auc", "ks"]
    for pct in EV.TOP_PCTS:
        k = int(pct * 100)
        dbl += [f"top_{k}pct_bad_rate", f"top_{k}pct_bad_capture", f"top_{k}pct_lift"]
    return duck_round(sql, dbl)


def lift_oracle() -> str:
    sql = f"""WITH {_ranked_sql()},
b AS (SELECT *, CAST(floor((rnk - 1) * 10 / n) + 1 AS INTEGER) AS score_band FROM rk),
t AS (SELECT {SPLIT}, avg(TARGET) AS rate, CAST(sum(TARGET) AS DOUBLE) AS bad FROM lab GROUP BY {SPLIT}),
per AS (SELECT {SPLIT}, score_band, count(*) AS rows, CAST(sum(TARGET) AS BIGINT) AS bad_count, avg(TARGET) AS bad_rate,
  min(pd) AS min_score, max(pd) AS max_score FROM b GROUP BY {SPLIT}, score_band)
SELECT {SPLIT}, score_band,
  'top_' || CAST(CAST((score_band - 1) * 100 / 10 AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(score_band * 100 / 10 AS INTEGER) AS VARCHAR) || 'pct' AS risk_rank,
  rows, bad_count, bad_rate, bad_rate / greatest(rate, 1e-9) AS lift, bad_count / greatest(bad, 1.0) AS bad_capture,
  sum(bad_count) OVER (PARTITION BY {SPLIT} ORDER BY score_band) / greatest(bad, 1.0) AS cumulative_bad_capture,
  min_score, max_score
FROM per JOIN t USING ({SPLIT})"""
    return duck_round(sql, ["bad_rate", "lift", "bad_capture", "cumulative_bad_capture", "min_score", "max_score"])


def topk_oracle() -> str:
    vals = ", ".join(f"({_dbl(p)})" for p in EV.TOPK_TABLE_PCTS)
    sql = f"""WITH {_ranked_sql()},
k(topk_pct) AS (VALUES {vals}),
t AS (SELECT {SPLIT}, CAST(sum(TARGET) AS DOUBLE) AS tb, avg(TARGET) AS rate FROM lab GROUP BY {SPLIT}),
sel AS (SELECT rk.{SPLIT}, k.topk_pct, count(*) AS rows, CAST(sum(TARGET) AS DOUBLE) AS bad FROM rk, k
  WHERE rnk <= ceil(n * k.topk_pct) GROUP BY rk.{SPLIT}, k.topk_pct)
SELECT {SPLIT}, topk_pct, rows, CAST(bad AS BIGINT) AS bad_count, bad / rows AS bad_rate_precision,
  CASE WHEN tb > 0 THEN bad / tb END AS bad_capture_recall, CASE WHEN rate > 0 THEN (bad / rows) / rate END AS lift
FROM sel JOIN t USING ({SPLIT})"""
    return duck_round(sql, ["topk_pct", "bad_rate_precision", "bad_capture_recall", "lift"])


def ap_oracle() -> str:
    sql = f"""WITH {_ranked_sql()},
c AS (SELECT {SPLIT}, TARGET, rnk, sum(TARGET) OVER (PARTITION BY {SPLIT} ORDER BY rnk) AS tp FROM rk)
SELECT {SPLIT}, sum(CASE WHEN TARGET = 1 THEN tp / rnk END) / nullif(sum(TARGET), 0) AS average_precision
FROM c GROUP BY {SPLIT}"""
    return duck_round(sql, ["average_precision"])


def _psi_sql(col: str, name: str) -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    return f"""
q_{name} AS (SELECT list_sort(list_distinct({npq_list(col, DECILES)})) AS q FROM scored WHERE {SPLIT} = 'development'),
e_{name} AS (SELECT CASE WHEN len(q) >= 3 THEN list_concat([CAST('-inf' AS DOUBLE)], q[2:len(q) - 1], [CAST('inf' AS DOUBLE)]) END AS edges FROM q_{name}),
b_{name} AS (SELECT {SPLIT}, least(len(list_filter(edges, lambda e: e <= {col})), len(edges) - 1) AS bucket FROM scored, e_{name}),
c_{name} AS (SELECT {SPLIT}, bucket, count(*) AS c FROM b_{name} GROUP BY ALL),
t_{name} AS (SELECT {SPLIT}, sum(c) AS tc FROM c_{name} GROUP BY ALL),
r_{name} AS (SELECT bucket, c AS rc, sum(c) OVER () AS trc FROM c_{name} WHERE {SPLIT} = 'development'),
k_{name} AS (SELECT s.{SPLIT}, r.bucket FROM (SELECT DISTINCT {SPLIT} FROM scored) s, r_{name} r
  UNION SELECT {SPLIT}, bucket FROM c_{name}),
p_{name} AS (SELECT k.{SPLIT}, sum((coalesce(c.c, 0) / greatest(t.tc, 1) - coalesce(r.rc, 0) / greatest((SELECT max(trc) FROM r_{name}), 1))
  * ln((coalesce(c.c, 0) / greatest(t.tc, 1) + 1e-6) / (coalesce(r.rc, 0) / greatest((SELECT max(trc) FROM r_{name}), 1) + 1e-6))) AS {name}
  FROM k_{name} k LEFT JOIN c_{name} c USING ({SPLIT}, bucket) LEFT JOIN r_{name} r USING (bucket)
  JOIN t_{name} t USING ({SPLIT}) GROUP BY k.{SPLIT})"""


def psi_oracle() -> str:
    sql = f"""WITH {scored_sql()},{_psi_sql('pd', 'psi_pd')},{_psi_sql('a_card_score', 'psi_points')}
SELECT {SPLIT}, psi_pd, psi_points FROM p_psi_pd FULL JOIN p_psi_points USING ({SPLIT})"""
    return duck_round(sql, ["psi_pd", "psi_points"])


@register("class_weights", lambda: class_weights_oracle())
def q_class_weights(spark, sf_dir):
    dev = scored_population(spark, sf_dir).filter(F.col(SPLIT) == "development").select(KEY, "TARGET")
    return E.class_weights(dev)


def class_weights_oracle() -> str:
    sql = f"""WITH {scored_sql()},
dv AS (SELECT {KEY}, TARGET FROM scored WHERE {SPLIT} = 'development'),
r AS (SELECT avg(TARGET) AS rate FROM dv),
w AS (SELECT 0.5 / greatest(rate, 1e-6) AS wp, 0.5 / greatest(1 - rate, 1e-6) AS wn, rate FROM r)
SELECT {KEY}, TARGET, CASE WHEN TARGET = 1 THEN wp ELSE wn END / (rate * wp + (1 - rate) * wn) AS sample_weight FROM dv, w"""
    return duck_round(sql, ["sample_weight"])


@register("strategy_action_profile", lambda: action_profile_oracle())
def q_action_profile(spark, sf_dir):
    """Validation + holdout action metrics in the fixed approve / review / decline order."""
    m = K.strategy_metrics(scored_population(spark, sf_dir)).filter(F.col(SPLIT).isin("validation", "final_holdout"))
    order = F.create_map(F.lit("approve"), F.lit(1), F.lit("manual_review"), F.lit(2), F.lit("decline"), F.lit(3))
    return m.select(SPLIT, "strategy_action", order[F.col("strategy_action")].alias("action_order"), "population_pct",
                    "bad_rate", "bad_capture", "avg_pd")


def action_profile_oracle() -> str:
    inner = strategy_oracle()
    sql = f"""SELECT {SPLIT}, strategy_action, CASE strategy_action WHEN 'approve' THEN 1 WHEN 'manual_review' THEN 2
  WHEN 'decline' THEN 3 END AS action_order, population_pct, bad_rate, bad_capture, avg_pd
FROM ({inner}) s WHERE {SPLIT} IN ('validation', 'final_holdout')"""
    return sql
