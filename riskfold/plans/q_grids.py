"""Catalogue: threshold, profit and cost grids."""

from __future__ import annotations

from riskfold.operators import grids as G
from riskfold.plans.q_eval import KEY, SPLIT, _dbl, points_sql, scored_population, scored_sql
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round, npq


@register("threshold_curve", lambda: threshold_oracle())
def q_threshold_curve(spark, sf_dir):
    return G.threshold_curve(scored_population(spark, sf_dir))


@register("profit_curve", lambda: profit_oracle(False))
def q_profit_curve(spark, sf_dir):
    return G.profit_curve(G.threshold_curve(scored_population(spark, sf_dir)))


@register("profit_optimum", lambda: profit_oracle(True))
def q_profit_optimum(spark, sf_dir):
    return G.profit_optimum(G.profit_curve(G.threshold_curve(scored_population(spark, sf_dir))))


@register("cost_curve", lambda: cost_oracle(False))
def q_cost_curve(spark, sf_dir):
    return G.cost_curve(scored_population(spark, sf_dir))


@register("cost_optimum", lambda: cost_oracle(True))
def q_cost_optimum(spark, sf_dir):
    curve = G.cost_curve(scored_population(spark, sf_dir))
    return G.optimum_on_reference(curve, "cost_scenario", "incremental_value_vs_approve_all_units")


@register("amount_cost_curve", lambda: amount_oracle(False))
def q_amount_cost_curve(spark, sf_dir):
    return G.amount_cost_curve(scored_population(spark, sf_dir))


@register("amount_cost_optimum", lambda: amount_oracle(True))
def q_amount_cost_optimum(spark, sf_dir):
    curve = G.amount_cost_curve(scored_population(spark, sf_dir))
    return G.optimum_on_reference(curve, "amount_cost_scenario", "incremental_profit_proxy_amount")


@register("cost_heatmap", lambda: heatmap_oracle())
def q_cost_heatmap(spark, sf_dir):
    return G.cost_heatmap(G.amount_cost_curve(scored_population(spark, sf_dir)))


# ---------------------------------------------------------------------------
# DuckDB oracles: direct predicates per grid point (no bucketing)
# ---------------------------------------------------------------------------

def _cut(p: float) -> str:
    """Cutoff for a top fraction, as the reference defines it."""
    if p <= 0:
        return "CAST('inf' AS DOUBLE)"
    if p >= 1:
        return "CAST('-inf' AS DOUBLE)"
    return f"(SELECT {npq('pd', 1 - p)} FROM scored WHERE {SPLIT} = 'validation')"


def _score_cut(c: str) -> str:
    return f"CASE WHEN isfinite({c}) THEN {points_sql(c)} END"


THRESHOLD_DOUBLES = [
    "decline_pct_target_from_validation", "pd_cutoff_from_validation", "score_cutoff_from_validation",
    "actual_decline_pct", "decline_bad_rate", "approve_bad_rate", "decline_bad_capture", "good_rejected_capture",
    "decline_lift", "break_even_bad_loss_to_good_profit",
]


def _threshold_sql() -> str:
    vals = ", ".join(f"({_dbl(d)}, {_cut(d)})" for d in G.DECLINE_PCT_GRID)
    return f"""WITH {scored_sql()},
g(decline_pct_target_from_validation, pd_cutoff_from_validation) AS (VALUES {vals}),
lab AS (SELECT * FROM scored WHERE TARGET IS NOT NULL),
x AS (SELECT lab.{SPLIT}, g.*, pd >= pd_cutoff_from_validation AS dec, TARGET FROM lab, g),
agg AS (SELECT {SPLIT}, decline_pct_target_from_validation, any_value(pd_cutoff_from_validation) AS pd_cutoff_from_validation,
  count(*) AS rows, count(*) FILTER (WHERE dec) AS decline_rows, count(*) FILTER (WHERE NOT dec) AS approve_rows,
  CAST(sum(TARGET) AS BIGINT) AS bad_count, CAST(count(*) - sum(TARGET) AS BIGINT) AS good_count,
  CAST(coalesce(sum(TARGET) FILTER (WHERE dec), 0) AS BIGINT) AS bad_rejected_count,
  avg(TARGET) FILTER (WHERE dec) AS decline_bad_rate, avg(TARGET) FILTER (WHERE NOT dec) AS approve_bad_rate,
  avg(TARGET) AS rate
  FROM x GROUP BY {SPLIT}, decline_pct_target_from_validation),
tc AS (SELECT *, decline_rows - bad_rejected_count AS good_rejected_count FROM agg)
SELECT {SPLIT}, decline_pct_target_from_validation, pd_cutoff_from_validation,
  {_score_cut('pd_cutoff_from_validation')} AS score_cutoff_from_validation,
  rows, decline_rows, approve_rows, decline_rows / rows AS actual_decline_pct, bad_count, good_count,
  bad_rejected_count, good_rejected_count, decline_bad_rate, approve_bad_rate,
  bad_rejected_count / greatest(bad_count, 1) AS decline_bad_capture,
  good_rejected_count / greatest(good_count, 1) AS good_rejected_capture,
  CASE WHEN decline_rows > 0 THEN decline_bad_rate / greatest(rate, 1e-9) END AS decline_lift,
  CASE WHEN bad_rejected_count > 0 THEN good_rejected_count / bad_rejected_count ELSE CAST('inf' AS DOUBLE) END
    AS break_even_bad_loss_to_good_profit
FROM tc"""


def threshold_oracle() -> str:
    return duck_round(_threshold_sql(), THRESHOLD_DOUBLES)


def profit_oracle(best: bool) -> str:
    mults = ", ".join(f"({_dbl(m)})" for m in G.BAD_LOSS_TO_GOOD_PROFIT_GRID)
    curve = f"""SELECT t.{SPLIT}, t.decline_pct_target_from_validation, t.actual_decline_pct, m.bad_loss_to_good_profit,
  t.bad_rejected_count * m.bad_loss_to_good_profit - t.good_rejected_count AS net_value_vs_approve_all_units,
  (t.bad_rejected_count * m.bad_loss_to_good_profit - t.good_rejected_count) / t.rows * 10000.0 AS net_value_per_10000_applications,
  t.break_even_bad_loss_to_good_profit, t.decline_bad_rate, t.approve_bad_rate, t.decline_bad_capture,
  t.good_rejected_capture, t.bad_rejected_count, t.good_rejected_count
FROM ({_threshold_sql()}) t, (VALUES {mults}) m(bad_loss_to_good_profit)"""
    if best:
        curve = f"""SELECT * EXCLUDE (_r) FROM (SELECT *, row_number() OVER (PARTITION BY {SPLIT}, bad_loss_to_good_profit
  ORDER BY net_value_vs_approve_all_units DESC, decline_pct_target_from_validation) AS _r FROM ({curve}) c) WHERE _r = 1"""
    dbl = ["decline_pct_target_from_validation", "actual_decline_pct", "bad_loss_to_good_profit", "net_value_vs_approve_all_units",
           "net_value_per_10000_applications", "break_even_bad_loss_to_good_profit", "decline_bad_rate", "approve_bad_rate",
           "decline_bad_capture", "good_rejected_capture"]
    return duck_round(curve, dbl)


def _grid_values(scenarios, fields) -> str:
    rows = []
    for r in G.admissible_grid(scenarios):
        d, m = r[-2], r[-1]
        params = ", ".join([f"'{r[0]}'"] + [_dbl(v) for v in r[1:-2]])
        rows.append(f"({params}, {_dbl(d)}, {_dbl(m)}, {_dbl(d + m)}, {_cut(d + m)}, {_cut(d)})")
    cols = ", ".join(fields) + ", decline_pct_target_from_validation, manual_review_pct_target_from_validation, " \
        "total_intervention_pct_target, pd_manual_cutoff_from_validation, pd_decline_cutoff_from_validation"
    return f"g({cols}) AS (VALUES {', '.join(rows)})"


COST_DOUBLES = [
    "decline_pct_target_from_validation", "manual_review_pct_target_from_validation", "total_intervention_pct_target",
    "pd_manual_cutoff_from_validation", "pd_decline_cutoff_from_validation", "score_manual_cutoff_from_validation",
    "score_decline_cutoff_from_validation", "actual_direct_decline_pct", "actual_manual_review_pct", "direct_decline_bad_rate",
    "manual_review_bad_rate", "auto_approve_bad_rate", "expected_bad_saved", "expected_good_lost", "expected_bad_saved_capture",
    "expected_good_lost_capture", "expected_final_reject_pct", "expected_final_approve_bad_rate", "manual_review_cost_total",
    "incremental_value_vs_approve_all_units", "incremental_value_per_10000_applications", *G.COST_FIELDS[1:],
]


def cost_oracle(best: bool) -> str:
    sql = f"""WITH {scored_sql()},
{_grid_values(G.COST_SCENARIOS, G.COST_FIELDS)},
lab AS (SELECT * FROM scored WHERE TARGET IS NOT NULL),
x AS (SELECT lab.{SPLIT}, g.*, TARGET, CASE WHEN pd >= pd_decline_cutoff_from_validation THEN 'd'
  WHEN pd >= pd_manual_cutoff_from_validation THEN 'm' ELSE 'a' END AS act FROM lab, g),
c AS (SELECT cost_scenario, {SPLIT}, decline_pct_target_from_validation, manual_review_pct_target_from_validation,
  {', '.join(f'any_value({f}) AS {f}' for f in G.COST_FIELDS[1:])},
  any_value(total_intervention_pct_target) AS total_intervention_pct_target,
  any_value(pd_manual_cutoff_from_validation) AS pd_manual_cutoff_from_validation,
  any_value(pd_decline_cutoff_from_validation) AS pd_decline_cutoff_from_validation,
  count(*) AS rows, CAST(sum(TARGET) AS BIGINT) AS bad_count, CAST(count(*) - sum(TARGET) AS BIGINT) AS good_count,
  count(*) FILTER (WHERE act = 'd') AS direct_decline_rows, count(*) FILTER (WHERE act = 'm') AS manual_review_rows,
  count(*) FILTER (WHERE act = 'a') AS auto_approve_rows,
  CAST(count(*) FILTER (WHERE act = 'd' AND TARGET = 1) AS BIGINT) AS bad_direct_decline,
  CAST(count(*) FILTER (WHERE act = 'd' AND TARGET = 0) AS BIGINT) AS good_direct_decline,
  CAST(count(*) FILTER (WHERE act = 'm' AND TARGET = 1) AS BIGINT) AS bad_manual_review,
  CAST(count(*) FILTER (WHERE act = 'm' AND TARGET = 0) AS BIGINT) AS good_manual_review,
  CAST(count(*) FILTER (WHERE act = 'a' AND TARGET = 1) AS BIGINT) AS bad_auto_approve,
  CAST(count(*) FILTER (WHERE act = 'a' AND TARGET = 0) AS BIGINT) AS good_auto_approve
  FROM x GROUP BY cost_scenario, {SPLIT}, decline_pct_target_from_validation, manual_review_pct_target_from_validation),
v AS (SELECT *, bad_direct_decline + manual_bad_catch_rate * bad_manual_review AS expected_bad_saved,
  good_direct_decline + manual_good_false_decline_rate * good_manual_review AS expected_good_lost,
  manual_review_rows * manual_review_cost AS manual_review_cost_total,
  bad_auto_approve + (1 - manual_bad_catch_rate) * bad_manual_review AS bad_appr,
  good_auto_approve + (1 - manual_good_false_decline_rate) * good_manual_review AS good_appr,
  direct_decline_rows + manual_bad_catch_rate * bad_manual_review + manual_good_false_decline_rate * good_manual_review AS rejected
  FROM c),
w AS (SELECT *, expected_bad_saved * bad_loss_cost - expected_good_lost * false_decline_good_cost - manual_review_cost_total
  AS incremental_value_vs_approve_all_units FROM v),
curve AS (SELECT cost_scenario, {SPLIT}, decline_pct_target_from_validation, manual_review_pct_target_from_validation,
  total_intervention_pct_target, pd_manual_cutoff_from_validation, pd_decline_cutoff_from_validation,
  {_score_cut('pd_manual_cutoff_from_validation')} AS score_manual_cutoff_from_validation,
  {_score_cut('pd_decline_cutoff_from_validation')} AS score_decline_cutoff_from_validation,
  rows, bad_count, good_count, direct_decline_rows, manual_review_rows, auto_approve_rows,
  direct_decline_rows / rows AS actual_direct_decline_pct, manual_review_rows / rows AS actual_manual_review_pct,
  bad_direct_decline, good_direct_decline, bad_manual_review, good_manual_review, bad_auto_approve, good_auto_approve,
  bad_direct_decline / greatest(direct_decline_rows, 1) AS direct_decline_bad_rate,
  bad_manual_review / greatest(manual_review_rows, 1) AS manual_review_bad_rate,
  bad_auto_approve / greatest(auto_approve_rows, 1) AS auto_approve_bad_rate,
  expected_bad_saved, expected_good_lost, expected_bad_saved / greatest(bad_count, 1) AS expected_bad_saved_capture,
  expected_good_lost / greatest(good_count, 1) AS expected_good_lost_capture, rejected / rows AS expected_final_reject_pct,
  bad_appr / greatest(bad_appr + good_appr, 1e-9) AS expected_final_approve_bad_rate, manual_review_cost_total,
  incremental_value_vs_approve_all_units, incremental_value_vs_approve_all_units / rows * 10000.0 AS incremental_value_per_10000_applications,
  {', '.join(G.COST_FIELDS[1:])}
  FROM w)"""
    if best:
        sql += _best("cost_scenario", "incremental_value_vs_approve_all_units")
    else:
        sql += "\nSELECT * FROM curve"
    return duck_round(sql, COST_DOUBLES)


def _best(scen: str, value: str) -> str:
    return f""",
best AS (SELECT {scen}, decline_pct_target_from_validation, manual_review_pct_target_from_validation FROM (
  SELECT *, row_number() OVER (PARTITION BY {scen} ORDER BY {value} DESC, decline_pct_target_from_validation,
  manual_review_pct_target_from_validation) AS _r FROM curve WHERE {SPLIT} = 'validation') WHERE _r = 1)
SELECT curve.* FROM curve JOIN best USING ({scen}, decline_pct_target_from_validation, manual_review_pct_target_from_validation)"""


AMOUNT_DOUBLES = [
    "decline_pct_target_from_validation", "manual_review_pct_target_from_validation", "total_intervention_pct_target",
    "pd_manual_cutoff_from_validation", "pd_decline_cutoff_from_validation", "score_manual_cutoff_from_validation",
    "score_decline_cutoff_from_validation", "actual_direct_decline_pct", "actual_manual_review_pct", "total_credit_exposure",
    "total_bad_credit_exposure", "total_good_credit_exposure", "direct_decline_credit_exposure", "manual_review_credit_exposure",
    "auto_approve_credit_exposure", "bad_direct_decline_credit_exposure", "good_direct_decline_credit_exposure",
    "bad_manual_review_credit_exposure", "good_manual_review_credit_exposure", "bad_auto_approve_credit_exposure",
    "good_auto_approve_credit_exposure", "direct_decline_credit_share", "manual_review_credit_share",
    "direct_decline_exposure_bad_rate", "manual_review_exposure_bad_rate", "auto_approve_exposure_bad_rate",
    "expected_bad_exposure_saved", "expected_good_exposure_lost", "expected_bad_exposure_saved_capture",
    "expected_good_exposure_lost_capture", "expected_final_reject_exposure_share", "expected_final_approve_exposure_bad_rate",
    "expected_loss_saved_amount", "expected_margin_lost_amount", "manual_review_cost_amount", "incremental_profit_proxy_amount",
    "incremental_profit_proxy_per_10000_applications", "incremental_profit_proxy_per_100m_credit", "manual_review_unit_cost",
    *G.AMOUNT_FIELDS[1:],
]


def _amount_curve_sql() -> str:
    return f"""WITH {scored_sql()},
{_grid_values(G.AMOUNT_SCENARIOS, G.AMOUNT_FIELDS)},
med AS (SELECT {npq('AMT_CREDIT', 0.5)} AS med FROM scored WHERE {SPLIT} = 'validation' AND AMT_CREDIT IS NOT NULL),
lab AS (SELECT scored.*, CAST(greatest(coalesce(AMT_CREDIT, med.med), 0.0) AS DECIMAL(38,4)) AS e FROM scored, med WHERE TARGET IS NOT NULL),
x AS (SELECT lab.{SPLIT}, g.*, TARGET, e, CASE WHEN pd >= pd_decline_cutoff_from_validation THEN 'd'
  WHEN pd >= pd_manual_cutoff_from_validation THEN 'm' ELSE 'a' END AS act FROM lab, g),
c AS (SELECT amount_cost_scenario, {SPLIT}, decline_pct_target_from_validation, manual_review_pct_target_from_validation,
  {', '.join(f'any_value({f}) AS {f}' for f in G.AMOUNT_FIELDS[1:])},
  any_value(total_intervention_pct_target) AS total_intervention_pct_target,
  any_value(pd_manual_cutoff_from_validation) AS pd_manual_cutoff_from_validation,
  any_value(pd_decline_cutoff_from_validation) AS pd_decline_cutoff_from_validation,
  count(*) AS rows, count(*) FILTER (WHERE act = 'd') AS direct_decline_rows,
  count(*) FILTER (WHERE act = 'm') AS manual_review_rows, count(*) FILTER (WHERE act = 'a') AS auto_approve_rows,
  CAST(sum(e) AS DOUBLE) AS total_credit_exposure, CAST(coalesce(sum(e) FILTER (WHERE TARGET = 1), 0) AS DOUBLE) AS total_bad_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE TARGET = 0), 0) AS DOUBLE) AS total_good_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'd'), 0) AS DOUBLE) AS direct_decline_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'm'), 0) AS DOUBLE) AS manual_review_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'a'), 0) AS DOUBLE) AS auto_approve_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'd' AND TARGET = 1), 0) AS DOUBLE) AS bad_direct_decline_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'd' AND TARGET = 0), 0) AS DOUBLE) AS good_direct_decline_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'm' AND TARGET = 1), 0) AS DOUBLE) AS bad_manual_review_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'm' AND TARGET = 0), 0) AS DOUBLE) AS good_manual_review_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'a' AND TARGET = 1), 0) AS DOUBLE) AS bad_auto_approve_credit_exposure,
  CAST(coalesce(sum(e) FILTER (WHERE act = 'a' AND TARGET = 0), 0) AS DOUBLE) AS good_auto_approve_credit_exposure
  FROM x GROUP BY amount_cost_scenario, {SPLIT}, decline_pct_target_from_validation, manual_review_pct_target_from_validation),
v AS (SELECT c.*, med.med * manual_review_cost_rate_of_median_credit AS manual_review_unit_cost,
  bad_direct_decline_credit_exposure + manual_bad_catch_rate * bad_manual_review_credit_exposure AS expected_bad_exposure_saved,
  good_direct_decline_credit_exposure + manual_good_false_decline_rate * good_manual_review_credit_exposure AS expected_good_exposure_lost,
  bad_auto_approve_credit_exposure + (1 - manual_bad_catch_rate) * bad_manual_review_credit_exposure AS bad_appr,
  good_auto_approve_credit_exposure + (1 - manual_good_false_decline_rate) * good_manual_review_credit_exposure AS good_appr,
  direct_decline_credit_exposure + manual_bad_catch_rate * bad_manual_review_credit_exposure
    + manual_good_false_decline_rate * good_manual_review_credit_exposure AS rejected
  FROM c, med),
w AS (SELECT *, expected_bad_exposure_saved * lgd_rate AS expected_loss_saved_amount,
  expected_good_exposure_lost * net_margin_rate AS expected_margin_lost_amount,
  manual_review_rows * manual_review_unit_cost AS manual_review_cost_amount FROM v),
curve AS (SELECT amount_cost_scenario, {SPLIT}, decline_pct_target_from_validation, manual_review_pct_target_from_validation,
  total_intervention_pct_target, pd_manual_cutoff_from_validation, pd_decline_cutoff_from_validation,
  {_score_cut('pd_manual_cutoff_from_validation')} AS score_manual_cutoff_from_validation,
  {_score_cut('pd_decline_cutoff_from_validation')} AS score_decline_cutoff_from_validation,
  rows, direct_decline_rows, manual_review_rows, auto_approve_rows,
  direct_decline_rows / rows AS actual_direct_decline_pct, manual_review_rows / rows AS actual_manual_review_pct,
  total_credit_exposure, total_bad_credit_exposure, total_good_credit_exposure, direct_decline_credit_exposure,
  manual_review_credit_exposure, auto_approve_credit_exposure, bad_direct_decline_credit_exposure,
  good_direct_decline_credit_exposure, bad_manual_review_credit_exposure, good_manual_review_credit_exposure,
  bad_auto_approve_credit_exposure, good_auto_approve_credit_exposure,
  direct_decline_credit_exposure / greatest(total_credit_exposure, 1e-9) AS direct_decline_credit_share,
  manual_review_credit_exposure / greatest(total_credit_exposure, 1e-9) AS manual_review_credit_share,
  bad_direct_decline_credit_exposure / greatest(direct_decline_credit_exposure, 1e-9) AS direct_decline_exposure_bad_rate,
  bad_manual_review_credit_exposure / greatest(manual_review_credit_exposure, 1e-9) AS manual_review_exposure_bad_rate,
  bad_auto_approve_credit_exposure / greatest(auto_approve_credit_exposure, 1e-9) AS auto_approve_exposure_bad_rate,
  expected_bad_exposure_saved, expected_good_exposure_lost,
  expected_bad_exposure_saved / greatest(total_bad_credit_exposure, 1e-9) AS expected_bad_exposure_saved_capture,
  expected_good_exposure_lost / greatest(total_good_credit_exposure, 1e-9) AS expected_good_exposure_lost_capture,
  rejected / greatest(total_credit_exposure, 1e-9) AS expected_final_reject_exposure_share,
  bad_appr / greatest(bad_appr + good_appr, 1e-9) AS expected_final_approve_exposure_bad_rate,
  expected_loss_saved_amount, expected_margin_lost_amount, manual_review_cost_amount,
  expected_loss_saved_amount - expected_margin_lost_amount - manual_review_cost_amount AS incremental_profit_proxy_amount,
  (expected_loss_saved_amount - expected_margin_lost_amount - manual_review_cost_amount) / rows * 10000.0
    AS incremental_profit_proxy_per_10000_applications,
  (expected_loss_saved_amount - expected_margin_lost_amount - manual_review_cost_amount) / greatest(total_credit_exposure, 1e-9)
    * 100000000.0 AS incremental_profit_proxy_per_100m_credit,
  lgd_rate, net_margin_rate, manual_review_cost_rate_of_median_credit, manual_review_unit_cost,
  {', '.join(G.AMOUNT_FIELDS[4:])}
  FROM w)"""


def amount_oracle(best: bool) -> str:
    sql = _amount_curve_sql()
    sql += _best("amount_cost_scenario", "incremental_profit_proxy_amount") if best else "\nSELECT * FROM curve"
    return duck_round(sql, AMOUNT_DOUBLES)


def heatmap_oracle() -> str:
    cols = ", ".join(
        f'avg(incremental_profit_proxy_per_100m_credit) FILTER (WHERE decline_pct_target_from_validation = {_dbl(d)}) AS "{G.heatmap_column(d)}"'
        for d in G.STRATEGY_DECLINE_PCT_GRID
    )
    sql = _amount_curve_sql() + f"""
SELECT manual_review_pct_target_from_validation, {cols} FROM curve
WHERE amount_cost_scenario = 'amount_balanced_base' AND {SPLIT} = 'validation'
GROUP BY manual_review_pct_target_from_validation"""
    return duck_round(sql, ["manual_review_pct_target_from_validation"] + [G.heatmap_column(d) for d in G.STRATEGY_DECLINE_PCT_GRID])
