"""Threshold, profit and cost grids in one pass over the scored rows.

The reference rescans every labelled row for every grid point.  Here:

1. the distinct cut fractions of the whole grid (at most ~30) become exact
   validation PD quantiles — a few driver literals;
2. each row gets ``cut_bucket`` = number of sorted cutoffs <= pd, so
   ``pd >= cutoff_k`` <=> ``cut_bucket >= k``;
3. one ``groupBy(split, cut_bucket)`` sums rows, bads and exposures, and a
   suffix sum turns those into "at or above cutoff k" totals;
4. every grid point reads two of those rows by equi-join on the bucket index.

The data are scanned once whatever the grid size; grid tables are bounded by
the grid definition and broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfold.functions.core import pd_to_points
from riskfold.operators.scorecard import bucket_cumulative, cutoff_buckets, quantile_values

# Fixed grids and scenarios.
DECLINE_PCT_GRID = (0.01, 0.03, 0.05, 0.07, 0.10, 0.12, 0.15, 0.20, 0.25, 0.30)
BAD_LOSS_TO_GOOD_PROFIT_GRID = (1.0, 2.0, 3.0, 5.0, 8.0, 10.0)
STRATEGY_DECLINE_PCT_GRID = (0.00, 0.01, 0.03, 0.05, 0.07, 0.10, 0.12, 0.15, 0.20, 0.25, 0.30)
STRATEGY_MANUAL_REVIEW_PCT_GRID = (0.00, 0.03, 0.05, 0.07, 0.10, 0.15, 0.20, 0.25, 0.30)
MAX_TOTAL_INTERVENTION_PCT = 0.50

# (name, bad loss, false decline, review cost, catch, good lost, max decline, max review, max total)
COST_SCENARIOS = (
    ("low_bad_loss_low_manual_value", 3.0, 1.0, 0.10, 0.35, 0.04, 0.10, 0.10, 0.20),
    ("balanced_base", 5.0, 1.0, 0.10, 0.60, 0.06, 0.15, 0.10, 0.25),
    ("high_bad_loss_strong_manual", 8.0, 1.0, 0.10, 0.70, 0.08, 0.20, 0.15, 0.35),
    ("expensive_manual_conservative_reject", 5.0, 1.5, 0.25, 0.50, 0.05, 0.10, 0.10, 0.20),
)
COST_FIELDS = (
    "cost_scenario", "bad_loss_cost", "false_decline_good_cost", "manual_review_cost", "manual_bad_catch_rate",
    "manual_good_false_decline_rate", "max_direct_decline_pct", "max_manual_review_pct", "max_total_intervention_pct",
)
# (name, LGD, net margin, review cost rate of median credit, catch, good lost, max decline, max review, max total)
AMOUNT_SCENARIOS = (
    ("low_lgd_low_margin", 0.35, 0.05, 0.0010, 0.35, 0.04, 0.10, 0.10, 0.20),
    ("amount_balanced_base", 0.50, 0.08, 0.0010, 0.60, 0.06, 0.15, 0.10, 0.25),
    ("high_lgd_growth", 0.70, 0.10, 0.0010, 0.70, 0.08, 0.20, 0.15, 0.35),
    ("high_margin_high_false_decline", 0.50, 0.12, 0.0020, 0.50, 0.05, 0.10, 0.10, 0.20),
)
AMOUNT_FIELDS = (
    "amount_cost_scenario", "lgd_rate", "net_margin_rate", "manual_review_cost_rate_of_median_credit",
    "manual_bad_catch_rate", "manual_good_false_decline_rate", "max_direct_decline_pct", "max_manual_review_pct",
    "max_total_intervention_pct",
)

SPLIT, LABEL, PD = "screening_split", "TARGET", "pd"
MONEY = "decimal(38,4)"


def admissible_grid(scenarios: Sequence[tuple]) -> list[tuple]:
    """(scenario row..., decline, review) for every admissible grid point."""
    out = []
    for sc in scenarios:
        max_d, max_m, max_t = sc[6], sc[7], sc[8]
        for d in STRATEGY_DECLINE_PCT_GRID:
            for m in STRATEGY_MANUAL_REVIEW_PCT_GRID:
                if d + m > MAX_TOTAL_INTERVENTION_PCT or d > max_d or m > max_m or d + m > max_t:
                    continue
                out.append((*sc, d, m))
    return out


def top_pct_cutoff(qmap: dict[float, float], top_pct: float) -> float:
    if top_pct <= 0:
        return math.inf
    if top_pct >= 1:
        return -math.inf
    return qmap[top_pct]


class CutoffTable:
    """Bucketed "at or above cutoff" totals for a set of top-percent fractions."""

    def __init__(self, scored: DataFrame, top_pcts: Sequence[float], values: dict[str, Column],
                 reference: str = "validation", key: str = "SK_ID_CURR"):
        fracs = sorted({p for p in top_pcts if 0 < p < 1})
        qv = quantile_values(scored.filter(F.col(SPLIT) == reference), PD, [1 - p for p in fracs], key)
        self.qmap = dict(zip(fracs, qv))
        self.cuts = sorted(set(qv))
        self.n_cuts = len(self.cuts)
        lab = scored.filter(F.col(LABEL).isNotNull())
        b = cutoff_buckets(lab, self.cuts, PD)
        self.cum = bucket_cumulative(b, SPLIT, values, self.n_cuts + 1)
        self.values = list(values)

    def cutoff(self, top_pct: float) -> float:
        return top_pct_cutoff(self.qmap, top_pct)

    def index(self, cutoff: float) -> int:
        """k with ``pd >= cutoff`` <=> ``cut_bucket >= k``."""
        if cutoff == math.inf:
            return self.n_cuts + 1
        if cutoff == -math.inf:
            return 0
        return self.cuts.index(cutoff) + 1

    def at(self, k_col: str, prefix: str) -> DataFrame:
        return self.cum.select(SPLIT, F.col("cut_bucket").alias(k_col), *[F.col(f"ge_{v}").alias(f"{prefix}{v}") for v in self.values])

    def totals(self) -> DataFrame:
        return self.at("_k0", "t_").filter(F.col("_k0") == 0).drop("_k0")


def _score_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(math.inf)), pd_to_points(c))


def threshold_curve(scored: DataFrame, reference: str = "validation", key: str = "SK_ID_CURR") -> DataFrame:
    """K8: for each decline % of the validation PD, decline/approve counts and rates per split."""
    ct = CutoffTable(scored, DECLINE_PCT_GRID, {"n": F.lit(1.0), "bad": F.col(LABEL).cast("double")}, reference, key)
    spark = scored.sparkSession
    g = spark.createDataFrame(
        [(d, ct.cutoff(d), ct.index(ct.cutoff(d))) for d in DECLINE_PCT_GRID],
        "decline_pct_target_from_validation double, pd_cutoff_from_validation double, k int",
    )
    j = ct.at("k", "d_").join(F.broadcast(g), "k").join(ct.totals(), SPLIT)
    n, bad = F.col("t_n"), F.col("t_bad")
    dn, db = F.col("d_n"), F.col("d_bad")
    gr = dn - db
    dec_rate = F.when(dn > 0, db / dn)
    return j.select(
        SPLIT,
        "decline_pct_target_from_validation",
        "pd_cutoff_from_validation",
        _score_or_null(F.col("pd_cutoff_from_validation")).alias("score_cutoff_from_validation"),
        n.cast("bigint").alias("rows"),
        dn.cast("bigint").alias("decline_rows"),
        (n - dn).cast("bigint").alias("approve_rows"),
        (dn / n).alias("actual_decline_pct"),
        bad.cast("bigint").alias("bad_count"),
        (n - bad).cast("bigint").alias("good_count"),
        db.cast("bigint").alias("bad_rejected_count"),
        gr.cast("bigint").alias("good_rejected_count"),
        dec_rate.alias("decline_bad_rate"),
        F.when(n - dn > 0, (bad - db) / (n - dn)).alias("approve_bad_rate"),
        (db / F.greatest(bad, F.lit(1.0))).alias("decline_bad_capture"),
        (gr / F.greatest(n - bad, F.lit(1.0))).alias("good_rejected_capture"),
        F.when(dn > 0, dec_rate / F.greatest(bad / n, F.lit(1e-9))).alias("decline_lift"),
        F.when(db > 0, gr / db).otherwise(F.lit(math.inf)).alias("break_even_bad_loss_to_good_profit"),
    )


def profit_curve(threshold: DataFrame) -> DataFrame:
    """K9: value of each decline point for each bad-loss / good-profit multiple."""
    mult = F.explode(F.array(*[F.lit(m) for m in BAD_LOSS_TO_GOOD_PROFIT_GRID])).alias("bad_loss_to_good_profit")
    x = threshold.select("*", mult)
    value = F.col("bad_rejected_count") * F.col("bad_loss_to_good_profit") - F.col("good_rejected_count")
    return x.select(
        SPLIT,
        "decline_pct_target_from_validation",
        "actual_decline_pct",
        "bad_loss_to_good_profit",
        value.alias("net_value_vs_approve_all_units"),
        (value / F.col("rows") * F.lit(10000.0)).alias("net_value_per_10000_applications"),
        "break_even_bad_loss_to_good_profit",
        "decline_bad_rate",
        "approve_bad_rate",
        "decline_bad_capture",
        "good_rejected_capture",
        "bad_rejected_count",
        "good_rejected_count",
    )


def profit_optimum(curve: DataFrame) -> DataFrame:
    """Best decline point per (split, multiple); ties -> lowest decline %. The curve is grid-sized."""
    w = Window.partitionBy(SPLIT, "bad_loss_to_good_profit").orderBy(
        F.col("net_value_vs_approve_all_units").desc(), F.col("decline_pct_target_from_validation")
    )
    return curve.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def _grid_frame(spark, rows: list[tuple], fields: Sequence[str], ct: CutoffTable) -> DataFrame:
    data = []
    for r in rows:
        d, m = r[-2], r[-1]
        dc, mc = ct.cutoff(d), ct.cutoff(d + m)
        data.append((*r, d + m, mc, dc, ct.index(dc), ct.index(mc)))
    schema = (
        f"{fields[0]} string, " + ", ".join(f"{f} double" for f in fields[1:])
        + ", decline_pct_target_from_validation double, manual_review_pct_target_from_validation double"
        + ", total_intervention_pct_target double, pd_manual_cutoff_from_validation double"
        + ", pd_decline_cutoff_from_validation double, k_dec int, k_man int"
    )
    return spark.createDataFrame(data, schema)


def _joined(ct: CutoffTable, g: DataFrame) -> DataFrame:
    return ct.at("k_dec", "d_").join(F.broadcast(g), "k_dec").join(ct.at("k_man", "m_"), [SPLIT, "k_man"]).join(ct.totals(), SPLIT)


def cost_curve(scored: DataFrame, reference: str = "validation", key: str = "SK_ID_CURR") -> DataFrame:
    """Expected counts, values and rates for every admissible (scenario, decline, review)."""
    grid = admissible_grid(COST_SCENARIOS)
    fracs = {r[-2] for r in grid} | {r[-2] + r[-1] for r in grid}
    ct = CutoffTable(scored, sorted(fracs), {"n": F.lit(1.0), "bad": F.col(LABEL).cast("double")}, reference, key)
    j = _joined(ct, _grid_frame(scored.sparkSession, grid, COST_FIELDS, ct))
    n, bad = F.col("t_n"), F.col("t_bad")
    good = n - bad
    dn, db = F.col("d_n"), F.col("d_bad")
    mn, mb = F.col("m_n") - dn, F.col("m_bad") - db
    an, ab = n - F.col("m_n"), bad - F.col("m_bad")
    dg, mg, ag = dn - db, mn - mb, an - ab
    catch, glost = F.col("manual_bad_catch_rate"), F.col("manual_good_false_decline_rate")
    saved = db + catch * mb
    lost = dg + glost * mg
    review_total = mn * F.col("manual_review_cost")
    value = saved * F.col("bad_loss_cost") - lost * F.col("false_decline_good_cost") - review_total
    bad_appr = ab + (F.lit(1.0) - catch) * mb
    good_appr = ag + (F.lit(1.0) - glost) * mg
    rejected = dn + catch * mb + glost * mg
    one = F.lit(1.0)
    return j.select(
        "cost_scenario", SPLIT, "decline_pct_target_from_validation", "manual_review_pct_target_from_validation",
        "total_intervention_pct_target", "pd_manual_cutoff_from_validation", "pd_decline_cutoff_from_validation",
        _score_or_null(F.col("pd_manual_cutoff_from_validation")).alias("score_manual_cutoff_from_validation"),
        _score_or_null(F.col("pd_decline_cutoff_from_validation")).alias("score_decline_cutoff_from_validation"),
        n.cast("bigint").alias("rows"), bad.cast("bigint").alias("bad_count"), good.cast("bigint").alias("good_count"),
        dn.cast("bigint").alias("direct_decline_rows"), mn.cast("bigint").alias("manual_review_rows"),
        an.cast("bigint").alias("auto_approve_rows"),
        (dn / n).alias("actual_direct_decline_pct"), (mn / n).alias("actual_manual_review_pct"),
        db.cast("bigint").alias("bad_direct_decline"), dg.cast("bigint").alias("good_direct_decline"),
        mb.cast("bigint").alias("bad_manual_review"), mg.cast("bigint").alias("good_manual_review"),
        ab.cast("bigint").alias("bad_auto_approve"), ag.cast("bigint").alias("good_auto_approve"),
        (db / F.greatest(dn, one)).alias("direct_decline_bad_rate"),
        (mb / F.greatest(mn, one)).alias("manual_review_bad_rate"),
        (ab / F.greatest(an, one)).alias("auto_approve_bad_rate"),
        saved.alias("expected_bad_saved"), lost.alias("expected_good_lost"),
        (saved / F.greatest(bad, one)).alias("expected_bad_saved_capture"),
        (lost / F.greatest(good, one)).alias("expected_good_lost_capture"),
        (rejected / n).alias("expected_final_reject_pct"),
        (bad_appr / F.greatest(bad_appr + good_appr, F.lit(1e-9))).alias("expected_final_approve_bad_rate"),
        review_total.alias("manual_review_cost_total"),
        value.alias("incremental_value_vs_approve_all_units"),
        (value / n * F.lit(10000.0)).alias("incremental_value_per_10000_applications"),
        *COST_FIELDS[1:],
    )


def optimum_on_reference(curve: DataFrame, scenario_col: str, value_col: str, reference: str = "validation") -> DataFrame:
    """W5 + J6: best grid point per scenario on the reference split, applied to every split."""
    keys = [scenario_col, "decline_pct_target_from_validation", "manual_review_pct_target_from_validation"]
    w = Window.partitionBy(scenario_col).orderBy(
        F.col(value_col).desc(), F.col("decline_pct_target_from_validation"), F.col("manual_review_pct_target_from_validation")
    )
    best = (
        curve.filter(F.col(SPLIT) == reference)
        .withColumn("_r", F.row_number().over(w))
        .filter(F.col("_r") == 1)
        .select(*keys)
    )
    return curve.join(F.broadcast(best), keys, "inner")


def amount_cost_curve(scored: DataFrame, reference: str = "validation", key: str = "SK_ID_CURR",
                      exposure_col: str = "AMT_CREDIT") -> DataFrame:
    """The cost grid weighted by credit exposure (NULL -> validation median, floor 0)."""
    med = quantile_values(scored.filter(F.col(SPLIT) == reference), exposure_col, [0.5], key)[0]
    # Money is summed exactly: credit amounts carry cents and the imputed
    # median at most one more digit, so DECIMAL(38,4) holds every exposure and
    # every "at or above cutoff" difference without rounding.
    expo = F.greatest(F.coalesce(F.col(exposure_col), F.lit(float(med))), F.lit(0.0)).cast(MONEY)
    y = F.col(LABEL).cast("int")
    grid = admissible_grid(AMOUNT_SCENARIOS)
    fracs = {r[-2] for r in grid} | {r[-2] + r[-1] for r in grid}
    ct = CutoffTable(scored, sorted(fracs), {"n": F.lit(1.0), "e": expo, "be": (expo * y).cast(MONEY)}, reference, key)
    j = _joined(ct, _grid_frame(scored.sparkSession, grid, AMOUNT_FIELDS, ct))

    def dbl(c):
        return c.cast("double")

    n = F.col("t_n")
    te, tbe, tge = dbl(F.col("t_e")), dbl(F.col("t_be")), dbl(F.col("t_e") - F.col("t_be"))
    dn, de, dbe = F.col("d_n"), dbl(F.col("d_e")), dbl(F.col("d_be"))
    mn = F.col("m_n") - dn
    me, mbe = dbl(F.col("m_e") - F.col("d_e")), dbl(F.col("m_be") - F.col("d_be"))
    an = n - F.col("m_n")
    ae, abe = dbl(F.col("t_e") - F.col("m_e")), dbl(F.col("t_be") - F.col("m_be"))
    dge = dbl(F.col("d_e") - F.col("d_be"))
    mge = dbl((F.col("m_e") - F.col("d_e")) - (F.col("m_be") - F.col("d_be")))
    age = dbl((F.col("t_e") - F.col("m_e")) - (F.col("t_be") - F.col("m_be")))
    catch, glost = F.col("manual_bad_catch_rate"), F.col("manual_good_false_decline_rate")
    unit = F.lit(float(med)) * F.col("manual_review_cost_rate_of_median_credit")
    saved = dbe + catch * mbe
    lost = dge + glost * mge
    bad_appr = abe + (F.lit(1.0) - catch) * mbe
    good_appr = age + (F.lit(1.0) - glost) * mge
    rejected = de + catch * mbe + glost * mge
    loss_saved = saved * F.col("lgd_rate")
    margin_lost = lost * F.col("net_margin_rate")
    review_amt = mn * unit
    profit = loss_saved - margin_lost - review_amt
    tiny = F.lit(1e-9)
    return j.select(
        "amount_cost_scenario", SPLIT, "decline_pct_target_from_validation", "manual_review_pct_target_from_validation",
        "total_intervention_pct_target", "pd_manual_cutoff_from_validation", "pd_decline_cutoff_from_validation",
        _score_or_null(F.col("pd_manual_cutoff_from_validation")).alias("score_manual_cutoff_from_validation"),
        _score_or_null(F.col("pd_decline_cutoff_from_validation")).alias("score_decline_cutoff_from_validation"),
        n.cast("bigint").alias("rows"), dn.cast("bigint").alias("direct_decline_rows"),
        mn.cast("bigint").alias("manual_review_rows"), an.cast("bigint").alias("auto_approve_rows"),
        (dn / n).alias("actual_direct_decline_pct"), (mn / n).alias("actual_manual_review_pct"),
        te.alias("total_credit_exposure"), tbe.alias("total_bad_credit_exposure"), tge.alias("total_good_credit_exposure"),
        de.alias("direct_decline_credit_exposure"), me.alias("manual_review_credit_exposure"),
        ae.alias("auto_approve_credit_exposure"), dbe.alias("bad_direct_decline_credit_exposure"),
        dge.alias("good_direct_decline_credit_exposure"), mbe.alias("bad_manual_review_credit_exposure"),
        mge.alias("good_manual_review_credit_exposure"), abe.alias("bad_auto_approve_credit_exposure"),
        age.alias("good_auto_approve_credit_exposure"),
        (de / F.greatest(te, tiny)).alias("direct_decline_credit_share"),
        (me / F.greatest(te, tiny)).alias("manual_review_credit_share"),
        (dbe / F.greatest(de, tiny)).alias("direct_decline_exposure_bad_rate"),
        (mbe / F.greatest(me, tiny)).alias("manual_review_exposure_bad_rate"),
        (abe / F.greatest(ae, tiny)).alias("auto_approve_exposure_bad_rate"),
        saved.alias("expected_bad_exposure_saved"), lost.alias("expected_good_exposure_lost"),
        (saved / F.greatest(tbe, tiny)).alias("expected_bad_exposure_saved_capture"),
        (lost / F.greatest(tge, tiny)).alias("expected_good_exposure_lost_capture"),
        (rejected / F.greatest(te, tiny)).alias("expected_final_reject_exposure_share"),
        (bad_appr / F.greatest(bad_appr + good_appr, tiny)).alias("expected_final_approve_exposure_bad_rate"),
        loss_saved.alias("expected_loss_saved_amount"), margin_lost.alias("expected_margin_lost_amount"),
        review_amt.alias("manual_review_cost_amount"), profit.alias("incremental_profit_proxy_amount"),
        (profit / n * F.lit(10000.0)).alias("incremental_profit_proxy_per_10000_applications"),
        (profit / F.greatest(te, tiny) * F.lit(100_000_000.0)).alias("incremental_profit_proxy_per_100m_credit"),
        "lgd_rate", "net_margin_rate", "manual_review_cost_rate_of_median_credit",
        unit.alias("manual_review_unit_cost"),
        *AMOUNT_FIELDS[4:],
    )


def cost_heatmap(amount_curve: DataFrame, scenario: str = "amount_balanced_base", split: str = "validation") -> DataFrame:
    """Manual % x decline % pivot of the profit per 100m credit."""
    part = amount_curve.filter((F.col("amount_cost_scenario") == scenario) & (F.col(SPLIT) == split))
    wide = part.groupBy("manual_review_pct_target_from_validation").pivot(
        "decline_pct_target_from_validation", list(STRATEGY_DECLINE_PCT_GRID)
    ).agg(F.avg("incremental_profit_proxy_per_100m_credit"))
    return wide.select(
        "manual_review_pct_target_from_validation",
        *[F.col(f"`{d!r}`").alias(heatmap_column(d)) for d in STRATEGY_DECLINE_PCT_GRID],
    )


def heatmap_column(decline_pct: float) -> str:
    return f"decline_{round(decline_pct * 100):02d}pct"


def scenario_assumptions(spark) -> DataFrame:
    """The unit-cost scenario table (fixed values above) as a DataFrame."""
    schema = f"{COST_FIELDS[0]} string, " + ", ".join(f"{f} double" for f in COST_FIELDS[1:])
    return spark.createDataFrame(list(COST_SCENARIOS), schema)


def amount_assumptions(spark) -> DataFrame:
    """The amount-weighted scenario table as a DataFrame."""
    schema = f"{AMOUNT_FIELDS[0]} string, " + ", ".join(f"{f} double" for f in AMOUNT_FIELDS[1:])
    return spark.createDataFrame(list(AMOUNT_SCENARIOS), schema)
