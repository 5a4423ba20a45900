"""Catalogue: correlation pruning, selection stages and model fits.

Model fits are rows-only in the driver's gate (they are not SQL); their
building blocks are unit-tested separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.operators import correlate as C
from riskfold.operators import evaluate as EV
from riskfold.operators import logit as L
from riskfold.operators import models as M
from riskfold.operators import screen as SC
from riskfold.plans.q_screen import DOUBLE_REPORT, REPORT_COLS, _report_sql, candidate_wide, memo, screening_report
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round, npq
from riskfold.session import materialise


#: The catalogue's bound on boosting rounds (the operator's own is 2,500): one fit, cut at its best round.
GBT_CATALOGUE_ROUNDS = 400

#: Strengths are compared after this many decimals: mirrored features (x and 1 - x) are equally strong in both engines.
STRENGTH_DECIMALS = 9

EVIDENCE_TABLE = [
    "candidate_feature", "original_feature", "encoding", "feature_group", "selection_stage", "quality_pass", "univariate_pass",
    "corr_keep", "final_stat_shortlist", "development_missing_rate", "validation_missing_rate", "development_nunique",
    "validation_nunique", "psi_development_validation", "auc", "auc_power", "ks", "iv", "screening_score", "corr_prune_threshold",
    "corr_drop_with", "corr_drop_abs_corr", "corr_drop_reason",
]
PRUNE_TABLE = [
    "candidate_feature", "corr_drop_with", "corr_drop_abs_corr", "screening_score", "auc_power", "ks", "iv",
    "development_missing_rate", "psi_development_validation", "feature_group", "encoding", "corr_drop_reason",
]


def passing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature_a, feature_b, abs_corr) of the passing features with |corr| of 0.80 or more on development."""

    def build():
        rep = screening_report(spark, sf_dir)
        # names of columns, at most one a feature
        passing = [r["candidate_feature"] for r in rep.filter("univariate_pass").select("candidate_feature").orderBy("candidate_feature").collect()]
        wide, _, _ = candidate_wide(spark, sf_dir)
        dev = wide.filter(F.col("screening_split") == "development")
        med = M.dev_medians(dev, passing) if passing else {}
        return materialise(C.strong_pairs(dev, passing, M.CORR_EXPORT, [med.get(f) for f in passing]), "correlation-pairs")

    return memo("passing_pairs", spark, sf_dir, build)


def pruned_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screening report with the correlation choice and the selection stage."""

    def build():
        rep = screening_report(spark, sf_dir)
        strengths = rep.filter("univariate_pass").select("candidate_feature", F.round(F.coalesce("screening_score", F.lit(0.0)), STRENGTH_DECIMALS).alias("strength"))
        choice = C.rank_ordered_choice(strengths, passing_pairs(spark, sf_dir), M.CORR_PRUNE).withColumnRenamed("corr_keep", "_keep")
        out = rep.join(choice, "candidate_feature", "left")
        out = out.withColumns(
            {
                "corr_keep": F.col("univariate_pass") & F.coalesce(F.col("_keep"), F.lit(False)),
                "corr_prune_threshold": F.lit(M.CORR_PRUNE),
                "corr_drop_with": F.coalesce("corr_drop_with", F.lit("")),
                "corr_drop_reason": F.coalesce("corr_drop_reason", F.lit("")),
            }
        ).drop("_keep")
        out = out.withColumn("final_stat_shortlist", F.col("univariate_pass") & F.col("corr_keep"))
        return materialise(SC.selection_stage(out), "pruned-report")

    return memo("pruned_report", spark, sf_dir, build)


def shortlist(spark: SparkSession, sf_dir: str) -> list[str]:
    """The names of the features that stay, strongest first (they become columns of the design)."""
    kept = pruned_report(spark, sf_dir).filter("final_stat_shortlist")
    order = [F.round(F.coalesce("screening_score", F.lit(0.0)), STRENGTH_DECIMALS).desc(), F.col("candidate_feature")]
    return [r["candidate_feature"] for r in kept.orderBy(*order).select("candidate_feature").collect()]


@register("correlation_prune", lambda: duck_round(_pruned_sql() + "\nSELECT * FROM pruned", [*DOUBLE_REPORT, "corr_drop_abs_corr", "corr_prune_threshold"]))
def q_correlation_prune(spark, sf_dir):
    return pruned_report(spark, sf_dir)


@register("selection_evidence", lambda: duck_round(
    _pruned_sql() + f"\nSELECT {', '.join(EVIDENCE_TABLE)} FROM pruned", [*DOUBLE_REPORT, "corr_drop_abs_corr", "corr_prune_threshold"]))
def q_selection_evidence(spark, sf_dir):
    """Every candidate's evidence and the stage that it reached."""
    return pruned_report(spark, sf_dir).select(*EVIDENCE_TABLE)


@register("prune_decisions", lambda: duck_round(
    _pruned_sql() + f"\nSELECT {', '.join(PRUNE_TABLE)} FROM pruned WHERE selection_stage = 'correlation_dropped'",
    ["corr_drop_abs_corr", "screening_score", "auc_power", "ks", "iv", "development_missing_rate", "psi_development_validation"]))
def q_prune_decisions(spark, sf_dir):
    """The features that a stronger correlated one ruled out."""
    return pruned_report(spark, sf_dir).filter("selection_stage = 'correlation_dropped'").select(*PRUNE_TABLE)


@register("screening_group_shortlist", lambda: duck_round(_pruned_sql() + """
SELECT feature_group, count(candidate_feature) AS candidate_count,
  CAST(sum(CAST(quality_pass AS INTEGER)) AS BIGINT) AS quality_pass_count,
  CAST(sum(CAST(univariate_pass AS INTEGER)) AS BIGINT) AS univariate_pass_count,
  CAST(sum(CAST(final_stat_shortlist AS INTEGER)) AS BIGINT) AS final_shortlist_count,
  median(auc_power) AS median_auc_power, median(iv) AS median_iv, median(psi_development_validation) AS median_psi_dev_val
FROM pruned GROUP BY feature_group""", ["median_auc_power", "median_iv", "median_psi_dev_val"]))
def q_group_shortlist(spark, sf_dir):
    return SC.group_summary(pruned_report(spark, sf_dir))


PAIR_META = ["feature_group", "screening_score", "auc_power", "iv", "development_missing_rate", "final_stat_shortlist"]


@register("correlation_pairs", lambda: _pairs_oracle())
def q_correlation_pairs(spark, sf_dir):
    meta = pruned_report(spark, sf_dir).select("candidate_feature", *PAIR_META)
    side = lambda s: meta.select(F.col("candidate_feature").alias(f"feature_{s}"), *[F.col(c).alias(f"feature_{s}_{c}") for c in PAIR_META])
    j = passing_pairs(spark, sf_dir).withColumnRenamed("abs_corr", "abs_corr_development").join(side("a"), "feature_a").join(side("b"), "feature_b")
    ka, kb = F.col("feature_a_final_stat_shortlist"), F.col("feature_b_final_stat_shortlist")
    return j.withColumn("above_prune_threshold", F.col("abs_corr_development") >= M.CORR_PRUNE).withColumn(
        "kept_feature", F.when(ka & ~kb, F.col("feature_a")).when(kb & ~ka, F.col("feature_b")).otherwise(F.lit(""))
    ).withColumn(
        "dropped_feature", F.when(ka & ~kb, F.col("feature_b")).when(kb & ~ka, F.col("feature_a")).otherwise(F.lit(""))
    )


def _pruned_sql() -> str:
    """The report with the choice made one feature after the other, from DuckDB's own ``corr``."""
    return "WITH RECURSIVE" + _report_sql().removeprefix("WITH") + f""",
pass AS (SELECT candidate_feature AS f, row_number() OVER (ORDER BY round(coalesce(screening_score, 0.0), {STRENGTH_DECIMALS}) DESC, candidate_feature) AS r
  FROM report WHERE univariate_pass),
dl AS (SELECT long0.SK_ID_CURR, long0.feature, CASE WHEN isnan(value) OR isinf(value) THEN NULL ELSE value END AS value
  FROM long0 JOIN pass ON long0.feature = pass.f WHERE screening_split = 'development'),
dm AS (SELECT feature, coalesce({npq('value', 0.5)}, 0.0) AS med FROM dl GROUP BY feature),
df AS MATERIALIZED (SELECT SK_ID_CURR, feature, coalesce(value, med) AS v FROM dl JOIN dm USING (feature)),
cp AS MATERIALIZED (SELECT * FROM (SELECT a.feature AS feature_a, b.feature AS feature_b, abs(corr(a.v, b.v)) AS abs_corr
  FROM df a JOIN df b ON a.SK_ID_CURR = b.SK_ID_CURR AND a.feature < b.feature GROUP BY ALL) WHERE abs_corr >= {M.CORR_EXPORT} AND NOT isnan(abs_corr)),
riv AS (SELECT CASE WHEN pa.r < pb.r THEN feature_a ELSE feature_b END AS strong, CASE WHEN pa.r < pb.r THEN feature_b ELSE feature_a END AS weak,
  least(pa.r, pb.r) AS strong_rank, abs_corr FROM cp JOIN pass pa ON feature_a = pa.f JOIN pass pb ON feature_b = pb.f WHERE abs_corr >= {M.CORR_PRUNE}),
adj AS (SELECT pass.f, pass.r, coalesce(list(riv.strong) FILTER (WHERE riv.strong IS NOT NULL), []) AS strongs
  FROM pass LEFT JOIN riv ON riv.weak = pass.f GROUP BY ALL),
walk(i, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL
  SELECT adj.r, CASE WHEN list_has_any(walk.kept, adj.strongs) THEN walk.kept ELSE list_append(walk.kept, adj.f) END
  FROM walk JOIN adj ON adj.r = walk.i + 1),
kept AS (SELECT unnest(kept) AS f FROM (SELECT kept FROM walk ORDER BY i DESC LIMIT 1)),
drops AS (SELECT weak, arg_min(strong, strong_rank) AS strong, arg_min(abs_corr, strong_rank) AS abs_corr
  FROM riv WHERE strong IN (SELECT f FROM kept) AND weak NOT IN (SELECT f FROM kept) GROUP BY weak),
p0 AS (SELECT {', '.join('report.' + c for c in REPORT_COLS)}, univariate_pass AND kept.f IS NOT NULL AS corr_keep, CAST({M.CORR_PRUNE} AS DOUBLE) AS corr_prune_threshold,
  coalesce(drops.strong, '') AS corr_drop_with, drops.abs_corr AS corr_drop_abs_corr,
  CASE WHEN drops.strong IS NULL THEN '' ELSE 'corr>={M.CORR_PRUNE} with stronger feature ' || drops.strong END AS corr_drop_reason,
  univariate_pass AND kept.f IS NOT NULL AS final_stat_shortlist
  FROM report LEFT JOIN kept ON kept.f = candidate_feature LEFT JOIN drops ON drops.weak = candidate_feature),
pruned AS (SELECT *, CASE WHEN final_stat_shortlist THEN 'final_shortlist' WHEN univariate_pass AND NOT corr_keep THEN 'correlation_dropped'
  WHEN quality_pass AND NOT univariate_pass THEN 'failed_univariate_screen' WHEN NOT quality_pass THEN 'failed_quality_screen'
  ELSE 'not_reviewed' END AS selection_stage FROM p0)"""


def _pairs_oracle() -> str:
    meta = lambda s: ", ".join(f"{s}.{c} AS feature_{s}_{c}" for c in PAIR_META)
    one = "CASE WHEN a.final_stat_shortlist AND NOT b.final_stat_shortlist THEN {} WHEN b.final_stat_shortlist AND NOT a.final_stat_shortlist THEN {} ELSE '' END"
    sql = _pruned_sql() + f"""
SELECT feature_a, feature_b, abs_corr AS abs_corr_development, {meta('a')}, {meta('b')}, abs_corr >= {M.CORR_PRUNE} AS above_prune_threshold,
  {one.format('feature_a', 'feature_b')} AS kept_feature, {one.format('feature_b', 'feature_a')} AS dropped_feature
FROM cp JOIN pruned a ON a.candidate_feature = feature_a JOIN pruned b ON b.candidate_feature = feature_b"""
    doubles = [f"feature_{s}_{c}" for s in "ab" for c in ("screening_score", "auc_power", "iv", "development_missing_rate")]
    return duck_round(sql, ["abs_corr_development", *doubles])


def design_fit(spark: SparkSession, sf_dir: str) -> list[dict]:
    return memo("design_fit", spark, sf_dir, lambda: M.design_fit(candidate_wide(spark, sf_dir)[0], shortlist(spark, sf_dir)))


def design(spark: SparkSession, sf_dir: str):
    """(key, split, label, raw values, features vector) of the shortlist, and the vector's names."""

    def build():
        wide, _, _ = candidate_wide(spark, sf_dir)
        d, names = M.apply_design(wide, shortlist(spark, sf_dir), design_fit(spark, sf_dir), with_raw=True)
        return materialise(d, "design"), names

    return memo("design", spark, sf_dir, build)


def logit(spark: SparkSession, sf_dir: str):
    """(fit, scored rows, names of the design)."""

    def build():
        d, names = design(spark, sf_dir)
        fit, scored = M.fit_logit_staged(d.drop("raw"))
        return fit, materialise(scored, "logit-scored"), names

    return memo("logit", spark, sf_dir, build)


def gbt(spark: SparkSession, sf_dir: str):
    """(fit, scored rows, names of the design)."""

    def build():
        d, names = design(spark, sf_dir)
        fit, scored = M.fit_gbt(d.drop("raw"), max_rounds=GBT_CATALOGUE_ROUNDS)
        return fit, materialise(scored, "gbt-scored"), names

    return memo("gbt", spark, sf_dir, build)


def _metrics(scored: DataFrame) -> DataFrame:
    m = EV.split_metrics(scored, score="pred")
    psi = EV.score_psi(scored, "pred").withColumnRenamed("psi", "psi_vs_development")
    return m.join(psi, "screening_split", "left")


@register("logit_metrics")
def q_logit_metrics(spark, sf_dir):
    return _metrics(logit(spark, sf_dir)[1])


@register("logit_coefficients")
def q_logit_coefficients(spark, sf_dir):
    fit, _, names = logit(spark, sf_dir)
    return M.coefficient_evidence(M.coefficient_table(spark, fit.coefficients, fit.intercept, names), pruned_report(spark, sf_dir))


@register("gbt_metrics")
def q_gbt_metrics(spark, sf_dir):
    return _metrics(gbt(spark, sf_dir)[1])


@register("gbt_importance")
def q_gbt_importance(spark, sf_dir):
    fit, _, names = gbt(spark, sf_dir)
    return M.importance_table(fit.nodes, names)


@register("importance_evidence")
def q_importance_evidence(spark, sf_dir):
    """Importance of every shortlisted feature with its screening evidence."""
    return M.importance_by_feature(q_gbt_importance(spark, sf_dir), pruned_report(spark, sf_dir))


@register("gbt_training_history")
def q_gbt_history(spark, sf_dir):
    """Loss after every tree and AUC after every tenth, by split; the best round is marked."""
    return gbt(spark, sf_dir)[0].history


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    a = _metrics(logit(spark, sf_dir)[1]).withColumn("model", F.lit("logistic_l2"))
    b = _metrics(gbt(spark, sf_dir)[1]).withColumn("model", F.lit("gradient_boosted_trees"))
    return a.unionByName(b)


@register("logit_training_history")
def q_logit_history(spark, sf_dir):
    """Weighted loss on development, loss, AUC and KS on validation, every ten steps."""
    return M.logit_history(spark, logit(spark, sf_dir)[0])


@register("model_card")
def q_model_card(spark, sf_dir):
    lf, ls, names = logit(spark, sf_dir)
    gf, gs, _ = gbt(spark, sf_dir)
    a = M.model_card(spark, "logistic_l2", names, _metrics(ls), best_iteration=lf.best_step, shift=lf.shift, intercept=lf.intercept,
                     params={"l2": M.L2, "weights": "class_balanced", "learning_rate": L.LEARNING_RATE, "max_steps": L.MAX_STEPS, "patience": L.PATIENCE})
    b = M.model_card(spark, "gradient_boosted_trees", names, _metrics(gs), best_iteration=gf.best_round, shift=gf.shift, intercept=None,
                     params={"stepSize": M.GBT_STEP, "maxDepth": 5, "minLeafRows": M.GBT_LEAF_ROWS, "maxRounds": GBT_CATALOGUE_ROUNDS, "patience": M.GBT_PATIENCE,
                             "roundsFitted": gf.rounds_fitted})
    return a.unionByName(b)


@register("project_overview")
def q_project_overview(spark, sf_dir):
    """Headline totals across the pipeline's reports (one row)."""
    from riskfold.plans.q_eval import scored_population
    from riskfold.plans.q_store import feature_store

    rep = pruned_report(spark, sf_dir)
    fs = feature_store(spark, sf_dir)
    counts = rep.agg(
        F.count(F.lit(1)).alias("candidate_features"),
        F.sum(F.col("quality_pass").cast("bigint")).alias("quality_pass_features"),
        F.sum(F.col("univariate_pass").cast("bigint")).alias("univariate_pass_features"),
        F.sum(F.col("final_stat_shortlist").cast("bigint")).alias("shortlist_features"),
    ).first()
    apps = fs.count()
    scored = scored_population(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.sum((F.col("strategy_action") == "decline").cast("bigint")).alias("declined_rows"),
    ).first()
    row = (apps, len(fs.columns), counts["candidate_features"], counts["quality_pass_features"],
           counts["univariate_pass_features"], counts["shortlist_features"], scored["scored_rows"], scored["declined_rows"])
    return spark.createDataFrame(
        [row],
        "applications bigint, feature_store_columns int, candidate_features bigint, quality_pass_features bigint, "
        "univariate_pass_features bigint, shortlist_features bigint, scored_rows bigint, declined_rows bigint",
    )
