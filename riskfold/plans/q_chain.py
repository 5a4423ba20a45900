"""Catalogue: the fitted trees as one chain - artefact, scorecard, decision, reasons.

The boosted fit is written as an artefact and loaded again; everything here is scored and explained from the loaded
files.  Model fits are not SQL, so these queries are rows-only in the driver's gate; identities are tested.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.operators import artifact as A
from riskfold.operators import evaluate as EV
from riskfold.operators import explain as X
from riskfold.operators import models as M
from riskfold.operators import scorecard as K
from riskfold.operators import segments as G
from riskfold.operators.trees import add_margin
from riskfold.plans import q_models as QM
from riskfold.plans import q_store as QS
from riskfold.plans.q_screen import candidate_wide, memo
from riskfold.plans.registry import register
from riskfold.session import ensure_checkpoint_dir, materialise

KEY, SPLIT, LABEL = M.KEY, M.SPLIT, M.LABEL
REASON_KEYS = [KEY, SPLIT, "strategy_action", LABEL, "pd", "a_card_score"]


def artifact(spark: SparkSession, sf_dir: str) -> A.ScoringArtifact:
    def build():
        fit, _, _ = QM.gbt(spark, sf_dir)
        d, _ = QM.design(spark, sf_dir)
        margins = materialise(add_margin(d.drop("raw"), fit.trees), "chain-margins")
        path = f"{ensure_checkpoint_dir(spark)}/scoring-artifact-{uuid.uuid4().hex}"
        A.save_artifact(path, QM.shortlist(spark, sf_dir), QM.design_fit(spark, sf_dir), fit, A.fit_artifact(margins, fit.shift))
        return A.load_artifact(spark, path)

    return memo("scoring_artifact", spark, sf_dir, build)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every application with pd, points, grade and decision of the loaded artefact."""

    def build():
        return materialise(artifact(spark, sf_dir).score(candidate_wide(spark, sf_dir)[0]), "chain-scored")

    return memo("chain_scored", spark, sf_dir, build)


def explained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Validation and holdout rows with their decision and the contributions behind it."""

    def build():
        wide, _, _ = candidate_wide(spark, sf_dir)
        rows, own = artifact(spark, sf_dir).explain(wide.filter(F.col(SPLIT).isin(*X.EXPLAIN_SPLITS)))
        decided = scored(spark, sf_dir).select(KEY, "pd", "a_card_score", "strategy_action")
        return materialise(rows.join(decided, KEY), "chain-explained"), own

    return memo("chain_explained", spark, sf_dir, build)


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, own = explained(spark, sf_dir)
    return X.reason_rows(rows, own, REASON_KEYS)


@register("model_score_metrics")
def q_metrics(spark, sf_dir):
    """E1, M6 on the fitted model's points."""
    pop = scored(spark, sf_dir)
    psi = EV.score_psi(pop, "a_card_score").withColumnRenamed("psi", "score_psi_vs_development")
    return EV.split_metrics(pop, score="pd", extra_means=["a_card_score"]).join(psi, SPLIT, "left")


@register("model_score_bands")
def q_bands(spark, sf_dir):
    return K.score_band_metrics(scored(spark, sf_dir))


@register("model_strategy_actions")
def q_actions(spark, sf_dir):
    return K.strategy_metrics(scored(spark, sf_dir))


@register("model_external_predictions")
def q_external(spark, sf_dir):
    """K7: probability, points, grade and decision of the unlabelled applications."""
    rows = scored(spark, sf_dir).filter(F.col(SPLIT) == "external_unlabeled")
    return rows.select(KEY, F.col("pd").alias("pred_default_probability"), "a_card_score", "score_grade", "strategy_action")


@register("model_submission")
def q_submission(spark, sf_dir):
    """K7: the unlabelled applications' probability under the label's name."""
    return scored(spark, sf_dir).filter(F.col(SPLIT) == "external_unlabeled").select(KEY, F.col("pd").alias(LABEL))


@register("model_score_scale")
def q_scale(spark, sf_dir):
    return A.score_scale(spark, artifact(spark, sf_dir))


@register("model_contributions_global")
def q_global(spark, sf_dir):
    """Mean contributions of every feature with its evidence and importance."""
    rows, own = explained(spark, sf_dir)
    found = X.global_importance(rows, own).withColumnRenamed("feature", "candidate_feature")
    return found.join(QM.q_importance_evidence(spark, sf_dir), "candidate_feature", "left")


@register("model_reason_codes")
def q_reasons(spark, sf_dir):
    return reasons(spark, sf_dir)


@register("model_reason_summary")
def q_reason_summary(spark, sf_dir):
    return X.reason_summary(reasons(spark, sf_dir), explained(spark, sf_dir)[0])


@register("model_reason_sample")
def q_reason_sample(spark, sf_dir):
    return X.reason_sample(reasons(spark, sf_dir))


def holdout_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holdout's decisions with the applicants' repayment capacity."""
    holdout = scored(spark, sf_dir).filter(F.col(SPLIT) == "final_holdout")
    return G.with_capacity(holdout, QS.feature_store(spark, sf_dir), KEY, also=CASE_AMOUNTS)


CASE_AMOUNTS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY"]


@register("model_capacity_segments")
def q_capacity(spark, sf_dir):
    """G1-G3 on the fitted model's decisions."""
    return G.segment_summary(holdout_capacity(spark, sf_dir))


@register("model_case_picks")
def q_cases(spark, sf_dir):
    """One applicant a decision, with the dimensions and the strongest reasons behind it."""
    cases = G.case_picks(holdout_capacity(spark, sf_dir)).withColumn("risk_dimensions", G.dimension_text())
    first = reasons(spark, sf_dir).filter("reason_rank = 1").select(KEY, F.col("reason_label").alias("main_reason"), F.col("candidate_feature").alias("main_feature"))
    return cases.join(first, KEY, "left").select(
        "case_type", KEY, "strategy_action", "pd", "a_card_score", LABEL, *CASE_AMOUNTS, "capacity_level", "risk_dimensions", "main_reason", "main_feature"
    )
