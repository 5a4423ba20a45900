"""A scoring artefact: everything that turns candidate features into points and a decision, as files.

The folder holds the design's fit (a row a feature), the trees' nodes and a card (shift, best round, grade edges,
cutoffs).  It is written once by the session that fitted the model and loaded by any other; scoring reads nothing
else but the rows to score.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.functions.core import POINTS_BASE, POINTS_BASE_ODDS, POINTS_FACTOR, POINTS_OFFSET, POINTS_PDO, sigmoid
from riskfold.operators import models as M
from riskfold.operators import scorecard as K
from riskfold.operators.trees import Trees, add_contributions, add_margin, read_trees


@dataclass(frozen=True)
class ScoringArtifact:
    """A loaded artefact; ``card`` holds shift, best_round, grade_edges, manual_cutoff and decline_cutoff."""

    features: list[str]
    fit_rows: list[dict]
    trees: Trees
    card: dict

    def design(self, wide: DataFrame) -> tuple[DataFrame, list[str]]:
        """The design of ``wide`` by the stored fit, with the raw values."""
        return M.apply_design(wide, self.features, self.fit_rows, with_raw=True)

    def score(self, wide: DataFrame) -> DataFrame:
        """(key, split, label, pd, a_card_score, score_grade, strategy_action) for every row of ``wide``."""
        return self.decide(add_margin(self.design(wide)[0].drop("raw"), self.trees))

    def decide(self, margins: DataFrame) -> DataFrame:
        """Points, grade and decision from rows with ``margin`` (the trees' log-odds without the shift)."""
        pd = margins.withColumn("pd", sigmoid(F.col("margin") + F.lit(float(self.card["shift"])))).drop("margin")
        graded = K.add_grades(K.add_points(pd), [float(e) for e in self.card["grade_edges"]])
        return K.assign_strategy(graded, self.card["manual_cutoff"], self.card["decline_cutoff"])

    def explain(self, wide: DataFrame) -> tuple[DataFrame, list[str]]:
        """Rows of ``wide`` with ``contrib``, ``bias``, ``log_odds`` and raw ``value``, and the features they follow."""
        design, names = self.design(wide)
        rows, own = add_contributions(design, self.trees, names, float(self.card["shift"]))
        return rows.withColumnRenamed("raw", "value"), own


def fit_artifact(margins: DataFrame, shift: float) -> dict:
    """The card's cut points: validation deciles of the points and validation cutoffs of the probability."""
    scored = K.add_points(margins.withColumn("pd", sigmoid(F.col("margin") + F.lit(shift))))
    manual, decline = K.strategy_cutoffs(scored)
    return {"shift": shift, "grade_edges": [str(e) for e in K.grade_edges(scored)], "manual_cutoff": manual, "decline_cutoff": decline}


def save_artifact(path: str, features: Sequence[str], fit_rows: Sequence[dict], fit: M.BoostedFit, card: dict) -> None:
    """Write the artefact below ``path`` (an existing one is replaced)."""
    spark = fit.nodes.sparkSession
    schema = ("feature string, missing_rate double, lower double, impute double, upper double, mean double, std double, "
              "add_indicator boolean, indicator_mean double, indicator_std double")  # fmt: skip
    names = [c.split()[0] for c in schema.split(", ")]
    spark.createDataFrame([tuple(r[n] for n in names) for r in fit_rows], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/fit")
    fit.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    whole = json.dumps({**card, "features": list(features), "best_round": fit.best_round}, sort_keys=True)
    spark.createDataFrame([(whole,)], "card string").coalesce(1).write.mode("overwrite").parquet(f"{path}/card")


def load_artifact(spark: SparkSession, path: str) -> ScoringArtifact:
    """The artefact below ``path``: features, nodes and one card, all bounded by the model's size."""
    card = json.loads(spark.read.parquet(f"{path}/card").first()["card"])
    fit_rows = [r.asDict() for r in spark.read.parquet(f"{path}/fit").collect()]
    return ScoringArtifact(card.pop("features"), fit_rows, read_trees(spark.read.parquet(f"{path}/nodes")), card)


def score_scale(spark: SparkSession, artifact: ScoringArtifact) -> DataFrame:
    """K7: the scale's constants and the cutoffs in probability and points (one row)."""
    manual, decline = float(artifact.card["manual_cutoff"]), float(artifact.card["decline_cutoff"])
    row = (POINTS_PDO, POINTS_BASE, POINTS_BASE_ODDS, POINTS_FACTOR, POINTS_OFFSET, "higher_score_lower_default_risk",
           K.DECLINE_PCT, K.MANUAL_REVIEW_PCT, manual, decline)
    scale = spark.createDataFrame(
        [row],
        "pdo double, base_score double, base_odds_good_bad double, factor double, offset double, score_direction string, "
        "decline_pct_on_validation double, manual_review_pct_on_validation double, manual_pd_cutoff double, decline_pd_cutoff double",
    )
    return K.add_points(K.add_points(scale, "manual_pd_cutoff", "manual_score_cutoff"), "decline_pd_cutoff", "decline_score_cutoff")
