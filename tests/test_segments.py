"""Decisions joined with repayment capacity."""

from riskfold.operators import segments as G


def test_scored_rows_keep_their_decision_whatever_the_features(spark):
    scored = spark.createDataFrame(
        [(1, "decline", 0.4, 450.0, 1), (2, "approve", 0.01, 700.0, 0), (3, "manual_review", 0.2, 550.0, None)],
        "SK_ID_CURR long, strategy_action string, pd double, a_card_score double, TARGET int",
    )
    columns = ", ".join(f"{c} double" for c in G.CAPACITY_COLUMNS)
    blank = dict.fromkeys(G.CAPACITY_COLUMNS)
    features = spark.createDataFrame(
        [tuple({**blank, "annuity_to_income_ratio": 0.5, "ext_source_mean": 0.4}.values()) + (1, 9.0, "x"), tuple(blank.values()) + (2, None, "y"), tuple(blank.values()) + (9, 1.0, "z")],
        columns + ", SK_ID_CURR long, AMT_CREDIT double, TARGET string",
    )
    rows = {r["SK_ID_CURR"]: r for r in G.with_capacity(scored, features, also=["AMT_CREDIT"]).collect()}
    assert sorted(rows) == [1, 2, 3] and [rows[k]["TARGET"] for k in (1, 2, 3)] == [1, 0, None]
    assert rows[1]["capacity_level"] == "high" and rows[1]["capacity_high_dimension_count"] == 1 and rows[1]["capacity_medium_plus_dimension_count"] == 2
    assert abs(rows[1]["external_score_risk_proxy"] - 0.6) < 1e-12 and rows[1]["AMT_CREDIT"] == 9.0
    assert rows[3]["capacity_level"] == "low" and rows[3]["AMT_CREDIT"] is None
    summary = {r["strategy_action"]: r for r in G.segment_summary(G.with_capacity(scored, features)).collect()}
    assert summary["decline"]["high_capacity_dimension_share"] == 0.0 and summary["decline"]["medium_plus_capacity_dimension_share"] == 1.0
    assert [summary[a]["action_order"] for a in G.ACTION_ORDER] == [1, 2, 3]
