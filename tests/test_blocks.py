import random

from riskfold.operators import blocks
from riskfold.operators.blocks import BUREAU, BUREAU_BALANCE, CREDIT_CARD, MONTH_WINDOWS, build_block, partitions_for
from riskfold.operators.store import build_feature_store, fill_no_history, join_blocks
from riskfold.plans import q_store

COLS = (
    "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, DAYS_CREDIT int, CREDIT_DAY_OVERDUE int, "
    "DAYS_CREDIT_ENDDATE double, DAYS_ENDDATE_FACT double, AMT_CREDIT_MAX_OVERDUE double, CNT_CREDIT_PROLONG int, "
    "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_LIMIT double, AMT_CREDIT_SUM_OVERDUE double, "
    "CREDIT_TYPE string, DAYS_CREDIT_UPDATE int, AMT_ANNUITY double"
)
CARD = (
    "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE int, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double, "
    "AMT_DRAWINGS_CURRENT double, AMT_INST_MIN_REGULARITY double, AMT_PAYMENT_TOTAL_CURRENT double, CNT_DRAWINGS_CURRENT double, "
    "NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int"
)


def _row(cur, acc, status, days, credit, debt, ctype="Consumer credit", overdue=0):
    return (cur, acc, status, days, overdue, None, None, None, 0, credit, debt, None, 0.0, ctype, days, None)


def test_block_edges(spark):
    rows = [
        _row(1, 10, "Active", 0, 100.0, 50.0),        # window end 0 is inside
        _row(1, 11, "Closed", -180, 0.0, None),       # window start -180 inside 6m; zero credit -> NULL ratio
        _row(1, 12, "Active", 365243, 10.0, 1.0),      # sentinel -> NULL day, outside every window
        _row(2, 20, "Closed", -181, 200.0, None, "Credit card", overdue=3),
    ]
    df = spark.createDataFrame(rows, COLS)
    out = {r["SK_ID_CURR"]: r for r in build_block(BUREAU, df).collect()}
    a, b = out[1], out[2]
    assert a["bureau_loan_count"] == 3 and a["bureau_active_loan_count"] == 2
    assert a["bureau_recent_6m_loan_count"] == 2  # both ends inclusive, sentinel excluded
    assert a["bureau_days_credit_min"] == -180  # sentinel nulled
    assert a["bureau_debt_to_credit_max"] == 0.5
    # entity 2 has no active rows: subset aggregates are NULL, not 0
    assert b["bureau_active_credit_sum"] is None
    # closed subset with all-NULL debt sums to 0 (the entity has rows there)
    assert b["bureau_closed_debt_sum"] == 0.0
    assert b["bureau_recent_6m_loan_count"] is None and b["bureau_recent_12m_loan_count"] == 1
    assert b["bureau_overdue_loan_count"] == 1
    filled = {r["SK_ID_CURR"]: r for r in fill_no_history(build_block(BUREAU, df)).collect()}
    assert filled[2]["bureau_recent_6m_loan_count"] == 0  # *_count zero-filled
    assert filled[2]["bureau_recent_6m_overdue_loan_ratio"] is None  # ratios stay NULL
    assert filled[1]["has_bureau_loan_history"] == 1


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_a_block_and_its_join_shuffle_each_row_once(spark):
    rows = spark.createDataFrame([_row(1, 10, "Active", 0, 100.0, 50.0)], COLS)
    block = build_block(BUREAU, rows)
    assert _exchanges(block) == 1  # the raw rows; no wide row of aggregates
    spine = spark.range(3).withColumnRenamed("id", "SK_ID_CURR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(join_blocks(spine, [block, build_block(BUREAU_BALANCE, _months(spark, []))])) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_of_the_store_follow_the_raw_rows(spark, monkeypatch, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(blocks, "PARTITION_ROWS", 10)
    assert [partitions_for(spark, n) for n in (0, 10 * cores, 10 * cores + 1, 1000 * cores)] == [cores, cores, cores + 1, 100 * cores]
    sizes = {"customer": 30, "orders": 50, "lineitem": 70, "events": 90}
    for table, n in sizes.items():
        spark.range(n).write.parquet(f"{tmp_path}/{table}.parquet")
    # bureau and earlier applications from orders, statuses and instalments from lineitem, card and POS from events
    assert q_store.store_partitions(spark, str(tmp_path)) == max(cores, (30 + 2 * (50 + 70 + 90)) // 10)


def test_a_given_number_of_partitions_changes_no_row_and_adds_no_shuffle(spark):
    rows = spark.createDataFrame([_row(k, 10 * k + i, "Active", -i, 100.0, 50.0) for k in (1, 2, 3) for i in range(4)], COLS)
    months = _months(spark, [(k, 10 * k, -m, "1") for k in (2, 3, 4) for m in range(3)])
    spine = spark.range(6).selectExpr("nullif(id, 5) AS SK_ID_CURR", "'train' AS dataset", "0 AS TARGET")

    def store(n):
        return build_feature_store(spine, [build_block(BUREAU, rows, n), build_block(BUREAU_BALANCE, months, n)], partitions=n)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        given = store(19)  # more than the session's 8
        assert _exchanges(given) == 3
        assert given.rdd.getNumPartitions() == 19
        assert sorted(map(str, given.collect())) == sorted(map(str, store(None).collect()))
        assert _exchanges(store(3)) == 3  # fewer
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _months(spark, rows):
    return spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")


def test_distinct_counts_by_subset_null_keys_and_values(spark):
    rng = random.Random(5)

    def pick(*xs):
        return rng.choice(xs)

    rows = [
        (pick(None, 1, 2, 3), pick(None, 7, 8, 9), pick(None, -30, -20, -10, -3, 0, 2), None, pick(None, 1.0), None, None, None, None, None, 0, 0)
        for _ in range(60)
    ] + [(4, None, -1) + (None,) * 9, (5, 7, 3) + (None,) * 9]
    got = {r["SK_ID_CURR"]: r for r in build_block(CREDIT_CARD, spark.createDataFrame(rows, CARD)).collect()}
    assert set(got) == {None, 1, 2, 3, 4, 5}
    for key, r in got.items():
        own = [x for x in rows if x[0] == key]
        assert r["credit_card_contract_count"] == len({x[1] for x in own} - {None})
        for name, w in MONTH_WINDOWS.items():
            inside = [x for x in own if x[2] is not None and -w <= x[2] <= 0]
            want = len({x[1] for x in inside} - {None}) if inside else None
            assert r[f"credit_card_recent_{name}_contract_count"] == want, (key, name)
