"""Bindings of the driver's tables to the credit-risk data model.

The operators work on the reference data model (application, bureau,
bureau_balance, previous_application, installments_payments,
credit_card_balance, POS_CASH_balance).  The test tables are a TPC-H-like
star schema, so each role is derived from them by a projection written once
as SQL text in two dialects: Spark SQL (``selectExpr``) and DuckDB (the
oracle).  The derivation is the *fixture*; the operators under test run on
its output.

No row is dropped: every binding projects whole tables (plus the joins the
role needs), so the work grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.sources.tables import read_table

# Fixed anchors of the bindings.
ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
SENTINEL = 365243


def _hash01(expr: str, dialect: str, salt: str = "") -> str:
    s = f"CAST({expr} AS STRING)"
    if salt:
        s = f"concat({s}, '{salt}')"
    if dialect == "spark":
        return f"(CAST(conv(substr(md5({s}), 1, 8), 16, 10) AS BIGINT) / CAST(4294967296 AS DOUBLE))"
    return f"(CAST(('0x' || substr(md5({s}), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def _days(ts: str, anchor: str, dialect: str) -> str:
    if dialect == "spark":
        return f"datediff(CAST({ts} AS DATE), DATE'{anchor}')"
    return f"CAST(date_diff('day', DATE '{anchor}', CAST({ts} AS DATE)) AS INTEGER)"


def _json_int(col: str, key: str, dialect: str) -> str:
    if dialect == "spark":
        return f"CAST(get_json_object({col}, '$.{key}') AS INT)"
    return f"CAST(json_extract_string({col}, '$.{key}') AS INTEGER)"


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


@dataclass(frozen=True)
class Binding:
    """A role derived from driver tables: FROM clause + projection."""

    name: str
    tables: tuple[str, ...]
    join: str | None  # join condition when two tables are used

    def exprs(self, dialect: str) -> list[str]:
        return _EXPRS[self.name](dialect)


# ---------------------------------------------------------------------------
# Projections.  Each returns "expr AS NAME" strings valid in the dialect.
# ---------------------------------------------------------------------------

def _application(dialect: str) -> list[str]:
    k = "c_custkey"
    u1 = _hash01(k, dialect, "ext1")
    u2 = _hash01(k, dialect, "ext2")
    u3 = _hash01(k, dialect, "ext3")
    return [
        f"{k} AS SK_ID_CURR",
        f"CASE WHEN {k} % 41 = 0 THEN 'XNA' WHEN {k} % 43 = 0 THEN ' Cash loans ' "
        f"WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Cash loans' ELSE 'Revolving loans' END AS NAME_CONTRACT_TYPE",
        f"CASE WHEN {k} % 29 = 0 THEN 'Unknown' ELSE concat(' ', c_mktsegment) END AS OCCUPATION_TYPE",
        f"CAST(-(6570 + ({k} * 7919) % 18250) AS INT) AS DAYS_BIRTH",
        f"CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' AND {k} % 7 = 0 THEN {SENTINEL} ELSE -(({k} * 104729) % 12000) END AS INT) AS DAYS_EMPLOYED",
        f"{D(f'-(({k} * 31) % 9000)')} AS DAYS_REGISTRATION",
        f"CAST(-(({k} * 17) % 6000) AS INT) AS DAYS_ID_PUBLISH",
        f"CASE WHEN {k} % 13 = 0 THEN NULL ELSE {D(f'-(({k} * 23) % 3000)')} END AS DAYS_LAST_PHONE_CHANGE",
        f"CASE WHEN {k} % 50 = 0 THEN {D('0')} ELSE abs(c_acctbal) * {D('12')} + {D('20000')} END AS AMT_INCOME_TOTAL",
        f"abs(c_acctbal) * {D('40')} + {D('50000')} AS AMT_CREDIT",
        f"CASE WHEN {k} % 37 = 0 THEN NULL ELSE (abs(c_acctbal) * {D('40')} + {D('50000')}) / {D('12 + c_nationkey')} END AS AMT_ANNUITY",
        f"CASE WHEN {k} % 19 = 0 THEN NULL ELSE (abs(c_acctbal) * {D('40')} + {D('50000')}) * {D('0.9')} END AS AMT_GOODS_PRICE",
        f"CASE WHEN {k} % 61 = 0 THEN {D('0')} ELSE {D(f'1 + {k} % 4')} END AS CNT_FAM_MEMBERS",
        f"CAST({k} % 3 AS INT) AS CNT_CHILDREN",
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {u1} END AS EXT_SOURCE_1",
        f"{u2} AS EXT_SOURCE_2",
        f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE {u3} END AS EXT_SOURCE_3",
        f"CAST(CASE WHEN {k} % 2 = 0 THEN 1 ELSE 0 END AS INT) AS FLAG_DOCUMENT_2",
        f"CAST(CASE WHEN {k} % 3 = 1 THEN 1 ELSE 0 END AS INT) AS FLAG_DOCUMENT_3",
        f"CAST(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS INT) AS FLAG_WORK_PHONE",
        f"CAST(CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS FLAG_PHONE",
        f"CAST(CASE WHEN {k} % 4 = 0 THEN 1 ELSE 0 END AS INT) AS FLAG_EMAIL",
        "CAST(1 AS INT) AS FLAG_MOBIL",
        f"CASE WHEN {k} % 9 = 0 THEN NULL ELSE {D(f'{k} % 2')} END AS AMT_REQ_CREDIT_BUREAU_HOUR",
        f"CASE WHEN {k} % 9 = 0 THEN NULL ELSE {D(f'{k} % 3')} END AS AMT_REQ_CREDIT_BUREAU_DAY",
        f"CASE WHEN {k} % 9 = 0 THEN NULL ELSE {D(f'{k} % 4')} END AS AMT_REQ_CREDIT_BUREAU_WEEK",
        f"CASE WHEN {k} % 9 = 0 THEN NULL ELSE {D(f'{k} % 7')} END AS AMT_REQ_CREDIT_BUREAU_YEAR",
    ]


def _application_split(dialect: str) -> list[str]:
    """Columns deciding train/test membership and the label of train rows."""
    k = "c_custkey"
    return [
        f"{_hash01(k, dialect, 'test')} AS _u_test",
        f"CAST(CASE WHEN {_hash01(k, dialect, 'target')} < {D('0.05')} + {D('0.12')} * "
        f"CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END + {D('0.08')} * CASE WHEN {k} % 3 = 0 THEN 1 ELSE 0 END "
        f"THEN 1 ELSE 0 END AS INT) AS TARGET",
    ]


def _bureau(dialect: str) -> list[str]:
    k = "o_orderkey"
    days = _days("o_orderdate", ORDERS_AS_OF, dialect)
    return [
        "o_custkey AS SK_ID_CURR",
        f"{k} AS SK_ID_BUREAU",
        "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE",
        f"CAST(CASE WHEN {k} % 97 = 0 THEN {SENTINEL} ELSE {days} END AS INT) AS DAYS_CREDIT",
        f"CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {k} % 45 ELSE 0 END AS INT) AS CREDIT_DAY_OVERDUE",
        f"{D(f'{days} + 365 + {k} % 1500')} AS DAYS_CREDIT_ENDDATE",
        f"CASE WHEN o_orderstatus = 'F' THEN {D(f'{days} + 200')} END AS DAYS_ENDDATE_FACT",
        f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE o_totalprice * {D('0.05')} END AS AMT_CREDIT_MAX_OVERDUE",
        f"CAST({k} % 3 AS INT) AS CNT_CREDIT_PROLONG",
        f"CASE WHEN {k} % 53 = 0 THEN {D('0')} ELSE o_totalprice END AS AMT_CREDIT_SUM",
        f"CASE WHEN {k} % 11 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN o_totalprice * {D('0.6')} ELSE {D('0')} END AS AMT_CREDIT_SUM_DEBT",
        f"CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice * {D('0.25')} END AS AMT_CREDIT_SUM_LIMIT",
        f"CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN o_totalprice * {D('0.1')} ELSE {D('0')} END AS AMT_CREDIT_SUM_OVERDUE",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Consumer credit' WHEN '2-HIGH' THEN 'Credit card' "
        "WHEN '3-MEDIUM' THEN 'Car loan' ELSE 'Mortgage' END AS CREDIT_TYPE",
        f"CAST({days} + {k} % 30 AS INT) AS DAYS_CREDIT_UPDATE",
        f"CASE WHEN {k} % 4 = 0 THEN NULL ELSE o_totalprice / {D('23')} END AS AMT_ANNUITY",
    ]


def _bureau_balance(dialect: str) -> list[str]:
    days = _days("l_shipdate", ORDERS_AS_OF, dialect)
    return [
        "l_orderkey AS SK_ID_BUREAU",
        f"CAST(ceil({days} / {D('30')}) AS INT) AS MONTHS_BALANCE",
        "CASE WHEN l_returnflag = 'R' THEN CAST(1 + l_linenumber % 5 AS STRING) WHEN l_returnflag = 'A' THEN 'X' "
        "WHEN l_linestatus = 'F' THEN 'C' ELSE '0' END AS STATUS",
    ]


def _previous(dialect: str) -> list[str]:
    k = "o_orderkey"
    days = _days("o_orderdate", ORDERS_AS_OF, dialect)
    return [
        "o_custkey AS SK_ID_CURR",
        f"{k} AS SK_ID_PREV",
        f"CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'P' THEN 'Refused' "
        f"ELSE CASE WHEN {k} % 3 = 0 THEN 'Canceled' ELSE 'Unused offer' END END AS NAME_CONTRACT_STATUS",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Cash loans' WHEN o_orderpriority = '3-MEDIUM' "
        "THEN 'Revolving loans' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'XNA' ELSE 'Consumer loans' END AS NAME_CONTRACT_TYPE",
        f"o_totalprice / {D('13')} AS AMT_ANNUITY",
        f"CASE WHEN {k} % 59 = 0 THEN {D('0')} ELSE o_totalprice END AS AMT_APPLICATION",
        f"CASE WHEN {k} % 61 = 0 THEN {D('0')} ELSE o_totalprice * {D(f'0.8 + 0.1 * ({k} % 4)')} END AS AMT_CREDIT",
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE o_totalprice * {D('0.1')} END AS AMT_DOWN_PAYMENT",
        "CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_totalprice END AS AMT_GOODS_PRICE",
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {D('0.1')} END AS RATE_DOWN_PAYMENT",
        f"CAST(CASE WHEN {k} % 89 = 0 THEN {SENTINEL} ELSE {days} END AS INT) AS DAYS_DECISION",
        f"{D(f'6 + 6 * ({k} % 4)')} AS CNT_PAYMENT",
        "CASE WHEN o_orderstatus = 'P' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'HC' WHEN '2-HIGH' THEN 'LIMIT' "
        "ELSE 'SCO' END ELSE 'XAP' END AS CODE_REJECT_REASON",
        f"CASE {k} % 4 WHEN 0 THEN 'New' WHEN 1 THEN 'Repeater' WHEN 2 THEN 'Refreshed' ELSE 'XNA' END AS NAME_CLIENT_TYPE",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit and cash offices' WHEN '5-LOW' THEN 'Country-wide' "
        "ELSE 'Stone' END AS CHANNEL_TYPE",
        "CASE WHEN o_totalprice < 100000 THEN 'low_normal' WHEN o_totalprice < 250000 THEN 'middle' ELSE 'high' END AS NAME_YIELD_GROUP",
        f"CASE WHEN o_orderstatus = 'F' THEN {D(f'{k} % 2')} END AS NFLAG_INSURED_ON_APPROVAL",
    ]


def _installments(dialect: str) -> list[str]:
    due = _days("o_orderdate", ORDERS_AS_OF, dialect)
    paid = _days("l_shipdate", ORDERS_AS_OF, dialect)
    return [
        "o_custkey AS SK_ID_CURR",
        "l_orderkey AS SK_ID_PREV",
        "l_linenumber AS NUM_INSTALMENT_NUMBER",
        f"{D(f'{due} + 30')} AS DAYS_INSTALMENT",
        f"CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE {D(paid)} END AS DAYS_ENTRY_PAYMENT",
        f"CASE WHEN l_partkey % 89 = 0 THEN {D('0')} ELSE l_extendedprice END AS AMT_INSTALMENT",
        f"CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice * (1 - l_discount) - l_quantity * {D('0.37')} END AS AMT_PAYMENT",
    ]


def _credit_card(dialect: str) -> list[str]:
    m = _days("ts", EVENTS_AS_OF, dialect)
    kk = _json_int("props", "k", dialect)
    return [
        "user_id AS SK_ID_CURR",
        "user_id * 10 + CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 2 END AS SK_ID_PREV",
        f"CAST({m} AS INT) AS MONTHS_BALANCE",
        f"value * {D('100')} AS AMT_BALANCE",
        f"{D(f'{kk} * 100')} AS AMT_CREDIT_LIMIT_ACTUAL",
        f"CASE WHEN event_type = 'purchase' THEN value ELSE {D('0')} END AS AMT_DRAWINGS_CURRENT",
        f"CASE WHEN event_type = 'signup' THEN NULL ELSE {D(f'{kk} % 10')} END AS AMT_INST_MIN_REGULARITY",
        "CASE WHEN event_type IN ('click', 'purchase') THEN value END AS AMT_PAYMENT_TOTAL_CURRENT",
        f"CASE WHEN event_type = 'purchase' THEN {D('1')} ELSE {D('0')} END AS CNT_DRAWINGS_CURRENT",
        "CASE WHEN event_type = 'signup' THEN 'Completed' WHEN event_type = 'view' THEN 'Signed' ELSE 'Active' END AS NAME_CONTRACT_STATUS",
        f"CAST(CASE WHEN event_type = 'error' THEN {kk} ELSE 0 END AS INT) AS SK_DPD",
        f"CAST(CASE WHEN event_type = 'error' AND {kk} > 50 THEN {kk} - 50 ELSE 0 END AS INT) AS SK_DPD_DEF",
    ]


def _pos(dialect: str) -> list[str]:
    m = _days("ts", EVENTS_AS_OF, dialect)
    kk = _json_int("props", "k", dialect)
    return [
        "user_id AS SK_ID_CURR",
        "user_id * 10 + CASE WHEN event_type IN ('view', 'signup') THEN 3 ELSE 4 END AS SK_ID_PREV",
        f"CAST({m} AS INT) AS MONTHS_BALANCE",
        f"{D(f'12 + {kk} % 24')} AS CNT_INSTALMENT",
        f"CASE WHEN event_type = 'view' THEN NULL ELSE {D(f'{kk} % 12')} END AS CNT_INSTALMENT_FUTURE",
        "CASE WHEN event_type = 'signup' THEN 'Completed' WHEN event_type = 'purchase' THEN 'Returned to the store' ELSE 'Active' END AS NAME_CONTRACT_STATUS",
        f"CAST(CASE WHEN event_type = 'error' THEN {kk} % 40 ELSE 0 END AS INT) AS SK_DPD",
        f"CAST(CASE WHEN event_type = 'error' AND {kk} > 70 THEN {kk} - 70 ELSE 0 END AS INT) AS SK_DPD_DEF",
    ]


def _scoring(dialect: str) -> list[str]:
    """One application per order with a planted-signal label and a closed-form PD."""
    k = "o_orderkey"
    u = _hash01(k, dialect)
    u_test = _hash01(k, dialect, "test")
    u_pd = _hash01(k, dialect, "pd")
    z = f"({D('-3.0')} + {D('4.0')} * o_totalprice / {D('500000')} + {D('1.5')} * ({u_pd} - {D('0.5')}))"
    pd_raw = f"({D('1')} / ({D('1')} + exp(-{z})))"
    return [
        f"{k} AS SK_ID_CURR",
        f"CASE WHEN {u_test} < {D('0.15')} THEN 'test' ELSE 'train' END AS dataset",
        f"CASE WHEN {u_test} < {D('0.15')} THEN NULL ELSE CAST(CASE WHEN {u} < {D('0.02')} + {D('0.15')} * o_totalprice / {D('500000')} "
        f"THEN 1 ELSE 0 END AS INT) END AS TARGET",
        f"floor({pd_raw} * {D('10000')}) / {D('10000')} + {D('0.00005')} AS pd",
        f"CASE WHEN {k} % 101 = 0 THEN NULL ELSE o_totalprice END AS AMT_CREDIT",
    ]


_EXPRS = {
    "scoring": _scoring,
    "application": lambda d: _application(d) + _application_split(d),
    "bureau": _bureau,
    "bureau_balance": _bureau_balance,
    "previous_application": _previous,
    "installments_payments": _installments,
    "credit_card_balance": _credit_card,
    "POS_CASH_balance": _pos,
}

BINDINGS = {
    "scoring": Binding("scoring", ("orders",), None),
    "application": Binding("application", ("customer",), None),
    "bureau": Binding("bureau", ("orders",), None),
    "bureau_balance": Binding("bureau_balance", ("lineitem",), None),
    "previous_application": Binding("previous_application", ("orders",), None),
    "installments_payments": Binding("installments_payments", ("lineitem", "orders"), "l_orderkey = o_orderkey"),
    "credit_card_balance": Binding("credit_card_balance", ("events",), None),
    "POS_CASH_balance": Binding("POS_CASH_balance", ("events",), None),
}

# Test share of applications (the rest are labelled training rows).
TEST_SHARE = 0.15


def spark_role(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """The role as a Spark DataFrame (projection pushed into the parquet scan)."""
    b = BINDINGS[role]
    if len(b.tables) == 1:
        src = read_table(spark, sf_dir, b.tables[0])
    else:
        left, right = (read_table(spark, sf_dir, t) for t in b.tables)
        # Both sides of this join are fact tables: let the planner pick
        # (sort-merge on the order key; AQE may demote to broadcast).
        src = left.join(right, F.expr(b.join), "inner")
    return src.selectExpr(*b.exprs("spark"))


def role_rows(spark: SparkSession, sf_dir: str, role: str) -> int:
    """Rows of the role's largest table, from the files' footers."""
    return max(read_table(spark, sf_dir, t).count() for t in BINDINGS[role].tables)


def duckdb_role(role: str) -> str:
    """The role as a DuckDB sub-query (tables are pre-registered views)."""
    b = BINDINGS[role]
    exprs = ",\n  ".join(b.exprs("duckdb"))
    if len(b.tables) == 1:
        return f"(SELECT\n  {exprs}\nFROM {b.tables[0]})"
    return f"(SELECT\n  {exprs}\nFROM {b.tables[0]} JOIN {b.tables[1]} ON {b.join})"


def application_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two application files of the reference: train (with TARGET), test (without)."""
    app = spark_role(spark, sf_dir, "application")
    train = app.filter(F.col("_u_test") >= TEST_SHARE).drop("_u_test")
    test = app.filter(F.col("_u_test") < TEST_SHARE).drop("_u_test", "TARGET")
    return train, test


def duckdb_application_files() -> tuple[str, str]:
    app = duckdb_role("application")
    train = f"(SELECT * EXCLUDE (_u_test) FROM {app} WHERE _u_test >= {TEST_SHARE})"
    test = f"(SELECT * EXCLUDE (_u_test, TARGET) FROM {app} WHERE _u_test < {TEST_SHARE})"
    return train, test
