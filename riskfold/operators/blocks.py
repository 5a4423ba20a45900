"""Feature blocks: roll a history table up to one row per entity.

A :class:`BlockSpec` declares row-level derived columns, base aggregates,
ratios, masked sub-blocks (status / product subsets) and recency windows.
:func:`build_block` turns it into **one** scan, **one** shuffle and **one**
``groupBy(key)`` with conditional aggregates, instead of one filtered group-by
and one join per subset.  The shuffle moves the narrow raw rows: a group holds
a hundred and more running aggregates, so groups combined before it would be
many times as wide as the rows they come from.

Semantics follow a pandas ``groupby().agg()`` + left merge:

* base aggregates exist for every entity present in the table;
* a subset/window aggregate is NULL for an entity with no row in that subset
  (the merged block would be absent), otherwise ``sum`` of all-NULL is 0,
  ``count``/``nunique`` count non-NULL values, ``mean/max/min`` skip NULLs;
* ratios divide with a zero denominator giving NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfold.functions.core import safe_div

SENTINEL = 365243
DAY_WINDOWS = {"6m": 180, "12m": 365, "24m": 730}
MONTH_WINDOWS = {"6m": 6, "12m": 12, "24m": 24}
#: Raw rows of all blocks that a partition of the entities holds on average: derived, sorted and aggregated they are many
#: times as wide, so a number of partitions that does not grow with the rows makes the tasks spill.
PARTITION_ROWS = 500_000


@dataclass(frozen=True)
class Agg:
    name: str
    fn: str  # count | sum | mean | max | min | nunique
    col: str


@dataclass(frozen=True)
class Ratio:
    name: str
    num: str
    den: tuple[str, ...]  # summed denominator terms (all output names)


@dataclass(frozen=True)
class Subset:
    name: str
    mask: str  # SQL boolean over the derived row
    aggs: tuple[Agg, ...]
    ratios: tuple[Ratio, ...] = ()


@dataclass(frozen=True)
class BlockSpec:
    prefix: str
    key: str
    source_table: str
    feature_group: str
    columns: tuple[str, ...]  # raw columns read (projection)
    derived: tuple[tuple[str, str], ...]  # (name, SQL) row-level columns, in order
    base: tuple[Agg, ...]
    base_ratios: tuple[Ratio, ...] = ()
    subsets: tuple[Subset, ...] = ()
    clean_days: bool = True
    account_key: str | None = None  # distinct account key (bridge for two-level blocks)
    meta: dict = field(default_factory=dict, compare=False)

    def out(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def feature_names(self) -> list[str]:
        names = [self.out(a.name) for a in self.base] + [self.out(r.name) for r in self.base_ratios]
        for s in self.subsets:
            names += [self.out(f"{s.name}_{a.name}") for a in s.aggs]
            names += [self.out(f"{s.name}_{r.name}") for r in s.ratios]
        return names


def window_subsets(time_col: str, windows: dict[str, int], aggs, ratios=()) -> tuple[Subset, ...]:
    """Recency windows ``-w <= t <= 0`` (both ends inclusive)."""
    return tuple(
        Subset(f"recent_{wname}", f"{time_col} <= 0 AND {time_col} >= -{w}", tuple(aggs), tuple(ratios))
        for wname, w in windows.items()
    )


def clean_day_columns(df: DataFrame) -> DataFrame:
    """NULL out the 365243 sentinel in every ``DAYS*`` column."""
    day_cols = [c for c in df.columns if c.startswith("DAYS")]
    if not day_cols:
        return df
    return df.withColumns({c: F.when(F.col(c) != SENTINEL, F.col(c)) for c in day_cols})


def _agg_expr(fn: str, x: Column) -> Column:
    if fn == "count":
        return F.count(x)
    if fn == "sum":
        return F.coalesce(F.sum(x), F.lit(0))
    if fn == "mean":
        return F.avg(x)
    if fn == "max":
        return F.max(x)
    if fn == "min":
        return F.min(x)
    raise ValueError(fn)


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions by entity for that many raw rows; no fewer than the session has cores."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PARTITION_ROWS))


def by_entity(rows: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``rows`` shuffled by entity into ``partitions`` (None: as the session is set)."""
    return rows.repartition(partitions, F.col(key)) if partitions else rows.repartition(F.col(key))


def prepare_rows(spec: BlockSpec, rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Project the needed raw columns, shuffle them by entity, clean sentinels, add derived columns."""
    df = by_entity(rows.select(*spec.columns), spec.key, partitions)
    if spec.clean_days:
        df = clean_day_columns(df)
    for name, sql in spec.derived:
        df = df.withColumn(name, F.expr(sql))
    return df


def build_block(spec: BlockSpec, rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """One ``groupBy(key).agg`` with every feature of the block, over rows that lie with their entity.

    A distinct count sums the marks of :func:`mark_first`: a plain
    ``count(DISTINCT ...)`` beside the other aggregates would copy every input
    row once per distinct count, and a block of counts joined to this one would
    shuffle the wide rows again.  Blocks that are joined have the same number
    of ``partitions`` (:func:`partitions_for`).
    """
    df = prepare_rows(spec, rows, partitions)
    masks = {s.name: F.expr(s.mask) for s in spec.subsets}
    aggs: list[Column] = []
    counted: dict[str, dict[str, str]] = {}  # column -> mark -> subset ("" for all rows)

    def expr(a: Agg, subset: str = "") -> Column:
        if a.fn == "nunique":
            mark = f"_first_{subset}_{a.col}"
            counted.setdefault(a.col, {})[mark] = subset
            return F.count(F.when(F.col(mark), F.lit(1)))
        return _agg_expr(a.fn, F.when(masks[subset], F.col(a.col)) if subset else F.col(a.col))

    for a in spec.base:
        aggs.append(expr(a).alias(spec.out(a.name)))
    for s in spec.subsets:
        present = F.count(F.when(masks[s.name], F.lit(1))) > 0
        for a in s.aggs:
            aggs.append(F.when(present, expr(a, s.name)).alias(spec.out(f"{s.name}_{a.name}")))
    for col, marks in counted.items():
        df = mark_first(df, spec.key, col, {m: masks.get(s) for m, s in marks.items()})
    block = df.groupBy(spec.key).agg(*aggs)
    ratios: dict[str, Column] = {}
    for r in spec.base_ratios:
        ratios[spec.out(r.name)] = _ratio(spec, r, "")
    for s in spec.subsets:
        for r in s.ratios:
            ratios[spec.out(f"{s.name}_{r.name}")] = _ratio(spec, r, f"{s.name}_")
    block = block.withColumns(ratios) if ratios else block
    return block.select(spec.key, *spec.feature_names())


def mark_first(df: DataFrame, key: str, col: str, marks: dict[str, Column | None]) -> DataFrame:
    """``df`` with a boolean per mark: the first row of its (key, value of ``col``) within the mark's mask (None: all rows).

    Which of the rows is first is open; their number per key is the count of
    distinct values.  All marks of a column share one sort inside the
    partitions that the rows have by ``key``.
    """
    met = Window.partitionBy(key, col).orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {}
    for name, mask in marks.items():
        inside = F.col(col).isNotNull() & (F.lit(True) if mask is None else F.coalesce(mask, F.lit(False)))
        out[name] = inside & (F.count(F.when(inside, F.lit(1))).over(met) == 1)
    return df.withColumns(out)


def _ratio(spec: BlockSpec, r: Ratio, scope: str) -> Column:
    den = None
    for term in r.den:
        c = F.col(spec.out(scope + term))
        den = c if den is None else den + c
    return safe_div(F.col(spec.out(scope + r.num)), den)


def account_map(spec: BlockSpec, rows: DataFrame) -> DataFrame:
    """Distinct (account, entity) bridge of an account-grain table, left partitioned by account."""
    return rows.select(spec.account_key, spec.key).repartition(F.col(spec.account_key)).dropDuplicates()


# ---------------------------------------------------------------------------
# Block specifications (fixed feature lists of the reference data model).
# ---------------------------------------------------------------------------

def _r(*items: tuple[str, str, tuple[str, ...] | str]) -> tuple[Ratio, ...]:
    return tuple(Ratio(n, num, den if isinstance(den, tuple) else (den,)) for n, num, den in items)


SAFE = "CASE WHEN {d} = 0 THEN NULL ELSE {n} / {d} END"

BUREAU = BlockSpec(
    prefix="bureau_",
    key="SK_ID_CURR",
    source_table="bureau",
    feature_group="external_credit_history",
    account_key="SK_ID_BUREAU",
    columns=(
        "SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", "DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_ENDDATE",
        "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
        "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "CREDIT_TYPE", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY",
    ),
    derived=(
        ("bureau_is_active", "CAST(coalesce(CREDIT_ACTIVE = 'Active', false) AS INT)"),
        ("bureau_is_closed", "CAST(coalesce(CREDIT_ACTIVE = 'Closed', false) AS INT)"),
        ("bureau_has_overdue", "CAST(coalesce(CREDIT_DAY_OVERDUE, 0) > 0 OR coalesce(AMT_CREDIT_SUM_OVERDUE, 0) > 0 AS INT)"),
        ("bureau_debt_to_credit", SAFE.format(n="AMT_CREDIT_SUM_DEBT", d="AMT_CREDIT_SUM")),
        ("bureau_limit_to_credit", SAFE.format(n="AMT_CREDIT_SUM_LIMIT", d="AMT_CREDIT_SUM")),
        ("bureau_is_consumer_credit", "CAST(coalesce(CREDIT_TYPE = 'Consumer credit', false) AS INT)"),
        ("bureau_is_credit_card", "CAST(coalesce(CREDIT_TYPE = 'Credit card', false) AS INT)"),
    ),
    base=(
        Agg("loan_count", "count", "SK_ID_BUREAU"),
        Agg("active_loan_count", "sum", "bureau_is_active"),
        Agg("closed_loan_count", "sum", "bureau_is_closed"),
        Agg("overdue_loan_count", "sum", "bureau_has_overdue"),
        Agg("max_days_overdue", "max", "CREDIT_DAY_OVERDUE"),
        Agg("sum_credit", "sum", "AMT_CREDIT_SUM"),
        Agg("mean_credit", "mean", "AMT_CREDIT_SUM"),
        Agg("max_credit", "max", "AMT_CREDIT_SUM"),
        Agg("sum_debt", "sum", "AMT_CREDIT_SUM_DEBT"),
        Agg("mean_debt", "mean", "AMT_CREDIT_SUM_DEBT"),
        Agg("sum_overdue_amount", "sum", "AMT_CREDIT_SUM_OVERDUE"),
        Agg("max_overdue_amount", "max", "AMT_CREDIT_SUM_OVERDUE"),
        Agg("sum_credit_limit", "sum", "AMT_CREDIT_SUM_LIMIT"),
        Agg("max_credit_max_overdue", "max", "AMT_CREDIT_MAX_OVERDUE"),
        Agg("sum_credit_prolong", "sum", "CNT_CREDIT_PROLONG"),
        Agg("days_credit_mean", "mean", "DAYS_CREDIT"),
        Agg("days_credit_min", "min", "DAYS_CREDIT"),
        Agg("days_credit_max", "max", "DAYS_CREDIT"),
        Agg("days_credit_update_max", "max", "DAYS_CREDIT_UPDATE"),
        Agg("credit_type_count", "nunique", "CREDIT_TYPE"),
        Agg("consumer_credit_count", "sum", "bureau_is_consumer_credit"),
        Agg("credit_card_count", "sum", "bureau_is_credit_card"),
        Agg("debt_to_credit_mean", "mean", "bureau_debt_to_credit"),
        Agg("debt_to_credit_max", "max", "bureau_debt_to_credit"),
        Agg("limit_to_credit_mean", "mean", "bureau_limit_to_credit"),
        Agg("annuity_sum", "sum", "AMT_ANNUITY"),
        Agg("annuity_mean", "mean", "AMT_ANNUITY"),
    ),
    base_ratios=_r(
        ("active_loan_ratio", "active_loan_count", "loan_count"),
        ("overdue_loan_ratio", "overdue_loan_count", "loan_count"),
        ("total_debt_to_credit_ratio", "sum_debt", "sum_credit"),
    ),
    subsets=tuple(
        Subset(
            status,
            f"bureau_is_{status} = 1",
            (
                Agg("credit_sum", "sum", "AMT_CREDIT_SUM"),
                Agg("debt_sum", "sum", "AMT_CREDIT_SUM_DEBT"),
                Agg("overdue_amount_sum", "sum", "AMT_CREDIT_SUM_OVERDUE"),
                Agg("days_credit_mean", "mean", "DAYS_CREDIT"),
                Agg("debt_to_credit_mean", "mean", "bureau_debt_to_credit"),
                Agg("debt_to_credit_max", "max", "bureau_debt_to_credit"),
            ),
            _r(("total_debt_to_credit_ratio", "debt_sum", "credit_sum")),
        )
        for status in ("active", "closed")
    )
    + tuple(
        Subset(
            product,
            f"bureau_is_{product} = 1",
            (
                Agg("credit_sum", "sum", "AMT_CREDIT_SUM"),
                Agg("debt_sum", "sum", "AMT_CREDIT_SUM_DEBT"),
                Agg("overdue_count", "sum", "bureau_has_overdue"),
                Agg("debt_to_credit_mean", "mean", "bureau_debt_to_credit"),
                Agg("debt_to_credit_max", "max", "bureau_debt_to_credit"),
            ),
            _r(("total_debt_to_credit_ratio", "debt_sum", "credit_sum")),
        )
        for product in ("consumer_credit", "credit_card")
    )
    + window_subsets(
        "DAYS_CREDIT",
        DAY_WINDOWS,
        (
            Agg("loan_count", "count", "SK_ID_BUREAU"),
            Agg("active_loan_count", "sum", "bureau_is_active"),
            Agg("overdue_loan_count", "sum", "bureau_has_overdue"),
            Agg("credit_sum", "sum", "AMT_CREDIT_SUM"),
            Agg("debt_sum", "sum", "AMT_CREDIT_SUM_DEBT"),
            Agg("debt_to_credit_mean", "mean", "bureau_debt_to_credit"),
            Agg("debt_to_credit_max", "max", "bureau_debt_to_credit"),
            Agg("max_days_overdue", "max", "CREDIT_DAY_OVERDUE"),
        ),
        _r(
            ("overdue_loan_ratio", "overdue_loan_count", "loan_count"),
            ("total_debt_to_credit_ratio", "debt_sum", "credit_sum"),
        ),
    ),
)

BUREAU_BALANCE = BlockSpec(
    prefix="bureau_balance_",
    key="SK_ID_CURR",
    source_table="bureau_balance",
    feature_group="external_credit_monthly_status",
    columns=("SK_ID_CURR", "SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"),
    clean_days=False,
    derived=(
        (
            "bureau_balance_status_num",
            "CASE STATUS WHEN 'C' THEN CAST(0 AS DOUBLE) WHEN '0' THEN CAST(0 AS DOUBLE) WHEN '1' THEN CAST(1 AS DOUBLE) WHEN '2' THEN CAST(2 AS DOUBLE) "
            "WHEN '3' THEN CAST(3 AS DOUBLE) WHEN '4' THEN CAST(4 AS DOUBLE) WHEN '5' THEN CAST(5 AS DOUBLE) END",
        ),
        ("bureau_balance_bad_month", "CAST(coalesce(STATUS IN ('1', '2', '3', '4', '5'), false) AS INT)"),
        ("bureau_balance_severe_bad_month", "CAST(coalesce(STATUS IN ('3', '4', '5'), false) AS INT)"),
        ("bureau_balance_closed_month", "CAST(coalesce(STATUS = 'C', false) AS INT)"),
        ("bureau_balance_no_info_month", "CAST(coalesce(STATUS = 'X', false) AS INT)"),
    ),
    base=(
        Agg("month_count", "count", "MONTHS_BALANCE"),
        Agg("account_count", "nunique", "SK_ID_BUREAU"),
        Agg("bad_month_count", "sum", "bureau_balance_bad_month"),
        Agg("severe_bad_month_count", "sum", "bureau_balance_severe_bad_month"),
        Agg("closed_month_count", "sum", "bureau_balance_closed_month"),
        Agg("no_info_month_count", "sum", "bureau_balance_no_info_month"),
        Agg("status_max", "max", "bureau_balance_status_num"),
        Agg("status_mean", "mean", "bureau_balance_status_num"),
        Agg("months_min", "min", "MONTHS_BALANCE"),
        Agg("months_max", "max", "MONTHS_BALANCE"),
    ),
    base_ratios=_r(
        ("bad_month_ratio", "bad_month_count", "month_count"),
        ("severe_bad_month_ratio", "severe_bad_month_count", "month_count"),
    ),
    subsets=window_subsets(
        "MONTHS_BALANCE",
        MONTH_WINDOWS,
        (
            Agg("month_count", "count", "MONTHS_BALANCE"),
            Agg("bad_month_count", "sum", "bureau_balance_bad_month"),
            Agg("severe_bad_month_count", "sum", "bureau_balance_severe_bad_month"),
            Agg("status_max", "max", "bureau_balance_status_num"),
            Agg("status_mean", "mean", "bureau_balance_status_num"),
        ),
        _r(
            ("bad_month_ratio", "bad_month_count", "month_count"),
            ("severe_bad_month_ratio", "severe_bad_month_count", "month_count"),
        ),
    ),
)

PREVIOUS = BlockSpec(
    prefix="previous_",
    key="SK_ID_CURR",
    source_table="previous_application",
    feature_group="internal_previous_application",
    columns=(
        "SK_ID_CURR", "SK_ID_PREV", "NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "AMT_ANNUITY", "AMT_APPLICATION",
        "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE", "RATE_DOWN_PAYMENT", "DAYS_DECISION", "CNT_PAYMENT",
        "CODE_REJECT_REASON", "NAME_CLIENT_TYPE", "CHANNEL_TYPE", "NAME_YIELD_GROUP", "NFLAG_INSURED_ON_APPROVAL",
    ),
    derived=(
        ("prev_is_approved", "CAST(coalesce(NAME_CONTRACT_STATUS = 'Approved', false) AS INT)"),
        ("prev_is_refused", "CAST(coalesce(NAME_CONTRACT_STATUS = 'Refused', false) AS INT)"),
        ("prev_is_canceled", "CAST(coalesce(NAME_CONTRACT_STATUS = 'Canceled', false) AS INT)"),
        ("prev_is_cash", "CAST(coalesce(NAME_CONTRACT_TYPE = 'Cash loans', false) AS INT)"),
        ("prev_is_revolving", "CAST(coalesce(NAME_CONTRACT_TYPE = 'Revolving loans', false) AS INT)"),
        ("prev_credit_to_application", SAFE.format(n="AMT_CREDIT", d="AMT_APPLICATION")),
        ("prev_down_payment_to_credit", SAFE.format(n="AMT_DOWN_PAYMENT", d="AMT_CREDIT")),
    ),
    base=(
        Agg("application_count", "count", "SK_ID_PREV"),
        Agg("approved_count", "sum", "prev_is_approved"),
        Agg("refused_count", "sum", "prev_is_refused"),
        Agg("canceled_count", "sum", "prev_is_canceled"),
        Agg("cash_count", "sum", "prev_is_cash"),
        Agg("revolving_count", "sum", "prev_is_revolving"),
        Agg("application_amount_sum", "sum", "AMT_APPLICATION"),
        Agg("application_amount_mean", "mean", "AMT_APPLICATION"),
        Agg("credit_amount_sum", "sum", "AMT_CREDIT"),
        Agg("credit_amount_mean", "mean", "AMT_CREDIT"),
        Agg("annuity_mean", "mean", "AMT_ANNUITY"),
        Agg("down_payment_mean", "mean", "AMT_DOWN_PAYMENT"),
        Agg("goods_price_mean", "mean", "AMT_GOODS_PRICE"),
        Agg("days_decision_mean", "mean", "DAYS_DECISION"),
        Agg("days_decision_max", "max", "DAYS_DECISION"),
        Agg("cnt_payment_mean", "mean", "CNT_PAYMENT"),
        Agg("credit_to_application_mean", "mean", "prev_credit_to_application"),
        Agg("down_payment_to_credit_mean", "mean", "prev_down_payment_to_credit"),
        Agg("reject_reason_count", "nunique", "CODE_REJECT_REASON"),
        Agg("client_type_count", "nunique", "NAME_CLIENT_TYPE"),
        Agg("channel_count", "nunique", "CHANNEL_TYPE"),
        Agg("yield_group_count", "nunique", "NAME_YIELD_GROUP"),
        Agg("insured_on_approval_rate", "mean", "NFLAG_INSURED_ON_APPROVAL"),
    ),
    base_ratios=_r(
        ("approval_rate", "approved_count", "application_count"),
        ("refusal_rate", "refused_count", "application_count"),
        # Named "current application" but divides by previous amounts (kept as is).
        ("total_credit_to_current_application_ratio", "credit_amount_sum", "application_amount_sum"),
    ),
    subsets=tuple(
        Subset(
            status,
            f"prev_is_{status} = 1",
            (
                Agg("amount_mean", "mean", "AMT_APPLICATION"),
                Agg("credit_mean", "mean", "AMT_CREDIT"),
                Agg("credit_sum", "sum", "AMT_CREDIT"),
                Agg("days_decision_max", "max", "DAYS_DECISION"),
                Agg("days_decision_mean", "mean", "DAYS_DECISION"),
                Agg("cnt_payment_mean", "mean", "CNT_PAYMENT"),
                Agg("credit_to_application_mean", "mean", "prev_credit_to_application"),
            ),
        )
        for status in ("approved", "refused", "canceled")
    )
    + tuple(
        Subset(
            product,
            f"prev_is_{product} = 1",
            (
                Agg("approved_count", "sum", "prev_is_approved"),
                Agg("refused_count", "sum", "prev_is_refused"),
                Agg("credit_mean", "mean", "AMT_CREDIT"),
                Agg("credit_sum", "sum", "AMT_CREDIT"),
                Agg("credit_to_application_mean", "mean", "prev_credit_to_application"),
            ),
            _r(("refusal_rate", "refused_count", ("approved_count", "refused_count"))),
        )
        for product in ("cash", "revolving")
    )
    + window_subsets(
        "DAYS_DECISION",
        DAY_WINDOWS,
        (
            Agg("application_count", "count", "SK_ID_PREV"),
            Agg("approved_count", "sum", "prev_is_approved"),
            Agg("refused_count", "sum", "prev_is_refused"),
            Agg("credit_mean", "mean", "AMT_CREDIT"),
            Agg("credit_sum", "sum", "AMT_CREDIT"),
            Agg("credit_to_application_mean", "mean", "prev_credit_to_application"),
            Agg("days_decision_max", "max", "DAYS_DECISION"),
        ),
        _r(("refusal_rate", "refused_count", "application_count")),
    ),
)

INSTALLMENTS = BlockSpec(
    prefix="installment_",
    key="SK_ID_CURR",
    source_table="installments_payments",
    feature_group="internal_repayment_history",
    columns=(
        "SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT",
        "AMT_INSTALMENT", "AMT_PAYMENT",
    ),
    derived=(
        ("installment_days_late", "CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT IS NOT NULL THEN greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, CAST(0 AS DOUBLE)) END"),
        ("installment_days_early", "CASE WHEN DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT IS NOT NULL THEN greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, CAST(0 AS DOUBLE)) END"),
        ("installment_is_late", "CAST(coalesce(installment_days_late, 0) > 0 AS INT)"),
        ("installment_payment_ratio", SAFE.format(n="AMT_PAYMENT", d="AMT_INSTALMENT")),
        ("installment_shortfall_amount", "CASE WHEN AMT_INSTALMENT - AMT_PAYMENT IS NOT NULL THEN greatest(AMT_INSTALMENT - AMT_PAYMENT, CAST(0 AS DOUBLE)) END"),
        ("installment_has_shortfall", "CAST(coalesce(installment_shortfall_amount, 0) > 0 AS INT)"),
    ),
    base=(
        Agg("record_count", "count", "SK_ID_PREV"),
        Agg("contract_count", "nunique", "SK_ID_PREV"),
        Agg("late_count", "sum", "installment_is_late"),
        Agg("late_days_mean", "mean", "installment_days_late"),
        Agg("late_days_max", "max", "installment_days_late"),
        Agg("early_days_mean", "mean", "installment_days_early"),
        Agg("payment_ratio_mean", "mean", "installment_payment_ratio"),
        Agg("payment_ratio_min", "min", "installment_payment_ratio"),
        Agg("shortfall_count", "sum", "installment_has_shortfall"),
        Agg("shortfall_amount_sum", "sum", "installment_shortfall_amount"),
        Agg("shortfall_amount_max", "max", "installment_shortfall_amount"),
        Agg("amount_sum", "sum", "AMT_INSTALMENT"),
        Agg("payment_sum", "sum", "AMT_PAYMENT"),
        Agg("last_due_day", "max", "DAYS_INSTALMENT"),
        Agg("first_due_day", "min", "DAYS_INSTALMENT"),
    ),
    base_ratios=_r(
        ("late_ratio", "late_count", "record_count"),
        ("shortfall_ratio", "shortfall_count", "record_count"),
        ("total_payment_ratio", "payment_sum", "amount_sum"),
    ),
    subsets=window_subsets(
        "DAYS_INSTALMENT",
        DAY_WINDOWS,
        (
            Agg("record_count", "count", "SK_ID_PREV"),
            Agg("contract_count", "nunique", "SK_ID_PREV"),
            Agg("late_count", "sum", "installment_is_late"),
            Agg("late_days_mean", "mean", "installment_days_late"),
            Agg("late_days_max", "max", "installment_days_late"),
            Agg("payment_ratio_mean", "mean", "installment_payment_ratio"),
            Agg("payment_ratio_min", "min", "installment_payment_ratio"),
            Agg("shortfall_count", "sum", "installment_has_shortfall"),
            Agg("shortfall_amount_sum", "sum", "installment_shortfall_amount"),
            Agg("amount_sum", "sum", "AMT_INSTALMENT"),
            Agg("payment_sum", "sum", "AMT_PAYMENT"),
        ),
        _r(
            ("late_ratio", "late_count", "record_count"),
            ("shortfall_ratio", "shortfall_count", "record_count"),
            ("total_payment_ratio", "payment_sum", "amount_sum"),
        ),
    ),
)

CREDIT_CARD = BlockSpec(
    prefix="credit_card_",
    key="SK_ID_CURR",
    source_table="credit_card_balance",
    feature_group="internal_credit_card_history",
    clean_days=False,
    columns=(
        "SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT",
        "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_TOTAL_CURRENT", "CNT_DRAWINGS_CURRENT", "NAME_CONTRACT_STATUS",
        "SK_DPD", "SK_DPD_DEF",
    ),
    derived=(
        ("credit_card_utilization", SAFE.format(n="AMT_BALANCE", d="AMT_CREDIT_LIMIT_ACTUAL")),
        ("credit_card_payment_to_min_due", SAFE.format(n="AMT_PAYMENT_TOTAL_CURRENT", d="AMT_INST_MIN_REGULARITY")),
        ("credit_card_dpd_month", "CAST(coalesce(SK_DPD, 0) > 0 AS INT)"),
        ("credit_card_def_dpd_month", "CAST(coalesce(SK_DPD_DEF, 0) > 0 AS INT)"),
        ("credit_card_active_month", "CAST(coalesce(NAME_CONTRACT_STATUS = 'Active', false) AS INT)"),
    ),
    base=(
        Agg("month_count", "count", "MONTHS_BALANCE"),
        Agg("contract_count", "nunique", "SK_ID_PREV"),
        Agg("active_month_count", "sum", "credit_card_active_month"),
        Agg("balance_mean", "mean", "AMT_BALANCE"),
        Agg("balance_max", "max", "AMT_BALANCE"),
        Agg("credit_limit_mean", "mean", "AMT_CREDIT_LIMIT_ACTUAL"),
        Agg("credit_limit_max", "max", "AMT_CREDIT_LIMIT_ACTUAL"),
        Agg("utilization_mean", "mean", "credit_card_utilization"),
        Agg("utilization_max", "max", "credit_card_utilization"),
        Agg("drawings_sum", "sum", "AMT_DRAWINGS_CURRENT"),
        Agg("drawings_mean", "mean", "AMT_DRAWINGS_CURRENT"),
        Agg("drawing_count_sum", "sum", "CNT_DRAWINGS_CURRENT"),
        Agg("payment_to_min_due_mean", "mean", "credit_card_payment_to_min_due"),
        Agg("dpd_month_count", "sum", "credit_card_dpd_month"),
        Agg("def_dpd_month_count", "sum", "credit_card_def_dpd_month"),
        Agg("dpd_max", "max", "SK_DPD"),
        Agg("def_dpd_max", "max", "SK_DPD_DEF"),
        Agg("months_min", "min", "MONTHS_BALANCE"),
        Agg("months_max", "max", "MONTHS_BALANCE"),
    ),
    base_ratios=_r(
        ("dpd_month_ratio", "dpd_month_count", "month_count"),
        ("def_dpd_month_ratio", "def_dpd_month_count", "month_count"),
        ("active_month_ratio", "active_month_count", "month_count"),
    ),
    subsets=window_subsets(
        "MONTHS_BALANCE",
        MONTH_WINDOWS,
        (
            Agg("month_count", "count", "MONTHS_BALANCE"),
            Agg("contract_count", "nunique", "SK_ID_PREV"),
            Agg("active_month_count", "sum", "credit_card_active_month"),
            Agg("balance_mean", "mean", "AMT_BALANCE"),
            Agg("balance_max", "max", "AMT_BALANCE"),
            Agg("credit_limit_mean", "mean", "AMT_CREDIT_LIMIT_ACTUAL"),
            Agg("utilization_mean", "mean", "credit_card_utilization"),
            Agg("utilization_max", "max", "credit_card_utilization"),
            Agg("drawings_sum", "sum", "AMT_DRAWINGS_CURRENT"),
            Agg("payment_to_min_due_mean", "mean", "credit_card_payment_to_min_due"),
            Agg("dpd_month_count", "sum", "credit_card_dpd_month"),
            Agg("def_dpd_month_count", "sum", "credit_card_def_dpd_month"),
            Agg("dpd_max", "max", "SK_DPD"),
            Agg("def_dpd_max", "max", "SK_DPD_DEF"),
        ),
        _r(
            ("dpd_month_ratio", "dpd_month_count", "month_count"),
            ("def_dpd_month_ratio", "def_dpd_month_count", "month_count"),
            ("active_month_ratio", "active_month_count", "month_count"),
        ),
    ),
)

POS_CASH = BlockSpec(
    prefix="pos_",
    key="SK_ID_CURR",
    source_table="POS_CASH_balance",
    feature_group="internal_pos_cash_history",
    clean_days=False,
    columns=(
        "SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE",
        "NAME_CONTRACT_STATUS", "SK_DPD", "SK_DPD_DEF",
    ),
    derived=(
        ("pos_dpd_month", "CAST(coalesce(SK_DPD, 0) > 0 AS INT)"),
        ("pos_def_dpd_month", "CAST(coalesce(SK_DPD_DEF, 0) > 0 AS INT)"),
        ("pos_active_month", "CAST(coalesce(NAME_CONTRACT_STATUS = 'Active', false) AS INT)"),
        ("pos_completed_month", "CAST(coalesce(NAME_CONTRACT_STATUS = 'Completed', false) AS INT)"),
    ),
    base=(
        Agg("month_count", "count", "MONTHS_BALANCE"),
        Agg("contract_count", "nunique", "SK_ID_PREV"),
        Agg("active_month_count", "sum", "pos_active_month"),
        Agg("completed_month_count", "sum", "pos_completed_month"),
        Agg("dpd_month_count", "sum", "pos_dpd_month"),
        Agg("def_dpd_month_count", "sum", "pos_def_dpd_month"),
        Agg("dpd_max", "max", "SK_DPD"),
        Agg("def_dpd_max", "max", "SK_DPD_DEF"),
        Agg("instalment_mean", "mean", "CNT_INSTALMENT"),
        Agg("instalment_future_mean", "mean", "CNT_INSTALMENT_FUTURE"),
        Agg("instalment_future_max", "max", "CNT_INSTALMENT_FUTURE"),
        Agg("months_min", "min", "MONTHS_BALANCE"),
        Agg("months_max", "max", "MONTHS_BALANCE"),
    ),
    base_ratios=_r(
        ("dpd_month_ratio", "dpd_month_count", "month_count"),
        ("def_dpd_month_ratio", "def_dpd_month_count", "month_count"),
        ("active_month_ratio", "active_month_count", "month_count"),
    ),
    subsets=window_subsets(
        "MONTHS_BALANCE",
        MONTH_WINDOWS,
        (
            Agg("month_count", "count", "MONTHS_BALANCE"),
            Agg("contract_count", "nunique", "SK_ID_PREV"),
            Agg("active_month_count", "sum", "pos_active_month"),
            Agg("completed_month_count", "sum", "pos_completed_month"),
            Agg("dpd_month_count", "sum", "pos_dpd_month"),
            Agg("def_dpd_month_count", "sum", "pos_def_dpd_month"),
            Agg("dpd_max", "max", "SK_DPD"),
            Agg("def_dpd_max", "max", "SK_DPD_DEF"),
            Agg("instalment_future_mean", "mean", "CNT_INSTALMENT_FUTURE"),
            Agg("instalment_future_max", "max", "CNT_INSTALMENT_FUTURE"),
        ),
        _r(
            ("dpd_month_ratio", "dpd_month_count", "month_count"),
            ("def_dpd_month_ratio", "def_dpd_month_count", "month_count"),
            ("active_month_ratio", "active_month_count", "month_count"),
        ),
    ),
)

SPECS = {s.source_table: s for s in (BUREAU, BUREAU_BALANCE, PREVIOUS, INSTALLMENTS, CREDIT_CARD, POS_CASH)}


def monthly_status_rows(balance: DataFrame, bureau: DataFrame) -> DataFrame:
    """bureau_balance rows tagged with their entity through the account bridge.

    A pandas left merge followed by a group-by drops rows whose entity key is
    NULL, so the effective join is INNER.  The bridge (distinct account ->
    entity) is one row per account: hash-joined, never broadcast unchecked.
    """
    bridge = account_map(BUREAU, bureau)
    return balance.join(bridge, "SK_ID_BUREAU", "inner")
