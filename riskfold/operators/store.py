"""Feature store assembly.

The entity spine is LEFT-joined with every block on the entity key.  Each
block leaves its ``groupBy`` hash-partitioned on that key, so the join chain
shuffles the spine once and reuses the partitioning for the following joins
(no broadcast: blocks grow with the number of entities).  The number of
partitions follows the raw rows, so a task's memory does not grow with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.functions.core import row_null_count, safe_div
from riskfold.operators.blocks import BlockSpec, by_entity

KEY = "SK_ID_CURR"
ID_COLUMNS = ("dataset", "SK_ID_CURR", "TARGET")

# Fixed names of the no-history logic.
HISTORY_COUNT_COLUMNS = (
    "bureau_loan_count",
    "bureau_balance_month_count",
    "previous_application_count",
    "installment_record_count",
    "credit_card_month_count",
    "pos_month_count",
)
ZERO_FILL_PREFIXES = ("bureau_", "previous_", "installment_", "credit_card_", "pos_")
ZERO_FILL_SUFFIXES = ("_count", "_sum")
GROUP_ORDER = (
    "current_application",
    "external_credit_history",
    "external_credit_monthly_status",
    "internal_previous_application",
    "internal_repayment_history",
    "internal_credit_card_history",
    "internal_pos_cash_history",
    "history_coverage",
    "feature_store_quality",
)


def history_flag_name(count_col: str) -> str:
    return f"has_{count_col.replace('_count', '')}_history"


def join_blocks(spine: DataFrame, blocks: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    out = spine
    for b in blocks:
        out = out.join(b, key, "left")
    return out


def fill_no_history(df: DataFrame) -> DataFrame:
    """``has_<x>_history`` flags, then zero-fill history counts and sums."""
    flags = {history_flag_name(c): F.col(c).isNotNull().cast("int") for c in HISTORY_COUNT_COLUMNS if c in df.columns}
    out = df.withColumns(flags)
    fills = {
        c: F.coalesce(F.col(c), F.lit(0))
        for c in out.columns
        if c.startswith(ZERO_FILL_PREFIXES) and c.endswith(ZERO_FILL_SUFFIXES)
    }
    return out.withColumns(fills)


def add_missingness(df: DataFrame, strict: bool = False) -> DataFrame:
    """Row null count over all feature columns, and its ratio.

    The reference divides by the column count read *after* the count column
    was added (one more than the columns counted); ``strict=True`` divides by
    the counted columns instead.
    """
    counted = [c for c in df.columns if c not in ID_COLUMNS]
    den = len(counted) if strict else len(df.columns) + 1 - 3
    out = df.withColumn("feature_store_missing_field_count", row_null_count(counted))
    return out.withColumn(
        "feature_store_missing_field_ratio", safe_div(F.col("feature_store_missing_field_count"), F.lit(float(den)))
    )


def build_feature_store(spine: DataFrame, blocks: Sequence[DataFrame], strict: bool = False, partitions: int | None = None) -> DataFrame:
    """The spine with all blocks; ``partitions``: the number that the blocks were built with."""
    rows = by_entity(spine, KEY, partitions) if partitions else spine
    return add_missingness(fill_no_history(join_blocks(rows, blocks)), strict=strict)


def manifest(spark: SparkSession, app_columns: Sequence[str], specs: Sequence[BlockSpec]) -> DataFrame:
    """One row per feature: name, source table and feature group (first wins)."""
    rows = [(c, "application", "current_application") for c in app_columns if c not in ID_COLUMNS]
    for s in specs:
        rows += [(f, s.source_table, s.feature_group) for f in s.feature_names()]
    rows += [(history_flag_name(c), "feature_store", "history_coverage") for c in HISTORY_COUNT_COLUMNS]
    rows += [
        ("feature_store_missing_field_count", "feature_store", "feature_store_quality"),
        ("feature_store_missing_field_ratio", "feature_store", "feature_store_quality"),
    ]
    seen, uniq = set(), []
    for r in rows:
        if r[0] not in seen:
            seen.add(r[0])
            uniq.append(r)
    return spark.createDataFrame(uniq, "feature string, source_table string, feature_group string")


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, missing_rate) for the given columns — one aggregate pass."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (feature, missing_rate)")


def group_coverage(store: DataFrame, manifest_df: DataFrame) -> DataFrame:
    """Per feature group: feature count and mean column missing rate (A5)."""
    feats = [r["feature"] for r in manifest_df.select("feature").collect() if r["feature"] in store.columns]
    rates = null_rates(store, feats)
    order = F.create_map(*[x for i, g in enumerate(GROUP_ORDER) for x in (F.lit(g), F.lit(i + 1))])
    groups = store.sparkSession.createDataFrame([(g,) for g in GROUP_ORDER], "feature_group string")
    per = rates.join(F.broadcast(manifest_df), "feature").groupBy("feature_group").agg(
        F.count(F.lit(1)).alias("feature_count"), F.avg("missing_rate").alias("avg_missing_rate")
    )
    return (
        groups.join(per, "feature_group", "left")
        .select(
            "feature_group",
            order[F.col("feature_group")].alias("group_order"),
            F.coalesce(F.col("feature_count"), F.lit(0)).cast("bigint").alias("feature_count"),
            "avg_missing_rate",
        )
    )
