"""Query catalogue: every operator bound to the driver tables, with its oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``
(DuckDB, over the pre-registered driver views).  Queries without an oracle
are the non-SQL ones (model fits); the driver checks those rows-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskfold.operators import blocks as B
from riskfold.plans import bindings as BD
from riskfold.plans.oracle_blocks import block_sql, double_outputs
from riskfold.plans.registry import ORACLES, QUERIES, oracles, register  # noqa: F401
from riskfold.plans.sqlkit import duck_round


# ---------------------------------------------------------------------------
# Feature blocks
# ---------------------------------------------------------------------------

def monthly_rows_sql() -> str:
    bb = BD.duckdb_role("bureau_balance")
    bu = BD.duckdb_role("bureau")
    return (
        f"(SELECT bb.*, m.SK_ID_CURR FROM {bb} bb JOIN "
        f"(SELECT DISTINCT SK_ID_BUREAU, SK_ID_CURR FROM {bu} _b) m ON bb.SK_ID_BUREAU = m.SK_ID_BUREAU)"
    )


def block_rows(spark: SparkSession, sf_dir: str, spec: B.BlockSpec) -> DataFrame:
    if spec is B.BUREAU_BALANCE:
        return B.monthly_status_rows(
            BD.spark_role(spark, sf_dir, "bureau_balance"), BD.spark_role(spark, sf_dir, "bureau")
        )
    return BD.spark_role(spark, sf_dir, spec.source_table)


def block_rows_sql(spec: B.BlockSpec) -> str:
    if spec is B.BUREAU_BALANCE:
        return monthly_rows_sql()
    return BD.duckdb_role(spec.source_table)


def _block_query(name: str, spec: B.BlockSpec) -> None:
    register(name, lambda: duck_round(block_sql(spec, block_rows_sql(spec)), double_outputs(spec)))(
        lambda spark, sf_dir: B.build_block(
            spec, block_rows(spark, sf_dir, spec), B.partitions_for(spark, BD.role_rows(spark, sf_dir, spec.source_table))
        )
    )


_block_query("block_accounts", B.BUREAU)
_block_query("block_monthly_status", B.BUREAU_BALANCE)
_block_query("block_previous", B.PREVIOUS)
_block_query("block_installments", B.INSTALLMENTS)
_block_query("block_card", B.CREDIT_CARD)
_block_query("block_pos", B.POS_CASH)

from riskfold.plans import q_chain, q_eval, q_explain, q_grids, q_models, q_raw, q_screen, q_store  # noqa: E402,F401

FLAGSHIP = "feature_store"
