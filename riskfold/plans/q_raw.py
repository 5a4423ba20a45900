"""Catalogue: raw files - inventory, CSV round trip, rejected lines, described dictionary."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from riskfold.operators import profile as PR
from riskfold.plans import q_store as QS
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round
from riskfold.session import ensure_checkpoint_dir
from riskfold.sources import raw as R
from riskfold.sources.tables import TABLES, read_table, table_path

#: Expected beside the driver's tables, and absent: its row says so.
ABSENT = "bureau_archive"


def _folder(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _inventory_sql() -> str:
    each = [
        f"SELECT '{t}' AS \"table\", true AS exists, (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM (DESCRIBE {t})) AS columns, "
        "'' AS key_columns, false AS has_target, NULL::BIGINT AS bad_count, NULL::DOUBLE AS bad_rate"
        for t in TABLES
    ]
    each.append(f"SELECT '{ABSENT}', false, NULL, NULL, '', false, NULL, NULL")
    return "\nUNION ALL ".join(each)


@register("raw_inventory", _inventory_sql)
def q_inventory(spark, sf_dir):
    """A1: the expected tables against what is there (sizes are in raw_file_sizes)."""
    return R.inventory(spark, {t: table_path(sf_dir, t) for t in [*TABLES, ABSENT]}).drop("file_mb")


CUSTOMER = "c_custkey long, c_name string, c_acctbal double, note string"


@register("csv_roundtrip", lambda: duck_round(
    "SELECT c_custkey, c_name, c_acctbal, c_name || chr(10) || 'é \"' || c_mktsegment || '\", ü' AS note FROM customer", ["c_acctbal"]))
def q_csv_roundtrip(spark, sf_dir):
    """A table as Latin-1 CSV, with quotes, separators and line ends inside values, written and read back."""
    note = F.concat("c_name", F.lit('\né "'), "c_mktsegment", F.lit('", ü'))
    path = _folder(spark, "csv-customer")
    R.write_csv(read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", note.alias("note")), path, "ISO-8859-1")
    return R.accepted(R.read_csv_checked(spark, path, CUSTOMER, "ISO-8859-1", multi_line=True))


@register("csv_rejects", lambda: duck_round("""
SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 50 < 2) AS rejected,
  count(*) FILTER (WHERE o_orderkey % 50 >= 2) AS accepted_rows,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o_orderkey % 50 >= 2) AS DOUBLE) AS accepted_price FROM orders""", ["accepted_price"]))
def q_csv_rejects(spark, sf_dir):
    """Lines with a value that is not of its column's type are counted by file, the others summed."""
    orders, path = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]), _folder(spark, "csv-orders")
    broken = F.when(F.col("o_orderkey") % 50 == 0, "n/a").when(F.col("o_orderkey") % 50 == 1, "12,5").otherwise(F.col("o_totalprice").cast("string"))
    R.write_csv(orders.select("o_orderkey", broken.alias("o_totalprice")), path)
    rows = R.read_csv_checked(spark, path, "o_orderkey long, o_totalprice double")
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    sums = R.accepted(rows).agg(F.count(F.lit(1)).alias("accepted_rows"), price.alias("accepted_price"))
    return R.reject_counts(rows).agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")).join(F.broadcast(sums))


#: Tables of the model and what the documentation calls them: both application files share one.
DOCUMENTED = {t: ("application_{train|test}.csv" if t.startswith("application") else f"{t}.csv") for t in QS.ROLE_TABLES}


def _described_sql() -> str:
    amount = "starts_with(\"column\", 'AMT')"
    return (
        f"SELECT * EXCLUDE (description, special), CASE WHEN {amount} THEN 'Betrag \"' || \"column\" || '\",' || chr(10) || 'größer 0' ELSE '' END AS description, "
        f"CASE WHEN {amount} THEN 'normalisé' ELSE '' END AS special FROM ({QS.dictionary_oracle()})"
    )


@register("described_dictionary", _described_sql)
def q_described_dictionary(spark, sf_dir):
    """The column dictionary with the descriptions of a Latin-1 documentation file (here: of the amounts)."""
    tables, path = QS.role_tables(spark, sf_dir), _folder(spark, "csv-descriptions")
    named = [(DOCUMENTED[t], c) for t, df in tables.items() for c in df.columns if c.startswith("AMT")]  # names of columns
    text = F.concat(F.lit('Betrag "'), "Row", F.lit('",\ngrößer 0'))
    doc = spark.createDataFrame(named, "Table string, Row string").select(
        F.monotonically_increasing_id().alias("No"), "Table", "Row", text.alias("Description"), F.lit("normalisé").alias("Special")
    )
    R.write_csv(doc, path, "ISO-8859-1")
    return PR.column_dictionary(PR.column_profile(tables), R.read_descriptions(spark, path, DOCUMENTED))
