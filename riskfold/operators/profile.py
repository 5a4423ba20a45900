"""Data profiling.

* :func:`table_profile` — rows, columns, key columns, label stats per table:
  one aggregate per table, unioned.
* :func:`column_profile` — per column dtype, missing share, distinct count
  and three example values, over the **whole** table in long format
  (``stack``), so the work is spread over (column, value) groups.
* :func:`column_dictionary` — rule-based column classification joined to
  the observed profile.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.session import materialise

EXAMPLES = 3


def key_columns(columns: Sequence[str]) -> str:
    return ", ".join(c for c in columns if c.startswith("SK_ID"))


def table_profile(tables: Mapping[str, DataFrame], file_mb: Mapping[str, float] | None = None) -> DataFrame:
    """One row per table: table, exists, rows, columns, file_mb, key_columns, has_target, bad_count, bad_rate."""
    parts = []
    for name, df in tables.items():
        has_target = "TARGET" in df.columns
        aggs = [F.count(F.lit(1)).alias("rows")]
        if has_target:
            aggs += [F.sum("TARGET").cast("bigint").alias("bad_count"), F.avg("TARGET").alias("bad_rate")]
        else:
            aggs += [F.lit(None).cast("bigint").alias("bad_count"), F.lit(None).cast("double").alias("bad_rate")]
        mb = (file_mb or {}).get(name)
        parts.append(
            df.agg(*aggs).select(
                F.lit(name).alias("table"),
                F.lit(True).alias("exists"),
                "rows",
                F.lit(len(df.columns)).cast("bigint").alias("columns"),
                F.lit(mb).cast("double").alias("file_mb"),
                F.lit(key_columns(df.columns)).alias("key_columns"),
                F.lit(has_target).alias("has_target"),
                "bad_count",
                "bad_rate",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _long(df: DataFrame, first: int) -> DataFrame:
    """(c, value_str, value_num) for every cell; c is the column's number, from ``first`` on."""
    entries = []
    for i, f in enumerate(df.schema.fields):
        numeric = isinstance(f.dataType, T.NumericType)
        v = F.col(f"`{f.name}`")
        num = v.cast("double") if numeric else F.lit(None).cast("double")
        entries.append(F.struct(F.lit(first + i).alias("c"), v.cast("string").alias("value_str"), num.alias("value_num")))
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _value_counts(long: DataFrame) -> DataFrame:
    """(c, value_str, n, value_num): how often each value stands in its column."""
    return long.groupBy("c", "value_str").agg(F.count(F.lit(1)).alias("n"), F.min("value_num").alias("value_num"))


def column_profile(tables: Mapping[str, DataFrame], approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """table, column, dtype, missing_pct, nunique, example_values (3 smallest distinct).

    ``approx_distinct=True`` takes the distinct count from HyperLogLog++
    (``approx_count_distinct``, relative error ``rsd``).
    """
    named: list[tuple[str, str, str, bool]] = []
    long = None
    for name, df in tables.items():
        part = _long(df, len(named))
        long = part if long is None else long.unionByName(part)
        # Fractional values are shown in fixed point (no exponent form).
        named += [(name, f.name, f.dataType.simpleString(), isinstance(f.dataType, (T.DoubleType, T.FloatType))) for f in df.schema.fields]
    keys = ["table", "column", "dtype"]
    # one pass over the cells: how often each value stands in its column (a hot value is summed before the shuffle);
    # missing share, distinct count and examples are read off these counts.  The key is a number and the value, and no
    # string is aggregated: that would sort all cells.
    counts = materialise(_value_counts(long), "column-values")
    columns = F.broadcast(long.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(named)], "c int, table string, column string, dtype string, fractional boolean"))
    missing = F.sum(F.when(F.col("value_str").isNull(), F.col("n")).otherwise(0)) / F.sum("n")
    stats = counts.groupBy("c").agg(missing.alias("missing_pct"), F.count("value_str").alias("nunique"))
    if approx_distinct:
        sketched = long.groupBy("c").agg(F.approx_count_distinct("value_str", rsd).alias("nunique"))
        stats = stats.drop("nunique").join(sketched, "c")
    # A per-column top-3: Spark plans the rank filter as a partial window group
    # limit before the shuffle, so no column is collected whole.
    distinct_vals = counts.filter(F.col("value_str").isNotNull())
    w = Window.partitionBy("c").orderBy(F.col("value_num").asc_nulls_last(), F.col("value_str"))
    top = distinct_vals.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= EXAMPLES).join(columns, "c")
    shown = F.when(F.col("fractional"), F.expr("try_cast(value_num AS DECIMAL(38,6))").cast("string")).otherwise(F.col("value_str"))
    top = top.withColumn("value_show", shown)
    ex = top.groupBy("c").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rk", "value_show"))), lambda s: s["value_show"]), " | "
        ).alias("example_values")
    )
    out = stats.join(columns, "c").join(ex, "c", "left")
    return out.select(*keys, "missing_pct", "nunique", F.coalesce("example_values", F.lit("")).alias("example_values"))


# ---------------------------------------------------------------------------
# Column dictionary rules (fixed values of the reference classification).
# ---------------------------------------------------------------------------

def business_category(c: Column) -> Column:
    def sw(*prefixes: str) -> Column:
        cond = None
        for p in prefixes:
            x = c.startswith(p)
            cond = x if cond is None else (cond | x)
        return cond

    return (
        F.when(c == "TARGET", "label")
        .when(sw("SK_ID"), "join_key")
        .when(sw("EXT_SOURCE"), "external_score")
        .when(sw("AMT"), "amount_debt_income")
        .when(sw("DAYS"), "timing_recency")
        .when(sw("CNT"), "count_family_or_terms")
        .when(sw("FLAG"), "binary_flag")
        .when(c.contains("STATUS"), "status_outcome")
        .when(
            sw("NAME", "CODE", "OCCUPATION", "ORGANIZATION", "WALLSMATERIAL", "FONDKAPREMONT", "HOUSETYPE"),
            "categorical_profile",
        )
        .when(sw("NUM", "OBS", "DEF"), "count_or_credit_bureau_summary")
        .when(sw("RATE", "REGION"), "rate_region_context")
        .otherwise("other")
    )


def data_domain(t: Column) -> Column:
    return (
        F.when(t.startswith("application"), "current_application")
        .when(t.startswith("bureau"), "external_credit_history")
        .when(t == "previous_application", "internal_previous_application")
        .when(t == "installments_payments", "internal_repayment_history")
        .when(t == "credit_card_balance", "internal_credit_card_history")
        .when(t == "POS_CASH_balance", "internal_pos_cash_history")
        .otherwise("unknown")
    )


def availability(t: Column, c: Column) -> tuple[Column, Column]:
    avail = (
        F.when(c == "TARGET", "label_only_not_feature")
        .when(c.startswith("SK_ID"), "join_key_not_model_feature")
        .when(t.startswith("application"), "available_at_application")
        .otherwise("historical_before_current_application_assumed")
    )
    risk = (
        F.when(c == "TARGET", "high")
        .when(c.startswith("SK_ID"), "low")
        .when(t.startswith("application"), "low")
        .otherwise("medium")
    )
    return avail, risk


def column_dictionary(profile: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """Classify each (table, column) of a column profile; descriptions optional."""
    t, c = F.col("table"), F.col("column")
    avail, risk = availability(t, c)
    out = profile.select(
        "table",
        "column",
        data_domain(t).alias("data_domain"),
        business_category(c).alias("business_category"),
        avail.alias("application_time_availability"),
        risk.alias("leakage_risk_initial"),
        F.when((c == "TARGET") | c.startswith("SK_ID"), "no").otherwise("candidate").alias("use_in_model_initial"),
        F.when(t.startswith("application"), "no").otherwise("yes_to_SK_ID_CURR").alias("aggregation_needed"),
        "missing_pct",
        "nunique",
    )
    if descriptions is None:
        return out.withColumn("description", F.lit("")).withColumn("special", F.lit(""))
    d = descriptions.dropDuplicates(["table", "column"])
    return (
        out.join(F.broadcast(d), ["table", "column"], "left")
        .withColumn("description", F.coalesce("description", F.lit("")))
        .withColumn("special", F.coalesce("special", F.lit("")))
    )


def schema_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column, missing_pct, nunique) from the tables' schemas alone, the figures NULL: no data are read."""
    spark = next(iter(tables.values())).sparkSession
    names = [(t, c, None, None) for t, df in tables.items() for c in df.columns]
    return spark.createDataFrame(names, "table string, column string, missing_pct double, nunique bigint")


def leakage_summary(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("data_domain", "leakage_risk_initial").agg(F.count(F.lit(1)).alias("columns"))
