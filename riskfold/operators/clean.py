"""Cleaning and application-level derived columns.

All per-row work is column arithmetic inside one projection.  The only
action is :func:`sentinel_counts`, a single-row aggregate that decides which
``<col>_SENTINEL_365243`` flags exist (the flag set is data-dependent in the
reference, so its size is plan metadata).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.functions.core import (
    row_max,
    row_mean,
    row_min,
    row_nonnull_count,
    row_null_count,
    row_std,
    row_sum_fill0,
    safe_div,
)

SENTINEL = 365243
UNKNOWN_CATEGORY_VALUES = ("XNA", "Unknown")
ID_COLUMNS = ("dataset", "SK_ID_CURR", "TARGET")
SENTINEL_SUFFIX = f"_SENTINEL_{SENTINEL}"
RECENT_REQUEST_COLUMNS = ("AMT_REQ_CREDIT_BUREAU_HOUR", "AMT_REQ_CREDIT_BUREAU_DAY", "AMT_REQ_CREDIT_BUREAU_WEEK")


def tag_dataset(df: DataFrame, dataset: str, add_null_target: bool = True) -> DataFrame:
    """Prepend the ``dataset`` literal and add a NULL ``TARGET`` when absent."""
    if add_null_target and "TARGET" not in df.columns:
        df = df.withColumn("TARGET", F.lit(None).cast("int"))
    return df.select(F.lit(dataset).alias("dataset"), *df.columns)


def concat_datasets(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize_categories(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Trim every string column; ``XNA`` / ``Unknown`` become NULL."""
    repl = {}
    for c in string_columns(df):
        if c in exclude:
            continue
        t = F.trim(F.col(c))
        repl[c] = F.when(~t.isin(*UNKNOWN_CATEGORY_VALUES), t)
    return df.withColumns(repl) if repl else df


def day_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("DAYS")]


def sentinel_counts(df: DataFrame) -> DataFrame:
    """One row: rows + sentinel count per ``DAYS*`` column (single pass)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.when(F.col(c) == SENTINEL, 1)).alias(c) for c in day_columns(df)]
    return df.agg(*aggs)


def sentinel_profile(df: DataFrame) -> DataFrame:
    """column, sentinel_value, sentinel_count, sentinel_rate, created_flag (P3 report)."""
    cols = day_columns(df)
    wide = sentinel_counts(df)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column, sentinel_count)")
    return long.select(
        "column",
        F.lit(SENTINEL).alias("sentinel_value"),
        F.col("sentinel_count"),
        (F.col("sentinel_count") / F.col("_rows")).alias("sentinel_rate"),
        (F.col("sentinel_count") > 0).alias("created_flag"),
    )


def clean_day_sentinels(df: DataFrame) -> DataFrame:
    """Flag (only when present) and NULL the 365243 sentinel in ``DAYS*`` columns."""
    cols = day_columns(df)
    counts = sentinel_counts(df).first().asDict()  # one bounded row
    flags = {f"{c}{SENTINEL_SUFFIX}": F.coalesce(F.col(c) == SENTINEL, F.lit(False)).cast("int") for c in cols if counts[c] > 0}
    nulled = {c: F.when(F.col(c) != SENTINEL, F.col(c)) for c in cols if counts[c] > 0}
    out = df.withColumns(flags) if flags else df
    return out.withColumns(nulled) if nulled else out


def add_application_features(df: DataFrame) -> DataFrame:
    """Years, affordability ratios, EXT_SOURCE row stats, horizontal sums, missingness."""
    cols = df.columns
    ext = [c for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3") if c in cols]
    docs = [c for c in cols if c.startswith("FLAG_DOCUMENT_")]
    contact = [c for c in ("FLAG_WORK_PHONE", "FLAG_PHONE", "FLAG_EMAIL", "FLAG_MOBIL") if c in cols]
    requests = [c for c in cols if c.startswith("AMT_REQ_CREDIT_BUREAU_")]
    raw = [c for c in cols if c not in ID_COLUMNS and not c.endswith(SENTINEL_SUFFIX)]

    # Derived columns whose inputs are absent are skipped (schemas vary by source).
    year_src = {
        "applicant_age_years": "DAYS_BIRTH",
        "employment_years": "DAYS_EMPLOYED",
        "registration_age_years": "DAYS_REGISTRATION",
        "id_publish_years": "DAYS_ID_PUBLISH",
        "last_phone_change_years": "DAYS_LAST_PHONE_CHANGE",
    }
    years = {k: -F.col(v) / F.lit(365.25) for k, v in year_src.items() if v in cols}
    out = df.withColumns(years) if years else df
    have = set(out.columns)
    ratio_src = {
        "credit_to_income_ratio": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "annuity_to_income_ratio": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "credit_to_annuity_ratio": ("AMT_CREDIT", "AMT_ANNUITY"),
        "goods_to_credit_ratio": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
        "income_per_family_member": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "children_to_family_ratio": ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
        "employment_to_age_ratio": ("employment_years", "applicant_age_years"),
    }
    new = {k: safe_div(n, d) for k, (n, d) in ratio_src.items() if n in have and d in have}
    if ext:
        new.update(
            {
                "ext_source_mean": row_mean(ext),
                "ext_source_min": row_min(ext),
                "ext_source_max": row_max(ext),
                "ext_source_std": row_std(ext),
                "ext_source_available_count": row_nonnull_count(ext),
            }
        )
    if docs:
        new["document_flag_count"] = row_sum_fill0(docs)
    if contact:
        new["contact_channel_count"] = row_sum_fill0(contact)
    if requests:
        recent = [c for c in requests if c in RECENT_REQUEST_COLUMNS]
        new["bureau_request_total_count"] = row_sum_fill0(requests)
        new["bureau_request_recent_count"] = row_sum_fill0(recent) if recent else F.lit(None).cast("double")
    new["application_missing_field_count"] = row_null_count(raw)
    out = out.withColumns(new)
    return out.withColumn(
        "application_missing_field_ratio", F.col("application_missing_field_count") / F.lit(float(len(raw)))
    )


def application_base(train: DataFrame, test: DataFrame) -> DataFrame:
    """Tag + union the two application files, normalise, clean, derive."""
    app = concat_datasets([tag_dataset(train, "train"), tag_dataset(test, "test")])
    app = normalize_categories(app, exclude=("dataset",))
    app = clean_day_sentinels(app)
    return add_application_features(app)


def application_quality(base: DataFrame) -> DataFrame:
    """Per dataset: rows, columns, label stats (train only), mean missingness."""
    n_cols = len(base.columns)
    is_train = F.col("dataset") == "train"
    return base.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(n_cols).alias("columns"),
        F.when(F.first(is_train), F.coalesce(F.sum("TARGET"), F.lit(0))).cast("bigint").alias("target_bad_count"),
        F.when(F.first(is_train), F.avg("TARGET")).alias("target_bad_rate"),
        F.avg("application_missing_field_count").alias("avg_missing_fields"),
        F.avg("application_missing_field_ratio").alias("avg_missing_field_ratio"),
    )
