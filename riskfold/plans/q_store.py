"""Catalogue: cleaning, profiling and the feature store (P*, A1-A5, J1, F7-F9)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.operators import blocks as B
from riskfold.operators import clean as C
from riskfold.operators import profile as PR
from riskfold.operators import store as S
from riskfold.plans import bindings as BD
from riskfold.plans.oracle_blocks import block_sql, double_outputs
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round

ROLE_TABLES = (
    "application_train",
    "application_test",
    "bureau",
    "bureau_balance",
    "previous_application",
    "POS_CASH_balance",
    "credit_card_balance",
    "installments_payments",
)
BLOCK_ORDER = (B.BUREAU, B.BUREAU_BALANCE, B.PREVIOUS, B.INSTALLMENTS, B.CREDIT_CARD, B.POS_CASH)


def _names(exprs: list[str]) -> list[str]:
    return [e.rsplit(" AS ", 1)[1].strip() for e in exprs]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def role_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    train, test = BD.application_files(spark, sf_dir)
    out = {"application_train": train, "application_test": test}
    for r in ROLE_TABLES[2:]:
        out[r] = BD.spark_role(spark, sf_dir, r)
    return out


def app_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = BD.application_files(spark, sf_dir)
    app = C.concat_datasets([C.tag_dataset(train, "train"), C.tag_dataset(test, "test")])
    return C.normalize_categories(app, exclude=("dataset",))


def app_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = BD.application_files(spark, sf_dir)
    return C.application_base(train, test)


def store_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the spine and its blocks, by the raw rows of all of them."""
    roles = ["application", *(spec.source_table for spec in BLOCK_ORDER)]
    return B.partitions_for(spark, sum(BD.role_rows(spark, sf_dir, r) for r in roles))


def block_frames(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> list[DataFrame]:
    from riskfold.plans.catalog import block_rows

    return [B.build_block(spec, block_rows(spark, sf_dir, spec), partitions) for spec in BLOCK_ORDER]


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application feature store, materialised once per session (Parquet).

    Every downstream report (screening, split, scoring, coverage) then starts
    from a short lineage instead of re-planning ~400 columns of joins.
    """
    from riskfold.plans.q_screen import memo
    from riskfold.session import materialise

    def build():
        n = store_partitions(spark, sf_dir)
        return materialise(S.build_feature_store(app_base(spark, sf_dir), block_frames(spark, sf_dir, n), partitions=n), "q_store")

    return memo("feature_store", spark, sf_dir, build)


@register("application_base", lambda: app_base_oracle())
def q_application_base(spark, sf_dir):
    return app_base(spark, sf_dir)


@register("sentinel_profile", lambda: sentinel_oracle())
def q_sentinel_profile(spark, sf_dir):
    return C.sentinel_profile(app_union(spark, sf_dir))


@register("application_quality", lambda: quality_oracle())
def q_application_quality(spark, sf_dir):
    return C.application_quality(app_base(spark, sf_dir))


@register("feature_store", lambda: feature_store_oracle())
def q_feature_store(spark, sf_dir):
    return feature_store(spark, sf_dir)


@register("feature_group_coverage", lambda: coverage_oracle())
def q_feature_group_coverage(spark, sf_dir):
    fs = feature_store(spark, sf_dir)
    man = S.manifest(spark, app_base_columns(), BLOCK_ORDER)
    return S.group_coverage(fs, man)


@register("raw_table_profile", lambda: table_profile_oracle())
def q_raw_table_profile(spark, sf_dir):
    return PR.table_profile(role_tables(spark, sf_dir))


@register("column_profile", lambda: column_profile_oracle())
def q_column_profile(spark, sf_dir):
    return PR.column_profile(role_tables(spark, sf_dir))


@register("column_dictionary", lambda: dictionary_oracle())
def q_column_dictionary(spark, sf_dir):
    return PR.column_dictionary(PR.column_profile(role_tables(spark, sf_dir)))


# ---------------------------------------------------------------------------
# DuckDB oracles (written in plain SQL, column lists from the bindings)
# ---------------------------------------------------------------------------

APP_RAW = [n for n in _names(BD._application("duckdb"))]
STRING_COLS = ["NAME_CONTRACT_TYPE", "OCCUPATION_TYPE"]
DAY_COLS = [c for c in APP_RAW if c.startswith("DAYS")]
SENTINEL_COLS = ["DAYS_EMPLOYED"]  # the only day column the binding plants sentinels in


def app_union_sql() -> str:
    train, test = BD.duckdb_application_files()
    sel = []
    for c in ["dataset"] + APP_RAW + ["TARGET"]:
        if c in STRING_COLS:
            sel.append(f"CASE WHEN trim({c}) IN ('XNA', 'Unknown') THEN NULL ELSE trim({c}) END AS {c}")
        else:
            sel.append(c)
    return (
        f"(SELECT {', '.join(sel)} FROM (SELECT 'train' AS dataset, * FROM {train} _tr "
        f"UNION ALL BY NAME SELECT 'test' AS dataset, *, CAST(NULL AS INTEGER) AS TARGET FROM {test} _te) _u)"
    )


def _app_derived_sql() -> tuple[str, list[str]]:
    """App base SQL and its double columns."""
    base = app_union_sql()
    flags = [f"CAST(coalesce({c} = {C.SENTINEL}, FALSE) AS INTEGER) AS {c}{C.SENTINEL_SUFFIX}" for c in SENTINEL_COLS]
    cleaned = [
        (f"CASE WHEN {c} = {C.SENTINEL} THEN NULL ELSE {c} END AS {c}" if c in SENTINEL_COLS else c)
        for c in ["dataset"] + APP_RAW + ["TARGET"]
    ]
    step1 = f"(SELECT {', '.join(cleaned)}, {', '.join(flags)} FROM {base} _b)"

    def sd(n, d):
        return f"CASE WHEN {d} = 0 THEN NULL ELSE {n} / {d} END"

    ext = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    n_ext = " + ".join(f"CAST({e} IS NOT NULL AS INTEGER)" for e in ext)
    s_ext = " + ".join(f"coalesce({e}, 0)" for e in ext)
    mean = f"(CASE WHEN ({n_ext}) > 0 THEN ({s_ext}) / ({n_ext}) END)"
    ss = " + ".join(f"coalesce(({e} - {mean}) * ({e} - {mean}), 0)" for e in ext)
    docs = [c for c in APP_RAW if c.startswith("FLAG_DOCUMENT_")]
    contact = ["FLAG_WORK_PHONE", "FLAG_PHONE", "FLAG_EMAIL", "FLAG_MOBIL"]
    req = [c for c in APP_RAW if c.startswith("AMT_REQ_CREDIT_BUREAU_")]
    recent = [c for c in req if c in C.RECENT_REQUEST_COLUMNS]
    raw = APP_RAW  # everything except dataset / key / TARGET / sentinel flags
    raw = [c for c in raw if c != "SK_ID_CURR"]
    step2 = (
        "(SELECT *, "
        + ", ".join(
            [
                "-DAYS_BIRTH / 365.25 AS applicant_age_years",
                "-DAYS_EMPLOYED / 365.25 AS employment_years",
                "-DAYS_REGISTRATION / 365.25 AS registration_age_years",
                "-DAYS_ID_PUBLISH / 365.25 AS id_publish_years",
                "-DAYS_LAST_PHONE_CHANGE / 365.25 AS last_phone_change_years",
            ]
        )
        + f" FROM {step1} _s1)"
    )
    derived = [
        sd("AMT_CREDIT", "AMT_INCOME_TOTAL") + " AS credit_to_income_ratio",
        sd("AMT_ANNUITY", "AMT_INCOME_TOTAL") + " AS annuity_to_income_ratio",
        sd("AMT_CREDIT", "AMT_ANNUITY") + " AS credit_to_annuity_ratio",
        sd("AMT_GOODS_PRICE", "AMT_CREDIT") + " AS goods_to_credit_ratio",
        sd("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS") + " AS income_per_family_member",
        sd("CNT_CHILDREN", "CNT_FAM_MEMBERS") + " AS children_to_family_ratio",
        sd("employment_years", "applicant_age_years") + " AS employment_to_age_ratio",
        f"{mean} AS ext_source_mean",
        f"least({', '.join(ext)}) AS ext_source_min",
        f"greatest({', '.join(ext)}) AS ext_source_max",
        f"CASE WHEN ({n_ext}) >= 2 THEN sqrt(({ss}) / (({n_ext}) - 1)) END AS ext_source_std",
        f"({n_ext}) AS ext_source_available_count",
        "(" + " + ".join(f"coalesce({c}, 0)" for c in docs) + ") AS document_flag_count",
        "(" + " + ".join(f"coalesce({c}, 0)" for c in contact) + ") AS contact_channel_count",
        "(" + " + ".join(f"coalesce({c}, 0)" for c in req) + ") AS bureau_request_total_count",
        "(" + " + ".join(f"coalesce({c}, 0)" for c in recent) + ") AS bureau_request_recent_count",
        "(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in raw) + ") AS application_missing_field_count",
    ]
    step3 = f"(SELECT *, {', '.join(derived)} FROM {step2} _s2)"
    sql = f"SELECT *, application_missing_field_count / {float(len(raw))} AS application_missing_field_ratio FROM {step3} _s3"
    doubles = [
        c for c in APP_RAW if c.startswith(("AMT_", "EXT_", "CNT_FAM", "DAYS_REG", "DAYS_LAST"))
    ] + [
        "applicant_age_years", "employment_years", "registration_age_years", "id_publish_years",
        "last_phone_change_years", "credit_to_income_ratio", "annuity_to_income_ratio", "credit_to_annuity_ratio",
        "goods_to_credit_ratio", "income_per_family_member", "children_to_family_ratio", "employment_to_age_ratio",
        "ext_source_mean", "ext_source_min", "ext_source_max", "ext_source_std", "bureau_request_total_count",
        "bureau_request_recent_count", "application_missing_field_ratio",
    ]
    return sql, doubles


def app_base_columns() -> list[str]:
    sql, _ = _app_derived_sql()
    derived = [
        "applicant_age_years", "employment_years", "registration_age_years", "id_publish_years",
        "last_phone_change_years", "credit_to_income_ratio", "annuity_to_income_ratio", "credit_to_annuity_ratio",
        "goods_to_credit_ratio", "income_per_family_member", "children_to_family_ratio", "employment_to_age_ratio",
        "ext_source_mean", "ext_source_min", "ext_source_max", "ext_source_std", "ext_source_available_count",
        "document_flag_count", "contact_channel_count", "bureau_request_total_count", "bureau_request_recent_count",
        "application_missing_field_count", "application_missing_field_ratio",
    ]
    return ["dataset"] + APP_RAW + ["TARGET"] + [f"{c}{C.SENTINEL_SUFFIX}" for c in SENTINEL_COLS] + derived


@lru_cache(maxsize=None)
def app_base_oracle() -> str:
    sql, doubles = _app_derived_sql()
    return duck_round(sql, doubles)


def sentinel_oracle() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", {C.SENTINEL} AS sentinel_value, "
        f"count(*) FILTER (WHERE {c} = {C.SENTINEL}) AS sentinel_count, "
        f"count(*) FILTER (WHERE {c} = {C.SENTINEL}) / count(*) AS sentinel_rate, "
        f"count(*) FILTER (WHERE {c} = {C.SENTINEL}) > 0 AS created_flag FROM {app_union_sql()} _a"
        for c in DAY_COLS
    ]
    return duck_round("\nUNION ALL\n".join(parts), ["sentinel_rate"])


def quality_oracle() -> str:
    base, _ = _app_derived_sql()
    n_cols = len(app_base_columns())
    sql = (
        f"SELECT dataset, count(*) AS rows, {n_cols} AS columns, "
        "CASE WHEN dataset = 'train' THEN CAST(coalesce(sum(TARGET), 0) AS BIGINT) END AS target_bad_count, "
        "CASE WHEN dataset = 'train' THEN avg(TARGET) END AS target_bad_rate, "
        "avg(application_missing_field_count) AS avg_missing_fields, "
        "avg(application_missing_field_ratio) AS avg_missing_field_ratio "
        f"FROM ({base}) _b GROUP BY dataset"
    )
    return duck_round(sql, ["target_bad_rate", "avg_missing_fields", "avg_missing_field_ratio"])


def _block_sqls() -> list[tuple[B.BlockSpec, str]]:
    from riskfold.plans.catalog import block_rows_sql

    return [(spec, block_sql(spec, block_rows_sql(spec))) for spec in BLOCK_ORDER]


def _feature_store_sql() -> tuple[str, list[str], list[str]]:
    base, app_doubles = _app_derived_sql()
    ctes = [f"app AS ({base})"]
    joins, cols, doubles = [], [c for c in app_base_columns()], list(app_doubles)
    for i, (spec, sql) in enumerate(_block_sqls()):
        ctes.append(f"b{i} AS ({sql})")
        joins.append(f"LEFT JOIN b{i} ON app.SK_ID_CURR = b{i}.SK_ID_CURR")
        cols += spec.feature_names()
        doubles += double_outputs(spec)
    select = ["app.*"] + [f"b{i}.* EXCLUDE (SK_ID_CURR)" for i in range(len(BLOCK_ORDER))]
    joined = f"SELECT {', '.join(select)} FROM app " + " ".join(joins)
    flags = [
        f"CAST({c} IS NOT NULL AS INTEGER) AS {S.history_flag_name(c)}" for c in S.HISTORY_COUNT_COLUMNS
    ]
    fill = [c for c in cols if c.startswith(S.ZERO_FILL_PREFIXES) and c.endswith(S.ZERO_FILL_SUFFIXES)]
    filled = (
        f"SELECT * REPLACE ({', '.join(f'coalesce({c}, 0) AS {c}' for c in fill)}), {', '.join(flags)} "
        f"FROM ({joined}) _j"
    )
    cols += [S.history_flag_name(c) for c in S.HISTORY_COUNT_COLUMNS]
    counted = [c for c in cols if c not in S.ID_COLUMNS]
    den = float(len(cols) + 1 - 3)
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in counted)
    with_count = f"SELECT *, ({nulls}) AS feature_store_missing_field_count FROM ({filled}) _f"
    sql = (
        "WITH " + ",\n".join(ctes) + "\n"
        f"SELECT *, feature_store_missing_field_count / {den} AS feature_store_missing_field_ratio FROM ({with_count}) _c"
    )
    cols += ["feature_store_missing_field_count", "feature_store_missing_field_ratio"]
    doubles.append("feature_store_missing_field_ratio")
    return sql, cols, doubles


@lru_cache(maxsize=None)
def feature_store_oracle() -> str:
    sql, _, doubles = _feature_store_sql()
    return duck_round(sql, doubles)


def coverage_oracle() -> str:
    sql, cols, _ = _feature_store_sql()
    feats = [c for c in cols if c not in S.ID_COLUMNS]
    groups = {}
    for c in app_base_columns():
        if c not in S.ID_COLUMNS:
            groups.setdefault(c, "current_application")
    for spec in BLOCK_ORDER:
        for f in spec.feature_names():
            groups.setdefault(f, spec.feature_group)
    for c in S.HISTORY_COUNT_COLUMNS:
        groups.setdefault(S.history_flag_name(c), "history_coverage")
    groups.setdefault("feature_store_missing_field_count", "feature_store_quality")
    groups.setdefault("feature_store_missing_field_ratio", "feature_store_quality")
    rates = ", ".join(f"avg(CAST({c} IS NULL AS DOUBLE)) AS {c}" for c in feats)
    man = ", ".join(f"('{f}', '{g}')" for f, g in groups.items())
    order = ", ".join(f"('{g}', {i + 1})" for i, g in enumerate(S.GROUP_ORDER))
    out = (
        f"WITH fs AS ({sql}),\n"
        f"wide AS (SELECT {rates} FROM fs),\n"
        "long AS (UNPIVOT wide ON COLUMNS(*) INTO NAME feature VALUE missing_rate),\n"
        f"man(feature, feature_group) AS (VALUES {man}),\n"
        f"grp(feature_group, group_order) AS (VALUES {order}),\n"
        "per AS (SELECT feature_group, count(*) AS feature_count, avg(missing_rate) AS avg_missing_rate "
        "FROM long JOIN man USING (feature) GROUP BY feature_group)\n"
        "SELECT grp.feature_group, grp.group_order, CAST(coalesce(per.feature_count, 0) AS BIGINT) AS feature_count, "
        "per.avg_missing_rate FROM grp LEFT JOIN per USING (feature_group)"
    )
    return duck_round(out, ["avg_missing_rate"])


def _role_sql(name: str) -> tuple[str, list[str]]:
    if name == "application_train":
        tr, _ = BD.duckdb_application_files()
        return tr, APP_RAW + ["TARGET"]
    if name == "application_test":
        _, te = BD.duckdb_application_files()
        return te, APP_RAW
    return BD.duckdb_role(name), _names(BD.BINDINGS[name].exprs("duckdb"))


def table_profile_oracle() -> str:
    parts = []
    for name in ROLE_TABLES:
        sql, cols = _role_sql(name)
        has_t = "TARGET" in cols
        bc = "CAST(sum(TARGET) AS BIGINT)" if has_t else "CAST(NULL AS BIGINT)"
        br = "avg(TARGET)" if has_t else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS \"table\", true AS \"exists\", count(*) AS rows, CAST({len(cols)} AS BIGINT) AS columns, "
            f"CAST(NULL AS DOUBLE) AS file_mb, '{PR.key_columns(cols)}' AS key_columns, {str(has_t).lower()} AS has_target, "
            f"{bc} AS bad_count, {br} AS bad_rate FROM {sql} _t"
        )
    return duck_round("\nUNION ALL\n".join(parts), ["file_mb", "bad_rate"])


def _profile_sql() -> str:
    parts = []
    for name in ROLE_TABLES:
        sql, cols = _role_sql(name)
        for c in cols:
            parts.append(
                f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", typeof({c}) AS dt, CAST({c} AS VARCHAR) AS value_str, "
                f"TRY_CAST({c} AS DOUBLE) AS value_num, CASE WHEN typeof({c}) = 'DOUBLE' THEN CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR) "
                f"ELSE CAST({c} AS VARCHAR) END AS value_show FROM {sql} _t"
            )
    long = "\nUNION ALL\n".join(parts)
    return f"""
WITH long AS ({long}),
typed AS (SELECT "table", "column", CASE dt WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' ELSE lower(dt) END AS dtype, value_str,
  CASE WHEN dt = 'VARCHAR' THEN NULL ELSE value_num END AS value_num, value_show FROM long),
stats AS (SELECT "table", "column", dtype, avg(CAST(value_str IS NULL AS DOUBLE)) AS missing_pct,
  count(DISTINCT value_str) AS nunique FROM typed GROUP BY ALL),
dv AS (SELECT "table", "column", dtype, value_str, min(value_num) AS value_num, min(value_show) AS value_show FROM typed WHERE value_str IS NOT NULL GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY "table", "column", dtype ORDER BY value_num ASC NULLS LAST, value_str) AS rk FROM dv),
ex AS (SELECT "table", "column", dtype, string_agg(value_show, ' | ' ORDER BY rk) AS example_values FROM rk WHERE rk <= 3 GROUP BY ALL)
SELECT stats.*, coalesce(ex.example_values, '') AS example_values FROM stats LEFT JOIN ex USING ("table", "column", dtype)
"""


def column_profile_oracle() -> str:
    return duck_round(_profile_sql(), ["missing_pct"])


def dictionary_oracle() -> str:
    sw = lambda *ps: " OR ".join(f"starts_with(\"column\", '{p}')" for p in ps)
    sql = f"""
SELECT "table", "column",
  CASE WHEN starts_with("table", 'application') THEN 'current_application'
       WHEN starts_with("table", 'bureau') THEN 'external_credit_history'
       WHEN "table" = 'previous_application' THEN 'internal_previous_application'
       WHEN "table" = 'installments_payments' THEN 'internal_repayment_history'
       WHEN "table" = 'credit_card_balance' THEN 'internal_credit_card_history'
       WHEN "table" = 'POS_CASH_balance' THEN 'internal_pos_cash_history' ELSE 'unknown' END AS data_domain,
  CASE WHEN "column" = 'TARGET' THEN 'label' WHEN {sw('SK_ID')} THEN 'join_key' WHEN {sw('EXT_SOURCE')} THEN 'external_score'
       WHEN {sw('AMT')} THEN 'amount_debt_income' WHEN {sw('DAYS')} THEN 'timing_recency'
       WHEN {sw('CNT')} THEN 'count_family_or_terms' WHEN {sw('FLAG')} THEN 'binary_flag'
       WHEN contains("column", 'STATUS') THEN 'status_outcome'
       WHEN {sw('NAME', 'CODE', 'OCCUPATION', 'ORGANIZATION', 'WALLSMATERIAL', 'FONDKAPREMONT', 'HOUSETYPE')} THEN 'categorical_profile'
       WHEN {sw('NUM', 'OBS', 'DEF')} THEN 'count_or_credit_bureau_summary'
       WHEN {sw('RATE', 'REGION')} THEN 'rate_region_context' ELSE 'other' END AS business_category,
  CASE WHEN "column" = 'TARGET' THEN 'label_only_not_feature' WHEN {sw('SK_ID')} THEN 'join_key_not_model_feature'
       WHEN starts_with("table", 'application') THEN 'available_at_application'
       ELSE 'historical_before_current_application_assumed' END AS application_time_availability,
  CASE WHEN "column" = 'TARGET' THEN 'high' WHEN {sw('SK_ID')} THEN 'low'
       WHEN starts_with("table", 'application') THEN 'low' ELSE 'medium' END AS leakage_risk_initial,
  CASE WHEN "column" = 'TARGET' OR {sw('SK_ID')} THEN 'no' ELSE 'candidate' END AS use_in_model_initial,
  CASE WHEN starts_with("table", 'application') THEN 'no' ELSE 'yes_to_SK_ID_CURR' END AS aggregation_needed,
  missing_pct, nunique, '' AS description, '' AS special
FROM ({_profile_sql()}) _p
"""
    return duck_round(sql, ["missing_pct"])


@register("raw_file_sizes")
def q_raw_file_sizes(spark, sf_dir):
    """A1 + S12 over the driver's own files: rows / columns / file size per table."""
    from riskfold.sources.tables import TABLES, file_sizes, read_table, table_path

    tables = {t: read_table(spark, sf_dir, t) for t in TABLES}
    # a table is one file or a folder of part files
    sizes = (
        file_sizes(spark, [table_path(sf_dir, t) for t in TABLES])
        .withColumn("table", F.regexp_extract(F.col("path"), r"([^/]+)\.parquet(?:/|$)", 1))
        .groupBy("table")
        .agg(F.sum("file_mb").alias("file_mb"))
    )
    prof = PR.table_profile(tables).drop("file_mb")
    return prof.join(sizes.select("table", "file_mb"), "table", "left")


@register("leakage_risk_summary", lambda: leakage_oracle())
def q_leakage_summary(spark, sf_dir):
    """A3: columns per (data domain, initial leakage risk) over the observed dictionary."""
    return PR.leakage_summary(PR.column_dictionary(PR.schema_rows(role_tables(spark, sf_dir))))


def leakage_oracle() -> str:
    inner = dictionary_oracle()
    return f"SELECT data_domain, leakage_risk_initial, count(*) AS columns FROM ({inner}) d GROUP BY ALL"
