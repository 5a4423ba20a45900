"""Catalogue: split, encodings and univariate screening."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.operators import counts as CC
from riskfold.operators import encode as E
from riskfold.operators import screen as SC
from riskfold.operators import store as S
from riskfold.plans import q_store as QS
from riskfold.plans.registry import register
from riskfold.plans.sqlkit import duck_round, npq, npq_list, sig_round_sql
from riskfold.session import materialise

KEYS = ["SK_ID_CURR", "screening_split", "TARGET"]

#: The catalogue compares two engines that sum in different orders: values that differ past the twelfth digit are one.
VALUE_DIGITS = 12


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def split_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature store with ``screening_split`` (split computed on the narrow key table)."""
    fs = QS.feature_store(spark, sf_dir)
    split = E.assign_split(fs.select("SK_ID_CURR", "dataset", "TARGET"))
    return fs.join(split.select("SK_ID_CURR", "screening_split"), "SK_ID_CURR")


_MEMO: dict = {}


def memo(name: str, spark: SparkSession, sf_dir: str, build):
    """Per-session cache of materialised intermediates; :func:`release` empties it."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def release() -> None:
    """Forget all cached intermediates (after the files under a path changed, or between timed runs)."""
    _MEMO.clear()


def candidate_wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], DataFrame]:
    """Encoded wide candidate matrix (checkpointed), candidate names and manifest."""

    def build():
        cm = split_frame(spark, sf_dir)
        cats = E.categorical_columns(cm)
        nums = E.numeric_columns(cm)
        enc, rows = E.encode_categoricals(cm, cats)
        store_groups = {r["feature"]: r["feature_group"] for r in S.manifest(spark, QS.app_base_columns(), QS.BLOCK_ORDER).collect()}
        man = [(f, f, "numeric_original", store_groups.get(f, "unknown")) for f in nums]
        man += [(n, o, enc_name, store_groups.get(o, "current_application")) for n, o, enc_name in rows]
        manifest = spark.createDataFrame(man, "candidate_feature string, original_feature string, encoding string, feature_group string")
        names = [m[0] for m in man]
        wide = materialise(enc.select(*KEYS, *[F.col(f"`{n}`") for n in names]), "q_screen")
        return wide, names, manifest

    return memo("candidate_wide", spark, sf_dir, build)


def candidate_counts(spark: SparkSession, sf_dir: str) -> CC.ColumnCounts:
    """How often each value stands in each column of the candidate matrix (counted once)."""
    return memo("candidate_counts", spark, sf_dir, lambda: CC.column_counts(*candidate_wide(spark, sf_dir)[:2], VALUE_DIGITS))


def encoded_long(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """The encodings of that prefix in long form; only keys and categorical columns are read from the feature store."""
    cm = split_frame(spark, sf_dir)
    cats = E.categorical_columns(cm)
    enc, rows = E.encode_categoricals(cm.select(*KEYS, *cats), cats)
    return SC.to_long(enc, [n for n, _, _ in rows if n.startswith(prefix)], KEYS, digits=VALUE_DIGITS).select("SK_ID_CURR", "feature", "value")


@register("split_assignment", lambda: split_oracle())
def q_split_assignment(spark, sf_dir):
    fs = QS.feature_store(spark, sf_dir)
    return E.assign_split(fs.select("SK_ID_CURR", "dataset", "TARGET"))


@register("split_summary", lambda: split_summary_oracle())
def q_split_summary(spark, sf_dir):
    fs = QS.feature_store(spark, sf_dir)
    return E.split_summary(E.assign_split(fs.select("SK_ID_CURR", "dataset", "TARGET")))


@register("freq_encoding", lambda: freq_oracle())
def q_freq_encoding(spark, sf_dir):
    return encoded_long(spark, sf_dir, "catfreq__")


@register("one_hot_levels", lambda: one_hot_oracle())
def q_one_hot_levels(spark, sf_dir):
    return encoded_long(spark, sf_dir, "catoh__")


def _one(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return screening_report(spark, sf_dir).select("candidate_feature", column)


@register("feature_auc", lambda: stat_oracle(["auc"]))
def q_feature_auc(spark, sf_dir):
    return _one(spark, sf_dir, "auc")


@register("feature_ks", lambda: stat_oracle(["ks"]))
def q_feature_ks(spark, sf_dir):
    return _one(spark, sf_dir, "ks")


@register("feature_iv", lambda: stat_oracle(["iv"]))
def q_feature_iv(spark, sf_dir):
    return _one(spark, sf_dir, "iv")


@register("feature_psi", lambda: stat_oracle(["psi_development_validation"]))
def q_feature_psi(spark, sf_dir):
    return _one(spark, sf_dir, "psi_development_validation")


REPORT_COLS = [
    "candidate_feature", "original_feature", "encoding", "feature_group", "development_missing_rate",
    "validation_missing_rate", "development_nunique", "validation_nunique", "psi_development_validation", "auc",
    "auc_power", "ks", "iv", "quality_pass", "univariate_pass", "screening_score",
]


def screening_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        _, _, manifest = candidate_wide(spark, sf_dir)
        return materialise(SC.screen(candidate_counts(spark, sf_dir), manifest).select(*REPORT_COLS), "q_screen")

    return memo("screening_report", spark, sf_dir, build)


@register("screening_report", lambda: stat_oracle(REPORT_COLS[1:]))
def q_screening_report(spark, sf_dir):
    return screening_report(spark, sf_dir)


@register("screening_group_summary", lambda: group_summary_oracle())
def q_screening_group_summary(spark, sf_dir):
    return SC.group_summary(screening_report(spark, sf_dir))


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

CATS = ["NAME_CONTRACT_TYPE", "OCCUPATION_TYPE"]


def _split_sql() -> str:
    fs, _, _ = QS._feature_store_sql()  # unrounded, like the Spark intermediates
    return f"""
fs AS ({fs}),
sp AS (SELECT SK_ID_CURR, dataset, TARGET,
  row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '{E.RANDOM_SEED}'), SK_ID_CURR) AS rk,
  count(*) OVER (PARTITION BY TARGET) AS n FROM fs WHERE dataset = 'train'),
split AS (
  SELECT SK_ID_CURR, dataset, TARGET,
    CASE WHEN rk <= round_even(n * 0.2, 0) THEN 'final_holdout'
         WHEN rk <= round_even(n * 0.2, 0) + round_even(n * 0.2, 0) THEN 'validation'
         ELSE 'development' END AS screening_split FROM sp
  UNION ALL
  SELECT SK_ID_CURR, dataset, TARGET, 'external_unlabeled' FROM fs WHERE dataset IS DISTINCT FROM 'train')"""


def split_oracle() -> str:
    return f"WITH {_split_sql()}\nSELECT * FROM split"


def split_summary_oracle() -> str:
    sql = (
        f"WITH {_split_sql()}\nSELECT dataset, screening_split, count(SK_ID_CURR) AS rows, avg(TARGET) AS bad_rate "
        "FROM split GROUP BY dataset, screening_split"
    )
    return duck_round(sql, ["bad_rate"])


@lru_cache(maxsize=None)
def _numeric_features() -> list[str]:
    _, cols, _ = QS._feature_store_sql()
    return [c for c in cols if c not in S.ID_COLUMNS and c not in CATS]


def _sanitize(expr: str) -> str:
    t = f"left(trim(regexp_replace({expr}, '[^0-9A-Za-z]+', '_', 'g'), '_'), 48)"
    return f"CASE WHEN {t} = '' THEN 'blank' ELSE {t} END"


@lru_cache(maxsize=None)
def _long_sql() -> str:
    nums = _numeric_features()
    casted = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in nums)
    lv = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS col, coalesce({c}, '{E.MISSING_LABEL}') AS level, SK_ID_CURR, screening_split, TARGET FROM cm"
        for c in CATS
    )
    return f"""WITH {_split_sql()},
cm AS (SELECT fs.*, split.screening_split FROM fs JOIN split USING (SK_ID_CURR)),
cmx AS (SELECT SK_ID_CURR, screening_split, TARGET, {casted} FROM cm),
num_long AS (SELECT SK_ID_CURR, screening_split, TARGET, feature, value
  FROM cmx UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(nums)}))),
lv AS ({lv}),
rates AS (SELECT col, level, count(*) AS cnt, count(*) / sum(count(*)) OVER (PARTITION BY col) AS rate
  FROM lv WHERE screening_split = 'development' GROUP BY col, level),
freq_long AS (SELECT lv.SK_ID_CURR, lv.screening_split, lv.TARGET, 'catfreq__' || lv.col AS feature,
  coalesce(rates.rate, 0.0) AS value FROM lv LEFT JOIN rates ON lv.col = rates.col AND lv.level = rates.level),
top AS (SELECT col, level, row_number() OVER (PARTITION BY col ORDER BY cnt DESC, level) AS idx
  FROM rates WHERE rate >= {E.MIN_CATEGORY_RATE} QUALIFY idx <= {E.MAX_ONE_HOT_LEVELS}),
oh_long AS (SELECT lv.SK_ID_CURR, lv.screening_split, lv.TARGET,
  'catoh__' || top.col || '__' || lpad(CAST(top.idx AS VARCHAR), 2, '0') || '_' || {_sanitize('top.level')} AS feature,
  CAST(CAST(lv.level = top.level AS INTEGER) AS DOUBLE) AS value FROM lv JOIN top ON lv.col = top.col),
long0 AS (SELECT SK_ID_CURR, screening_split, TARGET, feature, value FROM num_long
  UNION ALL SELECT * FROM freq_long UNION ALL SELECT * FROM oh_long),
long AS (SELECT SK_ID_CURR, screening_split, TARGET, feature,
  CASE WHEN isnan(value) OR isinf(value) THEN NULL ELSE {sig_round_sql('value', VALUE_DIGITS)} END AS value FROM long0)"""


def freq_oracle() -> str:
    return duck_round(_long_sql() + "\nSELECT SK_ID_CURR, feature, value FROM long WHERE starts_with(feature, 'catfreq__')", ["value"])


def one_hot_oracle() -> str:
    return duck_round(_long_sql() + "\nSELECT SK_ID_CURR, feature, value FROM long WHERE starts_with(feature, 'catoh__')", ["value"])


def _groups_values() -> str:
    groups = {}
    for c in QS.app_base_columns():
        if c not in S.ID_COLUMNS:
            groups.setdefault(c, "current_application")
    for spec in QS.BLOCK_ORDER:
        for f in spec.feature_names():
            groups.setdefault(f, spec.feature_group)
    for c in S.HISTORY_COUNT_COLUMNS:
        groups.setdefault(S.history_flag_name(c), "history_coverage")
    groups.setdefault("feature_store_missing_field_count", "feature_store_quality")
    groups.setdefault("feature_store_missing_field_ratio", "feature_store_quality")
    return ", ".join(f"('{f}', '{g}')" for f, g in groups.items())


@lru_cache(maxsize=None)
def _report_sql() -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    return (
        _long_sql()
        + f""",
bv AS (SELECT * FROM long WHERE screening_split IN ('development', 'validation')),
dev AS (SELECT * FROM long WHERE screening_split = 'development'),
basic AS (SELECT feature,
  avg(CASE WHEN screening_split = 'development' THEN CAST(value IS NULL AS DOUBLE) END) AS development_missing_rate,
  avg(CASE WHEN screening_split = 'validation' THEN CAST(value IS NULL AS DOUBLE) END) AS validation_missing_rate,
  count(DISTINCT CASE WHEN screening_split = 'development' THEN value END) AS development_nunique,
  count(DISTINCT CASE WHEN screening_split = 'validation' THEN value END) AS validation_nunique
  FROM bv GROUP BY feature),
ranked AS (SELECT feature, TARGET,
  (rank() OVER (PARTITION BY feature ORDER BY value) + rank() OVER (PARTITION BY feature ORDER BY value)
   + count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS avg_rank
  FROM dev WHERE value IS NOT NULL AND TARGET IS NOT NULL),
auc AS (SELECT feature, sum(TARGET) AS pos_n, count(*) - sum(TARGET) AS neg_n,
  sum(CASE WHEN TARGET = 1 THEN avg_rank ELSE 0 END) AS rank_sum FROM ranked GROUP BY feature),
vt AS (SELECT feature, value, count(*) AS n, sum(TARGET) AS bad FROM dev
  WHERE value IS NOT NULL AND TARGET IS NOT NULL GROUP BY feature, value),
vt2 AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY value) AS cn,
  sum(bad) OVER (PARTITION BY feature ORDER BY value) AS cb,
  sum(n) OVER (PARTITION BY feature) AS NN, sum(bad) OVER (PARTITION BY feature) AS BB,
  count(*) OVER (PARTITION BY feature) AS nvals FROM vt),
ks AS (SELECT feature, max(abs(cb / BB - (cn - cb) / (NN - BB))) AS ks_raw, any_value(nvals) AS nvals,
  any_value(NN) AS NN, any_value(BB) AS BB FROM vt2 GROUP BY feature),
ak AS (SELECT ks.feature,
  CASE WHEN BB > 0 AND NN - BB > 0 AND nvals >= 2 THEN (rank_sum - pos_n * (pos_n + 1) / 2.0) / (pos_n * neg_n) END AS auc,
  CASE WHEN BB > 0 AND NN - BB > 0 AND nvals >= 2 THEN ks_raw END AS ks
  FROM ks JOIN auc USING (feature)),
qs AS (SELECT dev.feature, {npq_list('value', [i / 10 for i in range(11)])} AS q FROM dev JOIN basic USING (feature)
  WHERE value IS NOT NULL AND development_nunique >= 2 GROUP BY dev.feature),
edges AS (SELECT feature, list_concat([CAST('-inf' AS DOUBLE)], list_sort(list_distinct(q))[2:len(list_distinct(q)) - 1],
  [CAST('inf' AS DOUBLE)]) AS edges FROM qs),
bk AS (SELECT bv.*, CASE WHEN edges.edges IS NULL THEN NULL WHEN value IS NULL THEN 0
  ELSE len(list_filter(edges.edges, lambda e: e < value)) END AS bucket
  FROM bv LEFT JOIN edges USING (feature)),
ivc AS (SELECT feature, bucket, sum(TARGET) AS bad, count(*) - sum(TARGET) AS good FROM bk
  WHERE screening_split = 'development' AND bucket IS NOT NULL GROUP BY feature, bucket),
ivt AS (SELECT *, sum(bad) OVER (PARTITION BY feature) AS TB, sum(good) OVER (PARTITION BY feature) AS TG FROM ivc),
iv AS (SELECT feature, CASE WHEN any_value(TB) > 0 AND any_value(TG) > 0 THEN
  sum((bad / TB - good / TG) * ln((bad / TB + 1e-6) / (good / TG + 1e-6))) END AS iv FROM ivt GROUP BY feature),
pc AS (SELECT feature, bucket, count(*) FILTER (WHERE screening_split = 'development') AS a,
  count(*) FILTER (WHERE screening_split = 'validation') AS b FROM bk WHERE bucket IS NOT NULL GROUP BY feature, bucket),
pt AS (SELECT *, sum(a) OVER (PARTITION BY feature) AS TA, sum(b) OVER (PARTITION BY feature) AS TB FROM pc),
psi AS (SELECT feature, sum((b / TB - a / TA) * ln((b / TB + 1e-6) / (a / TA + 1e-6))) AS psi_development_validation
  FROM pt GROUP BY feature),
grp(feature, feature_group) AS (VALUES {_groups_values()}),
man AS (
  SELECT feature AS candidate_feature,
    CASE WHEN starts_with(feature, 'catfreq__') THEN substr(feature, 10)
         WHEN starts_with(feature, 'catoh__') THEN split_part(substr(feature, 8), '__', 1) ELSE feature END AS original_feature,
    CASE WHEN starts_with(feature, 'catfreq__') THEN 'category_frequency_train'
         WHEN starts_with(feature, 'catoh__') THEN 'category_one_hot_train_top_level' ELSE 'numeric_original' END AS encoding
  FROM basic),
man2 AS (SELECT man.*, coalesce(grp.feature_group, CASE WHEN encoding = 'numeric_original' THEN 'unknown' ELSE 'current_application' END)
  AS feature_group FROM man LEFT JOIN grp ON man.original_feature = grp.feature),
rep AS (SELECT man2.*, basic.* EXCLUDE (feature), psi.psi_development_validation, ak.auc,
  greatest(ak.auc, 1 - ak.auc) AS auc_power, ak.ks, iv.iv
  FROM basic JOIN man2 ON basic.feature = man2.candidate_feature
  LEFT JOIN psi USING (feature) LEFT JOIN ak USING (feature) LEFT JOIN iv USING (feature)),
flags AS (SELECT *,
  coalesce(development_missing_rate <= {SC.MISSING_MAX}, false) AND coalesce(development_nunique > 1, false)
    AND (psi_development_validation IS NULL OR coalesce(psi_development_validation <= {SC.PSI_MAX}, false)) AS quality_pass
  FROM rep),
report AS (SELECT *, quality_pass AND (coalesce(auc_power >= {SC.AUC_POWER_THRESHOLD}, false)
    OR coalesce(ks >= {SC.KS_THRESHOLD}, false) OR coalesce(iv >= {SC.IV_THRESHOLD}, false)) AS univariate_pass,
  coalesce(auc_power, 0.5) - 0.5 + coalesce(ks, 0.0) * 0.5 + least(coalesce(iv, 0.0), 1.0) * 0.1
    - coalesce(development_missing_rate, 1.0) * 0.02
    - least(greatest(coalesce(psi_development_validation, 0.0), 0.0), 1.0) * 0.02 AS screening_score
  FROM flags)"""
    )


DOUBLE_REPORT = [
    "development_missing_rate", "validation_missing_rate", "psi_development_validation", "auc", "auc_power", "ks", "iv",
    "screening_score",
]


def stat_oracle(cols: list[str]) -> str:
    sql = _report_sql() + f"\nSELECT candidate_feature, {', '.join(cols)} FROM report"
    return duck_round(sql, [c for c in cols if c in DOUBLE_REPORT])


def group_summary_oracle() -> str:
    sql = _report_sql() + """
SELECT feature_group, count(candidate_feature) AS candidate_count,
  CAST(sum(CAST(quality_pass AS INTEGER)) AS BIGINT) AS quality_pass_count,
  CAST(sum(CAST(univariate_pass AS INTEGER)) AS BIGINT) AS univariate_pass_count,
  median(auc_power) AS median_auc_power, median(iv) AS median_iv, median(psi_development_validation) AS median_psi_dev_val
FROM report GROUP BY feature_group"""
    return duck_round(sql, ["median_auc_power", "median_iv", "median_psi_dev_val"])


# ---------------------------------------------------------------------------
# N5 design-matrix fit and N6 class weights
# ---------------------------------------------------------------------------

@register("winsor_impute_standardize", lambda: design_fit_oracle())
def q_design_fit(spark, sf_dir):
    return E.fit_design_counts(candidate_counts(spark, sf_dir))


def design_fit_oracle() -> str:
    sql = _long_sql() + f""",
dv AS (SELECT feature, value FROM long WHERE screening_split = 'development'),
q AS (SELECT feature, {npq('value', 0.01)} AS lower, coalesce({npq('value', 0.5)}, 0.0) AS impute,
  {npq('value', 0.99)} AS upper, avg(CAST(value IS NULL AS DOUBLE)) AS missing_rate FROM dv GROUP BY feature),
m AS (SELECT dv.feature, avg(coalesce(least(greatest(value, lower), upper), impute)) AS mean,
  stddev_pop(coalesce(least(greatest(value, lower), upper), impute)) AS std FROM dv JOIN q USING (feature) GROUP BY dv.feature)
SELECT q.feature, q.missing_rate, q.lower, q.impute, q.upper, m.mean,
  CASE WHEN m.std IS NULL OR m.std < {E.STD_FLOOR} THEN 1.0 ELSE m.std END AS std,
  q.missing_rate >= {E.INDICATOR_MIN_RATE} AS add_indicator, q.missing_rate AS indicator_mean,
  CASE WHEN sqrt(q.missing_rate * (1 - q.missing_rate)) < {E.STD_FLOOR} THEN 1.0 ELSE sqrt(q.missing_rate * (1 - q.missing_rate)) END
    AS indicator_std
FROM q JOIN m USING (feature)"""
    return duck_round(sql, ["missing_rate", "lower", "impute", "upper", "mean", "std", "indicator_mean", "indicator_std"])


@register("screening_top30", lambda: duck_round(
    _report_sql() + "\nSELECT candidate_feature, feature_group, screening_score, auc_power, ks, iv FROM report "
    "ORDER BY univariate_pass DESC, screening_score DESC, candidate_feature LIMIT 30",
    ["screening_score", "auc_power", "ks", "iv"]))
def q_screening_top30(spark, sf_dir):
    """The 30 strongest candidates (a top-k report; ties broken by name)."""
    rep = screening_report(spark, sf_dir)
    return rep.orderBy(F.col("univariate_pass").desc(), F.col("screening_score").desc(), "candidate_feature").limit(30).select(
        "candidate_feature", "feature_group", "screening_score", "auc_power", "ks", "iv"
    )
