"""Univariate feature screening from one count structure.

The wide candidate matrix is counted once (``counts.column_counts``): each value of each feature with the development
rows, labelled rows and bads and the validation rows that have it, packed in ranges of values.  Everything else is read
off those ranges:

* missing rates and distinct counts are their sums;
* running sums within a range and the ranges' offsets give AUC (tie-averaged Mann-Whitney), KS (tie-grouped) and exact
  quantiles;
* bins are the distinct development deciles (exact, interpolated) with the
  outer edges opened to +-inf; a binary or constant column collapses to one
  bin.  Buckets are right-closed, NULL is its own "missing" bucket.  A value's
  counts go to its bucket, from which IV and PSI come.

Tables with a row (or eleven) a feature are bounded by the number of columns
and broadcast; no feature or value is collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.functions.core import round_significant
from riskfold.operators.counts import COUNTED, DEV, VAL, ColumnCounts, _rows, column_counts  # noqa: F401
from riskfold.operators.rank import sketch_quantiles
from riskfold.session import materialise

# Fixed screening thresholds.
MISSING_MAX = 0.95
PSI_MAX = 0.35
AUC_POWER_THRESHOLD = 0.515
KS_THRESHOLD = 0.020
IV_THRESHOLD = 0.005
BINS = 10
EPS = 1e-6


def to_long(df: DataFrame, features: Sequence[str], keys: Sequence[str], digits: int | None = None) -> DataFrame:
    """Wide candidate matrix -> (keys..., feature, value double); +-inf/NaN -> NULL.

    Values stay exact unless ``digits`` asks for that many significant ones:
    rank statistics depend on exact ties, so values whose last bits are noise
    (0.6 and 0.6000000000000001 from two summation orders) can be merged.
    """
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value")) for f in features]
    long = df.select(*keys, F.explode(F.array(*entries)).alias("_e")).select(*keys, "_e.feature", "_e.value")
    v = F.col("value")
    return long.withColumn("value", F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v if digits is None else round_significant(v, digits)))


def _auc_ks(counts: ColumnCounts, totals: DataFrame) -> DataFrame:
    """f, auc, ks from the values' ranks within their range and the ranges' offsets."""

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, _, _, (_, rows, bad, _), (before, bad_before, labelled, bads) in _rows(batches, 4):
            rows, bad = rows[rows > 0], bad[rows > 0]
            upto, bad_upto = before + np.cumsum(rows), bad_before + np.cumsum(bad)
            sums = float((bad * (upto - rows + (rows + 1.0) / 2.0)).sum())
            both = bads > 0 and labelled > bads and len(rows)
            ks = float(np.abs(bad_upto / bads - (upto - bad_upto) / (labelled - bads)).max()) if both else None
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([sums]), pa.array([ks], pa.float64())], names=["f", "ranks", "ks"])

    rows = counts.with_offsets(["dev_labelled", "dev_bad"]).join(F.broadcast(totals.select("f", F.col("labelled").cast("double").alias("_l"), F.col("bads").alias("_b"))), "f")
    rows = rows.select("f", "r", "value", "counts", "o_dev_labelled", "o_dev_bad", "_l", "_b")
    per = rows.mapInArrow(ranks, "f int, ranks double, ks double").groupBy("f").agg(F.sum("ranks").alias("_ranks"), F.max("ks").alias("_ks"))
    bads, goods = F.col("bads"), F.col("labelled") - F.col("bads")
    valid = (bads > 0) & (goods > 0) & (F.col("labelled_values") >= 2)
    return per.join(F.broadcast(totals), "f").select(
        "f",
        F.when(valid, F.try_divide(F.col("_ranks") - bads * (bads + 1) / F.lit(2.0), bads * goods)).alias("auc"),
        F.when(valid, F.col("_ks")).alias("ks"),
    )


def _edges(counts: ColumnCounts, totals: DataFrame, bins: int = BINS) -> DataFrame:
    """f, edges: distinct interpolated development quantiles with the ends opened to +-inf, of features with two values or more."""
    q = counts.quantiles([i / bins for i in range(bins + 1)]).join(F.broadcast(totals.filter("development_nunique >= 2").select("f")), "f")
    cuts = q.groupBy("f").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda s: s["value"])).alias("_q"))
    inner = F.slice(F.col("_q"), 2, F.greatest(F.size("_q") - 2, F.lit(0)))
    edges = F.concat(F.array(F.lit(float("-inf"))), inner, F.array(F.lit(float("inf"))))
    return cuts.filter(F.size("_q") >= 2).select("f", edges.alias("edges"))


def _iv_psi(counts: ColumnCounts, edges: DataFrame) -> DataFrame:
    """f, iv, psi_development_validation from the counts of each bucket (at most bins + 1 rows a feature)."""

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, r, value, n, (inner,) in _rows(batches, 1):
            # right-closed bins: the number of edges below the value; 0 is the bucket of the missing ones
            at = np.zeros(len(value), np.int64) if r < 0 else np.searchsorted(np.asarray(inner, float), value, side="left")
            for k in np.unique(at):
                sums = n[:, at == k].sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([int(k)], pa.int32()), *[pa.array([float(x)]) for x in sums]], names=["f", "bucket", *COUNTED])

    rows = counts.ranges.join(F.broadcast(edges), "f").select("f", "r", "value", "counts", "edges")
    cells = rows.mapInArrow(bucketed, "f int, bucket int" + "".join(f", {c} double" for c in COUNTED)).groupBy("f", "bucket").agg(*[F.sum(c).alias(c) for c in COUNTED])
    good = F.col("dev_rows") - F.col("dev_bad")
    tot = cells.groupBy("f").agg(F.sum("dev_bad").alias("TB"), F.sum(good).alias("TG"), F.sum("dev_rows").alias("TA"), F.sum("val_rows").alias("TV"))
    j = cells.join(F.broadcast(tot), "f")
    change = lambda x, y: (x - y) * F.log((x + F.lit(EPS)) / (y + F.lit(EPS)))
    iv = change(F.try_divide("dev_bad", "TB"), F.try_divide(good, F.col("TG")))
    psi = change(F.try_divide("val_rows", "TV"), F.try_divide("dev_rows", "TA"))
    in_dev, in_either = F.col("dev_rows") > 0, (F.col("dev_rows") > 0) | (F.col("val_rows") > 0)
    return j.groupBy("f", "TB", "TG").agg(F.sum(F.when(in_dev, iv)).alias("_iv"), F.sum(F.when(in_either, psi)).alias("psi_development_validation")).select(
        "f", F.when((F.col("TB") > 0) & (F.col("TG") > 0), F.col("_iv")).alias("iv"), "psi_development_validation"
    )


def sketched_edges(wide: DataFrame, features: Sequence[str], k: int = 800, bins: int = BINS) -> DataFrame:
    """f, edges: like the exact ones, from a sketch of each feature's development values (see ``sketch_quantiles``).

    A cut point is a value whose rank is within the sketch's error of its decile; cached by the caller, the edges
    serve every later count.
    """
    cells = wide.filter(F.col("screening_split") == DEV).select(F.posexplode(F.array(*[F.col(f"`{f}`").cast("double") for f in features])).alias("f", "value"))
    finite = cells.filter(F.abs("value") != F.lit(float("inf")))
    q = sketch_quantiles(finite, "value", [i / bins for i in range(bins + 1)], ["f"], k)
    cuts = q.groupBy("f").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("prob_idx", "value"))), lambda s: s["value"])).alias("_q"))
    inner = F.slice(F.col("_q"), 2, F.greatest(F.size("_q") - 2, F.lit(0)))
    return cuts.filter(F.size("_q") >= 2).select("f", F.concat(F.array(F.lit(float("-inf"))), inner, F.array(F.lit(float("inf")))).alias("edges"))


def statistics(wide: DataFrame, features: Sequence[str], digits: int | None = None) -> DataFrame:
    """(feature, missing rates, distinct counts, psi, auc, ks, iv, edges), a row a feature."""
    return statistics_of(column_counts(wide, features, digits))


def statistics_of(counts: ColumnCounts) -> DataFrame:
    """:func:`statistics` from counts that are there already."""
    totals = materialise(counts.totals(), "value-totals")
    edges = materialise(_edges(counts, totals), "value-edges")
    out = counts.names().join(totals, "f", "left").join(_auc_ks(counts, totals), "f", "left").join(_iv_psi(counts, edges), "f", "left").join(edges, "f", "left")
    return out.select(
        "feature", "development_missing_rate", "validation_missing_rate", "development_nunique", "validation_nunique",
        "psi_development_validation", "auc", "ks", "iv", "edges",
    )


def screen(counts: ColumnCounts, manifest: DataFrame) -> DataFrame:
    """Full screening report per candidate feature (M7)."""
    named = statistics_of(counts).drop("edges").withColumnRenamed("feature", "candidate_feature")
    return add_flags(named.join(manifest, "candidate_feature", "left"))


def _c(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def add_flags(rep: DataFrame) -> DataFrame:
    auc_power = F.greatest(F.col("auc"), F.lit(1.0) - F.col("auc"))
    rep = rep.withColumn("auc_power", auc_power)
    quality = (
        _c(F.col("development_missing_rate") <= MISSING_MAX)
        & _c(F.col("development_nunique") > 1)
        & (F.col("psi_development_validation").isNull() | _c(F.col("psi_development_validation") <= PSI_MAX))
    )
    uni = quality & (
        _c(F.col("auc_power") >= AUC_POWER_THRESHOLD) | _c(F.col("ks") >= KS_THRESHOLD) | _c(F.col("iv") >= IV_THRESHOLD)
    )
    score = (
        F.coalesce(F.col("auc_power"), F.lit(0.5))
        - F.lit(0.5)
        + F.coalesce(F.col("ks"), F.lit(0.0)) * F.lit(0.5)
        + F.least(F.coalesce(F.col("iv"), F.lit(0.0)), F.lit(1.0)) * F.lit(0.1)
        - F.coalesce(F.col("development_missing_rate"), F.lit(1.0)) * F.lit(0.02)
        - F.least(F.greatest(F.coalesce(F.col("psi_development_validation"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * F.lit(0.02)
    )
    return rep.withColumn("quality_pass", quality).withColumn("univariate_pass", uni).withColumn("screening_score", score)


def selection_stage(rep: DataFrame) -> DataFrame:
    """final_shortlist / correlation_dropped / failed_univariate / failed_quality."""
    return rep.withColumn(
        "selection_stage",
        F.when(F.col("final_stat_shortlist"), "final_shortlist")
        .when(F.col("univariate_pass") & ~F.col("corr_keep"), "correlation_dropped")
        .when(F.col("quality_pass") & ~F.col("univariate_pass"), "failed_univariate_screen")
        .when(~F.col("quality_pass"), "failed_quality_screen")
        .otherwise("not_reviewed"),
    )


def group_summary(rep: DataFrame) -> DataFrame:
    """Per feature group counts and medians (the report has one row per feature)."""
    agg = [
        F.count("candidate_feature").alias("candidate_count"),
        F.sum(F.col("quality_pass").cast("bigint")).alias("quality_pass_count"),
        F.sum(F.col("univariate_pass").cast("bigint")).alias("univariate_pass_count"),
    ]
    if "final_stat_shortlist" in rep.columns:
        agg.append(F.sum(F.col("final_stat_shortlist").cast("bigint")).alias("final_shortlist_count"))
    agg += [
        F.median("auc_power").alias("median_auc_power"),
        F.median("iv").alias("median_iv"),
        F.median("psi_development_validation").alias("median_psi_dev_val"),
    ]
    return rep.groupBy("feature_group").agg(*agg)
