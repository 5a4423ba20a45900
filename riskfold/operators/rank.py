"""Distributed ranks, prefix sums and exact quantiles.

Rank metrics (AUC, KS, lift bands, top-k, average precision, stratified
splits, interpolated quantiles) all need a position in a global order.  A
``Window`` partitioned only by a split or class label would put a third of
the data (or all of it) into one task, so every ordered operation here uses
the same three-step plan instead:

1. ``repartitionByRange`` on (group, order...) — the range partitioner
   samples the keys, so a hot group or a hot value is spread over many
   partitions (the order always ends with a unique key);
2. inside each partition, rows are sorted and numbered; the tagged rows are
   materialised once with a reliable ``checkpoint`` (lineage cut, executor
   loss safe, and both uses below read the same partitioning);
3. per (partition, group) totals — at most ``P + groups`` rows, a proven
   bound — give exclusive offsets, broadcast back to the rows.

Where an error in rank will do, :func:`sketch_quantiles` needs no order at all:
tasks keep mergeable sketches of fixed size.

No operator here collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfold.session import ensure_checkpoint_dir

PID, POS = "_rk_pid", "_rk_pos"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ordered(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], num_partitions: int | None) -> DataFrame:
    p = _num_partitions(df, num_partitions)
    keys = [F.col(g) for g in group_cols] + list(order)
    tagged = (
        df.repartitionByRange(p, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(PID, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id())
    )
    ensure_checkpoint_dir(df.sparkSession)
    return tagged.checkpoint(eager=True)


#: Rows of a per-(partition, group) or quantile-position table up to which it is broadcast.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows (counted, not estimated)."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which NULL keys meet; the left side's key columns stay."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & F.col(f"`{c}`").eqNullSafe(F.col(f"`_right_{c}`"))
    return left.join(renamed, match, how).drop(*[f"_right_{c}" for c in on])


def _with_stats(rows: DataFrame, stats: DataFrame, g: Sequence[str]) -> DataFrame:
    return null_safe_join(rows, small(stats) if g else F.broadcast(stats), [PID, *g])


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    group_cols: Sequence[str] = (),
    rank_col: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 1-based ``rank_col``: the row number within ``group_cols`` in ``order``.

    ``order`` must be a total order (end it with a unique key) for the result
    to be deterministic.
    """
    tagged = _ordered(df, group_cols, order, num_partitions)
    g = list(group_cols)
    stats = tagged.groupBy(PID, *g).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
    w = Window.partitionBy(*g).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = _with_stats(tagged, stats.select(PID, *g, "_off", "_first"), g)
    return out.withColumn(rank_col, F.col("_off") + F.col(POS) - F.col("_first") + 1).drop(PID, POS, "_off", "_first")


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    values: dict[str, Column],
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums ``{name: sum(value) over rows <= this row}`` within groups."""
    base = df.withColumns({f"_v_{k}": v for k, v in values.items()})
    tagged = _ordered(base, group_cols, order, num_partitions)
    g = list(group_cols)
    local_w = Window.partitionBy(PID, *g).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumns({k: F.sum(f"_v_{k}").over(local_w) for k in values})
    stats = tagged.groupBy(PID, *g).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values])
    w = Window.partitionBy(*g).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(PID, *g, *[F.coalesce(F.sum(f"_t_{k}").over(w), F.lit(0)).alias(f"_o_{k}") for k in values])
    out = _with_stats(local, stats, g)
    out = out.withColumns({k: F.col(k) + F.col(f"_o_{k}") for k in values})
    return out.drop(PID, POS, *[f"_v_{k}" for k in values], *[f"_o_{k}" for k in values])


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    key_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles (numpy default) per group: (groups, prob_idx, prob, value).

    NULL values are ignored.  The rows at the two bracketing positions are
    found with an equi-join on the global rank — no group is collected.
    """
    g = list(group_cols)
    extra = [F.col(key_col).alias("_k")] if key_col else [F.xxhash64(*[F.col(c) for c in df.columns]).alias("_tie")]
    vals = df.select(*g, F.col(value_col).alias("_x"), *extra).filter(F.col("_x").isNotNull())
    # Ties only need spreading, not ordering: a row hash splits a hot value.
    order = [F.col("_x"), F.col("_k") if key_col else F.col("_tie")]
    ranked = global_rank(vals, order, g, "_r", num_partitions)
    counts = ranked.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    pos = counts.select(*g, "_n", F.posexplode(prob_arr).alias("prob_idx", "prob"))
    pos = pos.withColumn("_h", (F.col("_n") - 1) * F.col("prob"))
    pos = pos.withColumn("_lo", F.floor("_h") + 1).withColumn("_hi", F.ceil("_h") + 1)
    # both neighbours of every position in one pass over the ranked rows
    wanted = small(pos.select(*g, "prob_idx", "prob", "_h", "_lo", "_hi", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_r")))
    met = null_safe_join(ranked.select(*g, "_r", "_x"), wanted, [*g, "_r"])
    both = met.groupBy(*g, "prob_idx", "prob", "_h", "_lo", "_hi").agg(
        F.max(F.when(F.col("_r") == F.col("_lo"), F.col("_x"))).alias("_xlo"),
        F.max(F.when(F.col("_r") == F.col("_hi"), F.col("_x"))).alias("_xhi"),
    )
    t = F.col("_h") - (F.col("_lo") - 1)
    a, b = F.col("_xlo"), F.col("_xhi")
    # numpy's linear interpolation: a + (b-a)t below t=0.5, b - (b-a)(1-t) above.
    lerp = F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (F.lit(1.0) - t))
    return both.select(*g, F.col("prob_idx").cast("int").alias("prob_idx"), "prob", lerp.alias("value"))


#: Rank error of a KLL sketch with parameter k, at 99 % confidence, as a share of the rows (1.65 % at k = 200).
SKETCH_ERROR = {100: 0.0311, 200: 0.0165, 400: 0.0087, 800: 0.0046, 1600: 0.0024, 3200: 0.0013}


def sketch_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = (), k: int = 800) -> DataFrame:
    """Opt-in approximate quantiles per group: (groups, prob_idx, prob, value).

    One KLL sketch a group and task, merged in the aggregation: a hot group or value costs no more than any other,
    and no row is sorted or shuffled.  ``value`` is a value of the group whose rank is within ``SKETCH_ERROR[k]`` of
    ``prob``; 0 and 1 give the exact ends.  NULL and NaN are ignored; a group without values gives no rows.
    """
    if k not in SKETCH_ERROR:
        raise ValueError(f"k must be one of {sorted(SKETCH_ERROR)}")
    g = list(group_cols)
    vals = df.select(*g, F.col(value_col).cast("double").alias("_x")).filter("_x IS NOT NULL AND NOT isnan(_x)")
    sketches = vals.groupBy(*g).agg(F.kll_sketch_agg_double("_x", k).alias("_s"), F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    return sketches.select(*g, wanted.alias("_p"), F.kll_sketch_get_quantile_double("_s", wanted).alias("_q")).select(
        *g, F.posexplode(F.arrays_zip("_p", "_q")).alias("prob_idx", "_e")
    ).select(*g, "prob_idx", F.col("_e._p").alias("prob"), F.col("_e._q").alias("value"))
