"""Score-drift monitoring over a Structured Stream.

The reference monitors drift in batch: PSI of a split's score histogram
against the development histogram (left-closed bins on development deciles).
Here the same statistic is computed per micro-batch of a score stream:

* the reference histogram (edges + shares) is computed once in batch with
  :func:`reference_histogram` — at most 11 numbers;
* each micro-batch is bucketed with the same edges, counted per bucket (one
  partial aggregate) and compared with the reference in ``foreachBatch``;
* one row per batch ``(batch_id, rows, psi)`` is appended to a parquet sink,
  so the monitor restarts from its checkpoint after a failure.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskfold.functions.core import bucket_left
from riskfold.operators.rank import exact_quantiles

EPS = 1e-6


def reference_histogram(reference: DataFrame, score: str, key: str, bins: int = 10) -> tuple[list[float], list[float]]:
    """Edges (open ends) and bin shares of the reference scores; bounded driver values."""
    q = exact_quantiles(reference, score, [i / bins for i in range(bins + 1)], key_col=key).collect()
    uniq = sorted({r["value"] for r in q})
    if len(uniq) < 3:
        raise ValueError("Not enough distinct reference quantiles for a histogram.")
    edges = [-math.inf] + uniq[1:-1] + [math.inf]
    counts = (
        reference.select(bucket_left(F.col(score), F.array(*[F.lit(e) for e in edges])).alias("b"))
        .groupBy("b").count().collect()
    )
    total = sum(r["count"] for r in counts if r["b"] is not None)
    shares = [0.0] * (len(edges) - 1)
    for r in counts:
        if r["b"] is not None:
            shares[r["b"] - 1] = r["count"] / max(total, 1)
    return edges, shares


def batch_psi(batch: DataFrame, score: str, edges: Sequence[float], ref_shares: Sequence[float]) -> DataFrame:
    """One row (rows, psi) for a batch of scores against the reference shares."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    counts = batch.select(bucket_left(F.col(score), arr).alias("b")).filter(F.col("b").isNotNull()).groupBy("b").count()
    ref = batch.sparkSession.createDataFrame([(i + 1, float(s)) for i, s in enumerate(ref_shares)], "b int, r double")
    j = F.broadcast(ref).join(counts, "b", "left").fillna(0, subset=["count"])
    total = j.agg(F.sum("count")).first()[0] or 0  # one scalar per batch
    t = j.withColumn("t", F.col("count") / F.lit(float(max(total, 1))))
    return t.agg(
        F.sum("count").alias("rows"),
        F.sum((F.col("t") - F.col("r")) * F.log((F.col("t") + F.lit(EPS)) / (F.col("r") + F.lit(EPS)))).alias("psi"),
    )


def start_psi_monitor(
    stream: DataFrame,
    score: str,
    edges: Sequence[float],
    ref_shares: Sequence[float],
    sink_path: str,
    checkpoint_path: str,
    trigger_once: bool = False,
) -> StreamingQuery:
    """Start the monitor; one PSI row per micro-batch appended to ``sink_path``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = batch_psi(batch, score, edges, ref_shares).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        out.write.mode("append").parquet(sink_path)

    w = stream.select(score).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()


def read_score_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A file stream of scored rows (parquet)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
