"""How often each value stands in each column, as packed value ranges (the ground of M1-M7, M8's medians and N5).

A task sorts the cells of some thousand rows column by column and hands on one row for each column and value range:
its distinct values with their counts, as binary arrays.  The rows of a range meet in one task, which adds them up.
So a cell costs a few bytes in one shuffle and some nanoseconds in numpy, not a row of its own, and a value that most
rows share costs one entry a chunk.

A range holds about ``RANGE_ROWS`` rows: its bounds come from a bounded sample of rows (bounds only; every cell is
counted).  Offsets of the ranges give ranks, from which exact quantiles follow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfold.functions.core import SNAP_DIGITS
from riskfold.operators.rank import small
from riskfold.session import materialise

#: Cells that a task sorts at once, rows of a range, ranges of a column, sampled rows for each range.
CHUNK_CELLS, RANGE_ROWS, MAX_RANGES, SAMPLED = 4 << 20, 500_000, 256, 64
#: Bytes of packed cells that meet in a task.
TASK_BYTES = 64 << 20
DEV, VAL = "development", "validation"
COUNTED = ("dev_rows", "dev_labelled", "dev_bad", "val_rows")
_PACKED = "f int, r int, value binary, counts binary"
_SUMS = (*COUNTED, "dev_values", "val_values", "labelled_values")


@dataclass(frozen=True)
class ColumnCounts:
    """``ranges``: (f, r, value, counts, sums...) with the values of a range in rising order; r is -1 where they are missing.

    ``value`` holds n doubles, ``counts`` 4 x n doubles in the order of ``COUNTED``; the sums are over the range.
    """

    ranges: DataFrame
    features: list[str]

    def totals(self) -> DataFrame:
        """A row a feature with rows: missing rates, distinct values, rows, labelled rows and bads of the values there."""
        there = F.col("r") >= 0
        part = lambda c: F.sum(F.when(there, F.col(c)).otherwise(0.0))
        missing = lambda c: F.try_divide(F.sum(F.when(there, 0.0).otherwise(F.col(c))), F.sum(c))
        whole = lambda c: part(c).cast("bigint")
        return self.ranges.groupBy("f").agg(
            missing("dev_rows").alias("development_missing_rate"), missing("val_rows").alias("validation_missing_rate"),
            whole("dev_values").alias("development_nunique"), whole("val_values").alias("validation_nunique"),
            whole("dev_rows").alias("n"), whole("dev_labelled").alias("labelled"), part("dev_bad").alias("bads"),
            whole("labelled_values").alias("labelled_values"), F.sum("dev_rows").alias("dev_all"),
        )

    def with_offsets(self, names: Sequence[str]) -> DataFrame:
        """The ranges of values with ``o_<name>``: the sum of ``name`` over the column's ranges before."""
        before = Window.partitionBy("f").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_RANGES rows
        sums = self.ranges.filter("r >= 0").select("f", "r", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"o_{c}") for c in names])
        return self.ranges.filter("r >= 0").join(small(sums), ["f", "r"])

    def quantiles(self, probs: Sequence[float]) -> DataFrame:
        """(f, i, value): the i-th of ``probs`` over the development values, interpolated linearly (numpy's rule)."""
        wanted = np.array([float(p) for p in probs])

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for f, _, value, counts, (n, offset) in _rows(batches, 2):
                end = offset + np.cumsum(counts[0])
                h = (n - 1) * wanted
                lo, hi = np.floor(h) + 1, np.ceil(h) + 1
                for i in range(len(wanted)):
                    found = [value[np.searchsorted(end, at)] if offset < at <= end[-1] else None for at in (lo[i], hi[i])] if len(end) else [None, None]
                    if found != [None, None]:
                        cells = [[f], [i], [h[i]], [found[0]], [found[1]]]
                        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=["f", "i", "h", "a", "b"])

        per = self.ranges.filter("r >= 0").groupBy("f").agg(F.sum("dev_rows").alias("_n")).filter("_n > 0")
        rows = self.with_offsets(["dev_rows"]).join(F.broadcast(per), "f").select("f", "r", "value", "counts", "_n", "o_dev_rows")
        met = rows.mapInArrow(pick, "f int, i int, h double, a double, b double").groupBy("f", "i", "h").agg(F.max("a").alias("a"), F.max("b").alias("b"))
        t, a, b = F.col("h") - F.floor("h"), F.col("a"), F.col("b")
        return met.select("f", "i", F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (F.lit(1.0) - t)).alias("value"))

    def names(self) -> DataFrame:
        return self.ranges.sparkSession.createDataFrame(list(enumerate(self.features)), "f int, feature string")


def _rows(batches: Iterator[pa.RecordBatch], more: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list]]:
    """(f, r, values, counts, further cells) of packed rows."""
    for b in batches:
        rest = [b.column(4 + i).to_pylist() for i in range(more)]
        for at, (f, r) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            value = np.frombuffer(b.column(2)[at].as_buffer())
            yield f, r, value, np.frombuffer(b.column(3)[at].as_buffer()).reshape(len(COUNTED), -1), [c[at] for c in rest]


def significant(x: np.ndarray, digits: int) -> np.ndarray:
    """``x`` at ``digits`` significant digits, as ``functions.core.round_significant_once``."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        k = (digits - 1) - np.floor(np.log10(np.abs(x)))
        up, down = np.power(10.0, np.clip(k, 0, 22)), np.power(10.0, np.clip(-k, 0, None))
        out = np.where(k >= 0, np.rint(x * up) / up, np.rint(x / down) * down)
    return np.where(np.isfinite(x) & (x != 0) & (k <= 22), out, x) + 0.0


def _distinct(value: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in rising order, each once (NaN last), with the sums of their counts."""
    order = np.argsort(value, kind="stable")
    value, counts = value[order], counts[:, order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) & ~(np.isnan(value[1:]) & np.isnan(value[:-1]))
    starts = np.flatnonzero(new)
    return value[starts], np.add.reduceat(counts, starts, axis=1) if len(starts) else counts


def _sampled(cells: DataFrame, ranges: int, rows: int, width: int) -> np.ndarray | None:
    """(features, ranges - 1): bounds between ranges, from at most about SAMPLED x MAX_RANGES rows."""
    if ranges < 2:
        return None
    found = cells.select("x").sample(min(1.0, SAMPLED * ranges / rows), seed=2026).limit(2 * SAMPLED * ranges).toPandas()["x"]
    if not len(found):
        return None
    with np.errstate(all="ignore"):
        x = np.vstack([np.asarray(v, float).reshape(1, width) for v in found])
        x = np.where(np.isfinite(x), x, np.nan)
        x[:, np.isnan(x).all(axis=0)] = 0.0
        return np.nanquantile(x, np.arange(1, ranges) / ranges, axis=0).T


def column_counts(wide: DataFrame, features: Sequence[str], digits: int | None = None, only_dev: bool = False, finite: bool = True,
                  split_col: str = "screening_split", label: str = "TARGET") -> ColumnCounts:
    """The counts of every value of ``features`` on development and validation (``only_dev``: on development alone).

    ``digits`` merges values that agree in that many significant digits; ``finite`` counts NaN and +-inf as missing.
    """
    features = list(features)
    width = len(features)
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("x")
    cells = wide.filter(F.col(split_col).isin(*([DEV] if only_dev else [DEV, VAL]))).select((F.col(split_col) == DEV).alias("dev"), F.col(label).cast("double").alias("y"), x)
    rows = cells.count()
    ranges = min(MAX_RANGES, -(-rows // RANGE_ROWS))
    bounds = _sampled(cells, ranges, rows, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            for at in range(0, b.num_rows, max(1, CHUNK_CELLS // width)):
                part = b.slice(at, max(1, CHUNK_CELLS // width))
                held.append(part)
                size += part.num_rows * width
                if size >= CHUNK_CELLS:
                    yield from packed(held)
                    held, size = [], 0
        if size:
            yield from packed(held)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dev = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held]).astype(bool)
        y = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held]).astype(float)
        flat = [b.column(2).flatten() for b in held]
        cells = np.concatenate([c.to_numpy(zero_copy_only=False) for c in flat]).reshape(len(dev), width)
        gone = ~np.isfinite(cells) if finite else np.concatenate([c.is_null().to_numpy(zero_copy_only=False) for c in flat]).reshape(len(dev), width)
        of_row = np.array([dev, dev & ~np.isnan(y), np.where(dev, np.nan_to_num(y), 0.0), ~dev], float)
        out: list[tuple[int, int, bytes, bytes]] = []
        for f in range(width):
            missing = gone[:, f]
            if missing.any():
                out.append((f, -1, np.zeros(1).tobytes(), of_row[:, missing].sum(axis=1).tobytes()))
            if missing.all():
                continue
            v, n = _distinct(cells[~missing, f] + 0.0, of_row[:, ~missing])
            if digits is not None:
                v, n = _distinct(significant(significant(v, SNAP_DIGITS), digits), n)
            # a value belongs to the range of the bounds below it
            cuts = [0, *np.searchsorted(v, bounds[f], side="right").tolist(), len(v)] if bounds is not None else [0, len(v)]
            for r in range(len(cuts) - 1):
                if cuts[r] < cuts[r + 1]:
                    at = slice(cuts[r], cuts[r + 1])
                    out.append((f, r, v[at].tobytes(), np.ascontiguousarray(n[:, at]).tobytes()))
        for at in range(0, len(out), 64):
            columns = list(zip(*out[at : at + 64], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32(), pa.int32(), pa.binary(), pa.binary()], strict=True)], names=["f", "r", "value", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for f, r, value, counts, _ in _rows(batches, 0):
            if now != (f, r):
                if now is not None:
                    yield summed(now, parts)
                now, parts = (f, r), []
            parts.append((value, counts))
        if now is not None:
            yield summed(now, parts)

    def summed(at: tuple[int, int], parts: list) -> pa.RecordBatch:
        value, counts = _distinct(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts], axis=1))
        sums = [*counts.sum(axis=1), *(float((counts[i] > 0).sum()) for i in (0, 3, 1))]
        cells = [[at[0]], [at[1]], [value.tobytes()], [np.ascontiguousarray(counts).tobytes()], *[[float(s)] for s in sums]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.float64()] * len(_SUMS)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=["f", "r", "value", "counts", *_SUMS])

    tasks = max(int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows * width * 40 // TASK_BYTES))
    met = cells.mapInArrow(count, _PACKED).repartition(tasks, "f", "r").sortWithinPartitions("f", "r")
    schema = _PACKED + "".join(f", {s} double" for s in _SUMS)
    return ColumnCounts(materialise(met.mapInArrow(add_up, schema), "column-counts"), features)


def _filled_sums(counts: ColumnCounts, fit: DataFrame, power: int) -> DataFrame:
    """(f, n, s): rows, and the sum of (filled value - ``around``) ** ``power`` over the development rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, r, value, n, (lower, upper, impute, around) in _rows(batches, 4):
            if r < 0:
                # least and greatest skip NULL: a missing value reads as the lower bound where there is one
                d = np.full(n.shape[1], (impute if lower is None else lower) - around)
            else:
                lower, upper = (-np.inf if lower is None else lower), (np.inf if upper is None else upper)
                # NaN is the greatest of all values, as in least and greatest
                d = np.where(np.isnan(value), upper, np.clip(value, lower, upper)) - around
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([float(n[0].sum())]), pa.array([float((n[0] * d**power).sum())])], names=["f", "n", "s"])

    rows = counts.ranges.filter("dev_rows > 0").join(F.broadcast(fit), "f").select("f", "r", "value", "counts", "lower", "upper", "impute", "around")
    return rows.mapInArrow(sums, "f int, n double, s double").groupBy("f").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def fit_moments(counts: ColumnCounts, fit: DataFrame) -> DataFrame:
    """(f, mean, std) of the development values, clipped to ``lower`` and ``upper`` and filled with ``impute``, from ``fit`` by f."""
    mean = _filled_sums(counts, fit.withColumn("around", F.lit(0.0)), 1).select("f", (F.col("s") / F.col("n")).alias("mean"))
    mean = materialise(mean, "design-means")
    spread = _filled_sums(counts, fit.join(mean.withColumnRenamed("mean", "around"), "f"), 2)
    return mean.join(spread, "f").select("f", "mean", F.sqrt(F.col("s") / F.col("n")).alias("std"))
