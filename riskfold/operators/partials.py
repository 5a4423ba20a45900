"""Sums of long vectors over all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Partial sums that the driver adds up; more are added up by tasks before.
GATHERED = 64


def sum_vectors(parts: DataFrame, partitions: int | None = None) -> np.ndarray:
    """The sum of the vectors (doubles as binary) in the only column of ``parts``; empty without rows.

    ``partitions``: the number of them, where the caller knows it (asking plans the query once more).
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for cell in b.column(0):
                v = np.frombuffer(cell.as_buffer())
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    while (partitions or parts.rdd.getNumPartitions()) > GATHERED:
        partitions = None
        parts = parts.repartition(GATHERED // 2).mapInArrow(fold, "v binary")
    found = [np.frombuffer(r[0]) for r in parts.collect()]
    return np.sum(found, axis=0) if found else np.zeros(0)


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, sum of the vectors of i) from rows (i, vector) that are sorted by i."""
    now, total = None, None
    for b in batches:
        for i, cell in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            v = np.frombuffer(cell.as_buffer())
            if i != now:
                if now is not None:
                    yield now, total
                now, total = i, v
            else:
                total = total + v
    if now is not None:
        yield now, total
