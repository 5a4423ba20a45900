"""Shared helpers: table scans, shared-folder tables, name clashes, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan ``name`` from ``sf_dir``; only ``columns`` when given (column pruning)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with whole, replicated files: a lost executor costs a re-read,
    and values drawn from physical placement (partition numbers) stay fixed.
    """
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop every column whose name clashes (case-insensitively) with ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_of(name: str = "text") -> Column:
    """The text column as a string; NULL reads as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(name: str = "text") -> Column:
    """64-bit hash of the text: orders and tells apart rows that share an id."""
    return F.xxhash64(text_of(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
