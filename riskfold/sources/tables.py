"""Scans and sinks.

* :func:`read_table` — projected parquet scan of a driver table.
* :func:`read_csv_table` — CSV scan with an explicit schema (the reference's
  raw files), optional column projection, and ``dataset`` tagging.
* :func:`file_sizes` — size probe of raw files without reading their content.
* :func:`write_parquet` / :func:`write_report` — sinks.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    dataset: str | None = None,
    add_null_target: bool = False,
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """CSV scan as the reference reads its raw files.

    ``schema`` should be given in production (no inference pass over 100 TB);
    ``columns`` is the ``usecols`` projection; ``dataset`` prepends a literal
    tag; ``add_null_target`` adds a NULL ``TARGET`` when the file has none.
    ``multi_line`` reads quoted line ends as part of a value; files without
    them can be split between tasks with ``multi_line=False``.
    """
    reader = spark.read.option("header", "true").option("encoding", encoding).option("multiLine", str(multi_line).lower())
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    df = reader.csv(path)
    if columns:
        df = df.select(*columns)
    if add_null_target and "TARGET" not in df.columns:
        df = df.withColumn("TARGET", F.lit(None).cast("int"))
    if dataset is not None:
        df = df.select(F.lit(dataset).alias("dataset"), *df.columns)
    return df


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, file_mb) per file; only file metadata is read, never content."""
    df = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    return df.select("path", (F.col("length") / F.lit(1024.0 * 1024.0)).alias("file_mb"))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Report sink.  ``single_file`` writes through one task: only for reports of bounded size."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def preview(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """First ``n`` rows by an explicit key order (the reference's preview sink)."""
    return df.orderBy(key).limit(n)
