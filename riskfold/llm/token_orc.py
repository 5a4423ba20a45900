"""Token-id output in ORC, written in ascending document order.

Documents are range-partitioned by id, sorted, encoded and written as one ORC
file per range.  ORC's own machinery does the rest: run-length encoding of the
integer columns, stripes that are read in parallel, row indexes, and a Bloom
filter on the document id, so a lookup of a few ids skips files, stripes and
row groups by metadata (:func:`read_documents`).

A file's rows carry their running position inside the file; global starts come
from the per-file totals (:func:`read_positions`), so nothing is sorted twice.

Rules: a NULL text is an empty one (only the end id); a NULL id sorts first;
rows with equal ids are ordered by a hash of their text and all kept; columns
other than id and text are not written; an empty table gives an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import text_key, text_of
from riskfold.llm.tokens import encoder, slices

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("position", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


def _encode_rows(tokenizer: str, spaced: bool, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, position = encoder(tokenizer, spaced), 0
        for batch in batches:
            for at, part in slices(batch.column(2)):
                ids, counts = enc.encode(part)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                counts = counts + 1
                offsets = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        batch.column(1).slice(at, len(part)),
                        pa.array(position + offsets[:-1], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                    ],
                    names=SCHEMA.names,
                )
                position += int(offsets[-1])

    return rows


def write_token_orc(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    spaced: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    stripe_bytes: int = 64 << 20,
    row_index_stride: int = 10_000,
    bloom_fpp: float = 0.01,
) -> None:
    """Encode every whole text, append ``end_id`` and write ORC files to ``path``.

    ``tokenizer`` is a file of the tokenizers library; ``spaced`` says whether
    its vocabulary is byte-level (see ``tokens.ChunkEncoder``).
    """
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), text_key(text_col).alias("h"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", F.spark_partition_id().alias("part"), "text")
    )
    (
        rows.mapInArrow(_encode_rows(tokenizer, spaced, end_id), SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(bloom_fpp))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(row_index_stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("compression", "zstd")
        .orc(path)
    )


def read_documents(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The written rows; with ``doc_ids`` only those, pruned by ORC's indexes and Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if doc_ids is None else df.filter(F.col("doc_id").isin(doc_ids))


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with ``start``: the number of ids of all rows before this one.

    The join side is one row of two integers per file, so its size is that of
    the file listing the scan itself needs; it is broadcast.
    """
    df = read_documents(spark, path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        df.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    return df.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("position")).drop("base")


def ids_crc32(rows: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Add ``ids_crc32``: unsigned CRC-32 of a row's ids as little-endian 32-bit integers."""
    out = T.StructType([*[f for f in rows.schema if f.name != ids_col], T.StructField("ids_crc32", T.LongType())])
    kept = [f.name for f in rows.schema if f.name != ids_col]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            edge = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(crc, pa.int64())], names=out.names)

    return rows.mapInArrow(sums, out)
