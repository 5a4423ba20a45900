"""Best-fit packing of token documents into fixed-length sequences, in bulk-synchronous rounds.

Documents are cut into pieces of at most ``capacity`` tokens.  Pieces over half
the capacity open sequences of their own; all others look for gaps.  A round

1. range-sorts the waiting pieces and the gaps of open sequences by size,
2. sweeps them for successors: read as brackets (a piece opens, a gap closes),
   each piece in falling order of size meets the tightest gap that holds it;
   the matching bracket is the next row of the same depth, so one window over
   the depth finds all pairs,
3. resolves conflicts by rank (the depth counts ranks, so a gap has one piece),
4. shrinks the gaps, and repeats with the pieces left over.

A gap that would hold several of the largest waiting pieces takes part as that
many slots, so rounds stay few.  A round that places less than a third of the
waiting pieces is followed by as many empty sequences as the rest would fill
beyond the gaps that can take any of them, at least one where none was placed.  Only class totals (one row for each size and kind, at most twice the
capacity) are broadcast, and a depth holds at most that many rows, since a
class meets a depth once.  The rows of a round are written to the shared
folder, so a lost executor costs that round at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import saved, text_of
from riskfold.llm.tokens import encoder, slices
from riskfold.operators.rank import global_rank

#: New sequences are opened after a round that places less than one in so many waiting pieces.
OPEN_BELOW = 3

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    spaced: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every whole text as token pieces: doc_id, piece, start, length, ids.

    A document's ids end with ``end_id`` (an empty or NULL text has just that
    one) and are cut every ``capacity`` ids; only the last piece may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaced)
        for batch in batches:
            for at, part in slices(batch.column(1)):
                ids, counts = enc.encode(part)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                pieces = -(-counts // capacity)
                row = np.repeat(np.arange(len(part)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(capacity, counts[row] - number * capacity)
                offsets = np.concatenate([[0], np.cumsum(length)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + at)),
                        pa.array(number, pa.int32()),
                        pa.array(number * capacity, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                    ],
                    names=PIECES.names,
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def _round(waiting: DataFrame, slots: DataFrame) -> DataFrame:
    """One sweep: every row with its partner (``mate``, ``mate_size``), NULL where it has none."""
    rows = waiting.select(
        F.lit(0).alias("kind"), "id", F.lit(0).alias("slot"), F.lit(0).cast("long").alias("free"), "size"
    ).unionByName(slots.withColumn("kind", F.lit(1)))
    ranked = global_rank(rows, [F.col("size"), F.col("kind"), F.col("id"), F.col("slot")], rank_col="pos")
    before = Window.orderBy("size", "kind").rowsBetween(Window.unboundedPreceding, -1)
    signed = F.when(F.col("kind") == 0, F.col("n")).otherwise(-F.col("n"))
    classes = (
        ranked.groupBy("size", "kind")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "size",
            "kind",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
            F.coalesce(F.sum(signed).over(before), F.lit(0)).alias("level"),
        )
    )
    rank = F.col("pos") - F.col("first")
    depth = F.when(F.col("kind") == 0, F.col("level") + rank).otherwise(F.col("level") - rank + 1)
    at = Window.partitionBy("depth").orderBy("pos")
    met = ranked.join(F.broadcast(classes), ["size", "kind"]).withColumn("depth", depth)

    def neighbour(column: str) -> Column:
        ahead, back = F.lead(column).over(at), F.lag(column).over(at)
        return F.when((F.col("kind") == 0) & (F.lead("kind").over(at) == 1), ahead).when(
            (F.col("kind") == 1) & (F.lag("kind").over(at) == 0), back
        )

    return saved(
        met.select("kind", "id", "slot", "free", "size", neighbour("id").alias("mate"), neighbour("size").alias("mate_size")), "pack-round"
    )


def pack_best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """(id, sequence_id, offset) for items (id long >= 0 and unique, size from 1 to ``capacity``).

    Items of equal size are told apart by id.  No item is cut or left out; an
    empty table gives no rows.  A sequence is named by the item that opened it,
    or by a negative number.
    """
    spark = items.sparkSession
    items = items.select("id", F.col("size").cast("long").alias("size"))
    large = items.filter(F.col("size") * 2 > capacity)
    waiting = items.filter(F.col("size") * 2 <= capacity)
    placed = [large.select("id", F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    gaps = large.select("id", (capacity - F.col("size")).alias("free")).filter("free > 0")
    opened = 0
    facts = [F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("size").alias("least"), F.max("size").alias("most")]
    left = waiting.agg(*facts).first()
    while left["n"]:
        # a gap that would hold several of the largest waiting pieces offers that many equal slots
        slots = (
            gaps.filter(F.col("free") >= left["least"])
            .withColumn("k", F.greatest(F.lit(1), F.floor(F.col("free") / left["most"])).cast("int"))
            .select("id", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("slot"), "free", F.floor(F.col("free") / F.col("k")).alias("size"))
        )
        out = _round(waiting, slots)
        waiting = out.filter((F.col("kind") == 0) & F.col("mate").isNull()).select("id", "size")
        filled = out.filter("kind = 1").withColumn("used", F.coalesce("mate_size", F.lit(0)))
        before = Window.partitionBy("id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        at = capacity - F.col("free") + F.coalesce(F.sum("used").over(before), F.lit(0))
        placed.append(
            filled.withColumn("offset", at).filter("mate is not null").select(F.col("mate").alias("id"), F.col("id").alias("sequence_id"), "offset")
        )
        gaps = filled.groupBy("id").agg((F.min("free") - F.sum("used")).alias("free")).filter("free > 0")
        was = left["n"]
        left = waiting.agg(*facts).first()
        if left["n"] and (was - left["n"]) * OPEN_BELOW <= was:
            room = gaps.filter(F.col("free") >= left["most"]).agg(F.sum("free")).first()[0] or 0
            more = max(int(left["n"] == was), (left["total"] - room) // capacity)
            fresh = spark.range(opened + 1, opened + 1 + more).select((-F.col("id")).alias("id"), F.lit(capacity).cast("long").alias("free"))
            gaps, opened = gaps.unionByName(fresh), opened + more
    return reduce(DataFrame.unionByName, placed)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset``, packed by :func:`pack_best_fit`."""
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_pack_id")]
    rows = saved(pieces.select(*kept, F.monotonically_increasing_id().alias("_pack_id")), "pack-pieces")
    where = pack_best_fit(rows.select(F.col("_pack_id").alias("id"), F.col("length").alias("size")), capacity)
    return rows.join(where.withColumnRenamed("id", "_pack_id"), "_pack_id").drop("_pack_id")
