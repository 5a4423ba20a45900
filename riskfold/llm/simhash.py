"""SimHash near-duplicates through pivot distance tables.

Fingerprints at most ``max_bits`` apart are linked, and links make components.

* Equal fingerprints are one node, so copies cost nothing.
* Routing.  The 64 bits are cut into ``max_bits + 2`` blocks; two fingerprints
  within ``max_bits`` agree in at least two whole blocks, so every linked pair
  meets in a bucket of one of the block pairs.  (Distances to a pivot alone
  cannot route: for near-random 64-bit values one pivot rejects only two pairs
  in five.)
* Pivot tables.  Every fingerprint's Hamming distances to ``N_PIVOTS`` fixed
  reference fingerprints are precomputed.  By the triangle inequality a pair
  whose coordinates differ by more than ``max_bits`` anywhere is discarded; a
  bucket is swept in the order of its first coordinate, the other coordinates
  thin out the rest, and survivors are verified on all 64 bits.
* A bucket emits a spanning forest, not its pairs; pairs already connected are
  skipped.  Buckets over ``MAX_BUCKET`` fingerprints are dealt into chunks, and
  every pair of chunks is a bucket of its own, so no task holds a hot bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import saved, text_key, text_of
from riskfold.llm.components import star_components

N_PIVOTS = 32
PIVOT_SEED = 2_718_281
MAX_BUCKET = 4_096


def simhash(text: str, words: int = 4) -> int:
    """The 64-bit fingerprint of a whole text (unsigned); zero without words."""
    import xxhash

    tokens = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        shingles = [joined]
    else:
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(size + 1) - 1
        begins = (ends - size)[: len(tokens) - words + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(begins, ends[words - 1 :].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), "<u8", len(shingles))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = bits.sum(axis=0, dtype=np.int32) * 2 > len(shingles)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) with fp the fingerprint's 64 bits as a signed long."""
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("fp", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((simhash(x.as_py(), words) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=out.names)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), text_of(text_col).alias("text")
    ).mapInArrow(rows, out)


def _pivot_table(fp: np.ndarray) -> np.ndarray:
    pivots = np.random.default_rng(PIVOT_SEED).integers(0, 2**64, N_PIVOTS, dtype=np.uint64)
    return np.bitwise_count(fp[None, :] ^ pivots[:, None]).astype(np.int8)


def _linked(fp: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) within ``max_bits``: thinned by the pivot tables, then verified."""
    for coordinate in table[1:]:
        if len(a) < 256:
            break
        near = np.abs(coordinate[a] - coordinate[b]) <= max_bits
        a, b = a[near], b[near]
    near = (np.abs(table[:, a] - table[:, b]).max(axis=0) <= max_bits) if len(a) else np.zeros(0, bool)
    a, b = a[near], b[near]
    true = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
    return a[true], b[true]


def bucket_forest(fp: np.ndarray, bucket: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) links that connect what lies within ``max_bits`` inside each bucket.

    ``bucket`` holds one number a row; equal numbers are one bucket.
    """
    table = _pivot_table(fp)
    order = np.lexsort((fp, table[0], bucket))
    fp, table, bucket = fp[order], table[:, order], bucket[order]
    root = np.arange(len(fp))
    a, step = np.arange(len(fp) - 1), 0
    while len(a):
        step += 1
        a = a[a + step < len(fp)]
        b = a + step
        # sorted by bucket and first coordinate: what is out of reach now stays so
        reach = (bucket[a] == bucket[b]) & (table[0, b] - table[0, a] <= max_bits)
        a = a[reach]
        b = a + step
        open_ = root[a] != root[b]
        x, y = _linked(fp, table, a[open_], b[open_], max_bits)
        if not len(x):
            continue
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            while root[i] != i:
                i = root[i]
            while root[j] != j:
                j = root[j]
            root[max(i, j)] = min(i, j)
        while not np.array_equal(up := root[root], root):
            root = up
        if step % 16 == 0:  # a bucket that is one component needs no more pairs
            last = np.append(np.flatnonzero(np.diff(bucket)), len(bucket) - 1)
            first = np.concatenate([[0], last[:-1] + 1])
            whole = np.maximum.reduceat(root, first) == np.minimum.reduceat(root, first)
            a = a[~np.repeat(whole, last - first + 1)[a]]
    child = np.flatnonzero(root != np.arange(len(root)))
    return fp[child], fp[root[child]]


def _blocks(count: int) -> list[tuple[int, int]]:
    edge = [round(i * 64 / count) for i in range(count + 1)]
    return list(zip(edge[:-1], edge[1:], strict=True))


def links(nodes: DataFrame, max_bits: int = 4, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(u, v): links that connect all fingerprints ``fp`` within ``max_bits`` of each other."""
    masks = []
    for pair in combinations(_blocks(max_bits + 2), 2):
        mask = sum((1 << hi) - (1 << lo) for lo, hi in pair)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    # exact key: the agreeing bits themselves, and the number of the block pair
    keyed = nodes.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("pair", "bits")
    )
    hot = saved(
        keyed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_bucket), "simhash-hot"
    )
    chunks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(max_bucket / 2)).cast("long")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    dealt = (
        keyed.join(hot, ["pair", "bits"], "left")
        .withColumn("chunks", F.when(F.col("n").isNull(), F.lit(1)).otherwise(chunks))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("fp", "pair", "bits", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"))
    )
    keys = ["pair", "bits", "c1", "c2"]
    rows = dealt.repartition(*keys).sortWithinPartitions(*keys).select("fp", F.xxhash64(*keys).alias("bucket"))
    out = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_fp, rest_bucket = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def found(fp: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
            runs = np.cumsum(np.concatenate([[0], np.diff(bucket) != 0])) if len(bucket) else bucket
            size = np.bincount(runs)[runs] if len(bucket) else bucket
            more = size > 1
            u, v = bucket_forest(fp[more], runs[more], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=out.names)

        for b in batches:
            fp = np.concatenate([rest_fp, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            bucket = np.concatenate([rest_bucket, b.column(1).to_numpy(zero_copy_only=False)])
            if not len(bucket):
                continue
            change = np.flatnonzero(np.diff(bucket))
            cut = int(change[-1]) + 1 if len(change) else 0  # the last bucket may go on
            if cut:
                yield found(fp[:cut], bucket[:cut])
            rest_fp, rest_bucket = fp[cut:], bucket[cut:]
        if len(rest_fp):
            yield found(rest_fp, rest_bucket)

    return rows.mapInArrow(sweep, out)


def near_duplicates(
    docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text", with_root: bool = False
) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint``: 16 hex digits.  ``component_id``: the least doc_id among
    all rows reachable over links (NULL ids give way to others); where ids are NULL
    or repeat, components can share it.  ``with_root`` adds ``root``, a fingerprint
    (long) that belongs to one component alone.  NULL and
    empty texts have fingerprint zero and are linked like any other; rows that
    repeat an id or a text all stay; other columns are not carried; an empty
    table gives no rows.
    """
    prints = saved(fingerprints(docs, words, id_col, text_col), "simhash-prints")
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = star_components(saved(links(nodes, max_bits), "simhash-links"))
    member = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = member.select("fp", "root").join(least, "root").select("fp", "component_id", "root")
    return prints.join(classes, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["root"] if with_root else [])
    )
