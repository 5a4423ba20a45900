"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows go from each source partition to each shard is drawn first, as a
matrix whose row sums are the partition sizes and whose column sums are the
shard sizes (multivariate hypergeometric).  Each partition then permutes its
rows locally and cuts the permutation by its matrix row, the rows are
exchanged once, and each shard is permuted again.  The result is a uniformly
random order of all rows, and shard sizes differ by at most one.

The matrix is drawn down a tree with ``FANOUT`` children a node, so a node
needs only its own column sums and its children's row counts: rows of a level
are drawn in parallel.  One cell is an exact inverse-CDF draw: the weights of
the hypergeometric law follow from their ratio, over the part of the support
within twelve standard deviations (the rest weighs less than a double's last
bit).  The second permutation cuts a shard into blocks of about ``block_rows``
rows by a random key, so no task sorts a whole shard.

Everything is DataFrame and SQL functions.  Rules: rows with NULLs, empty or
equal texts are rows like any other; repeated rows are placed one by one; an
empty table gives no rows; input columns named ``shard`` or ``slot`` give way
to the result's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfold.llm.common import saved, without

FANOUT = 64
_PID, _RANK, _KEY, _BLOCK = "_shard_pid", "_shard_rank", "_shard_key", "_shard_block"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def hypergeometric_sql(total: str, marked: str, drawn: str, uniform: str) -> str:
    """SQL for one draw: the marked items among ``drawn`` taken from ``total`` of which ``marked`` are marked."""
    law = _let(
        "h",
        f"named_struct('t', cast({total} as double), 'k', cast({marked} as double), 'n', cast({drawn} as double))",
        _let(
            "m",
            "named_struct('mean', h.n * h.k / greatest(h.t, 1D), 'sd', sqrt(greatest(0D, h.n * (h.k / greatest(h.t, 1D))"
            " * ((h.t - h.k) / greatest(h.t, 1D)) * ((h.t - h.n) / greatest(h.t - 1, 1D)))))",
            "named_struct('t', h.t, 'k', h.k, 'n', h.n,"
            " 'lo', cast(greatest(0D, h.n + h.k - h.t, floor(m.mean - 12 * m.sd - 12)) as bigint),"
            " 'hi', cast(least(h.n, h.k, ceil(m.mean + 12 * m.sd + 12)) as bigint))",
        ),
    )
    step = "s.w * ((p.k - x) * (p.n - x)) / ((x + 1) * (p.t - p.k - p.n + x + 1))"
    weight = (
        "aggregate(sequence(p.lo, p.hi), named_struct('w', 1D, 'sum', 0D),"
        f" (s, x) -> named_struct('w', {step}, 'sum', s.sum + s.w), s -> s.sum)"
    )
    pick = (
        "aggregate(sequence(p.lo, p.hi), named_struct('w', 1D, 'sum', 0D, 'at', p.lo),"
        f" (s, x) -> named_struct('w', {step}, 'sum', s.sum + s.w, 'at', if(s.sum <= goal, x, s.at)), s -> s.at)"
    )
    return _let("p", law, _let("goal", f"{uniform} * {weight}", pick))


def _uniform(*parts: str) -> str:
    return f"(shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / 9007199254740992D)"


def _row_sql(cols: str, rows: str, seed: str) -> str:
    """SQL for a matrix row: how ``rows`` items split over columns holding ``cols`` items."""
    draw = hypergeometric_sql("a.pool", f"{cols}[j]", "a.rows", _uniform(seed, "j"))
    return (
        f"aggregate(sequence(0, size({cols}) - 1),"
        f" named_struct('rows', {rows}, 'pool', aggregate({cols}, 0L, (t, v) -> t + v), 'out', cast(array() as array<bigint>)),"
        f" (a, j) -> {_let('d', draw, f'''named_struct('rows', a.rows - d, 'pool', a.pool - {cols}[j], 'out', array_append(a.out, d))''')},"
        " a -> a.out)"
    )


def communication_matrix(sizes: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(pid, counts array of ``n_shards``) from (pid, n): the drawn matrix.

    Column sums are the shard sizes, equal up to one row; row sums are ``n``.
    """
    top = sizes.agg(F.max("pid")).first()[0]
    levels = [sizes.select(F.col("pid").alias("node"), "n")]
    while top is not None and (top := top // FANOUT) > 0:
        below = levels[-1]
        levels.append(below.groupBy((F.col("node") / FANOUT).cast("long").alias("node")).agg(F.sum("n").alias("n")))
    share = f"transform(sequence(0, {n_shards - 1}), s -> sum(n) div {n_shards} + if(s < sum(n) % {n_shards}, 1L, 0L))"
    drawn = levels[-1].agg(F.expr(share).alias("counts")).select(F.lit(0).cast("long").alias("node"), "counts")
    for depth, level in reversed(list(enumerate(levels))):
        children = level.groupBy((F.col("node") / FANOUT).cast("long").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("node").alias("child"), "n"))).alias("children")
        )
        row = _row_sql("q.left", "c.n", f"{seed}L, {depth}, c.child")
        left = "zip_with(q.left, r, (x, y) -> x - y)"
        rows = (
            "aggregate(children, named_struct('left', counts,"
            " 'out', cast(array() as array<struct<child: bigint, counts: array<bigint>>>)),"
            f" (q, c) -> {_let('r', row, f'''named_struct('left', {left}, 'out', array_append(q.out, named_struct('child', c.child, 'counts', r)))''')},"
            " q -> q.out)"
        )
        drawn = drawn.join(children, "node").select(F.explode(F.expr(rows)).alias("r"))
        drawn = drawn.select(F.col("r.child").alias("node"), F.col("r.counts").alias("counts"))
    return drawn.select(F.col("node").alias("pid"), "counts")


def shuffle_shards(
    df: DataFrame, n_shards: int = 16, seed: int = 20_240_611, block_rows: int = 8_192, max_partitions: int = 16_384
) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    At most ``max_partitions`` source partitions are told apart, so the matrix,
    which is broadcast, has at most ``max_partitions * n_shards`` counts (2 MB
    with the defaults); more partitions are merged without a shuffle.
    """
    kept = without(df, ["shard", "slot"])
    local = (
        kept.coalesce(max_partitions)
        .withColumn(_KEY, F.rand(seed))
        .sortWithinPartitions(_KEY)
        .withColumn(_KEY, F.monotonically_increasing_id())
        .withColumn(_PID, F.shiftright(_KEY, 33).cast("long"))
        .withColumn(_RANK, F.col(_KEY).bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(_KEY)
    )
    rows = saved(local, "shard-rows")
    sizes = saved(rows.groupBy(F.col(_PID).alias("pid")).agg(F.count(F.lit(1)).alias("n")), "shard-sizes")
    matrix = saved(communication_matrix(sizes, n_shards, seed), "shard-matrix")
    ends = "aggregate(counts, cast(array() as array<bigint>), (a, v) -> array_append(a, v + if(size(a) = 0, 0L, element_at(a, -1))))"
    cuts = matrix.select(F.col("pid").alias(_PID), F.expr(ends).alias("_shard_ends"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // (n_shards * block_rows)))
    key = F.xxhash64(F.lit(seed), F.lit("second"), _PID, _RANK)
    placed = (
        rows.join(F.broadcast(cuts), _PID)
        .withColumn("shard", F.expr(f"size(filter(_shard_ends, e -> e <= {_RANK}))"))
        .drop("_shard_ends")
        .withColumn(_KEY, key)
        .withColumn(_BLOCK, F.floor(F.shiftrightunsigned(_KEY, 11) / F.lit(float(1 << 53)) * blocks))
    )
    earlier = Window.partitionBy("shard").orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", _BLOCK)
        .agg(F.count(F.lit(1)).alias("_shard_n"))
        .select("shard", _BLOCK, F.coalesce(F.sum("_shard_n").over(earlier), F.lit(0)).alias("_shard_start"))
    )
    order = Window.partitionBy("shard", _BLOCK).orderBy(_KEY, _PID, _RANK)
    return (
        placed.withColumn("slot", F.row_number().over(order).cast("long") - 1)
        .join(starts, ["shard", _BLOCK])
        .withColumn("slot", F.col("slot") + F.col("_shard_start"))
        .select(*[F.col(f"`{c}`") for c in kept.columns], "shard", "slot")
    )
