from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from riskfold.llm import sharding as S


def test_hypergeometric_draws_follow_the_law(spark):
    total, marked, drawn, n = 30, 12, 9, 40_000
    u = S._uniform("7L", "id")
    got = Counter(r[0] for r in spark.range(n).select(F.expr(S.hypergeometric_sql(str(total), str(marked), str(drawn), u))).collect())
    for k in range(drawn + 1):
        p = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)
        assert abs(got[k] / n - p) < 5 * (p / n) ** 0.5 + 1e-4


def test_hypergeometric_edges(spark):
    cases = [(0, 0, 0), (5, 5, 3), (5, 0, 3), (10**9, 5 * 10**8, 10**6), (7, 3, 7)]
    for t, k, n in cases:
        draw = spark.range(50).select(F.expr(S.hypergeometric_sql(f"{t}L", f"{k}L", f"{n}L", S._uniform("id"))).alias("d"))
        lo, hi = max(0, n + k - t), min(n, k)
        got = [r.d for r in draw.collect()]
        assert all(lo <= d <= hi for d in got)
        if t == 10**9:
            assert 0.49 < sum(got) / len(got) / n < 0.51


@pytest.mark.parametrize("partitions", [1, 3, 70])
def test_matrix_sums(spark, partitions):
    sizes = spark.createDataFrame([(i, 5 + i % 7) for i in range(partitions) if i != 1], "pid long, n long")
    rows = S.communication_matrix(sizes, 5, 3).collect()
    want = {r.pid: r.n for r in sizes.collect()}
    assert {r.pid: sum(r.counts) for r in rows} == want
    total, cols = sum(want.values()), [sum(c) for c in zip(*(r.counts for r in rows), strict=True)]
    assert cols == [total // 5 + (s < total % 5) for s in range(5)]


def _check(rows, n, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, by.values())) == n
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_whole_and_even(spark):
    rows = [(i, None if i % 5 == 0 else "same" if i % 3 else "", "x") for i in range(503)] + [(7, "same", "x")] * 300 + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, Shard string").repartition(9)
    got = S.shuffle_shards(df, n_shards=4, block_rows=50)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    out = got.collect()
    _check(out, len(rows), 4)
    assert Counter((r.doc_id, r.text) for r in out) == Counter((a, b) for a, b, _ in rows)


def test_small_and_empty(spark):
    assert S.shuffle_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    _check(S.shuffle_shards(spark.range(3), n_shards=16).collect(), 3, 16)


def test_placement_is_uniform(spark):
    """Every row reaches every shard equally often, wherever it started."""
    hits = Counter()
    for seed in range(30):
        for r in S.shuffle_shards(spark.range(0, 40, 1, 2), n_shards=2, seed=seed).collect():
            hits[r.id < 20, r.shard] += 1
    assert all(250 < hits[half, shard] < 350 for half in (True, False) for shard in (0, 1))
