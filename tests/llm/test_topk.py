import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfold.llm import threshold_topk as K


def brute(vectors, k, every):
    import math

    out = []
    for q, a in vectors.items():
        if q % every:
            continue
        score = [(-sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b, strict=True)), c) for c, b in vectors.items() if c != q and len(b) == len(a)]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(score)[:k], 1)]
    return out


def _run(spark, rows, k, every=2, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    v = K.quantised(df)
    return sorted(tuple(r) for r in K.top_k(v, v.filter(F.col("id") % every == 0), k, **kw).collect())


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_against_brute_force(spark, block_rows):
    rng = random.Random(1)
    f = lambda: rng.randint(-64, 64) / 64
    vectors = {i: [f() for _ in range(6)] for i in range(90)}
    vectors |= {i: list(vectors[3]) for i in range(90, 130)}  # one very common vector: ties
    vectors |= {130: [0.0] * 6, 131: [1.0, 2.0], 132: [3.0, 1.0]}
    rows = [(i, v, None) for i, v in vectors.items()]
    rows += [(200, None, 1), (201, [None] * 6, 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] * 6, None), (None, [1.0] * 6, None), (4, vectors[4], 9)]
    assert _run(spark, rows, 5, block_rows=block_rows, query_rows=10) == sorted(brute(vectors, 5, 2))


def test_stops_before_the_end():
    """The walk ends early where the threshold falls below the k-th score."""
    import numpy as np

    rows = np.full((4000, 3), -5)
    rows[:40] = 60
    block = K.Block(np.arange(4000), rows)
    seen = []
    block.scores = lambda at, q, own=block.scores: (seen.append(len(at)), own(at, q))[1]
    ids, scores = block.top(np.array([1, 1, 1]), -1, 10)
    assert ids.tolist() == list(range(10)) and set(scores.tolist()) == {180}
    assert sum(seen) < 4000


def test_few_and_none(spark):
    assert _run(spark, [(0, [1.0], None), (1, [2.0], None)], 5) == [(0, 1, 1, 64 * 128)]
    assert _run(spark, [], 5) == []
    assert _run(spark, [(2, [], None), (4, [], None)], 5) == [(2, 1, 4, 0), (4, 1, 2, 0)]


def test_the_bound_ends_the_walk_where_few_dimensions_decide(monkeypatch):
    """Vectors whose components decay: the walk stops by its threshold, and the result is the brute force's."""
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(1500, 32)) * 64 * np.exp(-np.arange(32) / 3)).astype(np.int64)
    block, scored, plain = K.Block(np.arange(1500), rows), [], K.Block.scores
    monkeypatch.setattr(K.Block, "scores", lambda self, at, q: scored.append(len(at)) or plain(self, at, q))
    for i in range(0, 1500, 100):
        scored.clear()
        ids, best = block.top(rows[i], i, 20)
        assert sum(scored) < 1499
        products = rows @ rows[i]
        want = sorted((j for j in range(1500) if j != i), key=lambda j: (-products[j], j))[:20]
        assert ids.tolist() == want and best.tolist() == [products[j] for j in want]
