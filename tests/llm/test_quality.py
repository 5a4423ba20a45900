import math
import random
import zlib

import numpy as np

from riskfold.llm import quality as Q


def _docs(n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for d in range(n):
        words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(rng.randint(5, 40))]
        bad = d % 4 == 0
        text = (" | ".join(words) if d % 8 else " ".join(words[:1] * 30)) if bad else " ".join(words) + "."
        rows.append((d, text, "s"))
        labels.append((d, 0 if bad else 1))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = _docs(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE string")
    weights = Q.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    out = Q.score(docs, weights)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = {r.doc_id: r for r in out.withColumn("h", Q.held_out()).collect()}
    held = [d for d, _ in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert held and {d for d in got if got[d].h} == set(held)
    assert sum(got[d].predicted == q for d, q in labels if got[d].h) / len(held) > 0.97
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_held_out_labels_have_no_say(spark):
    rows, labels = _docs(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string")
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 4 == 2 else q) for d, q in labels]
    a, b = (Q.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, flipped))
    assert np.array_equal(a, b) and a.any()


def test_update_matches_plain_ftrl():
    rng = np.random.default_rng(2)
    rule, z, n = Q.Ftrl(), np.zeros(6), np.zeros(6)
    pz, pn = [0.0] * 6, [0.0] * 6
    for _ in range(200):
        index = rng.choice(6, 3, replace=False)
        value, label = rng.random(3), int(rng.integers(0, 2))
        w = [0.0 if abs(pz[i]) <= rule.l1 else -(pz[i] - math.copysign(rule.l1, pz[i])) / ((rule.beta + pn[i] ** 0.5) / rule.alpha + rule.l2) for i in index]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, value, strict=True))))
        for i, x, wi in zip(index, value, w, strict=True):
            g = (p - label) * x
            sigma = ((pn[i] + g * g) ** 0.5 - pn[i] ** 0.5) / rule.alpha
            pz[i] += g - sigma * wi
            pn[i] += g * g
        rule.update(z, n, index, value, label)
    assert np.allclose(z, pz) and np.allclose(n, pn)


def test_odd_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "", None), (2, "a " * 50_000, None), (2, "!", None), (2, "!", None)], "doc_id long, text string, predicted string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(1, None), (None, 1), (3, 7)], "doc_id long, quality int")
    for labels in (none, odd):
        weights = Q.train(docs, labels)
        assert not weights.any()
        assert [r.score for r in Q.score(docs, weights).collect()] == [0.5] * 5
    both = spark.createDataFrame([(1, 0), (1, 1), (2, 1)], "doc_id long, quality int")
    got = Q.score(docs, Q.train(docs, both)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert Q.score(docs.limit(0), np.zeros(Q.DIMENSIONS)).count() == 0
