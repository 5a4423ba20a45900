import random
import re

import numpy as np
import pytest
import xxhash

from riskfold.llm import simhash as S


def plain_simhash(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [w] if len(w) < words else [w[i : i + words] for i in range(len(w) - words + 1)]
    hs = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def plain_components(ids, fps, bits=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return [least[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", " \t\n\x0b", "One", "a B c", "A b C d E f", "É\x85é x y z Ä w", "w " * 30_000])
def test_simhash_matches_plain(text):
    assert S.simhash(text) == plain_simhash(text)


def test_bucket_forest_connects_exactly(n=400):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 7))) for b in base for _ in range(n // 12)})
    bucket = np.array([rng.randint(0, 2) for _ in fps])
    u, v = S.bucket_forest(np.array(fps, np.uint64), bucket, 4)
    for k in range(3):
        own = [f for f, b in zip(fps, bucket, strict=True) if b == k]
        want = plain_components(own, own)
        at = {f: i for i, f in enumerate(own)}
        mine = [(int(a), int(b)) for a, b in zip(u, v, strict=True) if int(a) in at]
        root = list(range(len(own)))

        def find(i, root=root):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in mine:
            x, y = find(at[a]), find(at[b])
            root[max(x, y)] = min(x, y)
        assert [own[find(i)] for i in range(len(own))] == want


def _spread(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    out = S.near_duplicates(df, **kw)
    assert out.columns == ["doc_id", "text_key", "fingerprint", "component_id"]
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["al", "be", "ga", "de", "ep", "ze", "et", "th"])
    rows = []
    for d in range(150):
        base = [word() for _ in range(60)]
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(60)] = word()
            rows.append((len(rows), " ".join(w), None, None))
    rows += [(900, None, "x", 1), (901, "", None, None), (5, rows[5][1], None, None), (None, rows[9][1], None, None), (None, "zz", None, 3)]
    fps = [plain_simhash(r[1]) for r in rows]
    want = sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components([r[0] for r in rows], fps), strict=True)), key=str)
    assert _spread(spark, rows) == want
    assert len({w[2] for w in want}) < len(rows) - 20


def test_hot_bucket_is_dealt_into_chunks(spark):
    """Many fingerprints around one centre: every pair of blocks is a hot bucket."""
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = list({centre ^ sum(1 << k for k in rng.sample(range(64), rng.choice([2, 4, 9, 11]))) for _ in range(500)})
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    found = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits=4, max_bucket=20)
    from riskfold.llm.components import star_components

    got = {r.node: r.root for r in star_components(found).collect()}
    want = plain_components(fps, fps)
    mine = {}
    for f, s in zip(fps, signed, strict=True):
        mine.setdefault(got.get(s, s), []).append(f)
    assert sorted(sorted(x) for x in mine.values()) == sorted(
        sorted(f for f, c in zip(fps, want, strict=True) if c == w) for w in set(want)
    )


def test_empty_table(spark):
    assert _spread(spark, []) == []
