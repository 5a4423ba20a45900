import random

import pytest

from riskfold.llm import line_dedup as L


def plain_dedup(docs, min_words):
    """docs: sorted (doc_id, text) without repeats.  Every run of lines of min_words words that equals an earlier one goes."""
    seen, out = {}, []
    for order, (d, text) in enumerate(docs):
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for a in range(len(full)):
            words = 0
            for b in range(a, len(full)):
                words += len(lines[full[b]].split())
                if words >= min_words:
                    run = tuple(lines[i].strip() for i in full[a : b + 1])
                    if seen.setdefault(run, (order, a)) < (order, a):
                        gone.update(range(full[a], full[b] + 1))
        out.append((d, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text, len(gone)))
    return out


def _run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, LINES_removed string")
    got = L.dedup_lines(df, **kw)
    assert got.columns == ["doc_id", "text", "lines_removed"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice("abc") for _ in range(rng.randint(0, 4)))
    texts = []
    for _ in range(40):
        lines = [line() for _ in range(rng.randint(1, 12))]
        if texts and rng.random() < 0.6:
            other = rng.choice(texts).split("\n")
            a = rng.randrange(len(other))
            cut = other[a : a + rng.randint(1, 6)]
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = [x + " " for x in cut]
        texts.append("\n".join(lines))
    docs = [*enumerate(texts), (900, ""), (901, None), (902, "\n\n"), (903, "a b c d e f g h\n" * 5)]
    want = plain_dedup(docs, 6)
    assert _run(spark, [(d, t, None) for d, t in docs], min_words=6) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 5


def test_copies_keep_one_and_ties(spark):
    text = "one two three four five\nsix seven eight nine ten eleven"
    rows = [(5, text, "x"), (3, text, None), (None, text, None), (5, text, "x"), (7, "zz", None)]
    got = _run(spark, rows, min_words=4)
    assert [g for g in got if g[1] == text] == [(None, text, 0)]
    assert sum(g[1] == "" and g[2] == 2 for g in got) == 3 and (7, "zz", 0) in got


def test_long_text_and_empty_table(spark):
    long = "\n".join(f"line {i} of a very long text" for i in range(20_000))
    assert _run(spark, [(1, long, None), (2, "head\n" + long + "\ntail", None)]) == [(1, long, 0), (2, "head\ntail", 20_000)]
    assert _run(spark, []) == []


def test_every_shared_run_shares_a_fingerprint():
    rng = random.Random(4)
    for _ in range(50):
        run = [" ".join(rng.choice("pqrs") for _ in range(rng.randint(1, 5))) for _ in range(6)]
        if sum(len(x.split()) for x in run) < 10:
            continue
        ends = [["u v w"] * rng.randint(0, 3) for _ in range(4)]
        one = {w[0] for w in L.windows("\n".join(ends[0] + run + ends[1]), 10)}
        two = {w[0] for w in L.windows("\n".join(ends[2] + run + ends[3]), 10)}
        assert one & two
