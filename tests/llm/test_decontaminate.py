import random

import numpy as np
import pytest

from riskfold.llm import decontaminate as D


def plain_score(item, passage):
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            s = 2 if item[i - 1] == passage[j - 1] else -1
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best / (2 * len(item))


def test_alignment_matches_plain():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 15)), rng.integers(0, 4, rng.integers(1, 25))
        assert D.smith_waterman(a, b)[0] == plain_score(a.tolist(), b.tolist())


def _words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


def _tables(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, item_id string"),
        spark.createDataFrame(items, "item_id long, text string, doc_id string"),
    )


def test_finds_all_against_brute_force(spark):
    rng = random.Random(2)
    items = [(i, " ".join(_words(rng, rng.randint(15, 40))), None) for i in range(12)] + [(50, None, None), (51, "", None), (52, "one two", None)]
    docs = []
    for d in range(120):
        w = _words(rng, rng.randint(0, 60))
        if d % 3 == 0:
            copy = items[rng.randrange(12)][1].split()
            for _ in range(rng.randint(0, len(copy) // 4)):
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([[], ["new"], [copy[k], "more"]])
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + "," for x in copy]
        docs.append((d, " ".join(w), "x"))
    docs += [(200, None, None), (201, "", None), (None, items[3][1], None), (3, docs[3][1], "x"), (202, "pad " * 50_000 + items[5][1], None)]
    got = D.find_matches(*_tables(spark, docs, items))
    assert got.columns == ["doc_id", "text_key", "item_id", "similarity", "first_word", "last_word"]
    found = sorted(((r.doc_id, r.item_id, round(r.similarity, 6)) for r in got.collect()), key=str)
    want = []
    for d, t, _ in docs:
        w = D.WORD.findall((t or "").lower())[-200:]
        for i, x, _ in items:
            q = D.WORD.findall((x or "").lower())
            if len(q) >= 3 and (s := plain_score(q, w)) >= 0.7:
                want.append((d, i, round(s, 6)))
    assert found == sorted(want, key=str) and len(want) > 30


def test_span_and_hot_item(spark):
    rng = random.Random(6)
    item = _words(rng, 20)
    docs = [(d, " ".join(["the", "cat", "sat", "down"] + item + ["far", "away", str(d)]), None) for d in range(60)]
    docs += [(100 + d, " ".join(_words(rng, 30)), None) for d in range(30)]
    rows = D.find_matches(*_tables(spark, docs, [(1, " ".join(item), None)])).collect()
    assert {r.doc_id for r in rows} == set(range(60))
    assert {(r.first_word, r.last_word, r.similarity) for r in rows} == {(4, 23, 1.0)}


def test_drop_contaminated(spark):
    rng = random.Random(8)
    item = " ".join(_words(rng, 20))
    docs, items = _tables(spark, [(1, item, None), (1, "clean text here", None), (None, item, None), (None, None, None)], [(1, item, None)])
    left = D.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted((tuple(r) for r in left.collect()), key=str) == [(1, "clean text here", None), (None, None, None)]


@pytest.mark.parametrize("docs,items", [([], []), ([(1, "a b c d", None)], []), ([], [(1, "a b c d", None)])])
def test_empty_tables(spark, docs, items):
    assert D.find_matches(*_tables(spark, docs, items)).collect() == []


def test_passes_give_the_same(spark):
    rng = random.Random(9)
    items = [(i, " ".join(_words(rng, 15)), None) for i in range(7)]
    docs = [(d, items[d % 7][1] + " tail", None) for d in range(20)]
    rows = [sorted((r.doc_id, r.item_id) for r in D.find_matches(*_tables(spark, docs, items), items_per_pass=k).collect()) for k in (2, 100)]
    assert rows[0] == rows[1] == [(d, d % 7) for d in range(20)]


@pytest.mark.parametrize("size,inserted", [(38, 16), (50, 20), (59, 20), (59, 30), (200, 100), (30, 18)])
def test_long_insertions_against_brute_force(spark, size, inserted):
    """An insertion of up to 2 * size * (1 - threshold) words still passes, in one piece, in two, or between other edits."""
    rng = random.Random(size + inserted)
    item, other = _words(rng, size), _words(rng, 20)
    copies = []
    for at in (size // 2, size // 3, size - 5):
        copies.append(item[:at] + _words(rng, inserted) + item[at:])
        more = item[:5] + _words(rng, inserted // 2) + item[5:at] + _words(rng, inserted - inserted // 2) + item[at:]
        copies += [more, [w for k, w in enumerate(copies[-1]) if k not in (2, size)]]
    docs = [(d, " ".join(_words(rng, 30) + c + _words(rng, 30)), None) for d, c in enumerate(copies)]
    rows = D.find_matches(*_tables(spark, docs, [(1, " ".join(item), None), (2, " ".join(other), None)])).collect()
    scores = {d: plain_score(item, t.split()) for d, t, _ in docs}
    assert {r.doc_id: round(r.similarity, 6) for r in rows} == {d: round(s, 6) for d, s in scores.items() if s >= 0.7}
    assert any(s >= 0.7 for s in scores.values())


def _edited(rng, words, kind):
    out = list(words)
    if kind == "inserted":
        return [x for i, w in enumerate(words) for x in ([w, "new"] if i % 2 else [w])]
    for _ in range(rng.randint(0, len(words) // 3)):
        k = rng.randrange(len(out))
        out[k : k + 1] = {"replaced": ["new"], "dropped": [], "mixed": rng.choice([[], ["new"], [out[k], "more"], ["x", out[k]]])}[kind]
    return out


def test_every_passing_copy_is_found(spark):
    """Copies that are replaced, dropped, added to and mixed, up to the threshold: found are those whose full alignment passes."""
    rng = random.Random(12)
    common = ["of", "the", "and", "to", "in"]
    items = []
    for i in range(40):
        items.append((i, " ".join(rng.choice(common) if rng.random() < 0.5 else w for w in _words(rng, rng.choice([3, 4, 5, 8, 20, 40, 70]))), None))
    docs = []
    for i, text, _ in items:
        for kind in ("inserted", "replaced", "dropped", "mixed", "mixed"):
            pad = [rng.choice(common) for _ in range(rng.randint(0, 30))]
            docs.append((len(docs), " ".join(pad + _edited(rng, text.split(), kind) + [rng.choice(common) for _ in range(10)]), "x"))
    found = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in D.find_matches(*_tables(spark, docs, items)).collect()}
    want = {}
    for d, t, _ in docs:
        for i, x, _ in items:
            if (score := plain_score(x.split(), t.split())) >= 0.7:
                want[d, i] = round(score, 6)
    assert found == want
    inserted = [d for d in range(0, len(docs), 5)]
    assert sum((d, d // 5) in want for d in inserted) > 30


def test_seeds_spare_the_most_frequent_pairs():
    items = D.Items([(1, "a b c d e f g h i j k l m n o p q r s t"), (2, "x y"), (3, "u v w")], 0.7)
    # 20 words: 7 pairs must be intact, the 3 most frequent are no seeds, and 4 different seeds are needed
    assert items.spared.tolist()[::2] == [3, 0] and items.needed.tolist()[::2] == [4, 1]
    counts = {int(g): 100 for g in items.gram[5:7]} | {int(items.gram[9]): 50}
    keep = items.seeds(counts)
    assert np.flatnonzero(~keep).tolist() == [5, 6, 9] and keep.sum() == 19 - 3 + 2
    with pytest.raises(ValueError):
        D.Items([], 0.6)
