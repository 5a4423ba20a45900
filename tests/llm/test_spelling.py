import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from riskfold.llm import spelling as S
from riskfold.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_links(words):
    near = {w: set() for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    return near


def plain_variants(docs, damage=199):
    """The contract's rows for [(doc_id, text)]."""
    n = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near, form = plain_links(n), {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.mark.parametrize("seed", range(4))
def test_one_partition_against_all_pairs(seed):
    rng = random.Random(seed)
    for _ in range(200):
        length = rng.randint(0, 5)
        words = sorted({"".join(rng.choice("abé") for _ in range(length + rng.randint(0, 1))) for _ in range(rng.randint(1, 25))})
        got = S.near_pairs(words, length, at_end=True)
        assert len(got) == len(set(got))
        want = {frozenset(p) for p in combinations(words, 2) if one_edit(*p) and min(map(len, p)) == length}
        assert {frozenset(p) for p in got} == want
        short = {frozenset((a, b)) for a, b in combinations(words, 2) if b == a + b[-1:] and len(b) > len(a) or a == b + a[-1:] and len(a) > len(b)}
        assert {frozenset(p) for p in S.near_pairs(words, length, at_end=False)} == want - short


def test_acceptor_is_minimal():
    machine = S.Acceptor()
    q = machine.add(sorted(a + b + "ing" for a in "bst" for b in "ae"))
    assert len(machine.arcs) == 6 and len(machine.arcs[q]) == 3  # one state for each depth
    p = machine.add(["xing", "ying"])
    assert machine.both(machine.arcs[p]["x"], machine.arcs[machine.arcs[q]["b"]]["a"]) == ["ing"]


@pytest.mark.parametrize("limit", [3, 40, 4096])
def test_links_whatever_the_size_of_a_partition(spark, limit):
    rng = random.Random(limit)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 8))) for _ in range(250)} | {"stem" + c for c in "abcdefghijklmnop"} | {"z" * 3_000, "z" * 1_500 + "y" + "z" * 1_500}
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    rows = S.links(df, max_partition=limit).collect()
    assert len(rows) == len({(r["word"], r["near"]) for r in rows})
    got = {w: set() for w in words}
    for w, n, near, near_n in rows:
        got[w].add(near)
        assert (n, near_n) == (len(w), len(near))
    assert got == plain_links(words)


def _docs(seed):
    rng = random.Random(seed)
    stems = ["spelling", "variant", "größer", "àéîõüÿ", "abcdef", "banana", "letters"]
    def misspelt(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("xyzÀ") + w[i:], w[:i] + rng.choice("xyz") + w[i + 1 :]])
    pool = [*stems, *[misspelt(w) for w in stems for _ in range(4)]]
    pool += [misspelt(w) for w in pool]
    weights = [60] * len(stems) + [8] * (4 * len(stems)) + [1] * (len(pool) - 5 * len(stems))
    docs = []
    for d in range(120):
        words = rng.choices(pool, weights, k=rng.randint(0, 60))
        docs.append((d if d % 9 else None, rng.choice([" ", ", ", "1", "_\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    docs += [(500, None), (501, ""), (502, "×÷×÷×÷ " * 7), (503, "Long" * 3_000 + " " + "spelling " * 30_000), docs[3], docs[3]]
    return docs + [(504 + i, "q" * 900 + " " + "q" * 450 + "r" + "q" * 450) for i in range(6)]


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, tmp_path, seed):
    docs = _docs(seed)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, WORD string").repartition(5)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_spelling_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    want = plain_variants(docs)
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert any(r[1] and r[2] != r[1] for r in want) and any(r[1] is None and r[4] for r in want)


def test_root_follows_a_chain(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 9 else None) for i in range(10)]
    rows = S.with_roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r["root"] for r in rows} == {"w9"} and len(rows) == 10


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_variants(empty).collect() == []
