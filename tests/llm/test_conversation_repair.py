import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from riskfold.llm import conversation_repair as C
from riskfold.llm.queries import QUERIES

SPACE = " \t\n\x0b\f\r"


def plain_edits(rows):
    """The least (cost, initials) by working backwards over every turn and expected role."""
    def steps(i, q):
        if i < len(rows):
            initial, must_go, cut = rows[i]
            yield "D", 2, i + 1, q
            if not must_go:
                nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((q, initial))
                if nxt:
                    yield "K", 5 * cut, i + 1, nxt
                yield "R", 1 + 5 * cut, i + 1, "a" if q == "u" else "u"

    best = {}
    for i in range(len(rows), -1, -1):
        now = {q: (0, "") for q in ("", "a")} if i == len(rows) else {}
        for q in ("", "s", "u", "a"):
            options = [(c + best[j, p][0], e + best[j, p][1]) for e, c, j, p in steps(i, q)]
            now[q] = min([*options, *([now[q]] if q in now else [])], default=(10**9, ""))
        for _ in range(4):  # inserts lead to another state at the same turn
            for q in now:
                p = "a" if q == "u" else "u"
                now[q] = min(now[q], (5 + now[p][0], "I" + now[p][1]))
        best.update({(i, q): v for q, v in now.items()})
    return best[0, ""]


@pytest.mark.parametrize("block", [1, 2, 3, 128])
def test_search_against_working_backwards(block):
    rng = random.Random(block)
    for _ in range(1500):
        rows = [(rng.choice("ssuuuaaa "), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(0, 9))]
        assert C.cheapest_edits(rows, block) == plain_edits(rows), rows


def test_long_conversation():
    rng = random.Random(3)
    rows = [(rng.choice("uuuaaas"), rng.random() < 0.05, rng.random() < 0.05) for _ in range(3_000)]
    assert C.cheapest_edits(rows) == plain_edits(rows)
    assert C.cheapest_edits([("u", False, False), ("a", False, False)] * 30_000) == (0, "K" * 60_000)


def plain_repair(conversation):
    """The contract's row (without conv_id) for one conversation's turns [(turn, role, text)], damaged and sorted."""
    seen, rows, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in conversation:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            n[fault] += 1
        rows.append((role[0], fault in ("blank", "duplicate"), fault == "truncated"))
    initials = [r[0] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    turns = {t for t, _, _ in conversation if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = plain_edits(rows)
    out, at, q = [], 0, ""
    for e in audit:
        role, text = (None, "") if e == "I" else conversation[at][1:]
        at += e != "I"
        if e != "D":
            role = role if e == "K" else "assistant" if q == "u" else "user"
            q = role[0]
            out.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return (gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_query(table):
    """Results by conversation for [(conv_id, turn, role, text)]."""
    found = {c: [] for c, _, _, _ in table}
    for c, turn, role, text in table:
        text, role = " " if text is None else text, " " if role is None else role or " "
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        found[c] += [(turn, role, text)] * (2 if fault == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    return {c: plain_repair(sorted(rows, key=order)) for c, rows in found.items()}


def _random_table(seed):
    rng = random.Random(seed)
    texts = ["Fine.", "Yes!", "cut off", "", None, " \t\n", "Well? \r\n", "Fine.", "très bien.", "é", "dot . inside", "\x1f.", "ends. \x1c"]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    weights = [8, 8, 3, 1, 1, 1, 1]
    table = []
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 9)):
            turn = rng.choice([t, t, t, t + 2, None])
            table.append((c, turn, rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.4 else f"Text {t}."))
    table += [table[5]] * 3 + [(900, 0, "user", "long " * 200_000 + "."), (900, 1, "assistant", "y" * 300_000 + "!")]
    table += [(901, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)]
    rng.shuffle(table)
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, tmp_path, seed):
    table = _random_table(seed)
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    df.selectExpr("*", "'x' AS seq", "1 AS Report").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = got.collect()
    want = plain_query(table)
    assert len(rows) == len(want)
    for conv, *rest in rows:
        assert tuple(rest) == want[conv], conv


def test_repaired_turns_carry_the_texts(spark):
    table = [(1, 0, "user", "Hello."), (1, 1, "user", "More?"), (1, 2, "assistant", "Yes."), (2, 0, "assistant", " ")]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    rows = C.repair(df).collect()
    got = {c: [(r["edit"], r["turn"], r["role"], r["text"]) for r in rs if r["seq"] >= 0] for c, rs in groupby(sorted(rows, key=lambda r: (r["conv_id"], r["seq"])), key=lambda r: r["conv_id"])}
    assert got == {1: [("D", 0, None, None), ("K", 1, "user", "More?"), ("K", 2, "assistant", "Yes.")], 2: [("D", 0, None, None)]}
    assert sorted(map(tuple, C.repaired_turns(C.repair(df)).collect())) == [(1, 1, "user", "More?"), (1, 2, "assistant", "Yes.")]


def test_empty_table_and_conversations_without_turns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.summaries(C.repair(empty)).collect() == []
    also = spark.createDataFrame([(7,), (None,), (7,)], "conv_id long")
    rows = C.summaries(C.repair(empty, also=also)).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, rows), key=str) == [(7, 0, 0, 0, 0, 0, 0, "", none), (None, 0, 0, 0, 0, 0, 0, "", none)]
