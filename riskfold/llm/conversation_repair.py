"""Repair of conversation structure: the cheapest edits that make the roles alternate, by iterative-deepening A*.

A conversation's turns are faulty (blank, a copy of an earlier turn, cut off in the middle of a sentence) and its
roles out of order.  Edits, named by their initials:

* Keep a turn (0), Rerole it to user or assistant (1); either costs 5 more if the turn is truncated;
* Delete a turn (2); blank and duplicate turns must go;
* Insert an empty turn of user or assistant anywhere (5).

The repaired roles read: nothing, or an optional system turn and then user and assistant in turns, assistant last.
Of the cheapest edit sequences the one whose initials are least in ASCII order is taken.

Search: depth first over (turn, expected role), edits in the order D, I, K, R, under a cost bound that starts at
the heuristic (2 for every turn that must go or pay at least that) and rises to the least cost beyond it.  The
transposition table remembers for each state that failed the least cost it is known to need, and keeps it for the
next bound.  The first accepting path is the answer.  Long conversations are searched in blocks of ``BLOCK`` turns
from the last one on: what a block costs from each expected role is the exact heuristic at the border for the block
before it, so the time grows with the number of turns, not its square.

Layout: every turn is dealt out by conversation twice, first without its text (what the search needs), then with
it, and sorted, so a task reads a conversation's turns as a stream and holds a few bytes a turn, no texts.  The hash
of a conversation is one chain: a conversation is one task's work, however long.

Rules for odd rows: NULL roles and texts read as one space, an empty role likewise; a role is judged by its first
character; NULL turns come first; turns of equal number are ordered by role, then by the md5 of the text; repeated
rows are turns of their own (the later ones are duplicates); rows whose conversation is NULL are one conversation;
an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 128

# Expected next: at the start, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind each kept role, by state; a role that does not fit is not there.
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state behind a rerole or an insert, and the role it takes.
TURN_TO = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant", SYSTEM: "system"}
ACCEPTING = (True, False, False, True)

NOT_SPACE = r"[^\x20\x09-\x0D]"

REPORT = T.StructType([T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])


def _block_search(rows: list[tuple[str, bool, bool]], state: int, beyond: list[int] | None) -> tuple[int, str, int]:
    """(cost, edits, last state) of the cheapest repair of ``rows`` from ``state`` on.

    ``rows``: (initial, must go, truncated).  ``beyond``: cost from each state behind the last row (None: the
    conversation ends there).  The cost counts what lies beyond.
    """
    n = len(rows)
    rest = [0] * n + [min(beyond) if beyond else 0]
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if rows[i][1] or rows[i][2] else 0)
    table: dict[tuple[int, int], int] = {}

    def need(i: int, q: int) -> int:
        if i == n and beyond:
            return beyond[q]
        return table.get((i, q), rest[i])

    def search(i: int, q: int, budget: int) -> tuple[list[str], int] | int:
        """Edits (last first) and the last state, or the least cost that is known to be needed."""
        least = need(i, q)
        if least > budget:
            return least
        if i == n and (beyond or ACCEPTING[q]):
            return [], q
        moves = []
        if i < n:
            initial, must_go, truncated = rows[i]
            moves.append(("D", DELETE, i + 1, q))
        moves.append(("I", INSERT, i, TURN_TO[q]))
        if i < n and not must_go:
            extra = TRUNCATED if truncated else 0
            if initial in AFTER[q]:
                moves.append(("K", KEEP + extra, i + 1, AFTER[q][initial]))
            moves.append(("R", REROLE + extra, i + 1, TURN_TO[q]))
        least = None
        for edit, cost, j, p in moves:
            found = search(j, p, budget - cost) if cost <= budget else need(j, p)
            if not isinstance(found, int):
                found[0].append(edit)
                return found
            least = cost + found if least is None else min(least, cost + found)
        table[i, q] = least
        return least

    bound = need(0, state)
    while isinstance(found := search(0, state, bound), int):
        bound = found
    return bound, "".join(reversed(found[0])), found[1]


def cheapest_edits(rows: list[tuple[str, bool, bool]], block: int = BLOCK) -> tuple[int, str]:
    """(cost, initials of the edits) for the turns ``rows``: (initial of the role, must go, truncated)."""
    starts = list(range(0, max(len(rows), 1), block))
    found: dict[tuple[int, int], tuple[int, str, int]] = {}
    beyond = None
    for at in reversed(starts):
        for q in (START, SYSTEM, USER, ASSISTANT) if at else (START,):
            found[at, q] = _block_search(rows[at : at + block], q, beyond)
        beyond = [found[at, q][0] for q in range(4)] if at else beyond
    edits, q = [], START
    for at in starts:
        _, path, q = found[at, q]
        edits.append(path)
    return found[0, START][0], "".join(edits)


def _turn_rows(turns: DataFrame, also: DataFrame | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows in the order of the stream: of each conversation a marker (0), its turns without text (1), with text (2)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    role = F.when(F.coalesce(F.length(F.col(role_col)), F.lit(0)) == 0, F.lit(" ")).otherwise(F.col(role_col).cast("string"))
    last = F.regexp_extract(text, "(" + NOT_SPACE + r")[\x20\x09-\x0D]*\z", 1)
    turn = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"),
    )
    both = turn.withColumn("kind", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("text", F.when(F.col("kind") == 2, F.col("text")))
    if also is not None:
        marker = also.select(F.col(conv_col).alias("conv"), F.lit(0).alias("kind"))
        both = both.unionByName(marker, allowMissingColumns=True)
    order = ["conv", "kind", "turn", "role", "digest"]
    return both.repartition("conv").sortWithinPartitions(*order).select(*order, "blank", "truncated", "text")


class _Conversation:
    """What the stream has shown of one conversation."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, bool, bool]] = []
        self.seen: set[tuple[str, bytes]] = set()
        self.turns: set[int] = set()
        self.blank = self.duplicate = self.truncated = 0
        self.edits: str | None = None
        self.at = 0

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, truncated: bool) -> None:
        key = (role, digest)
        repeat = not blank and key in self.seen
        self.seen.add(key)
        cut = truncated and not blank and not repeat
        self.blank += blank
        self.duplicate += repeat
        self.truncated += cut
        self.rows.append((role[0], blank or repeat, cut))
        if turn is not None:
            self.turns.add(turn)

    def decide(self) -> tuple[int, ...]:
        """The report; from here on ``edits`` are known."""
        cost, self.edits = cheapest_edits(self.rows)
        legal = {"su", "ua", "au"}
        illegal = sum(a[0] + b[0] not in legal for a, b in zip(self.rows, self.rows[1:], strict=False))
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        self.seen.clear()
        return gaps, self.blank, self.duplicate, self.truncated, illegal, cost


def repair(turns: DataFrame, also: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The edits of every conversation of ``turns`` and ``also`` (conversations that may have no turns).

    (conversation, seq, edit, turn, role, text, report): ``seq`` -1 carries the report (gaps, blank, duplicate,
    truncated, illegal, cost); 0 and on are the edits in order, with the repaired role and text (NULL for a
    deleted turn; the turn number is NULL for an inserted one).  Rows of a conversation follow each other in
    one partition in the order of ``seq``.
    """
    rows = _turn_rows(turns, also, conv_col, turn_col, role_col, text_col)
    out = T.StructType(
        [T.StructField(conv_col, turns.schema[conv_col].dataType), T.StructField("seq", T.LongType()), T.StructField("edit", T.StringType()),
         T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("report", REPORT)]
    )
    names = REPORT.names

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        now: object = edit  # no conversation yet
        conv = _Conversation()
        ready: list[tuple] = []

        def decide() -> None:
            ready.append((now, -1, None, None, None, None, dict(zip(names, conv.decide(), strict=True))))
            conv.state = START

        def inserted() -> None:
            while conv.edits[conv.at : conv.at + 1] == "I":
                step(None, None, None)

        def step(turn: int | None, role: str | None, text: str | None) -> None:
            what = conv.edits[conv.at]
            if what in "IR":
                conv.state = TURN_TO[conv.state]
                role = ROLE_OF[conv.state]
                text = "" if what == "I" else text
            elif what == "K":
                conv.state = AFTER[conv.state][role[0]]
            else:
                role = text = None
            ready.append((now, conv.at, what, turn, role, text, None))
            conv.at += 1

        def end() -> None:
            if now is edit:
                return
            if conv.edits is None:
                decide()
            inserted()

        def packed() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True)) if ready else [[]] * len(schema)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            ready.clear()
            return batch

        for b in batches:
            for key, kind, turn, role, digest, blank, truncated, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if now is edit or key != now:
                    end()
                    now, conv = key, _Conversation()
                if kind == 1:
                    conv.add(turn, role, digest, blank, truncated)
                elif kind == 2:
                    if conv.edits is None:
                        decide()
                    inserted()
                    step(turn, role, text)
            yield packed()
        end()
        yield packed()

    return rows.mapInArrow(edit, out)


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """The turns of ``repair`` that are left or new, in any order: (conversation, seq, role, text)."""
    return repaired.filter("seq >= 0 AND edit != 'D'").drop("edit", "turn", "report")


def summaries(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """A row for each conversation of ``repair``, which must come as that left it (no shuffle, no file between).

    (conversation, the report's columns, ``audit``: the edits' initials in order, ``repaired_sha256``: hash of
    the repaired ``role:text``, joined by line ends).  Texts are hashed as they stream by.
    """
    out = T.StructType(
        [T.StructField(conv_col, repaired.schema[conv_col].dataType), *REPORT.fields, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )
    names = REPORT.names

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        head, edits, digest, ready = None, [], None, []

        def end() -> None:
            if head is not None:
                ready.append((*head, "".join(edits), digest.hexdigest()))

        def packed() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True)) if ready else [[]] * len(schema)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            ready.clear()
            return batch

        for b in batches:
            for key, seq, edit, role, text, report in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if seq == -1:
                    end()
                    head, edits, digest, first = (key, *[report[n] for n in names]), [], hashlib.sha256(), True
                    continue
                edits.append(edit)
                if edit != "D":
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            yield packed()
        end()
        yield packed()

    return repaired.select(conv_col, "seq", "edit", "role", "text", "report").mapInArrow(sums, out)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with planted faults: by crc32(``conv_id:turn``) % 20 a turn is dropped (0), emptied (1),
    loses its ``.!?`` (2), comes twice (3) or gets the role user (4).  NULL ids, turns, roles and texts: one space.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault: Column = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text"))
    kept = conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).filter("fault != 0")
    role = F.when(F.col("fault") == 4, "user").otherwise(named("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
