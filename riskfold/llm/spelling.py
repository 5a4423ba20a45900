"""Spelling variants: pairs of vocabulary words one edit apart, by composing finite-state machines.

The vocabulary acceptor is composed with a transducer that makes exactly one insertion, deletion or replacement,
and with the acceptor again; accepted pairs are the near words.

* Partitions.  A pair's edit lies in the first or in the second half of the shorter word, and the other half is the
  same in both.  So the composed machine is cut by the state that it starts from: the words that share a first half
  (the acceptor behind that prefix), or share a second half (the acceptor in front of that suffix).  Each partition
  composes the part of the acceptor in its *middle*, for words of the shorter length and one longer.  A partition of
  more than ``MAX_PARTITION`` words is cut again, by the halves of its middle, until it fits or a single character
  is left (then it holds at most an alphabet's words): no cap, no lost pair, and no task holds a hot prefix.
* Acceptor.  Minimised: states with the same right language are one state, in both lengths alike.
* Transducer.  Unambiguous: the edit is where the words differ first, an inserted character is not the next one of
  the shorter word, so each pair comes out once, in one partition.
* Composition.  Before the edit both acceptors are in the state of the same prefix; behind it they must read the
  same, so the pair of states is explored for what both accept, remembered for each pair of states.

From the pairs come each word's near words, its form (the near word of largest count, if that is enough times its
own) and its root (the last word that the forms lead to, by pointer doubling; counts grow along forms, so they end).

Words are counted inside each task before the shuffle; pairs are summed up by word without being gathered.

Rules for odd rows: NULL and empty texts have no words; repeated rows count as often as they stand; a NULL id reads
as the empty string; ties go to the smaller word in code-point order; an empty table gives no rows; other columns
are not carried.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import saved, text_of

RUN = "[a-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
MAX_PARTITION = 4_096
#: Distinct words that a task holds before it hands on their counts.
HELD_WORDS = 300_000


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, damage: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lowered, of at least ``min_length`` characters, over all texts.

    ``damage``: a run loses the character h % length if ``damage`` divides h, the crc32 of ``<id>:<run>``.
    """
    out = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, crc32 = re.compile(RUN).findall, zlib.crc32
        held: Counter[str] = Counter()

        def packed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=out.names)
            held.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                runs = Counter(find(text.as_py().encode().lower().decode()))  # bytes: A-Z only
                start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs.items():
                    if len(run) < min_length:
                        continue
                    if damage:
                        h = crc32(run.encode(), start)
                        if h % damage == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_length:
                                continue
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield packed()
        yield packed()

    counted = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(rows, out)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# ---- one partition: acceptor, transducer, composition


class Acceptor:
    """Minimal deterministic acceptors of sets of words, all states in one register."""

    def __init__(self) -> None:
        self.states: dict[tuple[tuple[str, int], ...], int] = {(): 0}
        self.arcs: list[dict[str, int]] = [{}]
        self.shared: dict[tuple[int, int], list[str]] = {}
        self.swaps: dict[int, list[tuple[str, str]]] = {}

    def add(self, words: list[str], at: int = 0) -> int:
        """The state that accepts ``words`` (sorted, distinct, of one length) from character ``at`` on; 0 accepts the end."""
        if at == len(words[0]):
            return 0
        arcs, first = {}, 0
        for i in range(1, len(words) + 1):
            if i == len(words) or words[i][at] != words[first][at]:
                arcs[words[first][at]] = self.add(words[first:i], at + 1)
                first = i
        key = tuple(arcs.items())
        state = self.states.setdefault(key, len(self.arcs))
        if state == len(self.arcs):
            self.arcs.append(arcs)
        return state

    def both(self, p: int, q: int) -> list[str]:
        """What the states ``p`` and ``q`` both accept (behind the edit the two words read the same)."""
        if p == 0 or q == 0:
            return [""] if p == q else []
        key = (p, q) if p < q else (q, p)
        found = self.shared.get(key)
        if found is None:
            a, b = self.arcs[p], self.arcs[q]
            found = [c + rest for c, state in a.items() if c in b for rest in self.both(state, b[c])]
            self.shared[key] = found
        return found

    def replaced(self, q: int) -> list[tuple[str, str]]:
        """Pairs of words accepted from ``q`` that differ by one replacement, the smaller word first."""
        found = self.swaps.get(q)
        if found is None:
            arcs = sorted(self.arcs[q].items())
            found = [(c + u, c + v) for c, state in arcs for u, v in self.replaced(state)]
            for i, (c, p) in enumerate(arcs):
                for d, r in arcs[i + 1 :]:
                    found += [(c + rest, d + rest) for rest in self.both(p, r)]
            self.swaps[q] = found
        return found

    def inserted(self, q: int, r: int, at_end: bool) -> list[tuple[str, str]]:
        """(shorter, longer): a word from ``q`` and one from ``r`` that has one character more."""
        short, long = self.arcs[q], self.arcs[r]
        found = [(c + u, c + v) for c, state in short.items() if c in long for u, v in self.inserted(state, long[c], at_end)]
        for d, state in long.items():
            # where the words differ first: the shorter one does not go on with the inserted character
            found += [(rest, d + rest) for rest in self.both(q, state) if (rest[0] != d if rest else at_end)]
        return found


def near_pairs(middles: list[str], length: int, at_end: bool) -> list[tuple[str, str]]:
    """Pairs one edit apart among ``middles`` of ``length`` and one more character, the shorter (or smaller) first.

    Pairs of two longer ones are not meant.  ``at_end``: whether the inserted character may follow a whole middle.
    """
    words = sorted(set(middles))
    short, long = [w for w in words if len(w) == length], [w for w in words if len(w) == length + 1]
    if not short:
        return []
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * length + 1_000))
    machine = Acceptor()
    q = machine.add(short)
    found = list(machine.replaced(q)) if length else []
    if long:
        found += machine.inserted(q, machine.add(long), at_end)
    return found


# ---- all partitions


def _halves(length: str, lead: str, trail: str, cuts: DataFrame) -> DataFrame:
    """Two rows for each of ``cuts``: a partition is (length, lead, trail, key), its middle is cut in two.

    ``length`` is the shorter words' length, ``lead`` and ``trail`` are the lengths of the shared ends, ``key`` is
    these ends with a blank between them.
    """
    middle = F.col(length) - F.col(lead) - F.col(trail)
    first = F.floor(middle / 2).cast("int")
    second = (middle - first).cast("int")
    ends = F.array(
        F.struct((F.col(lead) + first).alias("lead"), F.col(trail).alias("trail")),
        F.struct(F.col(lead).alias("lead"), (F.col(trail) + second).alias("trail")),
    )
    cut = cuts.withColumn("_end", F.explode(ends)).withColumns({"lead": F.col("_end.lead"), "trail": F.col("_end.trail")}).drop("_end")
    return cut.withColumn("key", F.concat(F.substring("word", F.lit(1), F.col("lead")), F.lit(" "), _tail("word", "trail")))


def _tail(word: str, n: str) -> Column:
    return F.when(F.col(n) == 0, "").otherwise(F.substring(F.col(word), F.length(word) - F.col(n) + 1, F.col(n)))


PARTITION = ["length", "lead", "trail", "key"]


def partitions(words: DataFrame, max_partition: int = MAX_PARTITION) -> DataFrame:
    """(word, n, length, lead, trail, key): every word in the partitions that it may have a near word in.

    As the shorter word of a pair (or one of two equally long ones) a word is in partitions of its own length, as
    the longer one in those of one less.
    """
    roles = words.withColumn("length", F.explode(F.array(F.length("word"), F.length("word") - 1))).withColumns(
        {"lead": F.lit(0), "trail": F.lit(0)}
    )
    rows = saved(_halves("length", "lead", "trail", roles), "spelling-partitions")
    done = None
    while True:
        # one character left: the partition holds an alphabet's words at most (two, of the longer ones)
        hot = saved(
            rows.filter("length - lead - trail > 1").groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > max_partition).drop("size"),
            "spelling-hot",
        )
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        fit = rows.join(hot, PARTITION, "left_anti")
        done = saved(fit if done is None else done.unionByName(fit), "spelling-fit")
        again = rows.join(hot, PARTITION, "left_semi").select("word", "n", "length", "lead", "trail")
        rows = saved(_halves("length", "lead", "trail", again), "spelling-partitions")


def links(words: DataFrame, max_partition: int = MAX_PARTITION) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of ``words`` (word, n) that is one edit apart, once."""
    out = T.StructType(
        [T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("near", T.StringType()), T.StructField("near_n", T.LongType())]
    )
    dealt = partitions(words, max_partition).repartition(*PARTITION).sortWithinPartitions(*PARTITION).select(*PARTITION, "word", "n")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], []

        def end() -> None:
            if len(held) < 2:
                return
            length, lead, trail, _ = now
            middles = {w[lead : len(w) - trail]: (w, n) for w, n in held}
            for u, v in near_pairs(list(middles), length - lead - trail, at_end=trail == 0):
                ready.append((*middles[u], *middles[v]))

        def packed() -> pa.RecordBatch:
            a = list(zip(*ready, strict=True)) or [[]] * 4
            both = [(*a[0], *a[2]), (*a[1], *a[3]), (*a[2], *a[0]), (*a[3], *a[1])]
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(both, (pa.string(), pa.int64()) * 2, strict=True)], names=out.names)

        for b in batches:
            for *key, word, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if key != now:
                    end()
                    now, held = key, []
                    if len(ready) > 50_000:
                        yield packed()
                held.append((word, n))
        end()
        yield packed()

    return dealt.mapInArrow(compose, out)


def forms(words: DataFrame, factor: int = FACTOR, max_partition: int = MAX_PARTITION) -> DataFrame:
    """(word, n, n_near, form, form_n): near words counted, and the form of each word that has one."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = links(words, max_partition).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    enough = -F.col("best.less") >= F.lit(factor) * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def with_roots(table: DataFrame) -> DataFrame:
    """``table`` (word, form, ...) with ``root``: from each word the forms are followed to the last."""
    state = saved(table.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        state = saved(
            state.join(onward, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")),
            "spelling-roots",
        )
        settled = state.filter("_moved").isEmpty()
        state = state.drop("_moved")
        if settled:
            break
    return table.join(state, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, factor: int = FACTOR, damage: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", max_partition: int = MAX_PARTITION) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for all words of ``docs`` of at least ``min_count`` occurrences."""
    counted = count_words(docs, min_length, damage, id_col, text_col).filter(F.col("n") >= min_count)
    words = saved(counted, "spelling-words")
    return with_roots(saved(forms(words, factor, max_partition), "spelling-forms"))
