"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Score.  Smith-Waterman over words (match 2, mismatch and gap -1); the score
   over its greatest value is the similarity, and ``threshold`` 0.7 is about
   one word in five replaced or dropped, or one added for every two.
2. Bound.  An alignment of k matches and b other steps has a score of 2k - b, so
   one that passes for an item of m words has b <= 2k - 2m * threshold, and its
   matches stand in at most b + 1 runs: at least m * (2 * threshold - 1) - 1 pairs
   of neighbouring words of the item are intact, on diagonals at most
   2m * (1 - threshold) apart.
3. Counts.  How often each word pair of the test items occurs in the whole
   corpus; a task's counts are summed before the shuffle.  The same pass writes
   down, as word numbers, the texts that hold enough pairs of an item at all.
4. Seeds.  Of an item's pairs the most frequent ones are left out, half as many
   as must be intact; the rest are its rare seeds.  Whatever pairs an edited copy
   has lost, the other half of those it must keep are seeds.
5. Join.  Seeds found in a text put its passage against the item, along the
   diagonal where they meet; seeds whose diagonals are no further apart than the
   gaps of a passing alignment share one passage.  A passage with too few
   different seeds of the item cannot pass; the others are scored.

So no passage that passes is missed.  Only test items travel to the tasks,
``items_per_pass`` at a time (their words and pairs are the broadcast's size
bound); the corpus is never shuffled.

Rules: words are runs of letters, digits and underscores in lower case; items
under three words match nothing; NULL and empty texts likewise; equal items and
repeated rows each give their own matches; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import saved, text_key, text_of

WORD = re.compile(r"\w+")
#: Words of a seed, of the least item, and the threshold above which the bound on intact pairs holds for all items.
PAIR, LEAST_WORDS, LEAST_THRESHOLD = 2, 3, 2 / 3

MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
    ]
)


class Items:
    """Test items as word numbers, and their pairs of neighbouring words as single numbers."""

    def __init__(self, rows: list[tuple[int, str]], threshold: float):
        if threshold <= LEAST_THRESHOLD:
            raise ValueError(f"the threshold must be over {LEAST_THRESHOLD:.3f}: below it a passing copy need not keep two neighbouring words")
        self.ids = [i for i, _ in rows]
        words = [WORD.findall((t or "").lower()) for _, t in rows]
        self.number = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}), 1)}
        self.words = [np.array([self.number[w] for w in ws], np.int64) for ws in words]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.base = len(self.number) + 1
        if self.base**PAIR >= 2**63:
            raise ValueError("too many distinct words for one pass: lower items_per_pass")
        # a rounding error must not ask for one more
        intact = np.maximum(np.ceil(self.sizes * (2 * threshold - 1) - 1 - 1e-6), 1).astype(np.int64)
        self.spared = intact // 2
        self.needed = intact - self.spared
        self.reach = np.floor(2 * self.sizes * (1 - threshold) + 1e-6).astype(np.int64)
        grams = [self.grams(w) if len(w) >= LEAST_WORDS else np.zeros(0, np.int64) for w in self.words]
        self.gram = np.concatenate([np.zeros(0, np.int64), *grams])
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        self.place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]]).astype(np.int64)

    def numbers(self, text: str) -> np.ndarray:
        """A text's words: their numbers, 0 for a word of no item."""
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))

    def grams(self, words: np.ndarray) -> np.ndarray:
        """The pair at each position; -1 where a word is in no item."""
        if len(words) < PAIR:
            return np.zeros(0, np.int64)
        return np.where((words[:-1] > 0) & (words[1:] > 0), words[:-1] * self.base + words[1:], -1)

    def seeds(self, counts: dict[int, int]) -> np.ndarray:
        """Which of ``gram`` are seeds: all of an item's pairs but its ``spared`` most frequent ones (ties: the first)."""
        seen = np.fromiter((counts.get(g, 0) for g in self.gram.tolist()), np.int64, len(self.gram))
        order = np.lexsort((self.place, -seen, self.item))
        first = np.searchsorted(self.item[order], np.arange(len(self.ids)))
        rank = np.arange(len(order)) - first[self.item[order]]
        keep = np.zeros(len(order), bool)
        keep[order] = rank >= self.spared[self.item[order]]
        return keep


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best local score over its greatest value (2 a word), and the passage position where it ends."""
    across = np.arange(1, len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for w in item:
        step = np.maximum(row[:-1] + np.where(passage == w, 2, -1), row[1:] - 1)
        step = np.maximum(step, 0)
        # a gap along the passage costs one a word: a running maximum of score plus position
        row = np.concatenate([[0], np.maximum.accumulate(step + across) - across])
        row = np.maximum(row, 0)
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top - 1
    return best / (2 * len(item)), end


FIRST_LOOK = T.StructType(
    [T.StructField("gram", T.LongType()), T.StructField("n", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("words", T.BinaryType())]
)


def _first_look(rows: DataFrame, items: Items) -> DataFrame:
    """What one pass over the texts (doc_id, text_key, text) gives, written down.

    Rows (gram, n): a batch's counts of the items' pairs.  Rows (doc_id, text_key, words): the texts that hold as many
    different pairs of an item as an intact copy must, anywhere and whatever their order, as word numbers.
    """
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        known, entry = np.unique(held.gram, return_inverse=True)
        by_gram = np.argsort(entry, kind="stable")
        first = np.searchsorted(entry[by_gram], np.arange(len(known) + 1))
        intact = held.spared + held.needed
        seen = np.zeros(len(known), np.int64)
        for b in batches:
            doc_id, text_key, words = [], [], []
            for i, t in enumerate(b.column(2)):
                numbers = held.numbers(t.as_py())
                g = held.grams(numbers)
                g = g[g >= 0]
                if not len(g) or not len(known):
                    continue
                at = np.minimum(np.searchsorted(known, g), len(known) - 1)
                met, n = np.unique(at[known[at] == g], return_counts=True)
                seen[met] += n
                size = first[met + 1] - first[met]
                places = by_gram[np.repeat(first[met] - np.cumsum(size) + size, size) + np.arange(size.sum())]
                if (np.bincount(held.item[places], minlength=len(held.ids)) >= intact).any():
                    doc_id.append(b.column(0)[i].as_py())
                    text_key.append(b.column(1)[i].as_py())
                    words.append(numbers.astype(np.int32).tobytes())
            none = pa.nulls(len(words), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.array(doc_id, pa.int64()), pa.array(text_key, pa.int64()), pa.array(words, pa.binary())], names=FIRST_LOOK.names
            )
        found = np.flatnonzero(seen)
        none = pa.nulls(len(found), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(known[found]), pa.array(seen[found]), none, none, pa.nulls(len(found), pa.binary())], names=FIRST_LOOK.names)

    return saved(rows.mapInArrow(look, FIRST_LOOK), "benchmark-look")


def matches_in(words: np.ndarray, items: Items, order: np.ndarray, threshold: float) -> list[tuple[int, float, int, int]]:
    """(item number, similarity, first word, last word) of a text's best passage for each item it holds.

    ``order`` lists the seeds (positions in ``items.gram``) by n-gram.
    """
    grams = items.grams(words)
    where = np.flatnonzero(grams >= 0)
    seeds = items.gram[order]
    lo, hi = np.searchsorted(seeds, grams[where], "left"), np.searchsorted(seeds, grams[where], "right")
    count = hi - lo
    if not count.sum():
        return []
    at = np.repeat(where, count)
    met = order[np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    item = items.item[met]
    enough = np.bincount(item, minlength=len(items.ids)) >= items.needed
    met, at, item = met[enough[item]], at[enough[item]], item[enough[item]]
    if not len(met):
        return []
    # one passage for each item and stretch of neighbouring diagonals
    diagonal = at - items.place[met]
    by = np.lexsort((diagonal, item))
    item, diagonal, place = item[by], diagonal[by], items.place[met[by]]
    new = np.concatenate([[True], (np.diff(item) != 0) | (np.diff(diagonal) > items.reach[item[1:]])])
    stretch = np.cumsum(new) - 1
    different = np.unique(stretch * (int(items.sizes.max()) + 1) + place) // (int(items.sizes.max()) + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(item)) - 1
    passing = np.flatnonzero(np.bincount(different, minlength=len(first)) >= items.needed[item[first]])
    best: dict[int, tuple[int, float, int, int]] = {}
    for a, b in zip(first[passing].tolist(), last[passing].tolist(), strict=True):
        i = int(item[a])
        own, reach = items.words[i], int(items.reach[i])
        begin = max(0, int(diagonal[a]) - reach)
        passage = words[begin : int(diagonal[b]) + len(own) + reach]
        similarity, end = smith_waterman(own, passage)
        if similarity >= threshold and (i not in best or similarity > best[i][1]):
            last = begin + end
            _, back = smith_waterman(own[::-1], words[begin : last + 1][::-1])
            best[i] = (i, similarity, last - back, last)
    return [best[i] for i in sorted(best)]


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    items_per_pass: int = 20_000,
) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, first_word, last_word): texts that hold a test item, edited or not.

    The best passage of each text and item; positions count words from 0.  ``threshold`` must be over 2/3.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), text_of(text_col).alias("text")
    )
    listed = benchmark.select(F.col(item_col).cast("long").alias("i"), text_of(item_text_col).alias("t"))
    parts = -(-listed.count() // items_per_pass)
    found = None
    for part in range(parts):
        own = listed if parts == 1 else listed.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
        items = Items(sorted(((r.i, r.t) for r in own.toLocalIterator()), key=str), threshold)
        look = _first_look(rows, items)
        counts = look.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()  # at most the items' own pairs
        keep = items.seeds(dict(zip(counts["gram"].tolist(), counts["n"].tolist(), strict=True)))
        order = np.flatnonzero(keep)[np.argsort(items.gram[keep], kind="stable")]
        shared = spark.sparkContext.broadcast((items, order))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held, seeds = shared.value
            for b in batches:
                hits = [(k, *m) for k, w in enumerate(b.column(2)) for m in matches_in(np.frombuffer(w.as_buffer(), np.int32).astype(np.int64), held, seeds, threshold)]
                row = pa.array([h[0] for h in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(row),
                        b.column(1).take(row),
                        pa.array([held.ids[h[1]] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.float64()),
                        pa.array([h[3] for h in hits], pa.int64()),
                        pa.array([h[4] for h in hits], pa.int64()),
                    ],
                    names=MATCHES.names,
                )

        step = look.filter("words IS NOT NULL").select("doc_id", "text_key", "words").mapInArrow(search, MATCHES)
        found = step if found is None else found.unionByName(step)
    return found if found is not None else spark.createDataFrame([], MATCHES)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows whose text holds a test item (see :func:`find_matches`)."""
    hits = saved(find_matches(docs, benchmark, id_col=id_col, text_col=text_col, **settings), "leaks")
    keys = hits.select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_leak_id")) & (text_key(text_col) == F.col("_leak_key"))
    return docs.join(keys, same, "left_anti")
