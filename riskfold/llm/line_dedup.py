"""Line dedup by winnowing: repeated runs of lines are deleted, the first copy stays.

A run is a stretch of consecutive lines; one of at least ``min_words`` words
counts.  Around every line a *window* is the shortest run that reaches
``min_words`` words, once grown forwards from the line and once backwards.

1. Winnow: each window's least line hash (the last of equals) is selected as
   fingerprint.  A shared run holds a whole window, and a window's selection
   depends on its content alone, so every shared run has a shared fingerprint.
2. Join: fingerprints selected at two or more positions are kept, and with
   them the windows they stand for.
3. Extend: windows of equal content are grouped under their first place in the
   corpus (by id, text hash, line).  A later window is a verified repeat; the
   windows grown forwards and backwards overlap, so together they are the
   longest match both ways.
4. Delete the lines of all later windows.

A deleted line always has an equal line at an earlier place, so no content is
lost.  Minima are combined before each shuffle and joined back: no task gathers
a window's or a fingerprint's occurrences.

Rules: lines are compared without white space at their ends; blank lines belong
to no window but go with the run around them; NULL and empty texts pass
unchanged; rows that repeat both id and text are one document and treated
alike; an empty table gives no rows; a column named ``lines_removed`` gives way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.common import saved, text_key, text_of, without

WINDOWS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "text_key", "fingerprint", "content", "first", "last", "place")]
)


def windows(text: str, min_words: int) -> list[tuple[int, int, int, int, int]]:
    """(fingerprint, content hash, first line, last line, selected line) of every window of a text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    lines = text.split("\n")
    at = [i for i, line in enumerate(lines) if line and not line.isspace()]
    if not at:
        return []
    words = np.fromiter((len(lines[i].split()) for i in at), np.int64, len(at))
    total = np.concatenate([[0], np.cumsum(words)])
    if total[-1] < min_words:
        return []
    hashes = np.fromiter((digest(lines[i].strip().encode()) for i in at), np.uint64, len(at)).view(np.int64)
    n = len(at)
    last = np.searchsorted(total, total[:-1] + min_words, side="left") - 1  # shortest run from each line on
    first = np.searchsorted(total, total[1:] - min_words, side="right") - 1  # shortest run up to each line
    spans = {(i, int(e)) for i, e in enumerate(last) if e < n} | {(int(s), j) for j, s in enumerate(first) if s >= 0}
    out = []
    for s, e in sorted(spans):
        run = hashes[s : e + 1]
        chosen = e - int(np.argmin(run[::-1])) if e > s else s
        content = int(run[0]) if e == s else int(np.uint64(digest(run.tobytes(), 1)).view(np.int64))
        out.append((int(hashes[chosen]), content, at[s], at[e], at[chosen]))
    return out


def _window_rows(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [windows(t.as_py(), min_words) for t in b.column(2)]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            cells = np.array([c for f in found for w in f for c in w], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), *[pa.array(c) for c in cells.T]],
                names=WINDOWS.names,
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), text_of(text_col).alias("text")
    ).mapInArrow(rows, WINDOWS)


def repeated_windows(docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, runs): per document the line ranges that repeat an earlier run."""
    found = saved(_window_rows(docs, min_words, id_col, text_col), "line-windows")
    spot = F.struct("doc_id", "text_key", "place")
    shared = found.groupBy("fingerprint").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a < b").select("fingerprint")
    candidates = found.join(shared.hint("merge"), "fingerprint", "left_semi")
    start = F.struct("doc_id", "text_key", "first")
    origin = candidates.groupBy("content").agg(F.min(start).alias("a"), F.max(start).alias("b")).filter("a < b").select("content", "a")
    later = candidates.join(origin.hint("merge"), "content").filter(start > F.col("a"))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def dedup_lines(
    docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "lines_removed"
) -> DataFrame:
    """``docs`` with repeated runs cut from the text, and ``removed_col`` (int), the number of lines cut."""
    kept = without(docs, [removed_col])
    runs = saved(repeated_windows(docs, min_words, id_col, text_col), "line-runs").select(
        F.col("doc_id").alias("_run_id"), F.col("text_key").alias("_run_key"), F.col("runs").alias("_runs")
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_run_id")) & (text_key(text_col) == F.col("_run_key"))
    lines = F.split(F.col(text_col), "\n", -1)
    rest = F.filter(lines, lambda _, i: ~F.exists("_runs", lambda r: i.between(r["first"], r["last"])))
    hit = F.col("_runs").isNotNull()
    # the table of runs grows with the corpus: it is never broadcast, at any size
    cut = kept.join(runs.hint("merge"), same, "left").withColumn("_rest", F.when(hit, rest))
    return cut.withColumn(removed_col, F.when(hit, F.size(lines) - F.size("_rest")).otherwise(0)).select(
        *[
            F.when(hit, F.array_join("_rest", "\n")).otherwise(F.col(text_col)).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in kept.columns
        ],
        removed_col,
    )
