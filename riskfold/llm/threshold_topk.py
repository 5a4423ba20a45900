"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt into blocks of about ``block_rows`` rows and queries into
groups of about ``query_rows``; every block meets every group once (a stated
query set against all rows, block by block).  In a block each dimension has a
list of its rows sorted by value.  A query walks all lists together, from the
top where its weight is positive and from the bottom where it is negative, and
scores every row it meets in full.  No unseen row can score above the
*threshold*, the query's score for the values last read; when the k-th best
score so far is greater, or no row is unseen, the block is done (an equal one
goes on, since ties go to smaller ids).  The lists are walked in stages of growing depth, so the
bookkeeping is a few array operations a stage.  Each block's best k rows go on
to the query's final ranking, which keeps k of them.

Rules: NULL vectors and ids, and vectors that hold NULL or non-finite values,
take no part; an id that occurs twice has the lesser vector; vectors of
different length are not compared; fewer than k candidates are all returned;
empty tables give no rows.  Scores are exact integers below 2**63.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfold.llm.common import saved

#: Depths at which a walk stops to compare its threshold; it goes on until that ends it or all rows are met.
FIRST_DEPTH, DEEPER = 16, 2


def quantised(df: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<long>): floor(scale * x) of every component, x as a double."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(float("inf")), F.lit(False)))
    ok = F.col(id_col).isNotNull() & x.isNotNull() & finite
    numbers = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    return df.filter(ok).select(F.col(id_col).cast("long").alias("id"), numbers.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


class Block:
    """Candidate rows with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        by_id = np.argsort(ids)
        self.ids, self.rows = ids[by_id], np.ascontiguousarray(rows[by_id])
        self.lists = np.argsort(self.rows, axis=0, kind="stable")
        self.values = np.take_along_axis(self.rows, self.lists, axis=0)
        # products of doubles are exact while every partial sum stays below 2**53
        self.largest = int(np.abs(self.rows).max(initial=0))

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        exact = len(query) * self.largest * int(np.abs(query).max(initial=0)) < 2**53
        if exact:
            return (self.rows[at].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        return self.rows[at] @ query

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` rows other than ``own``, best first, ties to smaller ids."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        unseen = self.ids != own
        best_at, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, read = 0, FIRST_DEPTH
        while True:
            read = min(read, n)
            met = np.zeros(n, bool)
            if read == n or not len(up) + len(down):
                met[:] = True
                read = n
            else:
                met[self.lists[n - read : n - depth, up].ravel()] = True
                met[self.lists[depth:read, down].ravel()] = True
            fresh = np.flatnonzero(met & unseen)
            unseen[fresh] = False
            best_at, best = np.append(best_at, fresh), np.append(best, self.scores(fresh, query))
            if len(best) > k:
                cut = np.partition(best, len(best) - k)[len(best) - k]
                best_at, best = best_at[best >= cut], best[best >= cut]
            order = np.lexsort((best_at, -best))[:k]  # rows are in id order
            best_at, best = best_at[order], best[order]
            if not unseen.any():  # every row has been met somewhere
                break
            limit = int(query[up] @ self.values[n - read, up] + query[down] @ self.values[read - 1, down])
            if len(best) == k and best[-1] > limit:
                break
            depth, read = read, read * DEEPER
        return self.ids[best_at], best


def _dealt(rows: DataFrame, parts: int, name: str) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(parts)).cast("int")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = 8_192, query_rows: int = 2_048) -> DataFrame:
    """(query_id, rank, id, score) from (id, v) tables: each query's ``k`` best rows other than its own id."""
    rows, asked = saved(candidates, "topk-rows"), saved(queries, "topk-queries")
    blocks = max(1, -(-rows.count() // block_rows))
    groups = max(1, -(-asked.count() // query_rows))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = rows.select("id", "v", F.size("v").alias("dim"), _dealt(rows, blocks, "block").alias("block"), every(groups).alias("grp"))
    right = asked.select("id", "v", F.size("v").alias("dim"), _dealt(asked, groups, "query").alias("grp"), every(blocks).alias("block"))

    def meet(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(asks):
            block = Block(own["id"].to_numpy(np.int64), np.array(own["v"].tolist(), np.int64).reshape(len(own), -1))
            for i, v in zip(asks["id"], asks["v"], strict=True):
                ids, scores = block.top(np.asarray(v, np.int64), i, k)
                out.append(pd.DataFrame({"query_id": i, "id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype=np.int64)

    keys = ["dim", "block", "grp"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
