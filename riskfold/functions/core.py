"""Scalar column functions.

Everything here returns a :class:`pyspark.sql.Column` built from Spark
built-ins, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scorecard and probability handling.
PROB_CLIP = 1e-6
LOGIT_CLIP = 35.0
POINTS_PDO = 50.0
POINTS_BASE = 600.0
POINTS_BASE_ODDS = 20.0
POINTS_FACTOR = POINTS_PDO / math.log(2.0)
POINTS_OFFSET = POINTS_BASE - POINTS_FACTOR * math.log(POINTS_BASE_ODDS)


def col_or_expr(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with a zero denominator giving NULL (never an error)."""
    d = col_or_expr(den)
    return col_or_expr(num) / F.nullif(d, F.lit(0))


def flag(cond: Column) -> Column:
    """Boolean condition to a 0/1 integer, NULL counting as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip_lower(x: str | Column, lower: float = 0.0) -> Column:
    """``max(x, lower)`` that keeps NULL as NULL (bare ``greatest`` would not)."""
    c = col_or_expr(x)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lower)))


def _cols(cols: Iterable[str | Column]) -> list[Column]:
    return [col_or_expr(c) for c in cols]


def tree_sum(terms: Sequence[Column]) -> Column:
    """Balanced sum: keeps expression depth O(log n) for wide rows (hundreds of columns)."""
    terms = list(terms)
    if not terms:
        return F.lit(0)
    while len(terms) > 1:
        nxt = [terms[i] + terms[i + 1] for i in range(0, len(terms) - 1, 2)]
        if len(terms) % 2:
            nxt.append(terms[-1])
        terms = nxt
    return terms[0]


def row_nonnull_count(cols: Sequence[str | Column]) -> Column:
    return tree_sum([col_or_expr(c).isNotNull().cast("int") for c in cols])


def row_null_count(cols: Sequence[str | Column]) -> Column:
    return tree_sum([col_or_expr(c).isNull().cast("int") for c in cols])


def row_sum_fill0(cols: Sequence[str | Column]) -> Column:
    """Horizontal sum skipping NULLs; an all-NULL row sums to 0."""
    return tree_sum([F.coalesce(col_or_expr(c), F.lit(0)) for c in cols])


def row_mean(cols: Sequence[str | Column]) -> Column:
    n = row_nonnull_count(cols)
    total = sum((F.coalesce(col_or_expr(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    return F.when(n > 0, total / n)


def row_min(cols: Sequence[str | Column]) -> Column:
    return F.least(*_cols(cols)) if len(cols) > 1 else col_or_expr(cols[0])


def row_max(cols: Sequence[str | Column]) -> Column:
    return F.greatest(*_cols(cols)) if len(cols) > 1 else col_or_expr(cols[0])


def row_std(cols: Sequence[str | Column]) -> Column:
    """Sample (ddof=1) standard deviation across columns, NULLs skipped."""
    n = row_nonnull_count(cols)
    mean = row_mean(cols)
    ss = sum(
        (F.coalesce((col_or_expr(c).cast("double") - mean) * (col_or_expr(c).cast("double") - mean), F.lit(0.0)) for c in cols),
        F.lit(0.0),
    )
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def sigmoid(z: str | Column) -> Column:
    c = F.least(F.greatest(col_or_expr(z).cast("double"), F.lit(-LOGIT_CLIP)), F.lit(LOGIT_CLIP))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def pd_to_points(p: str | Column) -> Column:
    """Scorecard points: offset + factor * ln((1-p)/p), p clipped to [1e-6, 1-1e-6]."""
    q = F.least(F.greatest(col_or_expr(p), F.lit(PROB_CLIP)), F.lit(1.0 - PROB_CLIP))
    return F.lit(POINTS_OFFSET) + F.lit(POINTS_FACTOR) * F.log((F.lit(1.0) - q) / q)


def bucket_right(x: str | Column, edges: Column) -> Column:
    """Right-closed bin index over a sorted edge array (``pd.cut`` convention).

    Bin ``i`` (1-based) holds ``edges[i-1] < x <= edges[i]``; with the outer
    edges at -inf/+inf every non-null value lands in 1..len(edges)-1.
    NULL stays NULL.
    """
    c = col_or_expr(x)
    return F.when(c.isNotNull(), F.size(F.filter(edges, lambda e: e < c)))


def bucket_left(x: str | Column, edges: Column) -> Column:
    """Left-closed histogram bin (``np.histogram`` convention), last bin closed.

    Values outside ``[edges[0], edges[-1]]`` get NULL (they are not counted).
    """
    c = col_or_expr(x)
    n_bins = F.size(edges) - 1
    raw = F.size(F.filter(edges, lambda e: e <= c))
    inside = (c >= F.element_at(edges, 1)) & (c <= F.element_at(edges, -1))
    return F.when(c.isNotNull() & inside, F.least(raw, n_bins))


def level_score(x: str | Column, medium: float, high: float, reverse: bool = False) -> Column:
    """0/1/2 severity of a value against two thresholds; NULL scores 0."""
    c = col_or_expr(x)
    if reverse:
        return F.when(c.isNull(), 0).when(c <= high, 2).when(c <= medium, 1).otherwise(0)
    return F.when(c.isNull(), 0).when(c >= high, 2).when(c >= medium, 1).otherwise(0)


def sanitize_token(s: str | Column, max_len: int = 48) -> Column:
    """Non-alphanumerics to ``_``, strip ``_``, cut to ``max_len``, empty -> ``blank``."""
    t = F.regexp_replace(col_or_expr(s).cast("string"), "[^0-9A-Za-z]+", "_")
    t = F.regexp_replace(t, "^_+|_+$", "")
    t = F.substring(t, 1, max_len)
    return F.when((t.isNull()) | (t == ""), F.lit("blank")).otherwise(t)


def round_significant_once(c: Column, digits: int) -> Column:
    """One rounding to ``digits`` significant digits (half-even, IEEE ``rint``)."""
    a = F.abs(c)
    k = F.lit(digits - 1) - F.floor(F.log10(a))
    up = F.rint(c * F.pow(F.lit(10.0), k)) / F.pow(F.lit(10.0), k)
    down = F.rint(c / F.pow(F.lit(10.0), -k)) * F.pow(F.lit(10.0), -k)
    ok = (a > F.lit(0.0)) & (a < F.lit(float("inf"))) & (k <= 22)
    return F.when(ok & (k >= 0), up + F.lit(0.0)).when(ok, down + F.lit(0.0)).otherwise(c + F.lit(0.0))


SNAP_DIGITS = 14


def round_significant(c: Column, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits using only exact powers of ten (-0.0 -> 0.0).

    Two stages: values are first snapped to 14 significant digits, which
    removes last-bit noise from terminating decimals (a mean of cents over 8
    rows), so the second rounding sees identical inputs in every engine.
    """
    return round_significant_once(round_significant_once(c, SNAP_DIGITS), digits)
