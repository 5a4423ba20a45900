"""Column-level building blocks, all built-in Spark expressions (no UDFs)."""

from riskfold.functions.core import (  # noqa: F401
    bucket_left,
    bucket_right,
    clip_lower,
    col_or_expr,
    flag,
    level_score,
    pd_to_points,
    row_max,
    row_mean,
    row_min,
    row_nonnull_count,
    row_null_count,
    row_std,
    row_sum_fill0,
    safe_div,
    sanitize_token,
    sigmoid,
)
