"""Small helpers shared by the DuckDB oracles and the Spark catalogue."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.functions.core import SNAP_DIGITS, round_significant_once

SIG = 10  # significant digits kept in final reports
PLAIN_COLUMNS, JVM_COLUMNS = 12, 90  # double columns rounded by projections, and by one expression over their array


def round_sig_np(x: np.ndarray, digits: int) -> np.ndarray:
    """numpy twin of the SQL ``_sig_once``: rint(x * 10^k) / 10^k with k = digits-1-floor(log10|x|)."""
    x = np.asarray(x, dtype=np.float64)
    out = x + 0.0
    a = np.abs(x)
    ok = np.isfinite(x) & (a > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        k = (digits - 1) - np.floor(np.log10(np.where(ok, a, 1.0)))
    ok &= k <= 22
    up = ok & (k >= 0)
    down = ok & (k < 0)
    ku, kd = np.where(up, k, 0.0), np.where(down, -k, 0.0)
    out[up] = np.rint(x[up] * np.power(10.0, ku[up])) / np.power(10.0, ku[up]) + 0.0
    out[down] = np.rint(x[down] / np.power(10.0, kd[down])) * np.power(10.0, kd[down]) + 0.0
    return out


def round_doubles(df: DataFrame, digits: int = SIG) -> DataFrame:
    """Round every double/float output column to 10 significant digits (-0.0 -> 0.0).

    Only the *final* report is rounded so that engines summing in different
    orders hash equal; intermediates are never rounded.  The two stages
    (snap to 14 digits, then round) are two projections.  Many such expressions
    exceed the JVM's generated-method limit: over ``PLAIN_COLUMNS`` doubles they
    are one expression over the array of all of them, over ``JVM_COLUMNS`` one
    Arrow-batched pass.
    """
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return df
    df = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in cols})
    if PLAIN_COLUMNS < len(cols) <= JVM_COLUMNS:
        whole = F.array(*[F.col(f"`{c}`") for c in cols])
        snapped = F.transform(whole, lambda x: round_significant_once(x, SNAP_DIGITS))
        whole = F.transform(snapped, lambda x: round_significant_once(x, digits))
        at = {c: i for i, c in enumerate(cols)}
        rounded = df.withColumn("_rounded", whole)
        return rounded.select(*[F.get("_rounded", F.lit(at[c])).alias(c) if c in at else F.col(f"`{c}`") for c in df.columns])
    if len(cols) <= JVM_COLUMNS:
        df = df.withColumns({c: round_significant_once(F.col(f"`{c}`"), SNAP_DIGITS) for c in cols})
        return df.withColumns({c: round_significant_once(F.col(f"`{c}`"), digits) for c in cols})
    schema = df.schema
    snap = SNAP_DIGITS
    # The batch function carries its own copy of the rounding rule, so the
    # Python workers need nothing but numpy/pandas (no package import).
    rounder = _portable(round_sig_np)

    def batches(it):
        for pdf in it:
            for c in cols:
                pdf[c] = rounder(rounder(pdf[c].to_numpy(dtype=np.float64, na_value=np.nan), snap), digits)
            yield pdf

    return df.mapInPandas(batches, schema)


def _portable(fn):
    """A copy of ``fn`` whose module is __main__-like, so cloudpickle ships it by value."""
    import types

    g = {"np": np}
    return types.FunctionType(fn.__code__, g, fn.__name__, fn.__defaults__, fn.__closure__)


def _sig_once(c: str, digits: int) -> str:
    k = f"({digits - 1} - floor(log10(abs({c}))))"
    return (
        f"(CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) OR {c} = 0 OR {k} > 22 THEN {c} + 0.0 "
        f"WHEN {k} >= 0 THEN round_even({c} * pow(10.0, {k}), 0) / pow(10.0, {k}) + 0.0 "
        f"ELSE round_even({c} / pow(10.0, -{k}), 0) * pow(10.0, -{k}) + 0.0 END)"
    )


def _sig_duck(c: str, digits: int = SIG) -> str:
    """Same two-stage rounding as ``round_significant`` (snap to 14 digits, then round)."""
    return _sig_once(_sig_once(c, SNAP_DIGITS), digits)


def _sig_layers(src: str, cols: list[str], digits: int, tag: str) -> str:
    """Two flat projections: exponent per column, then the rounding (small expressions)."""
    q = chr(34)
    exps = ", ".join(
        f"CASE WHEN {q}{c}{q} IS NULL OR isnan({q}{c}{q}) OR isinf({q}{c}{q}) OR {q}{c}{q} = 0 THEN NULL "
        f"ELSE {digits - 1} - floor(log10(abs({q}{c}{q}))) END AS {q}__k{i}{q}"
        for i, c in enumerate(cols)
    )
    rounded = ", ".join(
        f"CASE WHEN {q}__k{i}{q} IS NULL OR {q}__k{i}{q} > 22 THEN {q}{c}{q} + 0.0 "
        f"WHEN {q}__k{i}{q} >= 0 THEN round_even({q}{c}{q} * pow(10.0, {q}__k{i}{q}), 0) / pow(10.0, {q}__k{i}{q}) + 0.0 "
        f"ELSE round_even({q}{c}{q} / pow(10.0, -{q}__k{i}{q}), 0) * pow(10.0, -{q}__k{i}{q}) + 0.0 END AS {q}{c}{q}"
        for i, c in enumerate(cols)
    )
    drop = ", ".join(f"{q}__k{i}{q}" for i in range(len(cols)))
    return (
        f"{tag}a AS (SELECT *, {exps} FROM {src}),\n"
        f"{tag}b AS (SELECT * EXCLUDE ({drop}) REPLACE ({rounded}) FROM {tag}a)"
    )


def duck_round(sql: str, double_cols: Iterable[str]) -> str:
    cols = list(double_cols)
    if not cols:
        return sql
    return (
        f"WITH _r0 AS MATERIALIZED (\n{sql}\n),\n"
        f"{_sig_layers('_r0', cols, SNAP_DIGITS, '_s')},\n"
        f"{_sig_layers('_sb', cols, SIG, '_f')}\n"
        "SELECT * FROM _fb"
    )


sig_round_sql = _sig_duck


def npq(col: str, p: float) -> str:
    """Aggregate SQL for the numpy-style linear quantile of ``col`` (NULLs ignored).

    h = (n - 1) p over the sorted values; a + (b - a) t below t = 0.5 and
    b - (b - a)(1 - t) above, exactly like the Spark operator.
    """
    lst = f"list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL))"
    h = f"((len({lst}) - 1) * CAST('{float(p)!r}' AS DOUBLE))"
    t = f"({h} - floor({h}))"
    lo = f"{lst}[CAST(floor({h}) AS BIGINT) + 1]"
    hi = f"{lst}[CAST(ceil({h}) AS BIGINT) + 1]"
    return (
        f"(CASE WHEN len({lst}) = 0 THEN NULL WHEN {t} < 0.5 THEN {lo} + ({hi} - {lo}) * {t} "
        f"ELSE {hi} - ({hi} - {lo}) * (1 - {t}) END)"
    )


def npq_list(col: str, probs) -> str:
    return "[" + ", ".join(npq(col, p) for p in probs) + "]"
