"""DuckDB oracle for feature blocks, in the reference's own plan shape.

The Spark operator runs one conditional-aggregate pass; this oracle instead
runs one ``GROUP BY`` per subset over a filtered copy and LEFT JOINs the
pieces onto the base aggregate — the way a pandas pipeline merges blocks.
Both read the same spec (the fixed feature list), so a wrong mask, window
bound, NULL rule or ratio in either plan shows up as a mismatch.
"""

from __future__ import annotations

from riskfold.operators.blocks import SENTINEL, Agg, BlockSpec

# Raw columns of integer type in the bound tables.
INT_COLUMNS = {
    "CNT_CREDIT_PROLONG", "DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_UPDATE", "MONTHS_BALANCE",
    "DAYS_DECISION", "SK_DPD", "SK_DPD_DEF", "NUM_INSTALMENT_NUMBER", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV",
}


def _is_int(spec: BlockSpec, col: str) -> bool:
    if col in INT_COLUMNS:
        return True
    for name, sql in spec.derived:
        if name == col:
            return sql.rstrip().endswith("AS INT)")
    return False


def agg_type(spec: BlockSpec, a: Agg) -> str:
    if a.fn in ("count", "nunique"):
        return "BIGINT"
    if a.fn == "mean":
        return "DOUBLE"
    if a.fn == "sum":
        return "BIGINT" if _is_int(spec, a.col) else "DOUBLE"
    return "INT" if _is_int(spec, a.col) else "DOUBLE"


def double_outputs(spec: BlockSpec) -> list[str]:
    out = [spec.out(a.name) for a in spec.base if agg_type(spec, a) == "DOUBLE"]
    out += [spec.out(r.name) for r in spec.base_ratios]
    for s in spec.subsets:
        out += [spec.out(f"{s.name}_{a.name}") for a in s.aggs if agg_type(spec, a) == "DOUBLE"]
        out += [spec.out(f"{s.name}_{r.name}") for r in s.ratios]
    return out


def _agg_sql(spec: BlockSpec, a: Agg) -> str:
    c = a.col
    if a.fn == "count":
        return f"count({c})"
    if a.fn == "nunique":
        return f"count(DISTINCT {c})"
    if a.fn == "mean":
        return f"avg({c})"
    if a.fn == "sum":
        t = agg_type(spec, a)
        return f"CAST(coalesce(sum({c}), 0) AS {t})"
    return f"{a.fn}({c})"


def prepared_sql(spec: BlockSpec, rows_sql: str) -> str:
    cols = []
    for c in spec.columns:
        if spec.clean_days and c.startswith("DAYS"):
            cols.append(f"CASE WHEN {c} = {SENTINEL} THEN NULL ELSE {c} END AS {c}")
        else:
            cols.append(c)
    sql = f"SELECT {', '.join(cols)} FROM {rows_sql} _src"
    for name, expr in spec.derived:
        sql = f"SELECT *, {expr} AS {name} FROM ({sql}) _d"
    return sql


def _safe(num: str, den: list[str]) -> str:
    d = " + ".join(den)
    return f"CASE WHEN ({d}) = 0 THEN NULL ELSE {num} / ({d}) END"


def block_sql(spec: BlockSpec, rows_sql: str) -> str:
    """The whole block: base group-by LEFT JOIN one group-by per subset."""
    prep = prepared_sql(spec, rows_sql)
    k = spec.key
    base_aggs = ", ".join(f"{_agg_sql(spec, a)} AS {spec.out(a.name)}" for a in spec.base)
    ctes = [f"prep AS ({prep})", f"base AS (SELECT {k}, {base_aggs} FROM prep GROUP BY {k})"]
    select = [f"base.{k}"] + [f"base.{spec.out(a.name)}" for a in spec.base]
    select += [
        _safe(f"base.{spec.out(r.num)}", [f"base.{spec.out(d)}" for d in r.den]) + f" AS {spec.out(r.name)}"
        for r in spec.base_ratios
    ]
    joins = []
    for i, s in enumerate(spec.subsets):
        alias = f"s{i}"
        aggs = ", ".join(f"{_agg_sql(spec, a)} AS {spec.out(s.name + '_' + a.name)}" for a in s.aggs)
        ctes.append(f"{alias} AS (SELECT {k}, {aggs} FROM prep WHERE {s.mask} GROUP BY {k})")
        joins.append(f"LEFT JOIN {alias} ON base.{k} = {alias}.{k}")
        select += [f"{alias}.{spec.out(s.name + '_' + a.name)}" for a in s.aggs]
        select += [
            _safe(
                f"{alias}.{spec.out(s.name + '_' + r.num)}",
                [f"{alias}.{spec.out(s.name + '_' + d)}" for d in r.den],
            )
            + f" AS {spec.out(s.name + '_' + r.name)}"
            for r in s.ratios
        ]
    return "WITH " + ",\n".join(ctes) + "\nSELECT " + ",\n  ".join(select) + "\nFROM base\n" + "\n".join(joins)
