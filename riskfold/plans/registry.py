"""Shared registry of catalogue queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskfold.plans.sqlkit import round_doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str | Callable[[], str]] = {}


def oracles() -> dict[str, str]:
    """All oracle SQL strings (built lazily: some are generated from specs)."""
    return {k: (v() if callable(v) else v) for k, v in ORACLES.items()}


def register(name: str, oracle: str | Callable[[], str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; final doubles are rounded."""

    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco
