"""Registered queries: one Spark callable and (where SQL can say it) one DuckDB oracle.

``queries()`` / ``oracle_sql()`` in ``__spark_entry__`` are read from here.
The double columns that a query names are rounded to 6 decimals on both sides,
so that the value hash does not depend on floating-point summation order; all
others stay as they are.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ROUND_DIGITS = 6


def rounded(frame: DataFrame, doubles: tuple, digits: int = ROUND_DIGITS) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else frame


def oracle_rounded(query: str, doubles: tuple = ()) -> str:
    if not doubles:
        return query
    repl = ", ".join(f"ROUND({c}, {ROUND_DIGITS}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{query}\n) q"


def oracle_statements() -> dict:
    """Oracle SQL with the views each statement needs (resolved at call time)."""
    return {name: O.with_views(sql) for name, sql in ORACLES.items()}


def register(name: str, sql: str | None = None, doubles: tuple = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), doubles)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle_rounded(sql, doubles)
        return fn

    return wrap
