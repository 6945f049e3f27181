"""Result reconciliation (V1): compare two summary tables key by key.

A full outer join, so a key present on one side only is a mismatch (an inner
join would hide it).  Exact columns compare NULL-safely; approximate columns
allow ``max(abs_tol, rel_tol * |left|)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def reconcile(left: DataFrame, right: DataFrame, on: list, exact: list, approx: list,
              abs_tol: float = 0.01, rel_tol: float = 1e-9, fail: bool = False) -> DataFrame:
    l = left.select(*on, *[F.col(c).alias(f"{c}_left") for c in exact + approx]).withColumn("_l", F.lit(True))
    r = right.select(*on, *[F.col(c).alias(f"{c}_right") for c in exact + approx]).withColumn("_r", F.lit(True))
    j = l.join(r, on, "full_outer")
    present = F.coalesce(F.col("_l"), F.lit(False)) & F.coalesce(F.col("_r"), F.lit(False))
    checks = []
    for c in exact:
        checks.append((f"{c}_matches", present & F.col(f"{c}_left").eqNullSafe(F.col(f"{c}_right"))))
    for c in approx:
        lv, rv = F.col(f"{c}_left"), F.col(f"{c}_right")
        tol = F.greatest(F.lit(abs_tol), F.abs(lv) * F.lit(rel_tol))
        checks.append((f"{c}_matches", present & F.coalesce(F.abs(lv - rv) <= tol, F.lit(False))))
    out = j.select(*on, *[expr.alias(name) for name, expr in checks])
    all_ok = reduce(lambda a, b: a & b, [F.col(name) for name, _ in checks])
    out = out.withColumn("all_outputs_match", all_ok)
    if fail:
        out = out.withColumn(
            "all_outputs_match",
            F.when(F.col("all_outputs_match"), F.lit(True)).otherwise(
                F.raise_error(F.lit("At least one reconciled output differs"))
            ),
        )
    return out
