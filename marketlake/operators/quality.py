"""Declared checks on models, as failing rows or as one result table.

Checks that count rows share one pass over a model. Checks that count values each read their
one column: ``accepted_values`` drops the good rows at the scan, and ``unique`` combines its
counts per key before the shuffle, so a hot key is cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from marketlake.contracts import Check
from marketlake.functions.records import quoted

RESULT = "model string, column string, check string, failures bigint, status string"


class CheckFailure(Exception):
    """At least one check found failing rows; ``results`` has a row for every check."""

    def __init__(self, message: str, results: list[Row]):
        super().__init__(message)
        self.results = results


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _outside_sql(check: Check) -> str:
    """SQL that is true where a value breaks a range or list check; NULL passes."""
    column = quoted(check.column)
    if check.kind == "accepted_values":
        return f"{column} not in ({', '.join(map(_text, check.values))})"
    bounds = ((check.low, "<"), (check.high, ">"))
    broken = [f"{column} {sign} {bound!r}D" for bound, sign in bounds if bound is not None]
    return f"({' or '.join(broken) or 'false'})"


def broken_sql(check: Check) -> str:
    """SQL that is true for a row that breaks a check of single rows, else false."""
    if check.kind == "not_null":
        return f"{quoted(check.column)} is null"
    if check.kind in ("accepted_values", "accepted_range"):
        return f"coalesce({_outside_sql(check)}, false)"
    raise ValueError(f"{check.kind} is no check of single rows")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """Rows, or values with their counts, that break a check."""
    column = F.col(quoted(check.column))
    if check.kind == "not_null":
        return df.where(column.isNull())
    if check.kind == "unique":
        seen = df.where(column.isNotNull()).groupBy(column.alias("value"))
        return seen.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    if check.kind == "accepted_values":
        odd = df.where(_outside_sql(check)).groupBy(column.alias("value"))
        return odd.agg(F.count(F.lit(1)).alias("n_records"))
    if check.kind == "accepted_range":
        return df.where(_outside_sql(check))
    raise ValueError(f"Unknown check: {check.kind}")


def check_model(df: DataFrame, model: str, checks: Iterable[Check]) -> DataFrame:
    """Result rows of one model: failing rows for ``not_null`` and ``accepted_range``, distinct
    failing values for ``unique`` and ``accepted_values``."""
    checks = list(checks)
    by_row = [c for c in checks if c.kind in ("not_null", "accepted_range")]
    parts = [_one_pass(df, model, by_row)] if by_row else []
    for check in checks:
        if check not in by_row:
            counted = failing_rows(df, check).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(counted.select(*_labels(model, check), "failures"))
    results = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return results.select("model", "column", "check", "failures", status.alias("status"))


def _labels(model: str, check: Check) -> list[Column]:
    named = {"model": model, "column": check.column, "check": check.kind}
    return [F.lit(value).alias(name) for name, value in named.items()]


def _one_pass(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    counts, results = [], []
    for i, check in enumerate(checks):
        column = quoted(check.column)
        broken = f"{column} is null" if check.kind == "not_null" else _outside_sql(check)
        counts.append(F.expr(f"count_if({broken}) as n{i}"))
        labels = f"'{model}' as model, {_text(check.column)} as column, '{check.kind}' as check"
        results.append(f"struct({labels}, n{i} as failures)")
    return df.agg(*counts).selectExpr(f"inline(array({', '.join(results)}))")


def run_checks(
    read: Callable[[str], DataFrame],
    checks: Mapping[str, Iterable[Check]],
    select: Iterable[str] | None = None,
    skip: bool = False,
) -> DataFrame | None:
    """Check all or the selected models; ``read`` gives a model's table. None when skipped."""
    if skip:
        return None
    chosen = [m for m in checks if select is None or m in set(select)]
    if not chosen:
        raise ValueError("no model with checks is selected")
    parts = [check_model(read(m), m, checks[m]) for m in chosen]
    return reduce(DataFrame.unionByName, parts)


def require_pass(results: DataFrame) -> list[Row]:
    """Collect the results, one small row per declared check, and fail if any check failed."""
    rows = results.collect()
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        told = "; ".join(
            f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in failed
        )
        raise CheckFailure(f"{len(failed)} of {len(rows)} checks failed: {told}", rows)
    return rows
