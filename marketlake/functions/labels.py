"""Labels for price trend and company size. NULL falls through to the last label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.contracts import CAP_ELSE, CAP_FROM, TREND_ABOVE, TREND_ELSE


def trend_label(change_pct: Column) -> Column:
    """Five-way trend; each bound is exclusive."""
    return _label([(change_pct > bound, label) for bound, label in TREND_ABOVE], TREND_ELSE)


def cap_label(market_cap: Column) -> Column:
    """Four-way size; each bound is inclusive."""
    return _label([(market_cap >= bound, label) for bound, label in CAP_FROM], CAP_ELSE)


def _label(cases: list[tuple[Column, str]], default: str) -> Column:
    (condition, label), *rest = cases
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))
