"""Counts, column statistics, first rows, column types and sizes."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from math import ceil, copysign, floor, log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.records import quoted

QUARTILES = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
# Values that one task may sort, and buckets that one pass counts, per column and quartile.
SORT_LIMIT = 100_000
# Lists of so many values that one task may hold; more of them are dealt out.
LISTS_PER_TASK = 16
BUCKETS = 10_000
_LARGEST = sys.float_info.max
# Guessed bytes of one value in the rough size.
BYTES_PER_VALUE = 8


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def first_rows(df: DataFrame, n: int = 10, order_by: list[Column | str] | None = None) -> DataFrame:
    """First rows; with an order the result repeats, and only ``n`` rows per task are moved."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def column_types(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "name string, type string, position int")


def rough_size(df: DataFrame) -> DataFrame:
    """Rows, columns and a rough number of bytes."""
    n_columns = len(df.columns)
    counted = row_count(df).withColumn("n_columns", F.lit(n_columns))
    return counted.withColumn("rough_bytes", F.col("n_rows") * n_columns * BYTES_PER_VALUE)


def overview(df: DataFrame) -> DataFrame:
    """Column types next to the table's row count and rough size."""
    fields = [
        F.struct(
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(i).alias("position"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return rough_size(df).select(F.inline(F.array(*fields)), "n_rows", "n_columns", "rough_bytes")


def exact_size(file_list: DataFrame) -> DataFrame:
    """Bytes and number of the listed files."""
    return file_list.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n_files")
    )


# --- column statistics -----------------------------------------------------------------


@dataclass
class _Span:
    """The range that holds the value of a rank: ``below`` values are smaller than ``low``."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int

    @property
    def settled(self) -> bool:
        return self.inside <= SORT_LIMIT or self.low == self.high


def describe(
    df: DataFrame, columns: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of the numeric columns.

    Quartiles are exact and interpolated. On a large table they are found by counting values
    per bucket and looking again into the bucket that holds the rank, so no task ever
    sees more than ``SORT_LIMIT`` values; each look is one pass with a small result.
    """
    names = columns or [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    ]
    if not names:
        raise ValueError("no numeric column to describe")
    values = df.select(*(_value(df, n).alias(f"v{i}") for i, n in enumerate(names)))
    keys = [f"v{i}" for i in range(len(names))]
    if approximate:
        return _by_column(values, keys, names, _sketched)
    stats = values.agg(*_moments(keys)).first().asDict()
    spans = _spans(values, keys, stats)
    found = _ranked(values, spans)
    rows = []
    for key, name in zip(keys, names, strict=True):
        n = stats[f"{key}_count"]
        quartiles = [_interpolate(found.get(key, {}), n, q) for q, _ in QUARTILES]
        low, high = stats[f"{key}_min"], stats[f"{key}_max"]
        rows.append(
            (name, n, stats[f"{key}_mean"], stats[f"{key}_std"], low, *quartiles, high)
        )
    return df.sparkSession.createDataFrame(rows, _DESCRIBED)


_DESCRIBED = (
    "column string, count bigint, mean double, std double, min double, "
    "p25 double, p50 double, p75 double, max double"
)


def _value(df: DataFrame, name: str) -> Column:
    """The column as double, with not-a-number counted as missing."""
    column = F.col(quoted(name)).cast("double")
    return F.when(F.isnan(column), None).otherwise(column)


def _moments(keys: list[str]) -> list[Column]:
    out = []
    for k in keys:
        out += [
            F.count(k).alias(f"{k}_count"),
            F.avg(k).alias(f"{k}_mean"),
            F.stddev_samp(k).alias(f"{k}_std"),
            F.min(k).alias(f"{k}_min"),
            F.max(k).alias(f"{k}_max"),
        ]
    return out


def _sketched(k: str) -> list[Column]:
    return [F.percentile_approx(k, q).alias(f"{k}_{label}") for q, label in QUARTILES]


def _by_column(values: DataFrame, keys: list[str], names: list[str], quartiles) -> DataFrame:
    row = values.agg(*_moments(keys), *(c for k in keys for c in quartiles(k)))
    labels = ["count", "mean", "std", "min", *(label for _, label in QUARTILES), "max"]
    structs = [
        F.struct(F.lit(n).alias("column"), *(F.col(f"{k}_{x}").alias(x) for x in labels))
        for k, n in zip(keys, names, strict=True)
    ]
    return row.select(F.inline(F.array(*structs)))


def _spans(values: DataFrame, keys: list[str], stats: dict) -> list[_Span]:
    """Narrow the range around each wanted rank until few enough values are left in it."""
    spans = []
    for k in keys:
        n = stats[f"{k}_count"]
        for q, _ in QUARTILES if n else ():
            for rank in sorted({floor(q * (n - 1)), ceil(q * (n - 1))}):
                low, high = stats[f"{k}_min"], stats[f"{k}_max"]
                spans.append(_Span(k, rank, low, high, 0, n))
    while any(not s.settled for s in spans):
        open_spans = [s for s in spans if not s.settled]
        shared = {(s.column, s.low, s.high): s for s in open_spans}
        counted = _count_buckets(values, list(shared))
        for span in open_spans:
            _narrow(span, counted[span.column, span.low, span.high])
    return spans


def _count_buckets(values: DataFrame, ranges: list[tuple[str, float, float]]) -> dict:
    """Value counts of equal-width buckets, for all open ranges in one pass."""
    entries = [
        F.struct(
            F.lit(i).alias("range"),
            F.when(F.col(k).between(low, high), _bucket(F.col(k), low, high)).alias("bucket"),
            F.col(k).alias("value"),
        )
        for i, (k, low, high) in enumerate(ranges)
    ]
    rows = (
        values.select(F.inline(F.array(*entries)))
        .where(F.col("bucket").isNotNull())
        .groupBy("range", "bucket")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
    )
    out = {r: [] for r in ranges}
    for row in rows.collect():  # at most BUCKETS + 1 rows per range
        out[ranges[row["range"]]].append((row["low"], row["high"], row["n"]))
    return out


def _bucket(value: Column, low: float, high: float) -> Column:
    """Bucket number; it never falls as the value grows, so buckets keep the order.

    Buckets are equally wide in a narrow range and grow with the size of the values in a
    wide one, so a few huge values do not push all others into one bucket.
    """
    low, high = max(low, -_LARGEST), min(high, _LARGEST)
    value = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    narrow = low > 0 and high / 2 <= low or high < 0 and low / 2 >= high
    if not narrow:
        unit = max(max(-low, high) * 2.0**-1000, sys.float_info.min)
        value = F.signum(value) * F.log1p(F.abs(value) / F.lit(unit))
        low, high = (copysign(log1p(abs(x) / unit), x) for x in (low, high))
    width = high / 2 - low / 2  # halves first: high - low can overflow
    if width == 0:
        return F.when(value > low, 1).otherwise(0)
    share = (value / 2 - F.lit(low / 2)) / F.lit(width)
    return F.floor(share * BUCKETS).cast("int")


def _narrow(span: _Span, buckets: list[tuple[float, float, int]]) -> None:
    below = span.below
    for low, high, n in sorted(buckets):
        if below + n > span.rank:
            if (low, high, n) == (span.low, span.high, span.inside):
                raise RuntimeError(f"values between {low} and {high} cannot be told apart")
            span.low, span.high, span.below, span.inside = low, high, below, n
            return
        below += n
    raise RuntimeError(f"rank {span.rank} not found; the table changed between passes")


def _ranked(values: DataFrame, spans: list[_Span]) -> dict[str, dict[int, float]]:
    """The values at the wanted ranks."""
    found: dict[str, dict[int, float]] = {}
    picks: dict[tuple[str, float, float], list[_Span]] = {}
    for s in spans:
        if s.low == s.high:
            found.setdefault(s.column, {})[s.rank] = s.low
        else:
            picks.setdefault((s.column, s.low, s.high), []).append(s)
    if not picks:
        return found
    entries = []
    for i, ((k, low, high), wanted) in enumerate(picks.items()):
        inside = F.when(F.col(k).between(low, high), F.col(k))  # at most SORT_LIMIT values
        places = F.array(*(F.lit(s.rank - s.below) for s in wanted))
        entries.append((i, inside, places))
    if len(entries) <= LISTS_PER_TASK:
        ordered = [
            _take(F.sort_array(F.collect_list(inside)), places).alias(f"p{i}")
            for i, inside, places in entries
        ]
        row = values.agg(*ordered).first()
        taken = {i: row[f"p{i}"] for i, _, _ in entries}
    else:
        structs = [
            F.struct(F.lit(i).alias("pick"), inside.alias("value"), places.alias("places"))
            for i, inside, places in entries
        ]
        kept = values.select(F.inline(F.array(*structs))).where(F.col("value").isNotNull())
        ordered = F.sort_array(F.collect_list("value"))
        rows = kept.groupBy("pick").agg(ordered.alias("o"), F.first("places").alias("places"))
        taken = {r["pick"]: r["v"] for r in rows.select("pick", _take(F.col("o"), F.col("places")).alias("v")).collect()}
    for i, wanted in enumerate(picks.values()):
        for s, value in zip(wanted, taken[i], strict=True):
            found.setdefault(s.column, {})[s.rank] = value
    return found


def _take(ordered: Column, places: Column) -> Column:
    return F.transform(places, lambda p: F.get(ordered, p))


def _interpolate(found: dict[int, float], n: int, q: float) -> float | None:
    if not n:
        return None
    place = q * (n - 1)
    low, high = found[floor(place)], found[ceil(place)]
    return low + (high - low) * (place - floor(place))
