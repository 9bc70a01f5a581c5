"""State as of a moment: the newest row per key, and each row's match in another series.

``as_of`` gives every row of one table the newest row of another one, with the same key, that is not
later. Neither table is sorted. Both are put into one, keys are split into buckets of time, and a
row looks back within its own bucket for the last value carried forward. What a bucket starts with is
the last value of the buckets before it, which come from one aggregate per key and bucket, combined before
the shuffle. So a key with half of all rows is many groups, of about as many rows each as buckets of
time have: the bounds follow the rows' own times, by counts in ``SLOTS`` steps.

Defined results: rows without a key or a time, and rows before the first value of their key, have
no match and NULLs; values without a key or a time match nothing; of values with one key and time the
one with the greatest tie columns counts, and one of them if these are equal too; rows that repeat
are matched each; an empty table on either side is no error. Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of time in which rows are counted, so the counts are a table of at most that size.
SLOTS = 4096


def newest_per_key(df: DataFrame, keys: list[str], time: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """The row with the greatest time of each key; ties go to the greatest tie columns.

    Rows are combined before the shuffle, so a hot key sends one row per task. Rows without a time
    count as the oldest ones.
    """
    others = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(time, *ties)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def state_at(df: DataFrame, keys: list[str], time: str, moment: Column, ties: tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each key that is not later than a moment."""
    return newest_per_key(df.where(F.col(time) <= moment), keys, time, ties)


def as_of(
    rows: DataFrame,
    values: DataFrame,
    keys: list[str],
    row_time: str,
    value_time: str,
    columns: list[str],
    *,
    ties: tuple[str, ...] = (),
    buckets: int | None = None,
    matched_time: str | None = None,
) -> DataFrame:
    """``rows`` with ``columns`` of the newest of ``values`` that has their keys and is not later.

    ``matched_time`` names a column for the time of the value.
    """
    spark = rows.sparkSession
    if clash := set(columns) & set(rows.columns):
        raise ValueError(f"both tables have {', '.join(sorted(clash))}")
    buckets = buckets or max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    value = F.struct(F.col(value_time).alias("_time"), *columns)
    kind = value_struct(values, value_time, columns)
    own = rows.select(
        *(F.col(k).alias(f"_key{n}") for n, k in enumerate(keys)),
        F.col(row_time).cast("timestamp").alias("_at"),
        F.struct(*rows.columns).alias("_row"),
        F.lit(None).cast(kind).alias("_value"),
        _ties(values, ties, False),
    )
    usable = F.col(value_time).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    known = values.where(usable).select(
        *(F.col(k).alias(f"_key{n}") for n, k in enumerate(keys)),
        F.col(value_time).cast("timestamp").alias("_at"),
        F.lit(None).cast(own.schema["_row"].dataType).alias("_row"),
        value.cast(kind).alias("_value"),
        _ties(values, ties, True),
    )
    both = own.unionByName(known)
    both = both.withColumn("_bucket", _bucket(both.select("_at"), buckets))
    names = [f"_key{n}" for n in range(len(keys))]

    # What each bucket of a key ends with, and from that what it starts with.
    place = F.struct("_at", "_ties")
    ends = both.groupBy(*names, "_bucket").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), place)).alias("_end")
    )
    earlier = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*names, "_bucket", F.last("_end", ignorenulls=True).over(earlier).alias("_start"))
    starts = starts.where("_start is not null")

    # At one time values come before rows, and the greatest tie last.
    order = ["_at", F.col("_row").isNotNull(), "_ties"]
    within = Window.partitionBy(*names, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_value", ignorenulls=True).over(within)).where("_row is not null")
    matched = found.join(starts, [*names, "_bucket"], "left").select(
        "_row", F.when(F.col("_at").isNotNull(), F.coalesce("_last", "_start")).alias("_match")
    )
    out = [F.col("_match")[c].alias(c) for c in columns]
    if matched_time:
        out.append(F.col("_match._time").alias(matched_time))
    return matched.select("_row.*", *out)


def value_struct(values: DataFrame, time: str, columns: list[str]):
    return values.select(F.struct(F.col(time).alias("_time"), *columns).alias("s")).schema["s"].dataType


def _ties(values: DataFrame, ties: tuple[str, ...], filled: bool) -> Column:
    if not ties:
        return F.lit(0).alias("_ties")
    kind = values.select(F.struct(*ties).alias("s")).schema["s"].dataType
    return (F.struct(*ties) if filled else F.lit(None)).cast(kind).alias("_ties")


def _bucket(times: DataFrame, buckets: int) -> Column:
    """Buckets of time with about as many rows each; rows without a time are in bucket 0."""
    seconds = F.unix_micros("_at").cast("double")
    low, high = times.agg(F.min(seconds), F.max(seconds)).first()
    if low is None or low == high:
        return F.lit(0)
    slot = F.width_bucket(seconds, F.lit(low), F.lit(high), F.lit(SLOTS))
    sizes = times.where("_at is not null").groupBy(slot.alias("slot")).count().collect()
    counts = [0] * (SLOTS + 2)
    for row in sizes:
        counts[row["slot"]] = row["count"]
    target, held, own, bucket_of = max(1, sum(counts) // buckets), 0, 0, []
    for n in counts:
        bucket_of.append(own)
        held += n
        if held >= target:
            own, held = own + 1, 0
    return F.coalesce(F.element_at(F.lit(bucket_of), (slot + 1).cast("int")), F.lit(0))
