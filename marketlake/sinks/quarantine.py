"""Batches that are checked while they are written: good rows in, others set aside with the reason.

Each row gets the list of the checks it breaks, and one job writes the rows by whether there are any.
The good ones become a batch of the source, the others a batch of the same name below ``QUARANTINE``.
As one job writes both, both have the column ``REASONS``, which is NULL for good rows. The numbers come
from the write itself.

``unique`` concerns other rows: a key that is stored already, or that comes more than once. Such keys are
found first, from the key column alone, with counts that are combined before the shuffle; none of the
rows of a repeated key is good, as none is known to be the right one. If they are few they go to every
task, else they meet the rows in a join that is dealt out by the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlake.contracts import Check
from marketlake.functions.paths import check_format, lake_path
from marketlake.functions.records import quoted
from marketlake.operators.quality import broken_sql
from marketlake.sources import files
from marketlake.sources.lake import Lake

QUARANTINE = "quarantine"
REASONS = "broken_checks"
#: So many keys that are not unique are broadcast, if they are short.
BROADCAST_KEYS, KEY_BYTES = 500_000, 64


@dataclass
class Checked:
    """Where the rows went, how many, and how often each check was broken."""

    good_path: str | None = None
    bad_path: str | None = None
    good: int = 0
    bad: int = 0
    broken: dict[str, int] = field(default_factory=dict)


def name_of(check: Check) -> str:
    return f"{check.column} {check.kind}"


def with_verdicts(
    df: DataFrame, checks: Iterable[Check], stored: DataFrame | None = None, kept: str | None = None
) -> DataFrame:
    """The rows with the names of the checks they break, an empty list for a good row.

    ``stored`` has rows whose keys are taken. ``kept`` is a folder for keys that are not unique.
    """
    reasons: list[Column] = []
    for check in checks:
        if check.kind != "unique":
            reasons.append(F.when(F.expr(broken_sql(check)), F.lit(name_of(check))))
            continue
        column = quoted(check.column)
        keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key"))
        again = keys.agg(F.count(F.lit(1)).alias("n"))
        if stored is None:
            odd = again.where("n > 1").select("_key")
        else:
            taken = stored.select(F.col(column).alias("_key")).distinct().withColumn("taken", F.lit(True))
            odd = again.join(taken, "_key", "left").where("n > 1 or taken").select("_key")
        place = f"{kept}/{check.column}" if kept else None
        if place:
            odd.write.parquet(place)
            odd = df.sparkSession.read.schema(odd.schema).parquet(place)
            size = F.max(F.coalesce(F.octet_length(F.col("_key").cast("string")), F.lit(0)))
            n, longest = odd.agg(F.count(F.lit(1)), size).first()
            if n <= BROADCAST_KEYS and (longest or 0) <= KEY_BYTES:
                odd = F.broadcast(odd)
        flag = f"_repeated{len(reasons)}"
        odd = odd.withColumn(flag, F.lit(True)).withColumnRenamed("_key", f"_key{len(reasons)}")
        df = df.join(odd, F.col(column) == F.col(f"_key{len(reasons)}"), "left").drop(f"_key{len(reasons)}")
        reasons.append(F.when(F.col(flag), F.lit(name_of(check))))
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    own = [c for c in df.columns if not c.startswith("_repeated")]
    return df.select(*map(quoted, own), listed.alias(REASONS))


def write_checked(
    lake: Lake,
    df: DataFrame,
    source: str,
    checks: Iterable[Check],
    date: datetime | None = None,
    filename: str | None = None,
    fmt: str = "parquet",
    layer: str = "bronze",
    stored: DataFrame | None = None,
) -> Checked:
    """Write the good rows as a batch and the others as one of the same name in quarantine.

    Batches of an earlier write under that name are replaced, also by none.
    """
    spark, checks = lake.spark, list(checks)
    check_format(fmt)
    staged = files.staging_path(lake.path(layer, source, f"checked-{uuid.uuid4().hex}"))
    seen, verdict = Observation(), "_verdict"
    try:
        rows = with_verdicts(df, checks, stored, f"{staged}/_keys")
        rows = rows.withColumn(REASONS, F.when(F.size(REASONS) > 0, F.col(REASONS)))
        rows = rows.withColumn(verdict, F.when(F.col(REASONS).isNull(), "good").otherwise("bad"))
        counts = [F.count_if(F.array_contains(F.coalesce(REASONS, F.array().cast("array<string>")), name_of(c))).alias(f"n{k}") for k, c in enumerate(checks)]
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(verdict) == "bad").alias("bad"), *counts
        )
        writer = rows.write.partitionBy(verdict)
        if fmt == "json":
            writer = writer.option("ignoreNullFields", False)
        writer.format(fmt).save(f"{staged}/rows")
        numbers = seen.get
        result = Checked(
            good=numbers["rows"] - numbers["bad"],
            bad=numbers["bad"],
            broken={name_of(c): numbers[f"n{k}"] for k, c in enumerate(checks)},
        )
        good_path = lake_path(source, date or datetime.now(), filename, fmt, layer)
        bad_path = f"{QUARANTINE}/{good_path}"
        # Bad rows first: a run that dies in between has set them aside and not yet published the rest.
        for kind, path in (("bad", bad_path), ("good", good_path)):
            folder = f"{staged}/rows/{verdict}={kind}"
            if not files.exists(spark, folder):
                files.discard(spark, lake.path(path))
                continue
            files.replace(spark, folder, lake.path(path))
            setattr(result, f"{kind}_path", path)
        return result
    finally:
        files.discard(spark, staged)


def read_quarantine(lake: Lake, source: str, layer: str = "bronze") -> DataFrame:
    """Rows that were set aside, with the reasons and the day they came."""
    return lake.scan(source, layer=f"{QUARANTINE}/{layer}", day_column="day")
