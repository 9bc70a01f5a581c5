"""Footers of a source's files, kept in the lake, so that plans are made without opening files.

The index has a row per file: its place, length and time, its schema, its number of rows, and for
each column the least and greatest value and the number of NULLs. It is partitioned by the day folder.
A refresh compares it with the listing; only files that are new or replaced are opened, on executors,
and only the days in which anything changed are written again. Counts, sizes, the newest file and
the range of a column are answers from the index alone, and a scan between two values reads only
the files that may hold such values.

Bounds are taken from the footers as they are. A column without bounds in some file, a number that
may be NaN above its bound, or a limit of another kind than the file's column never leaves the file
out. Writers may shorten the bounds of texts, which then still hold for skipping.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.paths import day_of
from marketlake.functions.records import quoted
from marketlake.sources import files
from marketlake.sources.drift import describe_footer, read_placed
from marketlake.sources.lake import Lake, batch_of

BOUNDS = "map<string, struct<kind: string, low: string, high: string, nulls: long>>"
ROWS = (
    "path string, length long, modified timestamp, batch string, schema string, nanos string, "
    f"rows long, bounds {BOUNDS}"
)
DAY, UNDATED = "day", "undated"

#: How bounds of each kind are compared; integers of 64 bits are exact in this type.
KINDS = {"number": "decimal(38,18)", "float": "double", "text": "string", "time": "timestamp"}

Limit = int | float | Decimal | str | date | datetime


@dataclass(frozen=True)
class Refreshed:
    """How many footers a refresh opened, and how many files had gone or been replaced."""

    opened: int
    gone: int


class FileIndex:
    """The index of one source of a layer."""

    def __init__(self, lake: Lake, source: str, layer: str = "bronze"):
        self.lake, self.source, self.layer = lake, source, layer
        self.path = lake.path("_index", layer, source)

    # --- keeping it -------------------------------------------------------------------

    def exists(self) -> bool:
        return files.exists(self.lake.spark, self.path)

    def rows(self) -> DataFrame:
        """What the index holds."""
        spark = self.lake.spark
        if not self.exists():
            return spark.createDataFrame([], f"{ROWS}, {DAY} string")
        return spark.read.schema(f"{ROWS}, {DAY} string").parquet(self.path)

    def refresh(self) -> Refreshed:
        """Bring the index up to what is stored."""
        spark, held = self.lake.spark, self.rows()
        day = day_of(F.col("path"), self.layer, self.source).cast("string")
        listed = self.lake.list_files(self.layer, self.source).select(
            "path",
            F.col("modificationTime").alias("modified"),
            "length",
            batch_of(F.col("path"), self.layer, self.source).alias("batch"),
            F.coalesce(day, F.lit(UNDATED)).alias(DAY),
        )
        same = ["path", "length", "modified"]
        new = listed.join(held.select(*same), same, "left_anti")
        gone = held.join(listed.select(*same), same, "left_anti")
        counts = (
            new.select(DAY, F.lit(1).alias("new"), F.lit(0).alias("gone"))
            .unionByName(gone.select(DAY, F.lit(0).alias("new"), F.lit(1).alias("gone")))
            .groupBy(DAY)
            .agg(F.sum("new").alias("new"), F.sum("gone").alias("gone"))
            .collect()
        )
        if not counts:
            return Refreshed(0, 0)
        days = [r[DAY] for r in counts]
        # Each footer costs a file access, so the few short rows are dealt out evenly.
        parallel = max(1, spark.sparkContext.defaultParallelism)
        opened = new.repartition(parallel, "path").mapInPandas(_read_footers, f"{ROWS}, {DAY} string")
        kept = held.where(F.col(DAY).isin(days)).join(listed.select(*same), same, "left_semi")
        staged = files.staging_path(self.path)
        try:
            kept.select(opened.columns).unionByName(opened).write.partitionBy(DAY).parquet(staged)
            written = {n for n in files.folder_names(spark, staged) if "=" in n}
            for name in sorted({f"{DAY}={d}" for d in days}):
                if name in written:
                    files.replace(spark, f"{staged}/{name}", f"{self.path}/{name}")
                else:
                    files.discard(spark, f"{self.path}/{name}")
        finally:
            files.discard(spark, staged)
        return Refreshed(sum(r["new"] for r in counts), sum(r["gone"] for r in counts))

    # --- answers without data ---------------------------------------------------------

    def row_count(self) -> DataFrame:
        return self.rows().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"))

    def size(self) -> DataFrame:
        return self.rows().agg(
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n_files")
        )

    def days(self) -> DataFrame:
        """Files, rows and bytes of each day folder."""
        return self.rows().groupBy(DAY).agg(
            F.count(F.lit(1)).alias("n_files"), F.sum("rows").alias("n_rows"), F.sum("length").alias("bytes")
        )

    def newest(self) -> DataFrame:
        return self.rows().agg(
            F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified")
        )

    def column_range(self, column: str) -> DataFrame:
        """Least and greatest value as text, NULLs and rows of a column, for each kind it is stored as.

        The bounds are NULL if a file with values has none. A file without the column has NULLs only.
        """
        own = F.col("bounds")[column]
        read = self.rows().select("rows", own.alias("own")).withColumn(
            "kind", F.coalesce("own.kind", F.lit("absent"))
        )
        nulls = F.coalesce("own.nulls", F.when(F.col("own").isNull(), F.col("rows")))
        blind = (F.col("own.low").isNull() & (F.coalesce(nulls, F.lit(-1)) < F.col("rows"))).alias("blind")
        parts = []
        for kind, sql_type in KINDS.items():
            low, high = (F.col(f"own.{c}").try_cast(sql_type) for c in ("low", "high"))
            parts.append(
                read.where(F.col("kind") == kind)
                .select("kind", "rows", nulls.alias("nulls"), low.alias("low"), high.alias("high"), blind)
                .groupBy("kind")
                .agg(
                    F.when(~F.bool_or("blind"), _as_text(F.min("low"), kind)).alias("low"),
                    F.when(~F.bool_or("blind"), _as_text(F.max("high"), kind)).alias("high"),
                    F.sum("nulls").alias("nulls"),
                    F.sum("rows").alias("n_rows"),
                )
            )
        absent = read.where(~F.col("kind").isin(list(KINDS))).groupBy("kind").agg(
            F.lit(None).cast("string").alias("low"),
            F.lit(None).cast("string").alias("high"),
            F.sum(nulls).alias("nulls"),
            F.sum("rows").alias("n_rows"),
        )
        out = absent
        for part in parts:
            out = out.unionByName(part)
        return out

    # --- scans ------------------------------------------------------------------------

    def files_between(self, column: str, low: Limit | None = None, high: Limit | None = None) -> DataFrame:
        """The files that may hold values of a column between two limits, both included."""
        return self.rows().where(may_hold(column, low, high))

    def scan(
        self,
        column: str | None = None,
        low: Limit | None = None,
        high: Limit | None = None,
        contract: T.StructType | None = None,
        day_column: str | None = None,
        first_day: date | None = None,
        last_day: date | None = None,
    ) -> DataFrame:
        """All rows, or those with a column between two limits; opens no footer to plan it.

        Days are cut by folder; files outside day folders belong to no range of days.
        """
        limited = column is not None and (low is not None or high is not None)
        chosen = self.files_between(column, low, high) if limited else self.rows()
        for day, holds in ((first_day, F.col(DAY) >= str(first_day)), (last_day, F.col(DAY) <= str(last_day))):
            chosen = chosen.where(holds & (F.col(DAY) != UNDATED)) if day else chosen
        placed = chosen.select("path", "schema", "nanos").collect()
        everything = self.rows().select("schema", "nanos").distinct().collect()
        read = read_placed(self.lake, self.source, self.layer, placed, everything, contract, day_column)
        if limited:
            own = F.col(quoted(column))
            for limit, holds in ((low, own >= F.lit(low)), (high, own <= F.lit(high))):
                read = read.where(holds) if limit is not None else read
        return read


def may_hold(column: str, low: Limit | None, high: Limit | None) -> Column:
    """Whether a file's bounds leave room for a value between the limits."""
    own = F.col("bounds")[column]
    some = own.isNotNull() & ~F.coalesce(own["nulls"] >= F.col("rows"), F.lit(False))
    room = F.lit(True)
    for limit, edge in ((low, "high"), (high, "low")):
        if limit is None:
            continue
        kinds = _kinds_of(limit)
        outside = F.lit(False)
        for kind in kinds:
            if kind == "float" and edge == "high":
                continue  # NaN is above every bound
            bound, value = own[edge].try_cast(KINDS[kind]), F.lit(limit).cast(KINDS[kind])
            out = bound < value if edge == "high" else bound > value
            outside = outside | F.coalesce((own["kind"] == kind) & out, F.lit(False))
        room = room & ~outside
    return some & room


def _as_text(bound: Column, kind: str) -> Column:
    """A bound as it is written; numbers without the zeros of their wide type."""
    text = bound.cast("string")
    return F.regexp_replace(text, r"\.?0+$", "") if kind == "number" else text


def _kinds_of(limit: Limit) -> tuple[str, ...]:
    if isinstance(limit, bool):
        return ()
    if isinstance(limit, (int, float, Decimal)):
        return ("number", "float")
    return ("text",) if isinstance(limit, str) else ("time",)


def _kind(value: object) -> str | None:
    if isinstance(value, bool):
        return None
    if isinstance(value, (int, Decimal)):
        return "number"
    if isinstance(value, float):
        return "float"
    if isinstance(value, str):
        return "text"
    return "time" if isinstance(value, (date, datetime)) else None


def _bounds(metadata, nanos: set[str]) -> dict[str, dict]:
    """Kind, least and greatest value and NULLs of each plain column over all row groups."""
    found: dict[str, dict] = {}
    for group in range(metadata.num_row_groups):
        chunk = metadata.row_group(group)
        for index in range(chunk.num_columns):
            column = chunk.column(index)
            name = column.path_in_schema
            if "." in name or name in nanos:
                continue
            stats = column.statistics
            own = found.setdefault(name, {"nulls": 0, "values": [], "blind": False})
            nulls = stats.null_count if stats is not None and stats.has_null_count else None
            own["nulls"] = None if nulls is None or own["nulls"] is None else own["nulls"] + nulls
            if stats is not None and stats.has_min_max:
                own["values"] += [stats.min, stats.max]
            elif nulls is None or nulls < chunk.num_rows:
                own["blind"] = True
    out = {}
    for name, own in found.items():
        kinds = {_kind(v) for v in own["values"]}
        kind = kinds.pop() if len(kinds) == 1 else None
        bounded = kind is not None and not own["blind"]
        out[name] = {
            "kind": kind or "other",
            "low": _written(min(own["values"])) if bounded else None,
            "high": _written(max(own["values"])) if bounded else None,
            "nulls": own["nulls"],
        }
    return out


def _written(value: object) -> str:
    if isinstance(value, datetime):
        from datetime import UTC

        return (value.astimezone(UTC) if value.tzinfo else value).replace(tzinfo=None).isoformat(" ")
    return repr(value) if isinstance(value, float) else str(value)


def _read_footers(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import json

    for chunk in chunks:
        rows = []
        for record in chunk.to_dict("records"):
            schema, nanos, metadata = describe_footer(record["path"])
            counted = {name for name, _ in json.loads(nanos)}
            facts = {"schema": schema, "nanos": nanos, "rows": metadata.num_rows}
            rows.append(record | facts | {"bounds": _bounds(metadata, counted)})
        names = [*(c.split()[0] for c in ROWS.split(f", bounds ")[0].split(", ")), "bounds", DAY]
        yield pd.DataFrame(rows, columns=names)
