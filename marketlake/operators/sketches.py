"""Profiles of a source that are kept per batch and merged over any range of days.

Every batch is read once. For each of its columns the numbers of rows and NULLs and the least and
greatest value are kept exactly, and sketches beside them: KLL for quantiles of numbers, HyperLogLog
for how many different values there are, and theta, which can also say how many values two
ranges of days have in common. Merging reads the profiles only, a row per batch and column.

The errors are those of the sketches: a quantile is off by at most ``QUANTILE_ERROR`` of the rows, a
number of different values by about ``DISTINCT_ERROR`` of itself (one standard error, for both
sketches; small numbers are exact). ``profile.describe`` stays the exact way.

A refresh compares the profiles with the batches that are there, by path, bytes and time: new and
replaced batches are profiled, and profiles of batches that are gone or replaced go. Days without a change
are not written again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.paths import day_of
from marketlake.functions.records import quoted
from marketlake.sources import files
from marketlake.sources.drift import scan_any_schema
from marketlake.sources.lake import Lake, batch_of

#: Sizes of the sketches, as powers of two for the numbers of different values.
QUANTILE_SIZE, DISTINCT_LOG = 400, 12
#: Of the rows, with 99 % confidence; and one standard error.
QUANTILE_ERROR, DISTINCT_ERROR = 0.01, 1.04 / 64

ROWS = (
    "batch string, bytes long, modified timestamp, column string, type string, rows long, nulls long, "
    "low string, high string, quantiles binary, distinct binary, members binary"
)
DAY, UNDATED = "day", "undated"


class BatchProfiles:
    """The profiles of one source of a layer."""

    def __init__(self, lake: Lake, source: str, layer: str = "bronze", contract: T.StructType | None = None):
        self.lake, self.source, self.layer, self.contract = lake, source, layer, contract
        self.path = lake.path("_profiles", layer, source)

    def rows(self) -> DataFrame:
        spark = self.lake.spark
        if not files.exists(spark, self.path):
            return spark.createDataFrame([], f"{ROWS}, {DAY} string")
        return spark.read.schema(f"{ROWS}, {DAY} string").parquet(self.path)

    def refresh(self) -> list[str]:
        """Bring the profiles up to what is stored; returns the batches that were read."""
        spark, held = self.lake.spark, self.rows()
        day = day_of(F.concat("path", F.lit("/")), self.layer, self.source).cast("string")
        listed = self.lake.list_batches(self.source, self.layer).select(
            F.col("path").alias("batch"), "bytes", "modified", F.coalesce(day, F.lit(UNDATED)).alias(DAY)
        )
        same = ["batch", "bytes", "modified"]
        known = held.select(*same, DAY).distinct()
        new = listed.join(known, same, "left_anti").collect()
        gone = known.join(listed, same, "left_anti").collect()
        days = sorted({r[DAY] for r in [*new, *gone]})
        if not days:
            return []
        kept = held.where(F.col(DAY).isin(days)).join(listed.select(*same), same, "left_semi")
        parts = kept.unionByName(self._profiled(new)) if new else kept
        staged = files.staging_path(self.path)
        try:
            parts.repartition(len(days), DAY).write.partitionBy(DAY).parquet(staged)
            written = files.folder_names(spark, staged)
            for name in (f"{DAY}={d}" for d in days):
                if name in written:
                    files.replace(spark, f"{staged}/{name}", f"{self.path}/{name}")
                else:
                    files.discard(spark, f"{self.path}/{name}")
        finally:
            files.discard(spark, staged)
        return sorted(r["batch"] for r in new)

    def _profiled(self, batches: list) -> DataFrame:
        """A row per batch and column, from one pass over the batches."""
        spark = self.lake.spark
        paths = [r["batch"] for r in batches]
        read = scan_any_schema(self.lake, self.source, self.contract, self.layer, folders=paths, path_column="_path")
        fields = [f for f in read.schema.fields if f.name != "_path"]
        values = read.select(
            batch_of(F.col("_path"), self.layer, self.source).alias("batch"),
            *(F.col(quoted(f.name)).alias(f"c{n}") for n, f in enumerate(fields)),
        )
        facts = []
        for n, f in enumerate(fields):
            facts += [fact.alias(f"{name}{n}") for name, fact in _facts(f"c{n}", f.dataType).items()]
        wide = values.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), *facts)
        columns = [
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                *(F.col(f"{name}{n}").alias(name) for name in _facts("", f.dataType)),
            )
            for n, f in enumerate(fields)
        ]
        long = wide.select("batch", "rows", F.explode(F.array(*columns)).alias("c")).select("batch", "rows", "c.*")
        about = spark.createDataFrame(batches, f"batch string, bytes long, modified timestamp, {DAY} string")
        names = [c.split()[0] for c in ROWS.split(", ")]
        return about.join(long, "batch").select(*names, DAY)

    # --- answers ----------------------------------------------------------------------

    def between(self, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
        """The profiles of the batches of some days; batches outside day folders are of no range."""
        rows = self.rows()
        for day, holds in ((first_day, F.col(DAY) >= str(first_day)), (last_day, F.col(DAY) <= str(last_day))):
            rows = rows.where(holds & (F.col(DAY) != UNDATED)) if day else rows
        return rows

    def describe(
        self,
        first_day: date | None = None,
        last_day: date | None = None,
        quantiles: tuple[float, ...] = (0.25, 0.5, 0.75),
    ) -> DataFrame:
        """Per column: rows, NULLs, bounds as text, quantiles and the number of different values."""
        merged = self.between(first_day, last_day).groupBy("column", "type").agg(
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.min(_comparable("low")).alias("least"),
            F.max(_comparable("high")).alias("greatest"),
            F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"),
            F.expr("hll_union_agg(distinct, true)").alias("distinct"),
        )
        ranks = ", ".join(f"{q!r}D" for q in quantiles)
        filled = F.col("rows") > F.col("nulls")
        numeric = F.col("type").isin(*_NUMBERS) | F.col("type").startswith("decimal")
        return merged.select(
            "column",
            "type",
            "rows",
            "nulls",
            F.col("least.text").alias("low"),
            F.col("greatest.text").alias("high"),
            F.when(numeric & filled, F.expr(f"kll_sketch_get_quantile_double(quantiles, array({ranks}))")).alias("quantiles"),
            F.when(filled, F.expr("hll_sketch_estimate(distinct)")).otherwise(0).alias("distinct"),
        )

    def in_common(self, column: str, one: tuple[date, date], other: tuple[date, date]) -> DataFrame:
        """How many values of a column both ranges of days have, and each of them."""
        own, theirs = (
            self.between(*days).where(F.col("column") == column).agg(F.expr("theta_union_agg(members)").alias(name))
            for days, name in ((one, "one"), (other, "other"))
        )
        # Two single rows.
        both = own.join(theirs, F.lit(True))
        return both.select(
            F.expr("theta_sketch_estimate(one)").alias("n_one"),
            F.expr("theta_sketch_estimate(other)").alias("n_other"),
            F.expr("theta_sketch_estimate(theta_intersection(one, other))").alias("n_common"),
        )


_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _facts(column: str, kind: T.DataType) -> dict[str, Column]:
    """What is kept of a column, as aggregates."""
    value = F.col(column) if column else F.lit(None)
    plain = isinstance(kind, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
    text = value.cast("string") if plain else F.to_json(value) if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)) else value.cast("string")
    numeric = isinstance(kind, T.NumericType)
    number = value.cast("double")
    none = F.first(F.lit(None).cast("binary"))
    return {
        "nulls": F.count_if(value.isNull()),
        "low": F.min(value).cast("string") if plain else F.first(F.lit(None).cast("string")),
        "high": F.max(value).cast("string") if plain else F.first(F.lit(None).cast("string")),
        "quantiles": F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)) if numeric else none,
        "distinct": F.hll_sketch_agg(text, F.lit(DISTINCT_LOG)),
        "members": F.theta_sketch_agg(text, F.lit(DISTINCT_LOG)),
    }


def _comparable(bound: str) -> Column:
    """Numbers compare as numbers, times and texts as they are written."""
    numeric = F.col("type").isin(*_NUMBERS) | F.col("type").startswith("decimal")
    number = F.when(numeric, F.col(bound).try_cast("double"))
    return F.when(F.col(bound).isNotNull(), F.struct(number.alias("number"), F.col(bound).alias("text")))
