"""Models built day by day: a run writes only the days whose input changed.

A model's table is external and partitioned by the day of the batches it comes from. What each day
was built from is kept beside the lake: the state of the day's files for a model over a source, the
run that wrote the day for a model over another one. A run compares that with what is there now,
reads the days that differ, and no others, and overwrites their partitions dynamically; days that
are gone are dropped. The state is noted after the partitions are in place, so a run that dies in
between writes the same partitions again and the result is that of a full rebuild.

A source is read by the folders of the changed days. A model that reads another table has its
partitions pruned: by a list of days, or, beyond ``LISTED_DAYS`` of them, by a join with the table of
changes, whose days Spark finds out while the query runs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.paths import day_of, model_location
from marketlake.functions.records import as_json_text, quoted
from marketlake.operators.quality import require_pass
from marketlake.plans.build import check_tables, select_models
from marketlake.plans.models import MODELS, Model
from marketlake.sinks.batches import write_folder
from marketlake.sinks.tables import ensure_database
from marketlake.sources import files
from marketlake.sources.drift import scan_any_schema
from marketlake.sources.lake import Lake, batch_of

DAY = "batch_day"
LISTED_DAYS = 100
#: A day's state: where it comes from, and the run that wrote it.
STATE = f"{DAY} date, version string, run string"


@dataclass
class Built:
    """What a run did to one model's table."""

    table: str
    run: str
    written: list[date | None] = field(default_factory=list)
    dropped: list[date | None] = field(default_factory=list)


@dataclass
class IncrementalResult:
    """A row per model, and one row per check, None if checks were skipped."""

    models: list[Built]
    checks: list[Row] | None


def build_incremental(
    lake: Lake,
    select: str | None = None,
    exclude: str | None = None,
    full_refresh: bool = False,
    run_date: date | None = None,
    skip_checks: bool = False,
    prefix: str = "",
) -> IncrementalResult:
    """Bring the selected models up to date, those they read first, then check them.

    Rows keep the run date of the run that wrote their day. ``full_refresh`` writes all days.
    """
    chosen = select_models(select, exclude)
    built = [_build_model(lake, model, full_refresh, run_date, prefix) for model in chosen]
    checks = check_tables(lake, [m.name for m in chosen], skip=skip_checks, prefix=prefix)
    return IncrementalResult(built, None if checks is None else require_pass(checks))


def state_path(lake: Lake, model: Model, prefix: str = "") -> str:
    return lake.path("_built", f"{prefix}{model.layer}", model.name)


def changes_path(lake: Lake, model: Model, prefix: str = "") -> str:
    return lake.path("_built", f"{prefix}{model.layer}", f"{model.name}_changes")


def state_of(lake: Lake, model: Model, prefix: str = "") -> DataFrame:
    """What each day of a model's table was built from, and by which run."""
    path = state_path(lake, model, prefix)
    if not files.exists(lake.spark, path):
        return lake.spark.createDataFrame([], STATE)
    return lake.spark.read.schema(STATE).parquet(path)


def versions_of(lake: Lake, model: Model, prefix: str = "") -> DataFrame:
    """The days of a model's input and the state of each.

    Of a source it is the number, size and times of a day's files; files outside day folders belong to
    the day NULL. Of a table it is the run that wrote the day.
    """
    if model.parent is not None:
        parent = state_of(lake, MODELS[model.parent], prefix)
        return parent.select(DAY, F.col("run").alias("version"))
    listed = lake.list_files("bronze", model.source)
    own = F.xxhash64(F.regexp_extract("path", f"/{model.source}/(.*)$", 1), "length", "modificationTime")
    return listed.groupBy(day_of(F.col("path"), "bronze", model.source).alias(DAY)).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.hex(F.bit_xor(own))).alias("version")
    )


def _build_model(
    lake: Lake, model: Model, full_refresh: bool, run_date: date | None, prefix: str
) -> Built:
    spark, run = lake.spark, uuid.uuid4().hex
    database = f"{prefix}{model.layer}"
    built = Built(f"`{database}`.`{model.name}`", run)
    location = model_location(lake.root, model.layer, model.name)
    whole = full_refresh or not _is_ours(lake, built.table)
    before = lake.spark.createDataFrame([], STATE) if whole else state_of(lake, model, prefix)
    old = before.select(F.col(DAY).alias("old_day"), F.col("version").alias("old"), F.col("run").alias("old_run"))
    new = versions_of(lake, model, prefix)
    # A row per day, however many files a day has.
    days = new.join(old, F.col(DAY).eqNullSafe(F.col("old_day")), "full_outer").collect()
    changed = [r for r in days if r["version"] is not None and r["version"] != r["old"]]
    gone = [r for r in days if r["version"] is None]
    ensure_database(lake, model.layer, database)
    if whole:
        spark.sql(f"DROP TABLE IF EXISTS {built.table}")
        files.discard(spark, location)
    if whole or changed or gone:
        built.written = [r[DAY] for r in changed]
        built.dropped = [r["old_day"] for r in gone]
        _write_days(lake, model, built, location, run_date, prefix)
        state = [
            (r[DAY], r["version"], run if r in changed else r["old_run"]) for r in days if r["version"] is not None
        ]
        rows = spark.createDataFrame(state, STATE).coalesce(1)
        write_folder(lake, rows, state_path(lake, model, prefix))
    return built


def _is_ours(lake: Lake, table: str) -> bool:
    """Whether the table is there and partitioned by day; one of a full build is not."""
    if not lake.spark.catalog.tableExists(table):
        return False
    return any(c.isPartition and c.name == DAY for c in lake.spark.catalog.listColumns(table))


def changed_days(
    lake: Lake, model: Model, days: list[date | None], run: str, prefix: str = ""
) -> DataFrame:
    """Rows of a model's input on these days, with the day as a column."""
    if model.parent is not None:
        parent = MODELS[model.parent]
        stored = lake.spark.table(f"`{prefix}{parent.layer}`.`{parent.name}`")
        dated = [d for d in days if d is not None]
        if len(dated) <= LISTED_DAYS:
            rows = stored.where(F.col(DAY).isin(dated))
        else:
            noted = lake.spark.createDataFrame([(d, run) for d in dated], "changed date, run string")
            path = changes_path(lake, model, prefix)
            noted.coalesce(1).write.mode("overwrite").parquet(path)
            changes = lake.spark.read.schema(noted.schema).parquet(path).where(F.col("run") == run)
            rows = stored.join(changes, F.col(DAY) == F.col("changed"), "left_semi")
        return rows.unionByName(stored.where(F.col(DAY).isNull())) if None in days else rows
    folders = [lake.path("bronze", model.source, str(d)) for d in days if d is not None]
    if None in days:
        path = F.col("path")
        loose = lake.list_files("bronze", model.source).where(
            day_of(path, "bronze", model.source).isNull()
        )
        folders += [r[0] for r in loose.select(batch_of(path, "bronze", model.source)).distinct().collect()]
    contract = as_json_text(model.bronze_contract)
    return scan_any_schema(lake, model.source, contract, folders=folders, day_column=DAY)


def _model_rows(
    lake: Lake, model: Model, built: Built, run_date: date | None, prefix: str
) -> DataFrame:
    """The model's rows of the days to write, with their day last."""
    source = changed_days(lake, model, built.written, built.run, prefix)
    if model.parent is None:
        return model.query(source, run_date, keep=(DAY,))
    return model.query(source, keep=(DAY,))


def _write_days(
    lake: Lake, model: Model, built: Built, location: str, run_date: date | None, prefix: str
) -> None:
    spark = lake.spark
    filled: set[date | None] = set()
    if built.written:
        rows = _model_rows(lake, model, built, run_date, prefix)
        # A day that has lost its last row must not keep the old ones; this reads the keys only.
        filled = {r[DAY] for r in rows.select(DAY).distinct().collect()}
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(location)
        columns = T.StructType([f for f in rows.schema.fields if f.name != DAY])
        if not spark.catalog.tableExists(built.table):
            _create(lake, built.table, columns, location)
    if not spark.catalog.tableExists(built.table):
        return
    for day in built.written + built.dropped:
        place = "null" if day is None else f"'{day}'"
        folder = f"{location}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"
        if day in filled:
            spark.sql(
                f"ALTER TABLE {built.table} ADD IF NOT EXISTS PARTITION ({DAY} = {place}) LOCATION '{folder}'"
            )
        else:
            spark.sql(f"ALTER TABLE {built.table} DROP IF EXISTS PARTITION ({DAY} = {place})")
            files.discard(spark, folder)
    spark.catalog.refreshTable(built.table)


def _create(lake: Lake, table: str, columns: T.StructType, location: str) -> None:
    listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns.fields)
    lake.spark.sql(
        f"CREATE TABLE {table} ({listed}, {DAY} date) USING parquet PARTITIONED BY ({DAY}) LOCATION '{location}'"
    )
