"""Models as external tables registered in the database of their layer.

A table that is built again is written into a folder of its own, and the registration is pointed to
that folder when it is complete, so the table can be read at every moment. The folder it had before
stays until the next build, for queries that are still reading it; scans of the library skip it. The
first build of a table is at the model's location, later ones beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake import contracts
from marketlake.functions.paths import model_location
from marketlake.functions.records import quoted
from marketlake.sinks.batches import write_folder
from marketlake.sources import files
from marketlake.sources.lake import Lake


def publish_table(
    lake: Lake,
    df: DataFrame,
    layer: str,
    name: str,
    database: str | None = None,
    full_refresh: bool = False,
    accept: Callable[[DataFrame], None] | None = None,
) -> str:
    """Rebuild a model's table from its query and register it; returns the table name.

    The new files are complete before the table points to them. ``accept`` gets the written rows
    before that; if it raises, they go and the table stays as it was. A change of columns, like
    ``full_refresh``, makes the registration anew.
    """
    spark = lake.spark
    database = database or layer
    table = f"`{database}`.`{name}`"
    ensure_database(lake, layer, database)
    current = table_location(spark, table)
    target = _new_place(lake, layer, name, current)
    write_folder(lake, df, target)
    if accept:
        try:
            accept(spark.read.schema(df.schema).parquet(target))
        except Exception:
            files.discard(spark, target)
            raise
    same = current and spark.table(table).dtypes == df.dtypes and not _spec(spark, table)
    if same and not full_refresh:
        _point(spark, table, target)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=target, source="parquet", schema=df.schema)
    _forget(lake, layer, name, target, current)
    return table


def publish_bucketed(
    lake: Lake,
    df: DataFrame,
    layer: str,
    name: str,
    keys: list[str],
    buckets: int = 64,
    database: str | None = None,
) -> str:
    """Rebuild a model's table in sorted buckets of its keys; returns the table name.

    Joins and counts on the keys between tables with as many buckets need no shuffle. Rows are dealt
    out by the keys once, here, so there is one file per bucket.
    """
    spark = lake.spark
    database = database or layer
    table = f"`{database}`.`{name}`"
    ensure_database(lake, layer, database)
    current = table_location(spark, table)
    target = _new_place(lake, layer, name, current)
    shadow = f"`{database}`.`{name}_{uuid.uuid4().hex[:12]}`"
    writer = df.repartition(buckets, *map(quoted, keys)).write.format("parquet")
    writer = writer.bucketBy(buckets, keys).sortBy(keys).option("path", target)
    try:
        writer.saveAsTable(shadow)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {shadow}")
        files.discard(spark, target)
        raise
    same = current and spark.table(table).dtypes == spark.table(shadow).dtypes
    if same and _spec(spark, table) == _spec(spark, shadow):
        _point(spark, table, target)
        spark.sql(f"DROP TABLE {shadow}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {shadow} RENAME TO {table}")
    _forget(lake, layer, name, target, current)
    return table


def table_location(spark: SparkSession, table: str) -> str | None:
    """The folder a table points to; None if there is no such table."""
    return _details(spark, table).get("Location") if spark.catalog.tableExists(table) else None


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _spec(spark: SparkSession, table: str) -> dict[str, str]:
    """How a table is bucketed or partitioned; nothing if it is neither."""
    details = _details(spark, table)
    kept = ("Num Buckets", "Bucket Columns", "Sort Columns", "# Partition Information")
    return {k: details[k] for k in kept if k in details}


def _new_place(lake: Lake, layer: str, name: str, current: str | None) -> str:
    base = model_location(lake.root, layer, name)
    if current is None:
        return base
    return f"{base.removesuffix('.parquet')}-{uuid.uuid4().hex}.parquet"


def _point(spark: SparkSession, table: str, folder: str) -> None:
    escaped = folder.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{escaped}'")
    spark.catalog.refreshTable(table)


def _forget(lake: Lake, layer: str, name: str, target: str, before: str | None) -> None:
    """Hide the folder of the last build from scans, and remove those of earlier ones."""
    spark, home = lake.spark, lake.path(layer, name)
    own, last = (k.rstrip("/").rpartition("/")[2] if k else None for k in (target, before))
    for folder in files.folder_names(spark, home):
        versions = folder == f"{name}.parquet" or (folder.startswith(f"{name}-") and folder.endswith(".parquet"))
        if not versions or folder == own:
            continue
        if folder == last:
            # Scans of the library skip what has this mark.
            files.mark_writing(spark, f"{home}/{folder}")
        else:
            files.discard(spark, f"{home}/{folder}")
            files.mark_finished(spark, f"{home}/{folder}")


def ensure_database(lake: Lake, layer: str, database: str | None = None) -> None:
    location = lake.path(layer).replace("'", "\\'")
    lake.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database or layer}` LOCATION '{location}'")


def create_layout(
    lake: Lake,
    layers: tuple[str, ...] = contracts.LAYERS,
    sources: tuple[str, ...] = contracts.SOURCES,
    prefix: str = "",
) -> list[str]:
    """One database per layer and one folder per layer and source; returns the folders."""
    created = []
    for layer in layers:
        ensure_database(lake, layer, f"{prefix}{layer}")
        for source in sources:
            folder = lake.path(layer, source)
            files.make_folder(lake.spark, folder)
            created.append(folder)
    return created
