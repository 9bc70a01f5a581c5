"""Writing one batch to ``{layer}/{source}/{YYYY-MM-DD}/{filename}.{format}``.

The named entry is a folder of part files, written in parallel. A batch written again under
the same name replaces the earlier one, and only after the new one is complete.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame

from marketlake.functions.paths import check_format, lake_path
from marketlake.sources import files
from marketlake.sources.lake import Lake


def write_batch(
    lake: Lake,
    df: DataFrame,
    source: str,
    date: datetime | None = None,
    filename: str | None = None,
    fmt: str = "parquet",
    layer: str = "bronze",
    accept: Callable[[], None] | None = None,
) -> str:
    """Write a batch and return its path relative to the lake root.

    ``accept`` is called when all rows are written and none is published; if it raises, the
    batch goes and an earlier one of that name stays.
    """
    check_format(fmt)
    relative = lake_path(source, date, filename, fmt, layer)
    write_folder(lake, df, lake.path(relative), fmt, accept)
    return relative


def delete_batch(
    lake: Lake,
    source: str,
    date: datetime,
    filename: str | None = None,
    fmt: str = "parquet",
    layer: str = "bronze",
) -> None:
    """Remove a batch that was written with these arguments."""
    files.discard(lake.spark, lake.path(lake_path(source, date, filename, fmt, layer)))


def write_days(
    lake: Lake,
    df: DataFrame,
    day_column: str,
    source: str,
    filename: str,
    fmt: str = "parquet",
    layer: str = "bronze",
) -> list[str]:
    """Write a batch that has rows of several days, in one job; returns a path per day.

    Every day's rows become a batch of that name in the folder of the day. Days of an earlier write
    under the same name are replaced one by one, so a write that broke off can be repeated.
    """
    spark = lake.spark
    check_format(fmt)
    staged = files.staging_path(lake.path(layer, source, filename))
    writer = df.write.partitionBy(day_column)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    written = []
    try:
        writer.format(fmt).save(staged)
        for folder in files.folder_names(spark, staged):
            _, assigned, day = folder.partition("=")
            if not assigned:
                continue
            relative = lake_path(source, datetime.fromisoformat(day), filename, fmt, layer)
            files.replace(spark, f"{staged}/{folder}", lake.path(relative))
            written.append(relative)
    finally:
        files.discard(spark, staged)
    return written


def write_folder(
    lake: Lake,
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    accept: Callable[[], None] | None = None,
) -> None:
    """Write a folder whole or not at all.

    A new folder is written in place and carries a mark until the last file is there; readers
    skip folders with the mark, so taking it off, one small deletion, is what publishes the
    batch. An existing folder is replaced by a finished copy; one with the mark is a broken
    write and goes first.
    """
    spark = lake.spark
    if files.is_unfinished(spark, target):
        files.discard(spark, target)
    replacing = files.exists(spark, target)
    place = files.staging_path(target) if replacing else target
    files.mark_writing(spark, place)
    writer = df.write.mode("append")
    if fmt == "json":
        # NULL fields are kept; timestamps are ISO text with milliseconds
        writer = writer.option("ignoreNullFields", False)
    try:
        writer.format(fmt).save(place)
        if accept:
            accept()
    except Exception:
        files.discard(spark, place)
        files.mark_finished(spark, place)
        raise
    files.mark_finished(spark, place)
    if replacing:
        files.replace(spark, place, target)
