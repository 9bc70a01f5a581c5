"""Lake paths: ``{layer}/{source}/{YYYY-MM-DD}/{filename}.{format}``.

The ``Column`` forms run on executors, for instance over ``_metadata.file_path``; the plain
form is for the one path a job writes to.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.contracts import FILE_FORMATS

DAY_FOLDER = r"\d{4}-\d{2}-\d{2}"


# How existing lakes write the day of a batch, and the time of one without a name.
# Dates are written by Python for one path and by Spark for a column of them.
DAY = ("%Y-%m-%d", "yyyy-MM-dd")
STAMP = ("%Y%m%d_%H%M%S", "yyyyMMdd_HHmmss")


def check_format(fmt: str) -> str:
    if fmt not in FILE_FORMATS:
        raise ValueError(f"Unsupported format: {fmt} is none of {', '.join(FILE_FORMATS)}")
    return fmt


def run_id(source: str, date: datetime) -> str:
    return f"{source}_{date.strftime(STAMP[0])}"


def lake_path(
    source: str,
    date: datetime | None = None,
    filename: str | None = None,
    fmt: str = "parquet",
    layer: str = "bronze",
) -> str:
    """Path of one batch, relative to the lake root."""
    date = date or datetime.now(UTC)
    stem = (filename or run_id(source, date)).removesuffix(f".{fmt}")
    return f"{layer}/{source}/{date.strftime(DAY[0])}/{stem}.{fmt}"


def lake_path_column(
    source: Column,
    date: Column,
    filename: Column | None = None,
    fmt: str = "parquet",
    layer: str = "bronze",
) -> Column:
    """The same path for every row of a table of batches."""
    unnamed = F.concat(source, F.lit("_"), F.date_format(date, STAMP[1]))
    stem = unnamed if filename is None else F.coalesce(filename, unnamed)
    day = F.date_format(date, DAY[1])
    entry = F.concat(F.regexp_replace(stem, rf"\.{fmt}$", ""), F.lit(f".{fmt}"))
    return F.concat(F.lit(f"{layer}/"), source, F.lit("/"), day, F.lit("/"), entry)


def parse_lake_path(path: Column) -> Column:
    """Split a lake path into a struct; fewer than four parts is an error.

    The check sits below the fields, so that Spark splits each path once for all of them.
    """
    split = F.split(F.btrim(path, F.lit("/")), "/")
    problem = F.concat(
        F.lit("Invalid lake path: "), path, F.lit(". Expected: layer/source/date/filename")
    )
    parts = F.when(F.size(split) < 4, F.raise_error(problem)).otherwise(split)
    file = F.get(parts, F.lit(3))
    dotted = file.contains(".")
    extension = F.substring_index(file, ".", -1)
    stem = F.substring(file, F.lit(1), F.length(file) - F.length(extension) - 1)
    return F.struct(
        F.get(parts, F.lit(0)).alias("layer"),
        F.get(parts, F.lit(1)).alias("source"),
        F.get(parts, F.lit(2)).alias("date"),
        F.when(dotted, stem).otherwise(file).alias("filename"),
        F.when(dotted, extension).when(~dotted, F.lit("unknown")).alias("format"),
        path.alias("full_path"),
    )


def run_of(path: Column, layer: str, source: str) -> Column:
    """The batch a data file belongs to: the full path up to the entry below the date folder."""
    return F.regexp_extract(path, f"^(.*/{layer}/{source}/{DAY_FOLDER}/[^/]+)", 1)


def day_of(path: Column, layer: str, source: str) -> Column:
    """Date folder of a data file as a date, NULL outside date folders."""
    day = F.regexp_extract(path, f"/{layer}/{source}/({DAY_FOLDER})/", 1)
    return F.try_to_date(F.nullif(day, F.lit("")), "yyyy-MM-dd")


def model_location(root: str, layer: str, table: str) -> str:
    """Where a model is stored; in Spark the last part is a directory of part files."""
    return f"{root.rstrip('/')}/{layer}/{table}/{table}.parquet"
