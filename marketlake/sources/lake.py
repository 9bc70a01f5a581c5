"""Scans over the lake's files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.paths import check_format, day_of, run_of
from marketlake.sources import files


@dataclass(frozen=True)
class Lake:
    """A lake root and the session that reads and writes it."""

    spark: SparkSession
    root: str

    def __post_init__(self) -> None:
        if not self.root:
            raise ValueError("root must be defined")
        object.__setattr__(self, "root", self.root.rstrip("/"))

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    # --- tables over files ------------------------------------------------------------

    def scan(
        self,
        source: str,
        layer: str = "bronze",
        schema: T.StructType | None = None,
        first_day: date | None = None,
        last_day: date | None = None,
        day_column: str | None = None,
        fmt: str = "parquet",
        indexed: bool = False,
    ) -> DataFrame:
        """All finished files below ``{layer}/{source}`` as one table.

        A date range is cut by folder, so other days are not even listed. ``day_column``
        adds the date of the folder a row was read from. Without a schema, Parquet files may
        disagree: the table has the columns of all of them. ``indexed`` plans a Parquet scan from the
        source's file index, after a refresh that opens only new files.
        """
        if indexed and fmt == "parquet":
            from marketlake.sources.index import FileIndex

            index = FileIndex(self, source, layer)
            index.refresh()
            return index.scan(
                contract=schema, day_column=day_column, first_day=first_day, last_day=last_day
            )
        folders = [self.path(layer, source)]
        if first_day or last_day:
            folders = self._day_folders(layer, source, first_day, last_day)
            if not folders and schema is None:
                raise ValueError(f"no {layer}/{source} data between {first_day} and {last_day}")
        if schema is None and fmt == "parquet":
            from marketlake.sources.drift import scan_any_schema

            return scan_any_schema(self, source, None, layer, folders, day_column)
        df = self._read(folders, schema, fmt)
        if day_column:
            day = (
                day_of(F.col("_metadata.file_path"), layer, source)
                if folders
                else F.lit(None).cast("date")
            )
            df = df.select("*", day.alias(day_column))
        return df

    def _day_folders(
        self, layer: str, source: str, first: date | None, last: date | None
    ) -> list[str]:
        low, high = str(first or "0000-00-00"), str(last or "9999-99-99")
        names = files.folder_names(self.spark, self.path(layer, source))
        return [self.path(layer, source, n) for n in names if low <= n <= high]

    def _read(self, folders: list[str], schema: T.StructType | None, fmt: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("recursiveFileLookup", True)
        reader = reader.option("pathGlobFilter", f"*.{check_format(fmt)}")
        if schema is not None:
            reader = reader.schema(schema)
        return finished_only(reader.format(fmt).load(folders), self.spark, folders)

    # --- files as rows ------------------------------------------------------------------

    def list_files(
        self, *prefix: str, suffix: str = ".parquet", limit: int | None = None
    ) -> DataFrame:
        """Files below a prefix: ``path``, ``modificationTime``, ``length``.

        The content column is not selected, so no file is opened.
        """
        listed = self.list_folder(self.path(*prefix), suffix)
        return listed if limit is None else listed.limit(limit)

    def list_folder(self, folder: str, suffix: str = ".parquet", whole: bool = True) -> DataFrame:
        """Files below a folder; without those of unfinished batches if it holds ``whole`` ones."""
        columns = ("path", "modificationTime", "length")
        if not files.exists(self.spark, folder):
            return self.spark.createDataFrame(
                [], "path string, modificationTime timestamp, length bigint"
            )
        listed = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{suffix}")
            .load(folder)
            .select(*columns)
        )
        return finished_only(listed, self.spark, [folder], F.col("path")) if whole else listed

    def list_batches(self, source: str, layer: str = "bronze", suffix: str = ".parquet") -> DataFrame:
        """Batches of a source: path, newest change, bytes, files.

        A batch is what one ingest run wrote: one file, or one folder of part files.
        """
        found = self.list_files(layer, source, suffix=suffix)
        return (
            found.groupBy(batch_of(F.col("path"), layer, source).alias("path"))
            .agg(
                F.max("modificationTime").alias("modified"),
                F.sum("length").alias("bytes"),
                F.count(F.lit(1)).alias("files"),
            )
        )

    def latest_batch(self, source: str, layer: str = "bronze", suffix: str = ".parquet") -> DataFrame:
        """The most recently changed batch as one row, or no row."""
        batches = self.list_batches(source, layer, suffix)
        return batches.orderBy(F.desc("modified"), F.desc("path")).limit(1)

    def latest_batch_path(self, source: str, layer: str = "bronze") -> str | None:
        row = self.latest_batch(source, layer).first()
        return row["path"] if row else None

    def newest_file(self, *prefix: str, suffix: str = ".parquet") -> DataFrame:
        """The newest file by one aggregate, without a sort."""
        return self.list_files(*prefix, suffix=suffix).agg(
            F.max_by("path", F.struct("modificationTime", "path")).alias("path"),
            F.max("modificationTime").alias("modified"),
        )

    def read_batch(self, path: str) -> DataFrame:
        """One Parquet batch; its part files may disagree as those of a source may."""
        from marketlake.sources.drift import read_any_schema

        return read_any_schema(self, path)


def finished_only(
    df: DataFrame, spark: SparkSession, folders: list[str], path: Column | None = None
) -> DataFrame:
    """Without the rows of batches that are still being written, or whose writer died."""
    unfinished = files.unfinished_folders(spark, folders)
    if not unfinished:
        return df
    path = F.col("_metadata.file_path") if path is None else path
    return df.where(~F.regexp_extract(path, r"^(.*)/[^/]*$", 1).isin(unfinished))


def batch_of(path: Column, layer: str, source: str) -> Column:
    """The batch a file belongs to; a file outside date folders is its own batch."""
    return F.coalesce(F.nullif(run_of(path, layer, source), F.lit("")), path)
