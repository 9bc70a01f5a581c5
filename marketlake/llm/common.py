"""What the corpus operators share: reading inputs, cutting lineage, small text expressions."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Columns of the documents table.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows from a reliable checkpoint in the shared folder, so that a lost executor
    costs a read and not the whole lineage. Spark removes the files when the frame is gone."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="marketlake-checkpoint-")
        context.setCheckpointDir(shared)
    return df.checkpoint()


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: compact, for rows with texts."""
    path = path or scratch_root(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def document_columns(df: DataFrame) -> list[str]:
    return [c for c in DOCUMENT_COLUMNS if c in df.columns]
