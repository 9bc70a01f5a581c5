"""Small inputs as tables, stacking of batches, and the partial-failure rule."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.sources.landing import REJECTED, answers, rule_of


def to_table(
    spark: SparkSession,
    data: DataFrame | dict[str, Any] | list[dict[str, Any]],
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table from a table, one record or a list of records held by the caller.

    Nested values of mixed types become JSON text. Landed data is read by ``read_records``.
    """
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, dict):
        data = [data]
    if not isinstance(data, list):
        raise ValueError(f"Unsupported data type for a table: {type(data).__name__}")
    if not data:
        return spark.createDataFrame([], schema or T.StructType([]))
    if schema is not None:
        return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in data], schema)
    frame = pd.DataFrame(data)
    try:
        table = pa.Table.from_pandas(frame, preserve_index=False)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, pa.ArrowTypeError):
        table = pa.Table.from_pandas(frame.map(_nested_text), preserve_index=False)
    return spark.createDataFrame(table)


def _nested_text(value: Any) -> Any:
    return json.dumps(value, default=str) if isinstance(value, (dict, list)) else value


def read_records(
    spark: SparkSession, path: str, contract: T.StructType, one_per_file: bool = True
) -> DataFrame:
    """Landed JSON documents, each one record or an array of records.

    Documents come one per file, or else one per line, which lets Spark split large files.
    """
    reader = spark.read.schema(contract).option("multiLine", one_per_file)
    return reader.option("mode", "FAILFAST").json(path)


def stack(batches: Iterable[DataFrame]) -> DataFrame:
    """Stack batches by column name; a column a batch lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def request_status(
    landed: DataFrame, source: str, requested: DataFrame | None = None
) -> DataFrame:
    """Per request key: answers, rejected answers, records, and whether it was fetched.

    ``requested`` (column ``request_key``) adds the keys that have no answer at all.
    """
    read = answers(landed, source).select(
        "request_key",
        F.col("outcome").isin(*REJECTED).cast("long").alias("rejected"),
        F.coalesce(F.size("records"), F.lit(0)).cast("long").alias("records"),
    )
    per_key = read.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("answers"),
        F.sum("rejected").alias("rejected"),
        F.sum(F.when(F.col("rejected") == 0, F.col("records")).otherwise(0)).alias("records"),
    )
    if requested is not None:
        per_key = requested.select("request_key").distinct().join(per_key, "request_key", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("answers", "rejected", "records")]
    fetched = F.when(F.coalesce("records", F.lit(0)) > 0, "fetched").otherwise("skipped")
    return per_key.select("request_key", *counts, fetched.alias("status"))


def require_records(records: DataFrame, source: str) -> DataFrame:
    """Fail if no answer of the source held any record; stops at the first one found."""
    if rule_of(source).needed:
        require_rows(0 if records.isEmpty() else 1, source)
    return records


def require_rows(rows: int, source: str) -> None:
    """Fail if a source that must give records gave none."""
    needed = rule_of(source).needed
    if needed and not rows:
        raise ValueError(f"No data extracted for any {needed}")
