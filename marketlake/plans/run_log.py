"""Run records: JSON lines below ``_runs`` in the lake, one per job."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.sources import files
from marketlake.sources.lake import Lake

RUN_RECORD = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("timestamp", T.StringType()),
            ("level", T.StringType()),
            ("event", T.StringType()),
            ("pipeline_id", T.StringType()),
            ("source", T.StringType()),
            ("layer", T.StringType()),
            ("path", T.StringType()),
            ("answers", T.LongType()),
            ("rejected", T.LongType()),
            ("rows", T.LongType()),
            ("columns_count", T.IntegerType()),
            ("extract_time_ms", T.DoubleType()),
            ("transform_time_ms", T.DoubleType()),
            ("load_time_ms", T.DoubleType()),
            ("total_time_ms", T.DoubleType()),
            ("file_size_bytes", T.LongType()),
            ("success", T.BooleanType()),
            ("error", T.StringType()),
        )
    ]
)


def append_record(lake: Lake, **fields) -> None:
    """Append one run record: a line in a file of its own, without a job."""
    fields.setdefault("timestamp", datetime.now(UTC).isoformat())
    if unknown := fields.keys() - set(RUN_RECORD.fieldNames()):
        raise ValueError(f"a run record has no {', '.join(sorted(unknown))}")
    line = json.dumps({n: fields[n] for n in RUN_RECORD.fieldNames() if fields.get(n) is not None})
    name = f"{fields['timestamp'].replace(':', '')}-{uuid.uuid4().hex}.json"
    files.make_folder(lake.spark, lake.path("_runs"))
    files.write_line(lake.spark, lake.path("_runs", name), line)


def run_log(lake: Lake) -> DataFrame:
    """All run records; none in a lake without runs."""
    if not files.exists(lake.spark, lake.path("_runs")):
        return lake.spark.createDataFrame([], RUN_RECORD)
    return lake.spark.read.schema(RUN_RECORD).json(lake.path("_runs"))


def query_log(
    logs: DataFrame,
    level: str | None = None,
    pipeline_id: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """Log records of a level (any letter case), a run or a source."""
    if level is not None:
        logs = logs.where(F.lower("level") == level.lower())
    if pipeline_id is not None:
        logs = logs.where(F.col("pipeline_id") == pipeline_id)
    if source is not None:
        logs = logs.where(F.col("source") == source)
    return logs
