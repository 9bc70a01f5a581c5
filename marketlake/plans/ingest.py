"""The ingest job: landed answers to one bronze batch, with a run record."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.paths import check_format, run_id
from marketlake.operators.normalize import require_rows
from marketlake.operators.profile import BYTES_PER_VALUE
from marketlake.plans.run_log import append_record
from marketlake.sinks.batches import write_batch
from marketlake.sources.landing import REST, decode
from marketlake.sources.lake import Lake


def ingest(
    lake: Lake,
    source: str,
    landed: DataFrame,
    date: datetime | None = None,
    filename: str | None = None,
    fmt: str = "parquet",
    layer: str = "bronze",
    contract: T.StructType | None = None,
) -> str:
    """Decode the landed answers of one run and write them as one batch; returns its path.

    The batch has the contract's columns and, in ``other_fields``, every field the contract does
    not name. Answers are decoded and written in one pass, which also counts the answers, the
    rejected ones and the rows; ``landing.rejects`` lists the rejected ones. A run that fails leaves
    no data, only its run record.
    """
    date = date or datetime.now(UTC)
    pipeline_id = run_id(source, date)
    clock = _Clock()
    about = {"pipeline_id": pipeline_id, "source": source, "layer": layer}
    try:
        check_format(fmt)
        extract_ms = clock.lap()
        answers, records = Observation(), Observation()
        batch = decode(landed, source, contract, counted=answers, rest=REST)
        batch = batch.observe(records, F.count(F.lit(1)).alias("rows"))
        transform_ms = clock.lap()
        path = write_batch(
            lake,
            batch,
            source,
            date,
            filename,
            fmt,
            layer,
            accept=lambda: require_rows(records.get["rows"], source),
        )
        load_ms = clock.lap()
        rows, seen = records.get["rows"], answers.get
    except Exception as error:
        append_record(
            lake,
            level="error",
            event="pipeline_failed",
            error=str(error),
            total_time_ms=clock.total(),
            success=False,
            **about,
        )
        raise
    append_record(
        lake,
        level="info",
        event="pipeline_completed",
        path=path,
        answers=seen["answers"],
        rejected=seen["rejected"],
        rows=rows,
        columns_count=len(batch.columns),
        extract_time_ms=extract_ms,
        transform_time_ms=transform_ms,
        load_time_ms=load_ms,
        total_time_ms=clock.total(),
        file_size_bytes=rows * len(batch.columns) * BYTES_PER_VALUE,
        success=True,
        **about,
    )
    return path


class _Clock:
    def __init__(self) -> None:
        self.start = self.last = time.monotonic()

    def lap(self) -> float:
        now = time.monotonic()
        spent, self.last = now - self.last, now
        return round(spent * 1000, 2)

    def total(self) -> float:
        return round((time.monotonic() - self.start) * 1000, 2)
