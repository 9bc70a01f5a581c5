"""Landed files to bronze batches as they come, each answer once.

The landed folder is a streaming file source: its checkpoint knows which files were read, so a run
takes only new ones, in micro-batches of a bounded number of files. A micro-batch is decoded as by
the ingest job and written under a name made of the stream's id and its own number, with a batch in
the folder of every day on which its answers were fetched. A run that dies before it commits a
micro-batch does the same one again and replaces what it wrote, so nothing is doubled or lost. Files
that come late go to the days they belong to.

Files may also be landed twice under different names. An answer is known by a digest of its source,
key, time, status and body; the digests of published micro-batches are kept by day, and a micro-batch is
compared with those of its own days only. Digests alone are shuffled for that. Bodies are, if any
are repeated within the micro-batch, and then only the repeated ones.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake import contracts
from marketlake.functions.paths import check_format
from marketlake.plans.run_log import append_record
from marketlake.sinks.batches import write_days
from marketlake.sources import files
from marketlake.sources.landing import REST, decode, rule_of
from marketlake.sources.lake import Lake

#: Digests of so many repeated answers are broadcast, 32 bytes each; more meet in a shuffle.
BROADCAST_REPEATS = 1_000_000
#: Late files are taken however old they are; the source remembers every file that long.
MAX_FILE_AGE = "3650d"

DAY, DIGEST, BATCH = "_day", "_digest", "batch"


@dataclass
class Ingested:
    """What the micro-batches of a run did."""

    paths: list[str] = field(default_factory=list)
    batches: int = 0
    answers: int = 0
    rejected: int = 0
    repeated: int = 0
    rows: int = 0


def stream_folder(lake: Lake, source: str, *parts: str) -> str:
    return lake.path("_streams", source, *parts)


def landed_stream(
    lake: Lake, path: str, fmt: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """New landed files; an answer without a time was fetched when its file was written."""
    reader = lake.spark.readStream.schema(contracts.LANDED).format(fmt)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{check_format(fmt)}")
    reader = reader.option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", MAX_FILE_AGE)
    return reader.load(path).withColumn(
        "fetched_at", F.coalesce("fetched_at", "_metadata.file_modification_time")
    )


def ingest_new(lake: Lake, source: str, landed: str, **options) -> Ingested:
    """Ingest all files that are there and new, then stop; fails as the ingest job does."""
    query, done = start_ingest(lake, source, landed, **options)
    query.awaitTermination()
    return done


def start_ingest(
    lake: Lake,
    source: str,
    landed: str,
    *,
    landed_fmt: str = "parquet",
    fmt: str = "parquet",
    layer: str = "bronze",
    contract: T.StructType | None = None,
    files_per_batch: int = 1000,
    skip_rejected: bool = False,
    every: str | None = None,
    published: Callable[[int], None] | None = None,
) -> tuple[StreamingQuery, Ingested]:
    """The running stream, and what it has done so far.

    It ends when all present files are done, or goes on, looking for new ones ``every`` interval.
    ``skip_rejected`` leaves out answers that would stop the run. ``published`` is called with the
    number of a micro-batch when its rows are in place and it is not yet committed.
    """
    rule_of(source)
    check_format(fmt)
    done, running = Ingested(), threading.Event()
    holder: dict[str, StreamingQuery] = {}

    def write(frame: DataFrame, number: int) -> None:
        running.wait()
        name = f"{source}_{holder['query'].id.split('-')[0]}_{number:08d}"
        own = Lake(frame.sparkSession, lake.root)
        about = {"pipeline_id": name, "source": source, "layer": layer}
        try:
            _write_batch(own, frame.where(F.col("source") == source), name)
            if published:
                published(number)
        except Exception as error:
            append_record(
                own, level="error", event="pipeline_failed", error=str(error), success=False, **about
            )
            raise

    def _write_batch(own: Lake, frame: DataFrame, name: str) -> None:
        pending = stream_folder(own, source, f"_pending-{name}")
        marked = frame.withColumns({DIGEST: digest(), DAY: F.to_date("fetched_at")})
        marked.select(DIGEST, DAY).write.mode("overwrite").partitionBy(DAY).parquet(pending)
        fresh, repeated = without_repeats(own, source, marked, pending, name)
        answers, records = Observation(), Observation()
        rows = decode(
            fresh, source, contract, counted=answers, rest=REST, day_column=DAY, skip=skip_rejected
        )
        rows = rows.observe(records, F.count(F.lit(1)).alias("rows"))
        paths = write_days(own, rows, DAY, source, name, fmt, layer)
        for folder in files.folder_names(own.spark, pending):
            if not folder.startswith(f"{DAY}="):
                continue
            seen = stream_folder(own, source, "seen", folder, f"{BATCH}={name}")
            files.replace(own.spark, f"{pending}/{folder}", seen)
        files.discard(own.spark, pending)
        counts = answers.get
        done.paths += paths
        done.batches += 1
        done.answers += counts["answers"]
        done.rejected += counts["rejected"]
        done.repeated += repeated
        done.rows += records.get["rows"]
        append_record(
            own,
            level="info",
            event="pipeline_completed",
            pipeline_id=name,
            source=source,
            layer=layer,
            path=",".join(paths),
            answers=counts["answers"],
            rejected=counts["rejected"],
            rows=records.get["rows"],
            columns_count=len(rows.columns) - 1,
            success=True,
        )

    trigger = {"processingTime": every} if every else {"availableNow": True}
    holder["query"] = (
        landed_stream(lake, landed, landed_fmt, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", stream_folder(lake, source, "checkpoint"))
        .trigger(**trigger)
        .start()
    )
    running.set()
    return holder["query"], done


def digest() -> Column:
    """SHA-256 of an answer; texts are told apart by their lengths."""
    facts = ("source", "request_key", "fetched_at", "status", "body")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in facts]
    return F.unhex(F.sha2(F.concat_ws("|", *(F.concat(F.length(p), F.lit(":"), p) for p in parts)), 256))


def without_repeats(
    lake: Lake, source: str, marked: DataFrame, pending: str, name: str
) -> tuple[DataFrame, int]:
    """The answers that no published micro-batch has, each once, and how many more there were."""
    spark = lake.spark
    columns = f"{DIGEST} binary, {DAY} date"
    own = spark.read.schema(columns).parquet(pending)
    counts = own.groupBy(DAY, DIGEST).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("known", F.lit(False))
    earlier = stream_folder(lake, source, "seen")
    if files.exists(spark, earlier):
        days = [r[DAY] for r in own.select(DAY).distinct().collect()]
        seen = spark.read.schema(f"{columns}, {BATCH} string").parquet(earlier)
        seen = seen.where(F.col(DAY).isin(days) & (F.col(BATCH) != name)).select(DAY, DIGEST).distinct()
        known = F.col("there").isNotNull().alias("known")
        counts = counts.drop("known").join(seen.withColumn("there", F.lit(True)), [DAY, DIGEST], "left")
        counts = counts.select(DAY, DIGEST, "n", known)
    odd = f"{pending}/_odd"
    counts.where("known or n > 1").select(DIGEST, "n", "known").write.mode("overwrite").parquet(odd)
    repeats = spark.read.schema(f"{DIGEST} binary, n long, known boolean").parquet(odd)
    kinds, more = repeats.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.expr("if(known, n, n - 1)")), F.lit(0))
    ).first()
    if not kinds:
        return marked, 0
    repeats = repeats.select(DIGEST, "known")
    if kinds <= BROADCAST_REPEATS:
        repeats = F.broadcast(repeats)
    joined = marked.join(repeats, DIGEST, "left")
    once = joined.where(F.col("known").isNull())
    several = joined.where(~F.col("known")).dropDuplicates([DIGEST])
    return once.unionByName(several), more
