"""Session settings the lake relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC: a timestamp becomes the same date on every machine.
# outputTimestampType: files hold standard timestamps, with usable statistics.
# nanosAsLong: price files written with nanosecond timestamps are readable.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that already runs; all of them are runtime settings."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder, removed when Spark ends.

    The session names it in ``spark.checkpoint.dir`` or by ``setCheckpointDir``. Only a local
    master may go without, as in tests, for it has no other machine to share with.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        given = context._jsc.sc().getCheckpointDir()
        shared = given.get() if given.isDefined() else None
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.gettempdir()
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/marketlake-{uuid.uuid4().hex}")
    # The file system does this when the session's JVM ends.
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return folder.toString()
