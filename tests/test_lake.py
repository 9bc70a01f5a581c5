import json
import os
from datetime import date, datetime
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import contracts
from marketlake.functions import as_json_text
from marketlake.functions.paths import lake_path
from marketlake.sinks.batches import write_batch, write_folder
from marketlake.sinks.tables import create_layout, publish_table
from marketlake.plans.query import query_source
from marketlake.plans.run_log import run_log
from marketlake.session import scratch_root
from marketlake.sources import catalog, drift, files
from marketlake.sources.drift import scan_any_schema
from marketlake.sources.lake import Lake
from tests.conftest import plan

DAY1, DAY2 = datetime(2025, 1, 17, 6), datetime(2025, 1, 18, 6)


def two_days(lake):
    df = lake.spark.range(10).withColumn("value", F.col("id") * 2)
    first = write_batch(lake, df.where("id < 4"), "demo", DAY1)
    second = write_batch(lake, df.where("id >= 4"), "demo", DAY2, "named")
    return first, second


def legacy_file(lake, source, day, name, frame):
    """One file per run, as written by other tools."""
    folder = lake.path("bronze", source, day)
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), f"{folder}/{name}.parquet")


def test_root_is_needed(spark):
    with pytest.raises(ValueError, match="root must be defined"):
        Lake(spark, "")


# --- batches -------------------------------------------------------------------------


def test_write_gives_the_lake_path_and_round_trips(lake):
    first, second = two_days(lake)
    assert first == "bronze/demo/2025-01-17/demo_20250117_060000.parquet"
    assert second == "bronze/demo/2025-01-18/named.parquet"
    assert len(first.split("/")) == 4
    assert sorted(r["id"] for r in lake.scan("demo").collect()) == list(range(10))


def test_write_json_keeps_nulls_and_iso_dates(lake):
    df = lake.spark.sql("select 'a' as id, cast(null as int) as n, timestamp'2025-01-17 01:02:03.5' as at")
    path = write_batch(lake, df, "demo", DAY1, fmt="json")
    assert path.endswith(".json")
    lines = lake.spark.read.text(lake.path(path)).collect()
    assert [json.loads(r["value"]) for r in lines] == [
        {"id": "a", "n": None, "at": "2025-01-17T01:02:03.500Z"}
    ]


def test_write_rejects_other_formats(lake):
    with pytest.raises(ValueError, match="Unsupported format: csv"):
        write_batch(lake, lake.spark.range(1), "demo", fmt="csv")


def test_the_same_batch_replaces_itself(lake):
    write_batch(lake, lake.spark.range(5), "demo", DAY1)
    write_batch(lake, lake.spark.range(2), "demo", DAY1)
    assert lake.scan("demo").count() == 2
    folder = lake.path("bronze", "demo", "2025-01-17")
    assert [n for n in os.listdir(folder) if n.startswith("_")] == []


def test_failed_write_leaves_nothing_or_the_old_batch(lake):
    broken = lake.spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(
        F.raise_error(F.lit("broken"))).cast("long").alias("id"))
    target = lake.path(lake_path("demo", DAY1))
    with pytest.raises(Exception, match="broken"):
        write_folder(lake, broken, target)
    assert not os.path.exists(target)
    write_batch(lake, lake.spark.range(3), "demo", DAY1)
    with pytest.raises(Exception, match="broken"):
        write_folder(lake, broken, target)
    assert lake.scan("demo").count() == 3


# --- scans ---------------------------------------------------------------------------


def test_scan_adds_the_folder_day(lake):
    two_days(lake)
    days = lake.scan("demo", day_column="day").groupBy("day").count().collect()
    assert {r["day"]: r["count"] for r in days} == {date(2025, 1, 17): 4, date(2025, 1, 18): 6}


def test_filter_on_the_folder_day_skips_files(lake):
    two_days(lake)
    one = lake.scan("demo", day_column="day").where("day = date'2025-01-17'").select("id")
    assert len(one.collect()) == 4
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numFiles").value()
    first = [f for f in lake.scan("demo").inputFiles() if "2025-01-17" in f]
    assert read == len(first)


def test_scan_of_days_lists_only_their_folders(lake):
    two_days(lake)
    later = lake.scan("demo", first_day=date(2025, 1, 18))
    assert all("2025-01-18" in f for f in later.inputFiles())
    assert later.count() == 6
    assert lake.scan("demo", last_day=date(2025, 1, 17)).count() == 4
    schema = T.StructType([T.StructField("id", T.LongType())])
    none = lake.scan("demo", schema=schema, first_day=date(2026, 1, 1), day_column="day")
    assert none.columns == ["id", "day"] and none.count() == 0
    with pytest.raises(ValueError, match="no bronze/demo data"):
        lake.scan("demo", first_day=date(2026, 1, 1))


def test_scan_prunes_columns_and_pushes_filters(lake):
    two_days(lake)
    text = plan(lake.scan("demo").where("value > 4").select("value"))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,4)]" in text
    assert "ReadSchema: struct<value:bigint>" in text


def test_listing_and_latest(lake):
    assert lake.list_files("bronze", "demo").count() == 0
    assert lake.latest_batch_path("demo") is None
    first, second = two_days(lake)
    listed = lake.list_files("bronze", "demo")
    assert "content" not in plan(listed)
    assert listed.count() == len(lake.scan("demo").inputFiles())
    assert lake.list_files("bronze", "demo", limit=1).count() == 1
    assert lake.list_files("bronze", "demo", suffix=".json").count() == 0
    assert lake.latest_batch_path("demo").endswith(second)
    assert second in lake.newest_file("bronze", "demo").first()["path"]
    assert lake.read_batch(lake.latest_batch_path("demo")).count() == 6
    batches = {r["path"][-len(first):]: r["files"] for r in lake.list_batches("demo").collect()}
    assert first in batches


# --- files that disagree ---------------------------------------------------------------


def test_drift_is_read_without_loss(lake):
    legacy_file(lake, "defillama", "2025-01-17", "a", pd.DataFrame(
        {"id": ["1"], "tvl": [5], "chains": [["A", "B"]], "chainTvls": [{"A": 1.0}], "mcap": [None]}))
    legacy_file(lake, "defillama", "2025-01-17", "b", pd.DataFrame(
        {"id": ["2"], "tvl": [1.5], "chains": ['["C"]'], "chainTvls": ['{"C": 2.0}']}))
    legacy_file(lake, "defillama", "2025-01-18", "c", pd.DataFrame(
        {"id": ["3"], "tvl": [2.5], "chainTvls": [{"D": 4.0, "E": 5.0}], "name": ["c"]}))
    contract = contracts.BRONZE_DEFILLAMA
    rows = {r["id"]: r for r in scan_any_schema(lake, "defillama", contract).collect()}
    assert {k: r["tvl"] for k, r in rows.items()} == {"1": 5.0, "2": 1.5, "3": 2.5}
    assert {k: r["chains"] for k, r in rows.items()} == {"1": ["A", "B"], "2": ["C"], "3": None}
    assert {k: r["chainTvls"] for k, r in rows.items()} == {
        "1": {"A": 1.0}, "2": {"C": 2.0}, "3": {"D": 4.0, "E": 5.0},
    }
    assert rows["3"]["name"] == "c" and rows["1"]["mcap"] is None
    text = scan_any_schema(lake, "defillama", as_json_text(contract))
    assert {r["id"]: r["chains"] for r in text.collect()} == {"1": '["A","B"]', "2": '["C"]', "3": None}


def test_structs_with_other_fields_share_one_scan(lake):
    for i, tvls in enumerate(({"A": 1.0}, {"B": 2.0}, {"A": 3.0, "C": 4.0})):
        legacy_file(lake, "defillama", f"2025-01-1{i}", "x", pd.DataFrame({"id": [str(i)], "chainTvls": [tvls]}))
    read = scan_any_schema(lake, "defillama", contracts.BRONZE_DEFILLAMA)
    assert plan(read).count("FileScan") == 1
    assert sorted((r["id"], r["chainTvls"]) for r in read.collect()) == [
        ("0", {"A": 1.0}), ("1", {"B": 2.0}), ("2", {"A": 3.0, "C": 4.0}),
    ]


def test_nanosecond_and_old_style_timestamps(lake):
    zoned = pd.Series(pd.date_range("2025-01-01", periods=1, tz="America/New_York"))
    bars = pd.DataFrame({"Date": zoned.astype("datetime64[ns, America/New_York]"),
                         "Symbol": ["AAPL"], "Volume": [5]})
    legacy_file(lake, "yahoo_finance", "2025-01-01", "a", bars)
    lake.spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    old = lake.spark.sql("select timestamp'2025-01-02 05:00:00' as Date, 'MSFT' as Symbol")
    write_batch(lake, old, "yahoo_finance", datetime(2025, 1, 2))
    lake.spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    new = lake.spark.sql("select timestamp'2025-01-03 05:00:00' as Date, 'TSLA' as Symbol")
    write_batch(lake, new, "yahoo_finance", datetime(2025, 1, 3))
    local = pd.DataFrame({"Date": pd.to_datetime(["2025-01-04 05:00:00"]).astype("datetime64[us]"),
                          "Symbol": ["NVDA"]})
    legacy_file(lake, "yahoo_finance", "2025-01-04", "a", local)
    read = scan_any_schema(lake, "yahoo_finance", contracts.BRONZE_YAHOO_FINANCE)
    assert sorted((r["Symbol"], str(r["Date"])) for r in read.select(
        "Symbol", F.col("Date").cast("string").alias("Date")).collect()) == [
        ("AAPL", "2025-01-01 05:00:00"), ("MSFT", "2025-01-02 05:00:00"), ("NVDA", "2025-01-04 05:00:00"),
        ("TSLA", "2025-01-03 05:00:00"),
    ]


def test_uniform_source_is_one_scan_with_pushdown(lake):
    two_days(lake)
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("gone", T.StringType())])
    read = scan_any_schema(lake, "demo", contract)
    text = plan(read.where("id is not null"))
    assert text.count("FileScan") == 1 and "IsNotNull(id)" in text
    assert read.count() == 10


def test_empty_source_is_an_empty_table(lake):
    read = scan_any_schema(lake, "nothing", contracts.BRONZE_COINGECKO)
    assert read.schema == contracts.BRONZE_COINGECKO and read.count() == 0


# --- tables --------------------------------------------------------------------------


def test_publish_registers_and_rebuilds(lake):
    spark = lake.spark
    table = publish_table(lake, spark.range(5), "silver", "t1", database="pub_silver")
    assert spark.table(table).count() == 5
    assert os.path.isdir(lake.path("silver", "t1", "t1.parquet"))
    publish_table(lake, spark.range(2), "silver", "t1", database="pub_silver")
    assert spark.table(table).count() == 2
    changed = spark.range(3).withColumn("x", F.lit("y"))
    publish_table(lake, changed, "silver", "t1", database="pub_silver")
    assert catalog.table(spark, "pub_silver", "t1").columns == ["id", "x"]
    publish_table(lake, spark.range(1), "silver", "t1", database="pub_silver", full_refresh=True)
    assert catalog.table(spark, "pub_silver", "t1").count() == 1
    assert lake.scan("t1", layer="silver").count() == 1


def test_failed_rebuild_keeps_the_old_table(lake):
    spark = lake.spark
    table = publish_table(lake, spark.range(5), "silver", "t2", database="keep_silver")
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish_table(lake, broken, "silver", "t2", database="keep_silver")
    assert spark.table(table).count() == 5


def test_layout_and_catalog_listing(lake):
    spark = lake.spark
    folders = create_layout(lake, prefix="lay_")
    assert len(folders) == len(contracts.LAYERS) * len(contracts.SOURCES)
    assert all(os.path.isdir(f) for f in folders)
    create_layout(lake, prefix="lay_")
    names = {r["database"] for r in catalog.list_databases(spark).collect()}
    assert {"lay_bronze", "lay_silver", "lay_gold"} <= names
    assert catalog.database_location(spark, "lay_gold").endswith("/lake/gold")
    assert catalog.database_location(spark, "absent") is None
    assert catalog.table_sizes(spark, "lay_gold").count() == 0
    publish_table(lake, spark.range(4), "gold", "g", database="lay_gold")
    assert catalog.list_tables(spark, "lay_gold").collect() == [("lay_gold", "g")]
    assert catalog.table_sizes(spark, "lay_gold").collect() == [("lay_gold", "g", 4)]


# --- files that disagree, without a contract -----------------------------------------


def test_every_part_file_of_a_batch_counts(lake):
    batch = lake.path("bronze", "parts", "2025-01-17", "b.parquet")
    lake.spark.sql("select 1 as a").write.parquet(batch)
    lake.spark.sql("select 2 as a, 5 as b").write.mode("append").parquet(batch)
    contract = T.StructType().add("a", "integer").add("b", "integer")
    want = [(1, None), (2, 5)]
    for table in (
        drift.scan_any_schema(lake, "parts", contract),
        lake.scan("parts"),
        lake.read_batch(batch),
        query_source(lake, "parts"),
    ):
        assert sorted(map(tuple, table.select("a", "b").collect())) == want


@pytest.mark.parametrize("few", [0, 32])
def test_default_view_has_all_columns_and_timestamps(lake, monkeypatch, few):
    monkeypatch.setattr(drift, "FEW_FILES", few)
    folder = Path(lake.path("bronze", "odd", "2025-01-17"))
    folder.mkdir(parents=True)
    stamp = pd.Timestamp("2025-01-16 09:30:00.123456")
    first = pa.table({"Date": pa.array([stamp], pa.timestamp("ns", "UTC")), "v": [1], "c": [["x"]]})
    pq.write_table(first, folder / "a.parquet")
    second = pa.table({"Date": pa.array([stamp], pa.timestamp("us", "UTC")), "v": [1.5], "c": ['["y"]'], "more": [7]})
    pq.write_table(second, folder / "b.parquet")
    for table in (lake.scan("odd", day_column="day"), query_source(lake, "odd")):
        kinds = dict(table.dtypes)
        assert (kinds["Date"], kinds["v"], kinds["c"], kinds["more"]) == (
            "timestamp", "double", "string", "bigint",
        )
        rows = sorted((r["v"], r["c"], r["more"], r["Date"]) for r in table.collect())
        assert [r[:3] for r in rows] == [(1.0, '["x"]', None), (1.5, '["y"]', 7)]
        assert {r[3] for r in rows} == {stamp.to_pydatetime()}
    (row,) = lake.read_batch(str(folder / "a.parquet")).collect()
    assert row["Date"] == stamp.to_pydatetime()


def test_types_widen_without_loss():
    wider, D = drift.wider, T.DecimalType
    assert wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert wider(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert wider(D(10, 2), T.LongType()) == D(21, 2) and wider(D(5, 0), D(4, 3)) == D(8, 3)
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider(T.BooleanType(), T.LongType()) == T.StringType()


def test_scheme_that_cannot_be_opened_is_named(lake):
    frame = pd.DataFrame({"path": ["odd://x/y.parquet"], "batch": ["b"], "day_folder": [""]})
    with pytest.raises(ValueError, match="odd://x/y.parquet"):
        list(drift._footer_reader(None)(iter([frame])))


# --- unfinished batches ---------------------------------------------------------------


def test_batch_of_a_broken_write_is_not_read(lake, monkeypatch):
    write_batch(lake, lake.spark.range(3), "s", DAY1, "good")
    # The writer dies after its files are there and before it takes the mark off.
    with monkeypatch.context() as m:
        m.setattr(files, "mark_finished", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            write_batch(lake, lake.spark.range(10), "s", DAY1, "bad")
    assert lake.scan("s").count() == 3
    assert lake.scan("s", schema=T.StructType().add("id", "long")).count() == 3
    assert lake.list_batches("s").count() == 1
    # Writing it again clears the rest of the broken one.
    write_batch(lake, lake.spark.range(5), "s", DAY1, "bad")
    assert lake.scan("s").count() == 8


def test_batch_that_is_not_accepted_leaves_the_old_one(lake):
    write_batch(lake, lake.spark.range(3), "s", DAY1, "x")

    def refuse():
        raise ValueError("no")

    for name in ("x", "y"):
        with pytest.raises(ValueError, match="no"):
            write_batch(lake, lake.spark.range(9), "s", DAY1, name, accept=refuse)
    assert lake.scan("s").count() == 3


def test_log_of_a_lake_without_runs_is_empty(lake):
    assert run_log(lake).count() == 0


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))

    class Context:
        master = "spark://host:7077"
        _jsc = spark.sparkContext._jsc

    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        sparkContext, conf, _jvm, _jsc = Context, Conf, spark._jvm, spark._jsc

    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        assert scratch_root(Session).startswith(given.get())
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(Session)
