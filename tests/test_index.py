"""The file index: refreshed by what changed, answers without data, files left out of scans."""

import glob
import math
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.operators import profile
from marketlake.sinks.batches import write_batch
from marketlake.sources import drift, index
from marketlake.sources.index import FileIndex, Refreshed

DAYS = [datetime(2025, 1, d) for d in (6, 7, 8, 9)]


@pytest.fixture
def stocked(lake):
    """Four days of a hundred ids each, in two files a day."""
    for k, day in enumerate(DAYS):
        rows = lake.spark.range(100 * k, 100 * k + 100, 1, 2).select(
            "id",
            F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("name"),
            (F.col("id") / 2).alias("half"),
            F.timestamp_seconds(F.col("id") * 3600).alias("at"),
            F.when(F.col("id") % 10 > 0, F.col("id")).alias("rest"),
        )
        write_batch(lake, rows, "things", day, "b")
    return lake


@pytest.fixture
def indexed(stocked):
    found = FileIndex(stocked, "things")
    assert found.refresh() == Refreshed(8, 0)
    return found


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_second_scan_opens_no_footer(indexed, monkeypatch):
    def opened(*_):
        raise AssertionError("a footer was opened")

    monkeypatch.setattr(drift, "describe_footer", opened)
    monkeypatch.setattr(index, "describe_footer", opened)
    assert indexed.refresh() == Refreshed(0, 0)
    assert ids(indexed.scan()) == list(range(400))
    days = indexed.scan(day_column="day").groupBy("day").count().collect()
    assert {(r["day"], r["count"]) for r in days} == {(d.date(), 100) for d in DAYS}


def test_counts_and_sizes_need_no_data(indexed):
    lake = indexed.lake
    stored = glob.glob(f"{lake.root}/bronze/things/*/b.parquet/part-*.parquet")
    assert indexed.size().first() == (sum(map(os.path.getsize, stored)), 8)
    assert indexed.row_count().first()["n_rows"] == 400
    assert profile.exact_size(lake.list_files("bronze", "things")).first()["bytes"] == indexed.size().first()["bytes"]
    by_day = {r["day"]: (r["n_files"], r["n_rows"]) for r in indexed.days().collect()}
    assert by_day == {str(d.date()): (2, 100) for d in DAYS}
    assert indexed.newest().first()["path"] == lake.newest_file("bronze", "things").first()["path"]
    assert all("/_index/bronze/things/day=" in f for f in indexed.row_count().inputFiles())


@pytest.mark.parametrize(
    "column, low, high, files",
    [
        ("id", 150, 160, 1),
        ("id", 149, 150, 2),
        ("id", None, 49, 1),
        ("id", 350, None, 1),
        ("id", 399.5, None, 0),
        ("id", Decimal("99.5"), 100, 1),
        ("id", 1000, 2000, 0),
        ("name", "n0120", "n0130", 1),
        ("at", datetime(1970, 1, 1), datetime(1970, 1, 1, 5), 1),
        ("at", date(1970, 1, 17), None, 1),
        ("half", None, 10.0, 1),
        ("half", 190.0, None, 8),
        ("rest", 0, 0, 0),
        ("rest", 10, 10, 1),
    ],
)
def test_files_outside_a_range_are_not_read(indexed, column, low, high, files):
    read = indexed.scan(column, low, high)
    assert len(read.inputFiles()) == files
    every = indexed.scan()
    for limit, keep in ((low, F.col(column) >= F.lit(low)), (high, F.col(column) <= F.lit(high))):
        every = every.where(keep) if limit is not None else every
    assert ids(read) == ids(every)


def test_replaced_new_and_deleted_files(indexed):
    lake = indexed.lake
    kept = {p: os.path.getmtime(p) for p in glob.glob(f"{indexed.path}/day=2025-01-06/*.parquet")}
    write_batch(lake, lake.spark.range(1000, 1010).coalesce(1), "things", DAYS[1], "b")
    write_batch(lake, lake.spark.range(2000, 2005).coalesce(1), "things", datetime(2025, 1, 10), "new")
    for path in glob.glob(f"{lake.root}/bronze/things/2025-01-09/b.parquet/*"):
        os.remove(path)
    (one, two) = sorted(glob.glob(f"{lake.root}/bronze/things/2025-01-08/b.parquet/part-*.parquet"))
    os.remove(two)
    assert indexed.refresh() == Refreshed(2, 5)
    want = [*range(100), *range(200, 250), *range(1000, 1010), *range(2000, 2005)]
    assert ids(indexed.scan()) == want
    assert indexed.row_count().first()["n_rows"] == len(want)
    assert len(indexed.scan("id", 1000, 3000).inputFiles()) == 2
    # The index of a day without changes is not written again.
    assert {p: os.path.getmtime(p) for p in glob.glob(f"{indexed.path}/day=2025-01-06/*.parquet")} == kept
    assert not os.path.exists(f"{indexed.path}/day=2025-01-09")
    assert indexed.refresh() == Refreshed(0, 0)


def test_files_that_disagree(lake):
    spark = lake.spark
    write_batch(lake, spark.range(5).coalesce(1), "mixed", DAYS[0], "a")
    texts = spark.sql("select 'x' as id, array(1) as list union all select null, null").coalesce(1)
    write_batch(lake, texts, "mixed", DAYS[1], "a")
    write_batch(lake, spark.sql("select 2.5D as other").coalesce(1), "mixed", DAYS[2], "a")
    write_batch(lake, spark.sql("select cast(null as bigint) as id").coalesce(1), "mixed", DAYS[3], "a")
    found = FileIndex(lake, "mixed")
    found.refresh()
    assert sorted(found.scan().columns) == ["id", "list", "other"]
    assert found.scan().count() == 9
    # The text cannot be compared with the number, so its file is kept; others have no value.
    paths = [r["path"] for r in found.files_between("id", 10, 20).collect()]
    assert len(paths) == 1 and "2025-01-07" in paths[0]
    assert [r["id"] for r in found.scan("id", "x", "x").collect()] == ["x"]
    ranges = {r["kind"]: (r["low"], r["high"], r["nulls"], r["n_rows"]) for r in found.column_range("id").collect()}
    assert ranges["text"] == ("x", "x", 1, 2) and ranges["absent"] == (None, None, 1, 1)
    assert ranges["number"] == ("0", "4", 0, 5)


def test_not_a_number_is_above_every_bound(lake):
    values = lake.spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double").coalesce(1)
    write_batch(lake, values, "floats", DAYS[0], "a")
    found = FileIndex(lake, "floats")
    found.refresh()
    assert [math.isnan(r["v"]) for r in found.scan("v", 5.0).collect()] == [True]


def test_sources_without_files(lake):
    found = FileIndex(lake, "nothing")
    assert found.refresh() == Refreshed(0, 0)
    assert found.row_count().first()["n_rows"] == 0 and found.size().first() == (0, 0)
    with pytest.raises(ValueError, match="no files"):
        found.scan()


def test_scans_of_a_lake_by_index(stocked):
    index_rows = FileIndex(stocked, "things")
    read = stocked.scan("things", first_day=date(2025, 1, 7), last_day=date(2025, 1, 8), indexed=True)
    assert ids(read) == list(range(100, 300)) and len(read.inputFiles()) == 4
    assert index_rows.exists()
    stocked.spark.range(900, 901).write.parquet(stocked.path("bronze", "things", "2025-01-20", "x.parquet"))
    late = stocked.scan("things", first_day=date(2025, 1, 9), indexed=True, day_column="day")
    assert ids(late) == [*range(300, 400), 900]
    schema = stocked.spark.range(1).schema
    assert stocked.scan("things", schema=schema, last_day=date(2025, 1, 6), indexed=True).columns == ["id"]
    none = stocked.scan("things", first_day=date(2026, 1, 1), indexed=True)
    assert none.count() == 0 and "name" in none.columns


def test_files_outside_day_folders(lake):
    lake.spark.range(3).coalesce(1).write.parquet(lake.path("bronze", "loose", "batch"))
    found = FileIndex(lake, "loose")
    assert found.refresh() == Refreshed(1, 0)
    assert ids(found.scan(day_column="day")) == [0, 1, 2]
    assert found.days().first()["day"] == "undated"
