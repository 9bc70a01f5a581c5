"""Profiles per batch within their errors, refreshed by what changed; checked writes."""

import bisect
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.contracts import Check, accepted_range, accepted_values, not_null, unique
from marketlake.operators import sketches
from marketlake.operators.sketches import DISTINCT_ERROR, QUANTILE_ERROR, BatchProfiles
from marketlake.sinks import quarantine
from marketlake.sinks.batches import delete_batch, write_batch
from marketlake.sinks.quarantine import REASONS, read_quarantine, with_verdicts, write_checked
from marketlake.sources import files
from tests.conftest import plan

DAYS = [datetime(2025, 1, d) for d in (6, 7, 8)]


@pytest.fixture
def values():
    rng = random.Random(4)
    return [[(round(rng.gauss(50 * k, 30), 3), f"u{rng.randrange(20_000)}") for _ in range(15_000)] for k in range(3)]


@pytest.fixture
def profiles(lake, values):
    for day, rows in zip(DAYS, values, strict=True):
        frame = lake.spark.createDataFrame(rows, "v double, user string").withColumns(
            {"n": F.when(F.col("v") > 0, F.col("v").cast("long")), "tags": F.array("user"), "at": F.lit(day)}
        )
        write_batch(lake, frame.repartition(3), "things", day, "b")
    return BatchProfiles(lake, "things")


@pytest.mark.parametrize("first, last", [(0, 0), (0, 1), (1, 2), (0, 2), (2, 2)])
def test_merged_profiles_are_within_their_errors(profiles, values, first, last):
    assert len(profiles.refresh()) == 3
    ranks = (0.05, 0.25, 0.5, 0.75, 0.95)
    found = profiles.describe(DAYS[first].date(), DAYS[last].date(), quantiles=ranks)
    by_column = {r["column"]: r for r in found.collect()}
    rows = [r for k in range(first, last + 1) for r in values[k]]
    numbers, users = sorted(v for v, _ in rows), {u for _, u in rows}
    v = by_column["v"]
    assert (v["rows"], v["nulls"], float(v["low"]), float(v["high"])) == (len(rows), 0, numbers[0], numbers[-1])
    for rank, value in zip(ranks, v["quantiles"], strict=True):
        low, high = bisect.bisect_left(numbers, value), bisect.bisect_right(numbers, value)
        assert low / len(rows) - QUANTILE_ERROR <= rank <= high / len(rows) + QUANTILE_ERROR
    user = by_column["user"]
    assert abs(user["distinct"] - len(users)) <= 3 * DISTINCT_ERROR * len(users)
    assert user["quantiles"] is None and user["low"] == min(users)
    assert by_column["n"]["nulls"] == sum(x <= 0 for x in numbers)
    assert by_column["at"]["distinct"] == last - first + 1
    assert abs(by_column["tags"]["distinct"] - len(users)) <= 3 * DISTINCT_ERROR * len(users)


def test_values_that_ranges_have_in_common(profiles, values):
    profiles.refresh()
    one, other = ({u for _, u in values[k]} for k in (0, 2))
    found = profiles.in_common("user", (DAYS[0].date(),) * 2, (DAYS[2].date(),) * 2).first()
    assert abs(found["n_one"] - len(one)) <= 4 * DISTINCT_ERROR * len(one)
    assert abs(found["n_other"] - len(other)) <= 4 * DISTINCT_ERROR * len(other)
    assert abs(found["n_common"] - len(one & other)) <= 6 * DISTINCT_ERROR * len(one | other)


def test_only_new_and_replaced_batches_are_read(profiles, monkeypatch):
    lake = profiles.lake
    profiles.refresh()
    assert profiles.refresh() == []
    write_batch(lake, lake.spark.range(7).selectExpr("cast(id as double) v", "'x' user"), "things", DAYS[1], "b")
    delete_batch(lake, "things", DAYS[2], "b")
    write_batch(lake, lake.spark.range(5).selectExpr("cast(id as double) v"), "things", DAYS[0], "second")
    assert [b.rpartition("/things/")[2] for b in profiles.refresh()] == ["2025-01-06/second.parquet", "2025-01-07/b.parquet"]
    rows = {r["column"]: r["rows"] for r in profiles.describe().collect()}
    assert rows["v"] == 15_000 + 7 + 5
    (day,) = profiles.describe(date(2025, 1, 7), date(2025, 1, 7)).where("column = 'v'").collect()
    assert (day["rows"], day["low"], day["high"], day["distinct"], day["quantiles"][1]) == (7, "0.0", "6.0", 7, 3.0)
    none = profiles.describe(date(2026, 1, 1))
    assert none.count() == 0
    monkeypatch.setattr(sketches, "scan_any_schema", None)
    assert profiles.describe().count() >= 2
    assert all("/_profiles/" in f for f in profiles.rows().inputFiles())


# --- checked writes -------------------------------------------------------------------

CHECKS: list[Check] = [
    *not_null("id"), *unique("id"), accepted_values("kind", ("a", "b")), accepted_range("v", 0, 10),
]
AT = datetime(2025, 1, 6)


def rows_of(lake, *rows):
    return lake.spark.createDataFrame(rows, "id string, kind string, v double")


def test_good_rows_are_published_and_others_set_aside(lake):
    df = rows_of(
        lake, ("1", "a", 1.0), ("2", "c", 1.0), ("3", "b", 11.0), (None, "a", -1.0), ("4", None, None),
        ("5", "a", 1.0), ("5", "b", 2.0), ("9", "a", 1.0),
    )
    stored = rows_of(lake, ("9", "a", 1.0), ("9", "a", 1.0), ("8", "a", 1.0))
    done = write_checked(lake, df, "things", CHECKS, AT, "b", stored=stored)
    assert (done.good, done.bad) == (2, 6)
    assert done.broken == {"id not_null": 1, "id unique": 3, "kind accepted_values": 1, "v accepted_range": 2}
    good = lake.scan("things")
    assert good.columns == [*df.columns, REASONS]
    assert sorted((r["id"], r[REASONS]) for r in good.collect()) == [("1", None), ("4", None)]
    bad = read_quarantine(lake, "things")
    found = sorted((str(r["id"]), r["v"], tuple(r[REASONS]), str(r["day"])) for r in bad.collect())
    assert found == [
        ("2", 1.0, ("kind accepted_values",), "2025-01-06"),
        ("3", 11.0, ("v accepted_range",), "2025-01-06"),
        ("5", 1.0, ("id unique",), "2025-01-06"),
        ("5", 2.0, ("id unique",), "2025-01-06"),
        ("9", 1.0, ("id unique",), "2025-01-06"),
        ("None", -1.0, ("id not_null", "v accepted_range"), "2025-01-06"),
    ]
    assert done.good_path == "bronze/things/2025-01-06/b.parquet"
    assert done.bad_path == "quarantine/bronze/things/2025-01-06/b.parquet"


def test_a_batch_written_again_replaces_both_parts(lake):
    write_checked(lake, rows_of(lake, ("1", "a", 1.0), ("2", "c", 1.0)), "things", CHECKS, AT, "b")
    done = write_checked(lake, rows_of(lake, ("3", "a", 1.0)), "things", CHECKS, AT, "b")
    assert (done.good, done.bad, done.bad_path) == (1, 0, None)
    assert [r["id"] for r in lake.scan("things").collect()] == ["3"]
    assert not files.exists(lake.spark, lake.path("quarantine/bronze/things/2025-01-06/b.parquet"))
    done = write_checked(lake, rows_of(lake, ("3", "x", 1.0)), "things", CHECKS, AT, "b")
    assert (done.good_path, done.bad) == (None, 1)
    assert files.folder_names(lake.spark, lake.path("bronze", "things", "2025-01-06")) == []
    empty = write_checked(lake, rows_of(lake, ("1", "a", 1.0)).limit(0), "others", CHECKS, AT, "b")
    assert (empty.good, empty.bad, empty.good_path) == (0, 0, None)


def test_rows_are_read_once_for_checks_of_single_rows(lake, tmp_path, monkeypatch):
    rows_of(lake, ("1", "a", 1.0), ("1", "c", 1.0)).write.parquet(str(tmp_path / "in"))
    df = lake.spark.read.parquet(str(tmp_path / "in"))
    singles = [c for c in CHECKS if c.kind != "unique"]
    text = plan(with_verdicts(df, singles))
    assert text.count("FileScan") == 1 and "Exchange" not in text
    text = plan(with_verdicts(df, CHECKS, kept=str(tmp_path / "keys")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    monkeypatch.setattr(quarantine, "BROADCAST_KEYS", 0)
    many = with_verdicts(df, CHECKS, kept=str(tmp_path / "more"))
    assert sorted(len(r[REASONS]) for r in many.collect()) == [1, 2]


def test_a_write_that_fails_leaves_nothing(lake):
    broken = rows_of(lake, ("1", "a", 1.0)).withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_checked(lake, broken, "things", CHECKS, AT, "b")
    assert [n for n in files.folder_names(lake.spark, lake.path("bronze", "things")) if n[0] != "_"] == []
    write_checked(lake, rows_of(lake, ("1", "a", 1.0)), "things", CHECKS, AT, "b", fmt="json")
    assert lake.scan("things", schema=rows_of(lake, ("1", "a", 1.0)).schema, fmt="json").count() == 1
