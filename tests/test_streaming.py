"""Incremental ingest: restarts, late and repeated files, odd answers."""

import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketlake import contracts
from marketlake.plans.run_log import run_log
from marketlake.sources import files
from marketlake.sources.landing import REST
from marketlake.streaming.ingest import ingest_new, start_ingest, stream_folder, without_repeats
from tests.conftest import plan


@pytest.fixture
def land(spark, tmp_path):
    """Land answers (key, day, ids or body) as one file below the landed folder."""
    folder = str(tmp_path / "landed")

    def write(name, *answers, source="coingecko"):
        rows = [
            (source, key, day, 200, body if isinstance(body, str) else json.dumps([{"id": i} for i in body]))
            for key, day, body in answers
        ]
        spark.createDataFrame(rows, contracts.LANDED).coalesce(1).write.parquet(f"{folder}/{name}")

    write.folder = folder
    return write


MON, TUE, WED = (datetime(2025, 1, d, 6) for d in (6, 7, 8))


def stored(lake, source="coingecko", column="id"):
    rows = lake.scan(source, day_column="day").select(column, "day").collect()
    return sorted((r[0], r["day"].day) for r in rows)


def test_each_run_takes_only_new_files(lake, land):
    land("a", ("1", MON, ["x", "y"]))
    first = ingest_new(lake, "coingecko", land.folder)
    assert (first.batches, first.answers, first.rows, first.repeated) == (1, 1, 2, 0)
    assert ingest_new(lake, "coingecko", land.folder).batches == 0
    land("b", ("2", TUE, ["z"]), ("3", WED, []))
    second = ingest_new(lake, "coingecko", land.folder)
    assert (second.batches, second.answers, second.rows) == (1, 2, 1)
    assert stored(lake) == [("x", 6), ("y", 6), ("z", 7)]
    (path,) = second.paths
    assert path.startswith("bronze/coingecko/2025-01-07/coingecko_") and path.endswith("_00000001.parquet")


@pytest.mark.parametrize("place", ["before", "after"])
def test_a_run_that_dies_is_done_again_and_doubles_nothing(lake, land, monkeypatch, place):
    land("a", ("1", MON, ["x"]), ("2", TUE, ["y"]))

    def die(*_):
        raise RuntimeError("lost")

    if place == "after":
        with pytest.raises(StreamingQueryException, match="lost"):
            ingest_new(lake, "coingecko", land.folder, published=die)
        assert stored(lake) == [("x", 6), ("y", 7)]
    else:
        # Between the first and the second day.
        real, calls = files.replace, []

        def once(spark, staged, target):
            calls.append(target)
            if len(calls) == 2:
                die()
            real(spark, staged, target)

        with monkeypatch.context() as patched:
            patched.setattr(files, "replace", once)
            with pytest.raises(StreamingQueryException, match="lost"):
                ingest_new(lake, "coingecko", land.folder)
        assert stored(lake) == [("x", 6)]
    land("b", ("3", MON, ["z"]))
    done = ingest_new(lake, "coingecko", land.folder)
    assert done.repeated == 0
    assert stored(lake) == [("x", 6), ("y", 7), ("z", 6)]
    events = Counter((r["event"], r["success"]) for r in run_log(lake).collect())
    assert events["pipeline_failed", False] == 1 and events["pipeline_completed", True] >= 2


def test_repeated_answers_count_once(lake, land):
    land("a", ("1", MON, ["x"]), ("1", MON, ["x"]))
    land("b", ("1", MON, ["x"]), ("2", MON, ["y"]))
    first = ingest_new(lake, "coingecko", land.folder)
    assert (first.answers, first.repeated, first.rows) == (2, 2, 2)
    # Known ones, one that is known and doubled, and the same body fetched another day.
    land("c", ("1", MON, ["x"]), ("1", MON, ["x"]), ("2", TUE, ["y"]), ("3", TUE, ["z"]))
    second = ingest_new(lake, "coingecko", land.folder)
    assert (second.answers, second.repeated, second.rows) == (2, 2, 2)
    assert stored(lake) == [("x", 6), ("y", 6), ("y", 7), ("z", 7)]
    land("d", ("2", TUE, ["y"]))
    third = ingest_new(lake, "coingecko", land.folder)
    assert (third.paths, third.repeated, third.rows) == ([], 1, 0)


def test_many_repeats_meet_in_a_shuffle(lake, land, monkeypatch):
    monkeypatch.setattr("marketlake.streaming.ingest.BROADCAST_REPEATS", 0)
    land("a", ("1", MON, ["x"]), ("1", MON, ["x"]), ("2", MON, ["y"]))
    assert ingest_new(lake, "coingecko", land.folder).rows == 2


def test_micro_batches_have_so_many_files(lake, land):
    for k in range(5):
        land(f"f{k}", (str(k), MON, [f"id{k}"]))
    done = ingest_new(lake, "coingecko", land.folder, files_per_batch=2)
    assert (done.batches, done.rows, len(done.paths)) == (3, 5, 3)
    assert stored(lake) == [(f"id{k}", 6) for k in range(5)]


def test_a_stopping_answer_stops_until_it_is_skipped(lake, land):
    land("a", ("1", MON, ["x"]), ("2", MON, "[{"))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="answer 2 is malformed"):
            ingest_new(lake, "coingecko", land.folder)
    assert not files.exists(lake.spark, lake.path("bronze", "coingecko", "2025-01-06"))
    done = ingest_new(lake, "coingecko", land.folder, skip_rejected=True)
    assert (done.answers, done.rejected, done.rows) == (2, 1, 1)
    assert stored(lake) == [("x", 6)]
    leftovers = files.folder_names(lake.spark, lake.path("bronze", "coingecko"))
    assert leftovers == ["2025-01-06"]


def test_an_answer_without_a_time_has_that_of_its_file(lake, land):
    land("a", ("1", None, ["x"]))
    ingest_new(lake, "coingecko", land.folder)
    (row,) = lake.scan("coingecko", day_column="day").collect()
    assert abs((row["day"] - datetime.now().date()).days) <= 1


def test_other_sources_in_the_folder_are_left_to_their_streams(lake, land):
    land("a", ("1", MON, ["x"]))
    bars = json.dumps([{"Date": "2025-01-06", "Close": 1.5, "Note": "n"}])
    land("b", ("AAPL", MON, bars), source="yahoo_finance")
    assert ingest_new(lake, "coingecko", land.folder).rows == 1
    assert ingest_new(lake, "yahoo_finance", land.folder).rows == 1
    (row,) = lake.scan("yahoo_finance").collect()
    assert (row["Symbol"], row["Close"], row[REST]) == ("AAPL", 1.5, {"Note": "n"})


def test_json_batches_and_a_stream_that_goes_on(lake, land):
    land("a", ("1", MON, ["x"]))
    query, done = start_ingest(lake, "coingecko", land.folder, fmt="json", every="1 second")
    try:
        land("b", ("2", TUE, ["y"]))
        for _ in range(60):
            query.processAllAvailable()
            if done.rows == 2:
                break
    finally:
        query.stop()
    read = lake.scan("coingecko", schema=contracts.BRONZE_COINGECKO, fmt="json")
    assert sorted(r["id"] for r in read.collect()) == ["x", "y"]


def test_bodies_are_not_shuffled_for_the_comparison(spark, lake, landed, tmp_path):
    frame = landed("coingecko", ("1", 200, "[]"), ("1", 200, "[]"), ("2", 200, "[]"))
    marked = frame.withColumns({"_digest": F.md5("request_key").cast("binary"), "_day": F.lit(MON.date())})
    pending = str(tmp_path / "pending")
    marked.select("_digest", "_day").write.partitionBy("_day").parquet(pending)
    fresh, repeated = without_repeats(lake, "coingecko", marked, pending, "n")
    assert repeated == 1 and fresh.count() == 2
    text = plan(fresh)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_folders_of_streams(lake):
    assert stream_folder(lake, "s", "seen") == f"{lake.root}/_streams/s/seen"
    with pytest.raises(ValueError, match="Unknown source"):
        ingest_new(lake, "nothing", "/tmp/none")
