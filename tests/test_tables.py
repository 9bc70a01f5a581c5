"""Tables that stay readable, buckets without shuffles, functions in the catalog, builds side by side."""

import threading
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake import contracts
from marketlake.contracts import unique
from marketlake.functions import cap_label, conform, lake_path_column, ratio, ratio_pct, trend_label
from marketlake.functions.paths import model_location
from marketlake.operators.quality import failing_rows
from marketlake.plans import models
from marketlake.plans.concurrent import BuildFailure, ConcurrentBuild, Outcome
from marketlake.plans.incremental import build_incremental
from marketlake.plans.models import MODELS, Model
from marketlake.sinks.batches import write_batch
from marketlake.sinks.functions import create_day_function, create_functions, run_sql
from marketlake.sinks.tables import publish_bucketed, publish_table, table_location
from marketlake.sources import files
from tests.conftest import plan

RUN = date(2025, 2, 1)


@pytest.fixture
def prefix(spark, request):
    name = f"tab{abs(hash(request.node.name)) % 10**8}_"
    yield name
    for layer in ("silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS `{name}{layer}` CASCADE")


# --- rebuilds -------------------------------------------------------------------------


def test_a_table_can_be_read_at_every_moment(lake, prefix):
    spark = lake.spark
    table = publish_table(lake, spark.range(100), "silver", "t", database=f"{prefix}silver")
    ended, seen, broken = threading.Event(), set(), []

    def read():
        while not ended.is_set():
            try:
                seen.add(spark.table(table).count())
            except Exception as error:
                broken.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in (200, 300, 400):
        publish_table(lake, spark.range(n), "silver", "t", database=f"{prefix}silver")
    ended.set()
    reader.join()
    assert not broken, broken
    assert seen <= {100, 200, 300, 400}
    assert spark.table(table).count() == 400 == lake.scan("t", layer="silver").count()
    # The current folder and the one before it.
    assert len([n for n in files.folder_names(spark, lake.path("silver", "t")) if n.startswith("t")]) == 2


def test_a_query_goes_on_with_the_rows_it_began_with(lake, prefix):
    spark = lake.spark
    table = publish_table(lake, spark.range(10), "silver", "t", database=f"{prefix}silver")
    before = spark.table(table)
    assert before.count() == 10
    publish_table(lake, spark.range(5), "silver", "t", database=f"{prefix}silver")
    assert before.agg(F.count("id")).first()[0] in (5, 10)
    assert spark.table(table).count() == 5


def test_rows_that_are_not_accepted_leave_the_table_as_it_was(lake, prefix):
    spark = lake.spark
    table = publish_table(lake, spark.range(10), "silver", "t", database=f"{prefix}silver")
    place = table_location(spark, table)

    def refuse(rows):
        assert rows.count() == 3
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        publish_table(lake, spark.range(3), "silver", "t", database=f"{prefix}silver", accept=refuse)
    assert spark.table(table).count() == 10 and table_location(spark, table) == place
    assert [n for n in files.folder_names(spark, lake.path("silver", "t")) if n[0] != "_"] == ["t.parquet"]


# --- buckets --------------------------------------------------------------------------


def test_joins_and_counts_on_bucketed_keys_need_no_shuffle(lake, prefix):
    spark = lake.spark
    ids = spark.range(2000).select((F.col("id") % 1500).cast("string").alias("coin_id"), F.col("id").alias("v"))
    left = publish_bucketed(lake, ids, "silver", "a", ["coin_id"], 8, f"{prefix}silver")
    right = publish_bucketed(lake, ids.limit(900), "silver", "b", ["coin_id"], 8, f"{prefix}silver")
    a, b = spark.table(left), spark.table(right)
    joined = a.join(b.select("coin_id", F.col("v").alias("w")).hint("merge"), "coin_id")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.count() == ids.join(ids.limit(900).hint("merge"), "coin_id").count()
    repeated = failing_rows(a, *unique("coin_id"))
    assert "Exchange" not in plan(repeated) and repeated.count() == 500
    assert len(a.inputFiles()) == 8


def test_bucketed_tables_are_rebuilt_in_place(lake, prefix):
    spark = lake.spark

    def publish(rows, buckets=4):
        return publish_bucketed(lake, rows, "silver", "a", ["id"], buckets, f"{prefix}silver")

    table = publish(spark.range(10))
    assert table_location(spark, table).endswith("/silver/a/a.parquet")
    publish(spark.range(20))
    assert spark.table(table).count() == 20
    assert "Exchange" not in plan(spark.table(table).groupBy("id").count())
    publish(spark.range(30), buckets=2)
    assert spark.table(table).count() == 30 and len(spark.table(table).inputFiles()) == 2
    publish(spark.range(7).withColumn("x", F.lit(1)), buckets=2)
    assert spark.table(table).columns == ["id", "x"]
    # An ordinary rebuild gives an ordinary table.
    publish_table(lake, spark.range(3), "silver", "a", database=f"{prefix}silver")
    assert "Exchange" in plan(spark.table(table).groupBy("id").count())
    assert [t.name for t in spark.catalog.listTables(f"{prefix}silver")] == ["a"]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|CAST|error"):
        publish(spark.range(3).select(F.raise_error(F.lit("error")).cast("long").alias("id")))
    assert spark.table(table).count() == 3


# --- functions ------------------------------------------------------------------------


def test_functions_in_sql_are_those_of_the_library(lake, prefix):
    spark, database = lake.spark, f"{prefix}silver"
    spark.sql(f"CREATE DATABASE `{database}`")
    assert "calculate_ratio" in create_functions(lake, database)
    numbers = [0.0, -0.0, 1.5, -10.0, -5.0, 5.0, 10.0, 1e8, 1e9, 1e10, float("nan"), None]
    rows = spark.createDataFrame([(a, b) for a in numbers for b in numbers], "a double, b double")
    rows.createOrReplaceTempView("numbers")
    ours = rows.select(
        ratio("a", "b").alias("r"), ratio_pct("a", "b").alias("p"),
        trend_label(F.col("a")).alias("t"), cap_label(F.col("b")).alias("c"),
    )
    text = f"""select `{database}`.calculate_ratio(a, b) r, `{database}`.calculate_ratio_pct(a, b) p,
      `{database}`.trend_label(a) t, `{database}`.cap_label(b) c from numbers"""
    named = spark.sql(text)
    assert list(map(str, named.collect())) == list(map(str, ours.collect()))
    shown = plan(spark.sql(f"{text} where `{database}`.calculate_ratio(a, 2) > 1 and b > 3"))
    assert "UDF" not in shown.upper().replace("UDFS", "") and "Python" not in shown
    times = spark.createDataFrame([("s", datetime(2025, 1, 2, 3, 4, 5), "f.json"), ("s", None, None)], "s string, t timestamp, f string")
    times.createOrReplaceTempView("times")
    got = spark.sql(
        f"select `{database}`.lake_path(s, t) a, `{database}`.lake_path(s, t, f, 'json', 'silver') b, "
        f"`{database}`.model_location('x//', 'gold', s) c from times"
    ).collect()
    want = times.select(
        lake_path_column(F.col("s"), F.col("t")),
        lake_path_column(F.col("s"), F.col("t"), F.col("f"), "json", "silver"),
    ).collect()
    assert [(r["a"], r["b"]) for r in got] == [tuple(r) for r in want]
    assert got[0]["c"] == model_location("x//", "gold", "s")


def test_days_of_a_table_by_a_function(lake, prefix):
    for day in (6, 7, 8):
        rows = lake.spark.createDataFrame([(f"x{day}", 1.0 * day)], "id string, current_price double")
        write_batch(lake, conform(rows, contracts.BRONZE_COINGECKO), "coingecko", datetime(2025, 1, day), "b")
    build_incremental(lake, select="silver.coingecko", run_date=RUN, skip_checks=True, prefix=prefix)
    database = f"{prefix}silver"
    name = create_day_function(lake, database, "coingecko")
    before = lake.spark.catalog.currentDatabase()
    text = f"select coin_id from {name}(date'2025-01-07', date'2025-01-08') where price_usd > 7"
    found = run_sql(lake, database, text)
    assert lake.spark.catalog.currentDatabase() == before
    assert [r["coin_id"] for r in found.collect()] == ["x8"]
    shown = plan(found)
    assert "2025-01-07" in shown.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThan(price_usd,7.0)" in shown
    assert all("batch_day=2025-01-06" not in f for f in found.inputFiles()) or len(found.inputFiles()) == 3


# --- builds side by side ----------------------------------------------------------------


@pytest.fixture
def stocked(lake):
    for day, source, frame in (
        (6, "coingecko", {"id": "x", "symbol": "s", "name": "n", "current_price": 1.0, "market_cap": 2e10, "market_cap_rank": 1}),
        (6, "defillama", {"id": "p", "name": "n", "slug": "s", "tvl": 1.0}),
    ):
        rows = lake.spark.createDataFrame([frame])
        write_batch(lake, conform(rows, contracts.BRONZE[source]), source, datetime(2025, 1, day), "b")
    bars = lake.spark.createDataFrame([("A", datetime(2025, 1, 6), 1.0)], "Symbol string, Date timestamp, Close double")
    write_batch(lake, conform(bars, contracts.BRONZE["yahoo_finance"]), "yahoo_finance", datetime(2025, 1, 6), "b")
    return lake


def outcomes(build):
    return {o.model: o.outcome for o in build.run()}


def test_all_models_are_built_in_their_order(stocked, prefix):
    build = ConcurrentBuild(stocked, run_date=RUN, prefix=prefix, skip_checks=True)
    assert build.require() == [Outcome(n, "built") for n in ("coingecko", "defillama", "yfinance", "crypto_prices")]
    assert stocked.spark.table(f"{prefix}gold.crypto_prices").count() == 1


def test_a_failing_model_stops_only_what_reads_it(stocked, prefix, monkeypatch):
    def broken(bronze, run_date=None):
        return bronze.select(F.raise_error(F.lit("broken model")).cast("string").alias("coin_id"))

    monkeypatch.setitem(MODELS, "coingecko", Model("silver", "coingecko", source="coingecko", query=broken))
    build = ConcurrentBuild(stocked, run_date=RUN, prefix=prefix, skip_checks=True)
    with pytest.raises(BuildFailure, match="coingecko failed.*crypto_prices skipped: coingecko was not built") as raised:
        build.require()
    assert {o.model: o.outcome for o in raised.value.outcomes} == {
        "coingecko": "failed", "defillama": "built", "yfinance": "built", "crypto_prices": "skipped",
    }
    assert not stocked.spark.catalog.tableExists(f"{prefix}silver.coingecko")
    assert stocked.spark.table(f"{prefix}silver.yfinance").count() == 1


def test_a_model_is_checked_before_its_table_changes(stocked, prefix):
    assert outcomes(ConcurrentBuild(stocked, select="+crypto_prices", run_date=RUN, prefix=prefix)) == {
        "coingecko": "built", "crypto_prices": "built",
    }
    rows = stocked.spark.createDataFrame([("x", 5.0)], "id string, current_price double")
    write_batch(stocked, conform(rows, contracts.BRONZE_COINGECKO), "coingecko", datetime(2025, 1, 7), "b")
    found = {o.model: o for o in ConcurrentBuild(stocked, select="+crypto_prices", run_date=RUN, prefix=prefix).run()}
    assert found["coingecko"].outcome == "failed" and "checks failed" in found["coingecko"].reason
    assert found["crypto_prices"].outcome == "skipped"
    assert stocked.spark.table(f"{prefix}silver.coingecko").count() == 1


def test_threads_carry_their_pool_and_tag(stocked, prefix, monkeypatch):
    context, seen = stocked.spark.sparkContext, {}

    def noted(name, query):
        def run(*args, **options):
            seen[name] = (
                threading.get_ident(), context.getLocalProperty("spark.scheduler.pool"),
                set(context.getJobTags()), context.getLocalProperty("mine"),
            )
            return query(*args, **options)

        return run

    for name, model in list(MODELS.items()):
        own = Model(model.layer, name, model.source, model.parent, noted(name, model.query))
        monkeypatch.setitem(MODELS, name, own)
    context.setLocalProperty("mine", "kept")
    build = ConcurrentBuild(stocked, run_date=RUN, prefix=prefix, skip_checks=True)
    assert set(outcomes(build).values()) == {"built"}
    context.setLocalProperty("mine", None)
    assert {v[1] for v in seen.values()} == {f"{m.layer}.{m.name}" for m in MODELS.values()}
    assert all(v[2] == {build.tag} and v[3] == "kept" for v in seen.values())
    assert not list(context.getJobTags())
    assert len({v[0] for v in seen.values()}) > 1


def test_a_build_is_cancelled_by_its_tag(stocked, prefix, monkeypatch):
    started = threading.Event()

    def slow(bronze, run_date=None):
        started.set()
        wide = bronze.select("id").crossJoin(stocked.spark.range(10**12).toDF("k"))
        return wide.groupBy("id").agg(F.sum(F.hash("k").cast("long")).alias("coin_symbol"))

    monkeypatch.setitem(MODELS, "coingecko", Model("silver", "coingecko", source="coingecko", query=slow))
    build = ConcurrentBuild(stocked, select="+crypto_prices", run_date=RUN, prefix=prefix, skip_checks=True)
    found = []
    thread = threading.Thread(target=lambda: found.extend(build.run()))
    thread.start()
    assert started.wait(60)
    time.sleep(2)
    build.cancel()
    thread.join(60)
    assert not thread.is_alive()
    assert [(o.model, o.outcome) for o in found] == [("coingecko", "cancelled"), ("crypto_prices", "skipped")]
    assert outcomes(build) == {"coingecko": "cancelled", "crypto_prices": "skipped"}
    assert models.MODELS is MODELS
