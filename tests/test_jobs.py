import json
import os
from datetime import date, datetime

import pytest

from marketlake import contracts
from marketlake.operators.quality import CheckFailure
from marketlake.plans.build import build, build_layer, check_tables, select_models
from marketlake.plans.ingest import ingest
from marketlake.plans.query import create_view, query_source
from marketlake.plans.run_log import query_log, run_log
from marketlake.sinks.batches import write_batch

AT = datetime(2025, 1, 17, 6, 30)
COIN = {
    "id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 50000.5,
    "market_cap": 1e12, "market_cap_rank": 1, "total_volume": 3e10,
    "price_change_percentage_7d_in_currency": 6.0, "circulating_supply": 2e7, "total_supply": 2.1e7,
}
PROTOCOL = {"id": "1", "name": "Aave", "slug": "aave", "tvl": 5.5, "chains": ["E"], "chainTvls": {"E": 1}}
BAR = {"Date": "2025-01-17T05:00:00Z", "Open": 1, "High": 2, "Low": 1, "Close": 1.5, "Volume": 9}


def fill(lake, landed, *coins):
    ingest(lake, "coingecko", landed("coingecko", ("1", 200, json.dumps(list(coins) or [COIN]))), AT)
    ingest(lake, "defillama", landed("defillama", ("p", 200, json.dumps({"protocols": [PROTOCOL]}))), AT)
    ingest(lake, "yahoo_finance", landed("yahoo_finance", ("AAPL", 200, json.dumps([BAR]))), AT)


# --- ingest --------------------------------------------------------------------------


def test_ingest_writes_a_batch_and_a_run_record(lake, landed):
    path = ingest(lake, "coingecko", landed("coingecko", ("1", 200, json.dumps([COIN, COIN]))), AT)
    assert path == "bronze/coingecko/2025-01-17/coingecko_20250117_063000.parquet"
    assert lake.scan("coingecko").count() == 2
    (row,) = run_log(lake).collect()
    assert (row["pipeline_id"], row["event"], row["level"]) == (
        "coingecko_20250117_063000", "pipeline_completed", "info",
    )
    assert (row["rows"], row["columns_count"], row["file_size_bytes"]) == (2, 26, 2 * 26 * 8)
    assert (row["answers"], row["rejected"]) == (1, 0)
    assert row["success"] and row["path"] == path and row["total_time_ms"] >= row["load_time_ms"] > 0


def test_ingest_with_partial_failure(lake, landed):
    answers = landed("yahoo_finance", ("AAPL", 200, json.dumps([BAR])), ("BAD", 500, None), ("NONE", 200, "[]"))
    ingest(lake, "yahoo_finance", answers, AT, filename="bars", fmt="json")
    assert os.listdir(lake.path("bronze/yahoo_finance/2025-01-17")) == ["bars.json"]
    (row,) = run_log(lake).collect()
    assert (row["answers"], row["rejected"], row["rows"]) == (3, 1, 1)
    assert lake.scan("yahoo_finance", schema=contracts.BRONZE_YAHOO_FINANCE, fmt="json").count() == 1


@pytest.mark.parametrize(
    "source, answers, message",
    [
        ("coingecko", [("1", 200, json.dumps([COIN])), ("2", 500, None)], "answer 2 is failed"),
        ("defillama", [("p", 200, "{")], "answer p is malformed"),
        ("fred", [("GDP", 200, "{}")], "No data extracted for any series"),
        ("yahoo_finance", [("X", 404, None)], "No data extracted for any symbol"),
    ],
)
def test_failed_ingest_leaves_only_a_run_record(lake, landed, source, answers, message):
    with pytest.raises(Exception, match=message):
        ingest(lake, source, landed(source, *answers), AT)
    assert lake.list_files("bronze", source).count() == 0
    (row,) = run_log(lake).collect()
    assert (row["event"], row["level"], row["success"]) == ("pipeline_failed", "error", False)
    assert message in row["error"]


def test_ingest_rejects_other_formats(lake, landed):
    with pytest.raises(ValueError, match="Unsupported format"):
        ingest(lake, "coingecko", landed("coingecko"), AT, fmt="csv")


def test_empty_pages_are_no_error(lake, landed):
    ingest(lake, "coingecko", landed("coingecko", ("1", 200, "[]")), AT)
    assert lake.scan("coingecko", schema=contracts.BRONZE_COINGECKO).count() == 0


def test_no_answers_are_no_error(lake, landed):
    ingest(lake, "coingecko", landed("coingecko"), AT)
    assert lake.scan("coingecko", schema=contracts.BRONZE_COINGECKO).count() == 0
    assert [(r["answers"], r["rows"]) for r in run_log(lake).collect()] == [(0, 0)]


def test_query_results_without_a_contract(lake, landed):
    answers = landed("dune", ("7", 200, '{"result":{"rows":[{"a":1},{"a":2}]}}'))
    ingest(lake, "dune", answers, AT)
    rows = lake.scan("dune").selectExpr("variant_get(record, '$.a', 'int') as a").collect()
    assert sorted(r["a"] for r in rows) == [1, 2]


# --- run log ---------------------------------------------------------------------------


def test_log_queries(lake, landed):
    fill(lake, landed)
    with pytest.raises(Exception):
        ingest(lake, "fred", landed("fred", ("GDP", 200, "{}")), AT)
    logs = run_log(lake)
    assert query_log(logs, level="ERROR").count() == 1
    assert query_log(logs, level="info").count() == 3
    assert query_log(logs, pipeline_id="fred_20250117_063000").count() == 1
    assert query_log(logs, source="defillama", level="info").count() == 1


# --- build -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "select, exclude, names",
    [
        (None, None, ["coingecko", "defillama", "yfinance", "crypto_prices"]),
        ("silver.*", None, ["coingecko", "defillama", "yfinance"]),
        ("gold.*", None, ["crypto_prices"]),
        ("+crypto_prices", None, ["coingecko", "crypto_prices"]),
        ("crypto_prices coingecko", None, ["coingecko", "crypto_prices"]),
        ("silver.yfinance", None, ["yfinance"]),
        (None, "silver.*", ["crypto_prices"]),
        ("+gold.*", "crypto_prices", ["coingecko"]),
    ],
)
def test_selection(select, exclude, names):
    assert [m.name for m in select_models(select, exclude)] == names


def test_unknown_selection():
    with pytest.raises(ValueError, match="matches no model"):
        select_models("bronze.*")


def test_build_end_to_end(lake, landed):
    spark = lake.spark
    fill(lake, landed)
    result = build(lake, run_date=date(2025, 1, 18), prefix="e2e_")
    assert result.tables == [
        "`e2e_silver`.`coingecko`", "`e2e_silver`.`defillama`", "`e2e_silver`.`yfinance`",
        "`e2e_gold`.`crypto_prices`",
    ]
    assert len(result.checks) == 25 and {r['status'] for r in result.checks} == {'pass'}
    gold = spark.table("e2e_gold.crypto_prices").first()
    assert (gold["trend_7d"], gold["market_cap_category"]) == ("uptrend", "large_cap")
    assert gold["ingestion_date"] == date(2025, 1, 18)
    bars = spark.table("e2e_silver.yfinance").first()
    assert (bars["symbol"], bars["trade_date"], bars["dividends"]) == ("AAPL", date(2025, 1, 17), None)
    protocol = spark.table("e2e_silver.defillama").first()
    assert json.loads(protocol["chain_tvls_json"]) == {"E": 1.0}


def test_build_again_replaces_and_checks_fail_the_job(lake, landed):
    spark = lake.spark
    fill(lake, landed)
    build(lake, select="+crypto_prices", prefix="again_")
    write_batch(lake, lake.scan("coingecko"), "coingecko", datetime(2025, 1, 18))
    with pytest.raises(CheckFailure, match="coingecko.coin_id unique: 1"):
        build(lake, select="+crypto_prices", prefix="again_")
    assert spark.table("again_gold.crypto_prices").count() == 2
    build(lake, select="+crypto_prices", prefix="again_", skip_checks=True, full_refresh=True)
    assert check_tables(lake, skip=True) is None
    statuses = check_tables(lake, ["crypto_prices"], prefix="again_").where("status = 'fail'")
    assert [(r["column"], r["check"]) for r in statuses.collect()] == [("coin_id", "unique")]


def test_layers_build_one_by_one(lake, landed):
    fill(lake, landed)
    assert build_layer(lake, "silver", prefix="step_").checks is None
    assert build_layer(lake, "gold", prefix="step_").tables == ["`step_gold`.`crypto_prices`"]
    build(lake, select="gold.*", prefix="step_", test_select=["coingecko", "crypto_prices"])


# --- SQL over views ----------------------------------------------------------------------


def test_view_and_queries(lake, landed, caplog):
    fill(lake, landed, *[dict(COIN, id=str(i)) for i in range(12)])
    name, count = create_view(lake, "coingecko")
    assert name == "coingecko_bronze" and count.collect() == [(12,)]
    assert query_source(lake, "coingecko").count() == 10
    top = query_source(lake, "coingecko", "SELECT max(market_cap) AS m FROM {view} WHERE id > '5'")
    assert top.collect() == [(1e12,)]
    assert query_source(lake, "coingecko", "SELECT count(*) FROM coingecko_bronze").collect() == [(12,)]
    with caplog.at_level("WARNING"):
        assert query_source(lake, "coingecko", "SELECT 1").collect() == [(1,)]
    assert "does not use the view" in caplog.text


def test_view_with_a_contract_reads_files_that_disagree(lake):
    spark = lake.spark
    write_batch(lake, spark.sql("select 'a' as id, 5 as tvl, array('x') as chains"), "defillama", AT)
    write_batch(lake, spark.sql("select 'b' as id, 1.5D as tvl"), "defillama", datetime(2025, 1, 18))
    text = "select id, tvl, chains[0] as chain from {view} order by id"
    rows = query_source(lake, "defillama", text, contract=contracts.BRONZE_DEFILLAMA).collect()
    assert rows == [("a", 5.0, "x"), ("b", 1.5, None)]


def test_views_of_built_layers(lake, landed):
    fill(lake, landed)
    build(lake, skip_checks=True, prefix="view_")
    rows = query_source(lake, "crypto_prices", "select coin_id from {view}", layer="gold")
    assert rows.collect() == [("bitcoin",)]
