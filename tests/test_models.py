from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import contracts
from marketlake.plans.models import (
    gold_crypto_prices,
    silver_coingecko,
    silver_defillama,
    silver_yfinance,
)
from tests.conftest import plan
from workload import adapters

RUN = date(2025, 1, 17)


def typed(spark, contract, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in contract.names) for r in rows], contract)


def test_silver_coingecko_contract(spark):
    bronze = typed(spark, contracts.BRONZE_COINGECKO, {"id": "a", "ath": 2.0}, {"symbol": "no key"})
    out = silver_coingecko(bronze, RUN)
    assert out.columns == [new for _, new in contracts.SILVER_COINGECKO] + ["ingestion_date"]
    assert len(out.columns) == 26
    rows = out.collect()
    assert [(r["coin_id"], r["all_time_high_usd"], r["ingestion_date"]) for r in rows] == [("a", 2.0, RUN)]


def test_every_snapshot_is_kept(spark):
    bronze = typed(spark, contracts.BRONZE_COINGECKO, {"id": "a"}, {"id": "a"})
    assert silver_coingecko(bronze).count() == 2


def test_run_date_defaults_to_today(spark):
    bronze = typed(spark, contracts.BRONZE_COINGECKO, {"id": "a"})
    row = silver_coingecko(bronze).select("ingestion_date", F.current_date()).first()
    assert row[0] == row[1]


def test_silver_defillama_writes_json_text(spark):
    row = {"id": "1", "chains": ["A"], "chainTvls": {"A": 1.5}, "listedAt": 7}
    out = silver_defillama(typed(spark, contracts.BRONZE_DEFILLAMA, row), RUN)
    assert len(out.columns) == 18
    got = out.first()
    assert (got["chains_json"], got["chain_tvls_json"]) == ('["A"]', '{"A":1.5}')
    assert got["listed_at_timestamp"] == 7
    text = typed(spark, contracts.BRONZE_DEFILLAMA, row).withColumn("chains", F.lit('["A", "B"]'))
    assert silver_defillama(text, RUN).first()["chains_json"] == '["A", "B"]'


def test_silver_yfinance_needs_both_keys(spark):
    bronze = spark.sql(
        """select timestamp'2025-01-17 23:30:00' as `Date`, 'AAPL' as Symbol, 1D as Open, 1D as High,
        1D as Low, 1D as Close, 5L as Volume, 0D as Dividends, 0D as `Stock Splits`
        union all select null, 'MSFT', 1D, 1D, 1D, 1D, 5L, 0D, 0D
        union all select timestamp'2025-01-17', null, 1D, 1D, 1D, 1D, 5L, 0D, 0D"""
    )
    out = silver_yfinance(bronze, RUN)
    assert len(out.columns) == 10
    assert [(r["symbol"], r["trade_date"]) for r in out.collect()] == [("AAPL", date(2025, 1, 17))]
    tokyo = silver_yfinance(bronze, RUN, exchange_zone="Asia/Tokyo")
    assert [r["trade_date"] for r in tokyo.collect()] == [date(2025, 1, 18)]


def test_gold_columns_and_values(spark):
    bronze = typed(
        spark,
        contracts.BRONZE_COINGECKO,
        {"id": "a", "market_cap": 1e10, "total_volume": 1e9, "circulating_supply": 5e9,
         "total_supply": 1e10, "price_change_percentage_7d_in_currency": 10.0},
        {"id": "b", "market_cap": 0.0, "total_volume": 1.0, "total_supply": 0.0},
    )
    rows = {r["coin_id"]: r for r in gold_crypto_prices(silver_coingecko(bronze, RUN)).collect()}
    a, b = rows["a"], rows["b"]
    assert len(a) == 25
    assert (a["volume_to_market_cap_ratio"], a["price_per_coin"], a["supply_circulation_pct"]) == (10.0, 2.0, 50.0)
    assert (a["trend_7d"], a["market_cap_category"]) == ("uptrend", "large_cap")
    assert (b["volume_to_market_cap_ratio"], b["price_per_coin"], b["supply_circulation_pct"]) == (None,) * 3
    assert (b["trend_7d"], b["market_cap_category"]) == ("strong_downtrend", "micro_cap")


@pytest.mark.parametrize("model", ["coingecko", "defillama", "yfinance", "crypto_prices"])
def test_models_are_one_narrow_stage(lake, sf_dir, model):
    """Stored bronze to model: one scan, key filter pushed down, no shuffle, no Python."""
    spark = lake.spark
    cases = {
        "coingecko": (contracts.BRONZE_COINGECKO, silver_coingecko, "IsNotNull(id)"),
        "defillama": (contracts.BRONZE_DEFILLAMA, silver_defillama, "IsNotNull(id)"),
        "yfinance": (contracts.BRONZE_YAHOO_FINANCE, silver_yfinance, "IsNotNull(Symbol), IsNotNull(Date)"),
        "crypto_prices": (
            contracts.BRONZE_COINGECKO, lambda b: gold_crypto_prices(silver_coingecko(b)), "IsNotNull(id)",
        ),
    }
    contract, query, pushed = cases[model]
    spark.createDataFrame([], contract).write.parquet(lake.path("bronze", "x", "2025-01-01", "x.parquet"))
    text = plan(query(lake.scan("x", schema=contract)))
    assert text.count("FileScan") == 1 and text.count("Project") <= 2
    assert f"PushedFilters: [{pushed}]" in text
    for absent in ("Exchange", "Python", "Sort", "Aggregate"):
        assert absent not in text


def test_gold_reads_only_its_columns(lake):
    silver = silver_coingecko(lake.spark.createDataFrame([], contracts.BRONZE_COINGECKO), RUN)
    silver.write.parquet(lake.path("silver"))
    text = plan(gold_crypto_prices(lake.spark.read.parquet(lake.path("silver"))))
    schema = text.split("ReadSchema: ")[1]
    assert "coin_image_url" not in schema and "max_supply" not in schema


def test_bronze_contract_covers_the_rename_tables():
    for source, names in (
        ("coingecko", contracts.SILVER_COINGECKO),
        ("defillama", contracts.SILVER_DEFILLAMA),
        ("yahoo_finance", contracts.SILVER_YFINANCE),
    ):
        assert {old for old, _ in names} <= set(contracts.BRONZE[source].names)


def test_adapter_produces_every_label(spark, sf_dir):
    gold = gold_crypto_prices(silver_coingecko(adapters.coins(spark, sf_dir), RUN))
    got = gold.agg(F.collect_set("trend_7d"), F.collect_set("market_cap_category")).first()
    assert (set(got[0]), set(got[1])) == (set(contracts.TRENDS), set(contracts.CAPS))
    assert isinstance(gold.schema["ingestion_date"].dataType, T.DateType)
