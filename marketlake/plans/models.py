"""The silver and gold models: each is one projection over one table, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import contracts
from marketlake.functions.labels import cap_label, trend_label
from marketlake.functions.ratios import ratio, ratio_pct
from marketlake.functions.records import json_text, quoted


def _renamed(
    bronze: DataFrame,
    keys: tuple[str, ...],
    names: tuple[tuple[str, str], ...],
    run_date: date | None,
    special: dict[str, str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Drop rows without their key, rename, and stamp the date of the run.

    ``keep`` names columns that go on as they are.
    """
    present = " and ".join(f"{quoted(k)} is not null" for k in keys)
    values = {old: quoted(old) for old, _ in names} | (special or {})
    today = "current_date()" if run_date is None else f"date'{run_date}'"
    return bronze.where(present).selectExpr(
        *(f"{values[old]} as {new}" for old, new in names),
        f"{today} as {contracts.INGESTION_DATE}",
        *map(quoted, keep),
    )


def silver_coingecko(
    bronze: DataFrame, run_date: date | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Coin market snapshots; every snapshot is kept."""
    return _renamed(bronze, ("id",), contracts.SILVER_COINGECKO, run_date, keep=keep)


def silver_defillama(
    bronze: DataFrame, run_date: date | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Protocol snapshots; the chain list and the values per chain are JSON text."""
    kinds = {f.name: f.dataType for f in bronze.schema.fields}
    texts = {c: json_text(c, kinds[c]) for c in ("chains", "chainTvls")}
    return _renamed(bronze, ("id",), contracts.SILVER_DEFILLAMA, run_date, texts, keep)


def silver_yfinance(
    bronze: DataFrame,
    run_date: date | None = None,
    exchange_zone: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Price bars per symbol and day.

    The day is the one in the session's time zone (UTC). ``exchange_zone`` takes the day of
    the exchange instead.
    """
    moment = "`Date`"
    if exchange_zone and isinstance(bronze.schema["Date"].dataType, T.TimestampType):
        moment = f"from_utc_timestamp(`Date`, '{exchange_zone}')"
    trade_date = {"Date": f"cast({moment} as date)"}
    return _renamed(bronze, ("Symbol", "Date"), contracts.SILVER_YFINANCE, run_date, trade_date, keep)


def gold_crypto_prices(silver: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Coin prices with ratios and labels."""
    # The columns and their order.
    return silver.select(
        "coin_id",
        "coin_symbol",
        "coin_name",
        "price_usd",
        "market_cap_usd",
        "market_cap_rank",
        "volume_24h_usd",
        ratio_pct("volume_24h_usd", "market_cap_usd").alias("volume_to_market_cap_ratio"),
        ratio("market_cap_usd", "circulating_supply").alias("price_per_coin"),
        trend_label(F.col("price_change_pct_7d")).alias("trend_7d"),
        cap_label(F.col("market_cap_usd")).alias("market_cap_category"),
        "high_24h_usd",
        "low_24h_usd",
        "all_time_high_usd",
        "all_time_low_usd",
        "circulating_supply",
        "total_supply",
        ratio_pct("circulating_supply", "total_supply").alias("supply_circulation_pct"),
        "price_change_pct_7d",
        "price_change_pct_14d",
        "price_change_pct_30d",
        "price_change_pct_200d",
        "price_change_pct_1y",
        "last_updated_at",
        contracts.INGESTION_DATE,
        *keep,
    )


@dataclass(frozen=True)
class Model:
    """A model: where it lives, what it reads, how it is computed from that."""

    layer: str
    name: str
    source: str | None = None
    parent: str | None = None
    query: Callable[..., DataFrame] = None

    @property
    def bronze_contract(self) -> T.StructType:
        return contracts.BRONZE[self.source]


MODELS: dict[str, Model] = {
    m.name: m
    for m in (
        Model("silver", "coingecko", source="coingecko", query=silver_coingecko),
        Model("silver", "defillama", source="defillama", query=silver_defillama),
        Model("silver", "yfinance", source="yahoo_finance", query=silver_yfinance),
        Model("gold", "crypto_prices", parent="coingecko", query=gold_crypto_prices),
    )
}
