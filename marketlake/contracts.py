"""Fixed values of the lake: layers, sources, column contracts, rename tables, checks.

Everything here is data. Column names, their order and the check lists must match what
existing lakes and dashboards use, so they are spelled out in full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Layer and source names.
LAYERS = ("bronze", "silver", "gold")
SOURCES = ("coingecko", "defillama", "yahoo_finance")
FILE_FORMATS = ("parquet", "json")

STRING, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()


def _struct(**groups: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in groups.items()])


# --- landed API answers: one row per request ---------------------------------------

LANDED = _struct(
    source=STRING,
    request_key=STRING,
    fetched_at=T.TimestampType(),
    status=T.IntegerType(),
    body=STRING,
)

# --- bronze contracts (fixed values: field names of the public APIs) ------------------

BRONZE_COINGECKO = _struct(
    id=STRING,
    symbol=STRING,
    name=STRING,
    image=STRING,
    current_price=DOUBLE,
    market_cap=DOUBLE,
    market_cap_rank=LONG,
    total_volume=DOUBLE,
    high_24h=DOUBLE,
    low_24h=DOUBLE,
    circulating_supply=DOUBLE,
    total_supply=DOUBLE,
    max_supply=DOUBLE,
    ath=DOUBLE,
    ath_change_percentage=DOUBLE,
    ath_date=STRING,
    atl=DOUBLE,
    atl_change_percentage=DOUBLE,
    atl_date=STRING,
    last_updated=STRING,
    price_change_percentage_7d_in_currency=DOUBLE,
    price_change_percentage_14d_in_currency=DOUBLE,
    price_change_percentage_30d_in_currency=DOUBLE,
    price_change_percentage_200d_in_currency=DOUBLE,
    price_change_percentage_1y_in_currency=DOUBLE,
)

BRONZE_DEFILLAMA = _struct(
    id=STRING,
    name=STRING,
    slug=STRING,
    symbol=STRING,
    category=STRING,
    chain=STRING,
    tvl=DOUBLE,
    mcap=DOUBLE,
    change_1h=DOUBLE,
    change_1d=DOUBLE,
    change_7d=DOUBLE,
    url=STRING,
    logo=STRING,
    gecko_id=STRING,
    listedAt=LONG,
    chains=T.ArrayType(STRING),
    chainTvls=T.MapType(STRING, DOUBLE),
)

BRONZE_YAHOO_FINANCE = _struct(
    **{
        "Date": T.TimestampType(),
        "Symbol": STRING,
        "Open": DOUBLE,
        "High": DOUBLE,
        "Low": DOUBLE,
        "Close": DOUBLE,
        "Volume": LONG,
        "Dividends": DOUBLE,
        "Stock Splits": DOUBLE,
    }
)

BRONZE_FRED = _struct(date=STRING, value=STRING, series_id=STRING)

BRONZE = {
    "coingecko": BRONZE_COINGECKO,
    "defillama": BRONZE_DEFILLAMA,
    "yahoo_finance": BRONZE_YAHOO_FINANCE,
    "fred": BRONZE_FRED,
}

# --- silver: (bronze column, silver column), in output order (fixed values) -----------

SILVER_COINGECKO = (
    ("id", "coin_id"),
    ("symbol", "coin_symbol"),
    ("name", "coin_name"),
    ("current_price", "price_usd"),
    ("high_24h", "high_24h_usd"),
    ("low_24h", "low_24h_usd"),
    ("market_cap", "market_cap_usd"),
    ("market_cap_rank", "market_cap_rank"),
    ("total_volume", "volume_24h_usd"),
    ("circulating_supply", "circulating_supply"),
    ("total_supply", "total_supply"),
    ("max_supply", "max_supply"),
    ("price_change_percentage_7d_in_currency", "price_change_pct_7d"),
    ("price_change_percentage_14d_in_currency", "price_change_pct_14d"),
    ("price_change_percentage_30d_in_currency", "price_change_pct_30d"),
    ("price_change_percentage_200d_in_currency", "price_change_pct_200d"),
    ("price_change_percentage_1y_in_currency", "price_change_pct_1y"),
    ("ath", "all_time_high_usd"),
    ("ath_change_percentage", "ath_change_pct"),
    ("ath_date", "ath_date_at"),
    ("atl", "all_time_low_usd"),
    ("atl_change_percentage", "atl_change_pct"),
    ("atl_date", "atl_date_at"),
    ("last_updated", "last_updated_at"),
    ("image", "coin_image_url"),
)

SILVER_DEFILLAMA = (
    ("id", "protocol_id"),
    ("name", "protocol_name"),
    ("slug", "protocol_slug"),
    ("symbol", "protocol_symbol"),
    ("category", "protocol_category"),
    ("chain", "primary_chain"),
    ("tvl", "tvl_usd"),
    ("mcap", "market_cap_usd"),
    ("change_1h", "tvl_change_pct_1h"),
    ("change_1d", "tvl_change_pct_1d"),
    ("change_7d", "tvl_change_pct_7d"),
    ("url", "protocol_url"),
    ("logo", "protocol_logo_url"),
    ("listedAt", "listed_at_timestamp"),
    ("gecko_id", "coingecko_id"),
    ("chains", "chains_json"),
    ("chainTvls", "chain_tvls_json"),
)

SILVER_YFINANCE = (
    ("Symbol", "symbol"),
    ("Date", "trade_date"),
    ("Open", "open_usd"),
    ("High", "high_usd"),
    ("Low", "low_usd"),
    ("Close", "close_usd"),
    ("Volume", "volume"),
    ("Dividends", "dividends"),
    ("Stock Splits", "stock_splits"),
)

INGESTION_DATE = "ingestion_date"

# --- labels (fixed values): bounds from high to low, then the label of what is left -----

TREND_ABOVE = ((10, "strong_uptrend"), (5, "uptrend"), (-5, "sideways"), (-10, "downtrend"))
TREND_ELSE = "strong_downtrend"
CAP_FROM = ((10_000_000_000, "large_cap"), (1_000_000_000, "mid_cap"), (100_000_000, "small_cap"))
CAP_ELSE = "micro_cap"

TRENDS = tuple(label for _, label in TREND_ABOVE) + (TREND_ELSE,)
CAPS = tuple(label for _, label in CAP_FROM) + (CAP_ELSE,)

# --- checks ------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One rule on one column: ``not_null``, ``unique``, ``accepted_values`` or ``accepted_range``."""

    column: str
    kind: str
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None


def not_null(*columns: str) -> list[Check]:
    return [Check(column, "not_null") for column in columns]


def unique(*columns: str) -> list[Check]:
    return [Check(column, "unique") for column in columns]


def accepted_values(column: str, values: tuple[str, ...]) -> Check:
    return Check(column, "accepted_values", values=tuple(values))


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check(column, "accepted_range", low=low, high=high)


# The declared checks of the four models.
CHECKS: dict[str, list[Check]] = {
    "coingecko": [
        *not_null("coin_id", "coin_symbol", "coin_name", "price_usd", "market_cap_usd"),
        *not_null("market_cap_rank", INGESTION_DATE),
        *unique("coin_id"),
    ],
    "defillama": not_null("protocol_id", "protocol_name", "protocol_slug", INGESTION_DATE),
    "yfinance": not_null("symbol", "trade_date", "close_usd", INGESTION_DATE),
    "crypto_prices": [
        *not_null("coin_id", "coin_symbol", "price_usd", "market_cap_rank"),
        *not_null("trend_7d", "market_cap_category"),
        *unique("coin_id"),
        accepted_values("trend_7d", TRENDS),
        accepted_values("market_cap_category", CAPS),
    ],
}
