"""Every registered query and the SQL it is checked against."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import contracts
from marketlake.contracts import accepted_range, accepted_values, not_null, unique
from marketlake.functions import (
    conform,
    keys_first,
    lake_path_column,
    nested_to_json,
    parse_lake_path,
    tag,
)
from marketlake.operators import normalize, profile, quality, sketches
from marketlake.operators.asof import as_of
from marketlake.plans import models
from marketlake.plans.build import build
from marketlake.plans.concurrent import ConcurrentBuild
from marketlake.plans.incremental import IncrementalResult, build_incremental, state_of
from marketlake.plans.ingest import ingest
from marketlake.plans.query import create_view, query_source
from marketlake.plans.run_log import query_log, run_log
from marketlake.session import configure, scratch_root
from marketlake.plans.models import MODELS
from marketlake.sinks import quarantine
from marketlake.sinks.batches import delete_batch, write_batch
from marketlake.sinks.functions import create_day_function, create_functions, run_sql
from marketlake.sinks.quarantine import write_checked
from marketlake.sinks.tables import create_layout, publish_bucketed, publish_table
from marketlake.sources import catalog, drift, landing, large_json
from marketlake.sources.index import FileIndex
from marketlake.sources.lake import Lake
from marketlake.streaming.ingest import ingest_new
from workload import adapters

RUN_DATE = date(2024, 2, 1)

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(run: Query) -> Query:
        @wraps(run)
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir.rstrip("/"))

        ENTRIES[run.__name__] = Entry(configured, sql)
        return configured

    return register


def _new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_root(spark))


def _new_prefix() -> str:
    return f"t{uuid.uuid4().hex[:12]}_"


# --- models ---------------------------------------------------------------------------

# Spelled out, so that a wrong rename in the library is a difference here.
_COINS = adapters.COINS.format(part="part")
_SILVER_COINS_SQL = f"""
select id as coin_id, symbol as coin_symbol, name as coin_name, current_price as price_usd,
  high_24h as high_24h_usd, low_24h as low_24h_usd, market_cap as market_cap_usd,
  market_cap_rank as market_cap_rank, total_volume as volume_24h_usd,
  circulating_supply as circulating_supply, total_supply as total_supply, max_supply as max_supply,
  price_change_percentage_7d_in_currency as price_change_pct_7d,
  price_change_percentage_14d_in_currency as price_change_pct_14d,
  price_change_percentage_30d_in_currency as price_change_pct_30d,
  price_change_percentage_200d_in_currency as price_change_pct_200d,
  price_change_percentage_1y_in_currency as price_change_pct_1y, ath as all_time_high_usd,
  ath_change_percentage as ath_change_pct, ath_date as ath_date_at, atl as all_time_low_usd,
  atl_change_percentage as atl_change_pct, atl_date as atl_date_at,
  last_updated as last_updated_at, image as coin_image_url, date '{RUN_DATE}' as ingestion_date
from ({_COINS}) where id is not null"""


_GOLD_SQL = f"""
with trends(above, trend) as (
  values (10e0, 'strong_uptrend'), (5e0, 'uptrend'), (-5e0, 'sideways'), (-10e0, 'downtrend')
),
sizes(least, size) as (values (1e10, 'large_cap'), (1e9, 'mid_cap'), (1e8, 'small_cap'))
select coin_id, coin_symbol, coin_name, price_usd, market_cap_usd, market_cap_rank,
  volume_24h_usd, volume_24h_usd / nullif(market_cap_usd, 0) * 100 as volume_to_market_cap_ratio,
  market_cap_usd / nullif(circulating_supply, 0) as price_per_coin,
  coalesce((select max_by(trend, above) from trends where above < price_change_pct_7d),
    'strong_downtrend') as trend_7d,
  coalesce((select max_by(size, least) from sizes where least <= market_cap_usd), 'micro_cap')
    as market_cap_category,
  high_24h_usd, low_24h_usd, all_time_high_usd, all_time_low_usd, circulating_supply,
  total_supply, circulating_supply / nullif(total_supply, 0) * 100 as supply_circulation_pct,
  price_change_pct_7d, price_change_pct_14d, price_change_pct_30d, price_change_pct_200d,
  price_change_pct_1y, last_updated_at, ingestion_date
from ({_SILVER_COINS_SQL})"""


def _silver_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_coingecko(adapters.coins(spark, sf_dir), RUN_DATE)


@query(_SILVER_COINS_SQL)
def silver_coingecko(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_coins(spark, sf_dir)


_PROTOCOLS_SQL = f"""
select cast(s_suppkey as varchar) as protocol_id, s_name as protocol_name,
  lower(s_name) as protocol_slug, upper(substr(n_name, 1, 3)) as protocol_symbol,
  r_name as protocol_category, n_name as primary_chain, s_acctbal as tvl_usd,
  s_acctbal * 2e0 as market_cap_usd, s_nationkey * 0.5e0 as tvl_change_pct_1h,
  s_nationkey * 1e0 as tvl_change_pct_1d, s_nationkey * 7e0 as tvl_change_pct_7d,
  'https://p.example/' || s_suppkey as protocol_url,
  'https://l.example/' || s_suppkey as protocol_logo_url,
  s_suppkey as listed_at_timestamp, 'gecko-' || s_suppkey as coingecko_id,
  '["' || n_name || '","' || r_name || '"]' as chains_json,
  '{{"' || n_name || '":' || n_nationkey || ',"' || r_name || '":' || r_regionkey || '}}'
    as chain_tvls_json,
  date '{RUN_DATE}' as ingestion_date
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where s_suppkey % 29 <> 0"""


@query(_PROTOCOLS_SQL)
def silver_defillama(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_defillama(adapters.protocols(spark, sf_dir), RUN_DATE)


_BARS_SQL = f"""
select event_type as symbol, cast(ts as date) as trade_date, value + 0.5e0 as open_usd,
  value + 1e0 as high_usd, value - 1e0 as low_usd, value as close_usd, user_id as volume,
  event_id % 3 * 0.25e0 as dividends, event_id % 5 * 1e0 as stock_splits,
  date '{RUN_DATE}' as ingestion_date
from events where event_type is not null and ts is not null and event_id % 31 <> 0"""


@query(_BARS_SQL)
def silver_yfinance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_yfinance(adapters.bars(spark, sf_dir), RUN_DATE)


@query(_GOLD_SQL)
def gold_crypto_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.gold_crypto_prices(_silver_coins(spark, sf_dir))


@query("""
select case when s_suppkey % 29 <> 0 then cast(s_suppkey as varchar) end as id, '["' || n_name || '","' || r_name || '"]' as chains,
  '{"' || n_name || '":' || n_nationkey || ',"' || r_name || '":' || r_regionkey || '}' as "chainTvls"
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def nested_values_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_to_json(adapters.protocols(spark, sf_dir).select("id", "chains", "chainTvls"))


# --- lake files ------------------------------------------------------------------------


def _events_lake(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> Lake:
    lake = _new_lake(spark)
    adapters.write_events(lake, sf_dir, fmt)
    return lake


@query(f"""
select event_id, ts, user_id, event_type, value, props, {adapters.BATCH_DAY} as ingest_date
from events""")
def scan_date_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    schema = adapters.table(spark, sf_dir, "events").schema
    return lake.scan("events", schema=schema, day_column="ingest_date")


@query("""
select event_id, event_type, value from events
where ts >= timestamp '2024-01-11' and ts < timestamp '2024-01-21'""")
def scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    schema = adapters.table(spark, sf_dir, "events").schema
    days = lake.scan(
        "events", schema=schema, first_day=date(2024, 1, 15), last_day=date(2024, 1, 25)
    )
    return days.select("event_id", "event_type", "value")


@query(f"""
select distinct 'bronze' as layer, 'events' as source,
  strftime({adapters.BATCH_DAY}, '%Y-%m-%d') as date,
  'events_' || strftime({adapters.BATCH_DAY}, '%Y%m%d') || '_000000' as filename,
  'parquet' as format, true as has_bytes
from events""")
def list_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    found = lake.list_batches("events")
    inner = F.substring_index("path", "/", -4)
    parts = found.select(parse_lake_path(inner).alias("p"), "bytes")
    return parts.select(
        *(f"p.{c}" for c in ("layer", "source", "date", "filename", "format")),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query("""
select event_id, ts, user_id, event_type, value, props from events
where ts >= timestamp '2024-01-21' or ts is null""")
def read_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    return lake.read_batch(lake.latest_batch_path("events"))


@query(f"""
select strftime(max({adapters.BATCH_DAY}), '%Y-%m-%d') as date,
  'events_' || strftime(max({adapters.BATCH_DAY}), '%Y%m%d') || '_000000' as filename
from events""")
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    path = F.regexp_extract("path", "(bronze/events/.*)$", 1)
    parts = lake.newest_file("bronze", "events").select(parse_lake_path(path).alias("p"))
    return parts.select("p.date", "p.filename")


@query("""
select event_id, date_trunc('milliseconds', ts) as ts, user_id, event_type, value, props
from events""")
def json_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir, "json")
    schema = adapters.table(spark, sf_dir, "events").schema
    return lake.scan("events", schema=schema, fmt="json")


@query("""
select 'rows' as metric, count(*) as value from events
union all select 'files with bytes', case when count(*) > 0 then 1 else 0 end from events""")
def stored_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    rows = profile.row_count(lake.scan("events"))
    size = profile.exact_size(lake.list_files("bronze", "events"))
    stored = ((F.col("bytes") > 0) & (F.col("n_files") > 0)).cast("bigint")
    return rows.select(F.lit("rows").alias("metric"), F.col("n_rows").alias("value")).unionByName(
        size.select(F.lit("files with bytes").alias("metric"), stored.alias("value"))
    )


_DRIFT_CONTRACT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("v", T.DoubleType()),
        T.StructField("chains", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


@query("""
select event_id, case when ts < timestamp '2024-01-11' then cast(user_id as double)
    when ts < timestamp '2024-01-21' then value else cast(null as double) end as v,
  '["' || event_type || '"]' as chains,
  case when ts < timestamp '2024-01-11' then event_type else cast(null as varchar) end as note,
  ts as at
from events""")
def drift_safe_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days: long and array; double and text without a column; only text."""
    lake, events = _new_lake(spark), adapters.table(spark, sf_dir, "events")
    text = F.to_json(F.array("event_type")).alias("chains")
    at = F.col("ts").cast("timestamp").alias("at")
    shapes = [
        ["event_id", F.col("user_id").alias("v"), F.array("event_type").alias("chains"),
         F.col("event_type").alias("note"), at],
        ["event_id", F.col("value").alias("v"), text, at],
        [F.col("event_id").cast("int").alias("event_id"), text, at],
    ]
    for (day, condition), columns in zip(adapters.BATCHES, shapes, strict=True):
        write_batch(lake, events.where(condition).select(*columns), "drifting", day)
    read = drift.scan_any_schema(lake, "drifting", _DRIFT_CONTRACT)
    return read.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("""
select o_orderkey,
  'bronze/orders/' || strftime(o_orderdate, '%Y-%m-%d') || '/orders_'
    || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '.parquet' as by_date,
  'silver/orders/' || strftime(o_orderdate, '%Y-%m-%d') || '/o' || o_orderkey || '.json' as named
from orders""")
def lake_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("o"), "o_orderkey")
    return adapters.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        lake_path_column(F.lit("orders"), F.col("o_orderdate")).alias("by_date"),
        lake_path_column(F.lit("orders"), F.col("o_orderdate"), name, "json", "silver").alias(
            "named"
        ),
    )


@query("""
select o_orderkey, 'bronze' as layer, o_orderpriority as source,
  strftime(o_orderdate, '%Y-%m-%d') as date,
  case when o_orderstatus = 'O' then 'a.b' when o_orderstatus = 'F' then 'c' else 'd' end
    as filename,
  case when o_orderstatus = 'O' then 'parquet' when o_orderstatus = 'F' then 'json'
    else 'unknown' end as format
from orders""")
def lake_path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = (
        F.when(F.col("o_orderstatus") == "O", "a.b.parquet")
        .when(F.col("o_orderstatus") == "F", "c.json")
        .otherwise("d")
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    path = F.concat_ws("/", F.lit("/bronze"), "o_orderpriority", day, file)
    orders = adapters.table(spark, sf_dir, "orders")
    parts = orders.select("o_orderkey", parse_lake_path(path).alias("p"))
    return parts.select(
        "o_orderkey", *(f"p.{c}" for c in ("layer", "source", "date", "filename", "format"))
    )


# --- landed answers --------------------------------------------------------------------


@query("""
select 'ev-' || event_id as id, event_type as symbol, value as current_price,
  cast(user_id as double) as market_cap, event_id as market_cap_rank,
  value + 6e0 as max_supply
from events""")
def decode_paged_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = landing.decode(adapters.landed_pages(spark, sf_dir), "coingecko")
    return records.select(
        "id", "symbol", "current_price", "market_cap", "market_cap_rank", "max_supply"
    )


@query("""
select 'ev-' || event_id as id, event_type as symbol, value as current_price,
  cast(user_id as double) as market_cap, event_id as market_cap_rank,
  value + 6e0 as max_supply, true as by_many_tasks
from events""")
def decode_large_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array of all events in one file, by ranges of a sixteenth of it."""
    folder = scratch_root(spark)
    adapters.write_event_array(spark, sf_dir, folder)
    (size,) = spark.read.format("binaryFile").load(folder).agg(F.sum("length")).first()
    landed = large_json.read_large_arrays(
        spark, folder, "coingecko", range_bytes=max(1, size // 16), suffix=".txt"
    )
    records = landing.decode(landed, "coingecko")
    tasks = landed.select(F.spark_partition_id().alias("p")).distinct().count()
    return records.select(
        "id", "symbol", "current_price", "market_cap", "market_cap_rank", "max_supply",
        F.lit(tasks >= 8).alias("by_many_tasks"),
    )


@query("""
select cast(s_suppkey as varchar) as id, s_name as name, s_acctbal as tvl,
  s_name as first_chain, cast(s_nationkey as double) as chain_tvl
from supplier""")
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = landing.decode(adapters.landed_envelopes(spark, sf_dir), "defillama")
    return records.select(
        "id",
        "name",
        "tvl",
        F.get("chains", F.lit(0)).alias("first_chain"),
        F.col("chainTvls")[F.col("name")].alias("chain_tvl"),
    )


@query("""
select strftime(ts, '%Y-%m-%d') as date, cast(user_id as varchar) as value,
  event_type as series_id
from events""")
def decode_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.decode(adapters.landed_series(spark, sf_dir), "fred")


@query("select event_id as a, value as b from events")
def decode_query_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = T.StructType(
        [T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())]
    )
    landed = adapters.landed_query_results(spark, sf_dir)
    return landing.decode_query_result(spark, landed, 7, contract)


@query("""
select ts as "Date", event_type as "Symbol", value as "Open", value + 1e0 as "High",
  value - 1e0 as "Low", value as "Close", user_id as "Volume", 0e0 as "Dividends",
  0e0 as "Stock Splits"
from events""")
def decode_price_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = landing.decode(adapters.landed_bars(spark, sf_dir), "yahoo_finance")
    return bars.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


@query("""
select event_type as request_key, count(*) as records, cast(0 as bigint) as rejected,
  'fetched' as status from events group by event_type
union all
select n_name, 0, case when n_nationkey < 10 then 1 else 0 end, 'skipped' from nation
union all
select r_name, 0, 0, 'skipped' from region""")
def request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = normalize.stack(
        [
            adapters.table(spark, sf_dir, name).select(F.col(key).alias("request_key"))
            for name, key in (("events", "event_type"), ("nation", "n_name"), ("region", "r_name"))
        ]
    )
    status = normalize.request_status(adapters.landed_series(spark, sf_dir), "fred", keys)
    return status.select("request_key", "records", "rejected", "status")


@query("""
select 'coingecko' as source, n_name as request_key, 'ignored' as reason from nation
union all
select 'fred', n_name, 'malformed' from nation where n_nationkey < 10
union all
select 'yahoo_finance', r_name, 'misfit' from region""")
def rejected_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = normalize.stack(
        [adapters.landed_bars(spark, sf_dir), adapters.landed_misfits(spark, sf_dir)]
    )
    misfits = landing.rejects(bars, "yahoo_finance")
    pages = landing.rejects(adapters.landed_pages(spark, sf_dir), "coingecko")
    series = landing.rejects(adapters.landed_series(spark, sf_dir), "fred")
    return normalize.stack([pages, series, misfits]).select("source", "request_key", "reason")


@query("""
select 'ev-' || event_id as id, event_type as symbol, value as current_price from events""")
def records_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of records stored as text, one array per line."""
    lake = _new_lake(spark)
    folder = lake.path("landed", "pages")
    pages = adapters.landed_pages(spark, sf_dir).where(F.col("body").startswith("["))
    pages.select("body").write.text(folder)
    wanted = T.StructType(
        [f for f in contracts.BRONZE_COINGECKO if f.name in ("id", "symbol", "current_price")]
    )
    return normalize.read_records(spark, folder, wanted, one_per_file=False)


@query("""
select 'early' as "Symbol", event_id, value as price, cast(null as bigint) as volume
from events where ts < timestamp '2024-01-11'
union all
select 'late', event_id, cast(null as double), user_id
from events where ts >= timestamp '2024-01-11' or ts is null""")
def stacked_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with other columns, tagged with their request key."""
    events = adapters.table(spark, sf_dir, "events")
    early = events.where("ts < timestamp_ntz'2024-01-11'").selectExpr("event_id", "value as price")
    late = events.where("ts >= timestamp_ntz'2024-01-11' or ts is null")
    late = late.selectExpr("event_id", "user_id as volume")
    both = normalize.stack([tag(early, "Symbol", "early"), tag(late, "Symbol", "late")])
    return keys_first(both, "Symbol")


# --- jobs ------------------------------------------------------------------------------


_PAGE_SQL = ", ".join(
    f"cast({text} as {'varchar' if 'concat' in text else 'double'}) as {name}"
    for name, text in adapters.PAGE_FIELDS.items()
    if name not in ("properties", "number")
)


@query(f"""
select 'ev-' || event_id as id, event_type as symbol, value as current_price,
  cast(user_id as double) as market_cap, event_id as market_cap_rank, {_PAGE_SQL},
  props as properties, cast(event_id as varchar) as number, date '2024-02-01' as ingest_date
from events""")
def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of a stored batch, and the fields that no contract names."""
    lake = _new_lake(spark)
    ingest(lake, "coingecko", adapters.landed_pages(spark, sf_dir), datetime(2024, 2, 1, 6))
    read = lake.scan("coingecko", day_column="ingest_date")
    others = [F.col(landing.REST)[name].alias(name) for name in ("properties", "number")]
    return read.select("*", *others).drop(landing.REST)


@query("""
select distinct 'coingecko_20240201_060000' as pipeline_id, 'pipeline_failed' as event,
  false as success, cast(null as bigint) as rows
from nation""")
def failed_run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is noted of a run that an answer of the server stops."""
    lake = _new_lake(spark)
    try:
        ingest(lake, "coingecko", adapters.landed_failures(spark, sf_dir), datetime(2024, 2, 1, 6))
    except Exception:
        return run_log(lake).select("pipeline_id", "event", "success", "rows")
    raise AssertionError("a failed answer must stop the run")


@query("""
select 'coingecko_20240201_060000' as pipeline_id, 'pipeline_completed' as event,
  (select count(*) from nation) as rejected, count(*) as rows, cast(26 as int) as columns_count,
  count(*) * 26 * 8 as file_size_bytes, true as success
from events""")
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _new_lake(spark)
    ingest(lake, "coingecko", adapters.landed_pages(spark, sf_dir), datetime(2024, 2, 1, 6))
    return run_log(lake).select(
        "pipeline_id", "event", "rejected", "rows", "columns_count", "file_size_bytes", "success"
    )


class _Died(Exception):
    """Stands for a lost driver."""


def _die(number: int) -> None:
    raise _Died(f"after micro-batch {number} was written")


@query(f"""
select 'ev-' || event_id as id, event_type as symbol, value as current_price,
  cast(user_id as double) as market_cap, event_id as market_cap_rank, {_PAGE_SQL},
  props as properties, {adapters.BATCH_DAY} as ingest_date
from events""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lots of which the second is late, a run that dies before it commits, a lot landed twice."""
    lake, landed = _new_lake(spark), scratch_root(spark)

    def land(number: int, name: str) -> None:
        adapters.landed_lot(spark, sf_dir, number).write.parquet(f"{landed}/{name}")

    land(0, "first")
    ingest_new(lake, "coingecko", landed)
    land(2, "third")
    try:
        ingest_new(lake, "coingecko", landed, published=_die)
        raise AssertionError("the run must die")
    except StreamingQueryException:
        pass
    land(1, "late")
    land(0, "again")
    ingest_new(lake, "coingecko", landed)
    read = lake.scan("coingecko", day_column="ingest_date")
    return read.select("*", F.col(landing.REST)["properties"].alias("properties")).drop(landing.REST)


def _bronze(spark: SparkSession, sf_dir: str, *sources: str, sound: bool = False):
    """A lake with bronze from the test tables, and the prefix of its databases.

    Some coins have no market cap and fail a declared check; ``sound`` leaves them out.
    """
    lake, prefix = _new_lake(spark), _new_prefix()
    create_layout(lake, prefix=prefix)
    makers = {"coingecko": adapters.coins, "defillama": adapters.protocols, "yahoo_finance": adapters.bars}
    for source in sources:
        rows = makers[source](spark, sf_dir)
        if sound:
            rows = rows.where("market_cap is not null")
        write_batch(lake, rows, source, datetime(2024, 2, 1))
    return lake, prefix


def _built(spark: SparkSession, sf_dir: str) -> str:
    lake, prefix = _bronze(spark, sf_dir, *contracts.SOURCES)
    build(lake, run_date=RUN_DATE, skip_checks=True, prefix=prefix)
    return prefix


@query(f"select * from ({_GOLD_SQL}) where market_cap_usd is not null")
def build_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold, built with their checks."""
    lake, prefix = _bronze(spark, sf_dir, "coingecko", sound=True)
    build(lake, "+crypto_prices", variables={"run_date": str(RUN_DATE)}, prefix=prefix)
    return catalog.table(spark, f"{prefix}gold", "crypto_prices")


@query(f"""
with known as (
  select *, case when market_cap_rank % 3 = 0 then date '2024-02-01'
    when market_cap_rank % 3 = 1 then date '2024-02-02' else date '2024-02-03' end as batch_day
  from ({_GOLD_SQL})
)
select *, batch_day <> date '2024-02-01' as written_last from known
where batch_day <> date '2024-02-02' or market_cap_rank % 2 = 0""")
def incremental_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after a second run, for which one day was new and the batch of another one replaced."""
    lake, prefix = _new_lake(spark), _new_prefix()
    coins = adapters.coins(spark, sf_dir)

    def put(day: int, which: str) -> None:
        write_batch(lake, coins.where(which), "coingecko", datetime(2024, 2, day), "coins")

    def run() -> IncrementalResult:
        return build_incremental(
            lake, select="+crypto_prices", run_date=RUN_DATE, skip_checks=True, prefix=prefix
        )

    put(1, "market_cap_rank % 3 = 0")
    put(2, "market_cap_rank % 3 = 1")
    run()
    put(2, "market_cap_rank % 3 = 1 and market_cap_rank % 2 = 0")
    put(3, "market_cap_rank % 3 = 2")
    last = run().models[-1]
    state = state_of(lake, MODELS["crypto_prices"], prefix)
    written = state.select("batch_day", (F.col("run") == last.run).alias("written_last"))
    return spark.table(last.table).join(written, "batch_day")


@query(f"""
with days(low, high) as (
  values (date '2024-01-10', date '2024-01-10'), (date '2024-01-10', date '2024-01-20'),
    (date '2024-01-20', date '2024-01-31'), (date '2024-01-10', date '2024-01-31')
)
select low as first_day, high as last_day, count(*) as rows, count(*) - count(value) as nulls,
  cast(min(event_id) as varchar) as least_id, cast(max(event_id) as varchar) as greatest_id,
  true as quartiles_fit, true as distinct_fits
from days join events on {adapters.BATCH_DAY} between low and high group by low, high""")
def merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles kept per batch, merged over ranges of days and held against exact numbers."""
    lake = _events_lake(spark, sf_dir)
    profiles = sketches.BatchProfiles(lake, "events")
    profiles.refresh()
    everything = lake.scan("events", day_column="ingest_date").select("value", "user_id", "ingest_date")
    rows = []
    for low, high in ((10, 10), (10, 20), (20, 31), (10, 31)):
        first, last = date(2024, 1, low), date(2024, 1, high)
        found = {r["column"]: r for r in profiles.describe(first, last).collect()}
        guessed = found["value"]["quantiles"] or [0.0] * 3
        exact = everything.where(F.col("ingest_date").between(first, last)).agg(
            F.count("value").alias("n"),
            F.count_distinct("user_id").alias("users"),
            *(F.count_if(F.col("value") < q).alias(f"below{k}") for k, q in enumerate(guessed)),
            *(F.count_if(F.col("value") <= q).alias(f"upto{k}") for k, q in enumerate(guessed)),
        ).first()
        slack = sketches.QUANTILE_ERROR * exact["n"] + 1
        fits = all(
            exact[f"below{k}"] - slack <= share * exact["n"] <= exact[f"upto{k}"] + slack
            for k, share in enumerate((0.25, 0.5, 0.75))
        )
        off = abs(found["user_id"]["distinct"] - exact["users"])
        rows.append(
            (
                first, last, found["value"]["rows"], found["value"]["nulls"], found["event_id"]["low"],
                found["event_id"]["high"], fits, off <= 4 * sketches.DISTINCT_ERROR * exact["users"] + 1,
            )
        )
    return spark.createDataFrame(
        rows,
        "first_day date, last_day date, rows long, nulls long, least_id string, greatest_id string, "
        "quartiles_fit boolean, distinct_fits boolean",
    )


_FIRST_THIRD = adapters.BATCHES[0][1].replace("timestamp_ntz", "timestamp ")


@query(f"""
with batch as (
  select event_id - case when event_id % 5 = 0 then 1 else 0 end as id, event_type, value
  from events where not ({_FIRST_THIRD}) or ts is null
),
taken as (select distinct event_id - case when event_id % 5 = 0 then 1 else 0 end as id from events where {_FIRST_THIRD}),
judged as (
  select batch.id, event_type, value, count(*) over (partition by batch.id) > 1 or taken.id is not null as again,
    event_type not in ('click', 'view') as odd_type, value < 10 or value > 90 as odd_value
  from batch left join taken on batch.id = taken.id
)
select id, event_type, value, case when again then 'id unique,' else '' end
  || case when odd_type then 'event_type accepted_values,' else '' end
  || case when odd_value then 'value accepted_range,' else '' end as reasons
from judged""")
def checked_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and rows set aside, with the checks they break."""
    lake, events = _new_lake(spark), adapters.table(spark, sf_dir, "events")
    rows = events.selectExpr("event_id - if(event_id % 5 = 0, 1, 0) as id", "event_type", "value", "ts")
    early = F.coalesce(F.expr(adapters.BATCHES[0][1]), F.lit(False))
    checks = [
        *unique("id"), accepted_values("event_type", ("click", "view")), accepted_range("value", 10, 90),
    ]
    write_checked(
        lake, rows.where(~early).drop("ts"), "events", checks, datetime(2024, 1, 31), stored=rows.where(early)
    )
    both = normalize.stack([lake.scan("events"), quarantine.read_quarantine(lake, "events").drop("day")])
    reasons = F.coalesce(F.col(quarantine.REASONS), F.array().cast("array<string>"))
    return both.select(
        "id", "event_type", "value", F.concat_ws("", F.transform(reasons, lambda r: F.concat(r, F.lit(",")))).alias("reasons")
    )


_SNAPSHOTS = """
select case when event_id % 2 = 0 then 'coin-hot' else 'coin-' || cast(user_id % 40 as varchar(20)) end as id,
  ts, event_id, value, user_id
from {events}"""
_MOMENTS = """
select o_orderkey, case when o_orderkey % 2 = 0 then 'coin-hot'
    when o_orderkey % 41 = 0 then null else 'coin-' || cast(o_custkey % 45 as varchar(20)) end as wanted,
  {moment} as moment
from {orders}"""


@query(f"""
with snapshots as ({_SNAPSHOTS.format(events="events")}),
gold as (
  select id as coin_id, ts as seen_at, value as price_usd, value * 1000 as market_cap_usd,
    value * 1000 / nullif(user_id % 5, 0) as price_per_coin
  from snapshots where ts is not null
  qualify row_number() over (partition by id, ts order by event_id desc) = 1
),
moments as ({_MOMENTS.format(orders="orders", moment="timestamp '2024-01-01' + to_seconds(o_orderkey * 7919 % 3000000)")})
select o_orderkey, wanted, moment, price_usd, market_cap_usd, price_per_coin, seen_at
from moments asof left join gold on wanted = coin_id and moment >= seen_at""")
def gold_as_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold row of a coin as of the moment of every order; one coin has half of all rows."""
    snapshots = spark.sql(_SNAPSHOTS, events=adapters.table(spark, sf_dir, "events"))
    bronze = snapshots.selectExpr(
        "id", "value as current_price", "value * 1000 as market_cap",
        "cast(user_id % 5 as double) as circulating_supply", "event_id as market_cap_rank",
        "cast(ts as timestamp) as seen_at",
    )
    dated = T.StructType([*contracts.BRONZE_COINGECKO.fields, T.StructField("seen_at", T.TimestampType())])
    silver = models.silver_coingecko(conform(bronze, dated), RUN_DATE, keep=("seen_at",))
    gold = models.gold_crypto_prices(silver, keep=("seen_at",))
    moment = "timestamp '2024-01-01' + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 3000000)"
    moments = spark.sql(_MOMENTS.replace("{moment}", moment), orders=adapters.table(spark, sf_dir, "orders"))
    renamed = moments.withColumn("coin_id", F.col("wanted"))
    matched = as_of(
        renamed, gold, ["coin_id"], "moment", "seen_at",
        ["price_usd", "market_cap_usd", "price_per_coin"],
        ties=("market_cap_rank",), matched_time="seen_at",
    )
    return matched.drop("coin_id").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("moment", "seen_at")}
    )


@query(f"""
select coin_id, price_usd, volume_to_market_cap_ratio, trend_7d, market_cap_category,
  'silver/coins/' || strftime(ingestion_date, '%Y-%m-%d') || '/coins_' || strftime(ingestion_date, '%Y%m%d')
    || '_000000.parquet' as path,
  batch_day
from (
  select *, case when market_cap_rank % 2 = 0 then date '2024-02-01' else date '2024-02-02' end as batch_day
  from ({_GOLD_SQL})
) where batch_day = date '2024-02-02'""")
def catalog_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Functions of the lake by name in SQL: two days of a table, of which one is read."""
    lake, prefix = _new_lake(spark), _new_prefix()
    coins = adapters.coins(spark, sf_dir)
    for day in (1, 2):
        which = coins.where(f"market_cap_rank % 2 = {day - 1}")
        write_batch(lake, which, "coingecko", datetime(2024, 2, day), "coins")
    build_incremental(lake, select="silver.coingecko", run_date=RUN_DATE, skip_checks=True, prefix=prefix)
    database = f"{prefix}silver"
    create_functions(lake, database)
    create_day_function(lake, database, "coingecko")
    text = """
    select coin_id, price_usd, calculate_ratio_pct(volume_24h_usd, market_cap_usd) as volume_to_market_cap_ratio,
      trend_label(price_change_pct_7d) as trend_7d, cap_label(market_cap_usd) as market_cap_category,
      lake_path('coins', cast(ingestion_date as timestamp), layer => 'silver') as path, batch_day
    from coingecko_between(date'2024-02-02', date'2024-02-29')"""
    return run_sql(lake, database, text)


@query(f"""
select g.coin_id, g.trend_7d, s.coin_name, n_rows
from ({_GOLD_SQL}) g join ({_SILVER_COINS_SQL}) s on g.coin_id = s.coin_id
join (select id, count(*) as n_rows from ({_COINS}) group by id) on g.coin_id = id""")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in buckets of the coin, joined and counted without a shuffle."""
    lake, prefix = _new_lake(spark), _new_prefix()
    silver = _silver_coins(spark, sf_dir)
    names = [
        publish_bucketed(lake, frame, layer, name, ["coin_id"], 8, f"{prefix}{layer}")
        for frame, layer, name in (
            (silver, "silver", "coins"),
            (models.gold_crypto_prices(silver), "gold", "prices"),
        )
    ]
    coins, prices = map(spark.table, names)
    counts = coins.groupBy("coin_id").agg(F.count(F.lit(1)).alias("n_rows"))
    joined = prices.select("coin_id", "trend_7d").join(
        coins.select("coin_id", "coin_name").hint("merge"), "coin_id"
    )
    return joined.join(counts.hint("merge"), "coin_id")


@query("""
select 'coingecko' as model, 'failed' as outcome, count(*) as odd_rows, 0 as rows from part
where p_partkey % 47 = 0 and p_partkey % 53 <> 0
union all select 'defillama', 'built', 0, count(*) from supplier where s_suppkey % 29 <> 0
union all select 'yfinance', 'built', 0, count(*) from events
  where event_type is not null and ts is not null and event_id % 31 <> 0
union all select 'crypto_prices', 'skipped', 0, 0""")
def concurrent_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of models built side by side, one of which a check rejects."""
    lake, prefix = _bronze(spark, sf_dir, *contracts.SOURCES)
    outcomes = ConcurrentBuild(lake, run_date=RUN_DATE, prefix=prefix).run()
    rows = []
    for o in outcomes:
        table = f"`{prefix}{models.MODELS[o.model].layer}`.`{o.model}`"
        n = spark.table(table).count() if spark.catalog.tableExists(table) else 0
        odd = re.search(r"market_cap_usd not_null: (\d+)", o.reason or "")
        rows.append((o.model, o.outcome, int(odd[1]) if odd else 0, n))
    return spark.createDataFrame(rows, "model string, outcome string, odd_rows long, rows int")


@query(f"""
select event_id, ts, event_type, (
  select count(distinct {adapters.BATCH_DAY}) from events
  where ts between timestamp '2024-01-08' and timestamp '2024-01-14') as batches_read
from events where ts between timestamp '2024-01-08' and timestamp '2024-01-14'""")
def indexed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of times over an indexed source; files outside it are not read."""
    lake = _events_lake(spark, sf_dir)
    index = FileIndex(lake, "events")
    index.refresh()
    low, high = datetime(2024, 1, 8), datetime(2024, 1, 14)
    batches = index.files_between("ts", low, high).select("batch").distinct().count()
    found = index.scan("ts", low, high).select("event_id", "ts", "event_type")
    return found.withColumn("batches_read", F.lit(batches))


@query(f"""
with kept as (
  select * from events where {adapters.BATCH_DAY} = date '2024-01-10'
  union all
  select * from events where {adapters.BATCH_DAY} = date '2024-01-20' and event_id % 2 = 0
),
facts as (
  select count(*) as n, count(distinct {adapters.BATCH_DAY}) as days, min(event_id) as low,
    max(event_id) as high, count(*) - count(value) as nulls
  from kept
)
select 'rows' as fact, cast(n as varchar) as value from facts
union all select 'days', cast(days as varchar) from facts
union all select 'least event_id', cast(low as varchar) from facts
union all select 'greatest event_id', cast(high as varchar) from facts
union all select 'value is null', cast(nulls as varchar) from facts""")
def index_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of an indexed source, without its data, after a batch was replaced and another one deleted."""
    lake = _events_lake(spark, sf_dir)
    index = FileIndex(lake, "events")
    index.refresh()
    (_, _), (second, condition), (third, _) = adapters.BATCHES
    half = adapters.table(spark, sf_dir, "events").where(condition).where("event_id % 2 = 0")
    write_batch(lake, half, "events", second)
    delete_batch(lake, "events", third)
    index.refresh()
    ids = index.column_range("event_id").where("kind = 'number'")
    values = index.column_range("value").agg(F.sum("nulls").cast("string").alias("value"))

    def fact(name: str, frame: DataFrame, value: str) -> DataFrame:
        return frame.selectExpr(f"'{name}' as fact", f"{value} as value")

    return normalize.stack(
        [
            fact("rows", index.row_count(), "cast(n_rows as string)"),
            fact("days", index.days().agg(F.count(F.lit(1)).alias("n")), "cast(n as string)"),
            fact("least event_id", ids, "low"),
            fact("greatest event_id", ids, "high"),
            fact("value is null", values, "value"),
        ]
    )


@query("""
select 'silver' as layer, 'coingecko' as name, count(*) as n_rows from part where p_partkey % 53 <> 0
union all select 'silver', 'defillama', count(*) from supplier where s_suppkey % 29 <> 0
union all select 'silver', 'yfinance', count(*) from events where event_id % 31 <> 0
union all select 'gold', 'crypto_prices', count(*) from part where p_partkey % 53 <> 0""")
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = _built(spark, sf_dir)
    sizes = normalize.stack(
        [catalog.table_sizes(spark, f"{prefix}{layer}") for layer in ("silver", "gold")]
    )
    return sizes.select(F.substring_index("database", "_", -1).alias("layer"), "name", "n_rows")


@query("""
select 'bronze' as layer, cast(0 as bigint) as n_rows, true as located
union all
select 'silver', (select count(*) from part where p_partkey % 53 <> 0)
  + (select count(*) from supplier where s_suppkey % 29 <> 0)
  + (select count(*) from events where event_id % 31 <> 0), true
union all select 'gold', (select count(*) from part where p_partkey % 53 <> 0), true""")
def catalog_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Databases of a built lake, where they are stored, and the rows of their tables."""
    prefix = _built(spark, sf_dir)
    databases = catalog.list_databases(spark).where(F.col("database").startswith(prefix))
    sizes, located = [], F.lit(False)
    for layer in contracts.LAYERS:
        name = f"{prefix}{layer}"
        sizes.append(catalog.table_sizes(spark, name))
        found = (catalog.database_location(spark, name) or "").endswith(f"/{layer}")
        located = F.when(F.col("database") == name, F.lit(found)).otherwise(located)
    rows = normalize.stack(sizes).groupBy("database").agg(F.sum("n_rows").alias("n_rows"))
    return databases.join(rows, "database", "left").select(
        F.substring_index("database", "_", -1).alias("layer"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        located.alias("located"),
    )


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is published twice holds the second result only."""
    lake, prefix = _new_lake(spark), _new_prefix()
    orders = adapters.table(spark, sf_dir, "orders")
    publish_table(lake, orders, "silver", "orders", f"{prefix}silver")
    finished = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    publish_table(lake, finished, "silver", "orders", f"{prefix}silver", full_refresh=True)
    return catalog.table(spark, f"{prefix}silver", "orders")


@query("""
select event_type as source, event_id, 'error' as level from events where event_type = 'error'""")
def log_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_log(_logs(spark, sf_dir), level="ERROR").select("source", "event_id", "level")


@query("""
select event_type as source, event_id, 'info' as level from events where event_type = 'click'""")
def log_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = query_log(
        _logs(spark, sf_dir), pipeline_id="click_20240101_000000", source="click"
    )
    return logs.select("source", "event_id", "level")


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _new_lake(spark)
    level = F.when(F.col("event_type") == "error", "error").otherwise("info")
    lines = adapters.table(spark, sf_dir, "events").select(
        "event_id",
        level.alias("level"),
        F.col("event_type").alias("source"),
        F.concat("event_type", F.lit("_20240101_000000")).alias("pipeline_id"),
    )
    lines.write.json(lake.path("logs"))
    return spark.read.schema(lines.schema).json(lake.path("logs"))


# --- checks ----------------------------------------------------------------------------

@query(f"select id, market_cap_rank from ({_COINS}) where market_cap is null")
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    coins = adapters.coins(spark, sf_dir)
    (check,) = not_null("market_cap")
    return quality.failing_rows(coins, check).select("id", "market_cap_rank")


@query("""
select o_custkey as value, count(*) as n_records from orders
where o_custkey is not null group by o_custkey having count(*) > 1""")
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    (check,) = unique("o_custkey")
    return quality.failing_rows(adapters.table(spark, sf_dir, "orders"), check)


@query("""
select o_orderstatus as value, count(*) as n_records from orders
where o_orderstatus not in ('O', 'F') group by o_orderstatus""")
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = accepted_values("o_orderstatus", ("O", "F"))
    return quality.failing_rows(adapters.table(spark, sf_dir, "orders"), check)


@query("select p_partkey, p_size from part where p_size < 5 or p_size > 40")
def check_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = adapters.table(spark, sf_dir, "part")
    return quality.failing_rows(part, accepted_range("p_size", 5, 40)).select(
        "p_partkey", "p_size"
    )


# Spelled out, as the renames are.
_NOT_NULL = {
    "coingecko": "coin_id coin_symbol coin_name price_usd market_cap_usd market_cap_rank ingestion_date",
    "defillama": "protocol_id protocol_name protocol_slug ingestion_date",
    "yfinance": "symbol trade_date close_usd ingestion_date",
    "crypto_prices": "coin_id coin_symbol price_usd market_cap_rank trend_7d market_cap_category",
}
_LISTED = {
    "trend_7d": "'strong_uptrend', 'uptrend', 'sideways', 'downtrend', 'strong_downtrend'",
    "market_cap_category": "'large_cap', 'mid_cap', 'small_cap', 'micro_cap'",
}
_MODEL_SQL = {
    "coingecko": _SILVER_COINS_SQL,
    "defillama": _PROTOCOLS_SQL,
    "yfinance": _BARS_SQL,
    "crypto_prices": _GOLD_SQL,
}


def _suite_sql(*names: str) -> str:
    parts = []

    def add(model: str, column: str, check: str, failures: str) -> None:
        parts.append(
            f"select '{model}' as model, '{column}' as \"column\", '{check}' as \"check\", "
            f"({failures}) as failures"
        )

    for model in names:
        sql = _MODEL_SQL[model]
        for column in _NOT_NULL[model].split():
            add(model, column, "not_null", f"select count(*) from ({sql}) where {column} is null")
        if "coin_id" in _NOT_NULL[model]:
            repeated = f"select coin_id from ({sql}) group by 1 having count(*) > 1"
            add(model, "coin_id", "unique", f"select count(*) from ({repeated})")
        for column, listed in _LISTED.items() if model == "crypto_prices" else ():
            odd = f"select count(distinct {column}) from ({sql}) where {column} not in ({listed})"
            add(model, column, "accepted_values", odd)
    union = " union all ".join(parts)
    return f"select *, case when failures = 0 then 'pass' else 'fail' end as status from ({union})"


@query(_suite_sql("coingecko", "crypto_prices"))
def failed_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check rows of a build that its checks stop."""
    lake, prefix = _bronze(spark, sf_dir, "coingecko")
    try:
        build(lake, "+crypto_prices", run_date=RUN_DATE, prefix=prefix)
    except quality.CheckFailure as failure:
        return spark.createDataFrame(failure.results, quality.RESULT)
    raise AssertionError("coins without a market cap must fail a check")


@query(_suite_sql(*_MODEL_SQL))
def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver_coins(spark, sf_dir)
    tables = {
        "coingecko": silver,
        "crypto_prices": models.gold_crypto_prices(silver),
        "defillama": models.silver_defillama(adapters.protocols(spark, sf_dir), RUN_DATE),
        "yfinance": models.silver_yfinance(adapters.bars(spark, sf_dir), RUN_DATE),
    }
    return quality.run_checks(tables.__getitem__, contracts.CHECKS)


# --- profiling -------------------------------------------------------------------------


@query("select count(*) as n_rows from lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(adapters.table(spark, sf_dir, "lineitem"))


def _describe_sql(table: str, columns: list[str]) -> str:
    parts = [
        f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 4) as mean, "
        f"round(stddev_samp({c}), 4) as std, cast(min({c}) as double) as min, "
        f"round(quantile_cont(cast({c} as double), 0.25), 6) as p25, "
        f"round(quantile_cont(cast({c} as double), 0.5), 6) as p50, "
        f"round(quantile_cont(cast({c} as double), 0.75), 6) as p75, "
        f"cast(max({c}) as double) as max from {table}"
        for c in columns
    ]
    return " union all ".join(parts)


def _rounded(described: DataFrame) -> DataFrame:
    for name, digits in {"mean": 4, "std": 4, "p25": 6, "p50": 6, "p75": 6}.items():
        described = described.withColumn(name, F.round(name, digits))
    return described


@query(_describe_sql("part", ["p_partkey", "p_size", "p_retailprice"]))
def describe_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.describe(adapters.table(spark, sf_dir, "part")))


@query(_describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def describe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = adapters.table(spark, sf_dir, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _rounded(profile.describe(lineitem, columns))


@query("select * from part order by p_retailprice desc, p_partkey limit 10")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = adapters.table(spark, sf_dir, "part")
    return profile.first_rows(part, 10, [F.desc("p_retailprice"), "p_partkey"])


@query("""
select t.name, t.type, t.position, n.n_rows, 6 as n_columns, n.n_rows * 6 * 8 as rough_bytes
from (values ('event_id', 'bigint', 0), ('ts', 'timestamp_ntz', 1), ('user_id', 'bigint', 2),
  ('event_type', 'string', 3), ('value', 'double', 4), ('props', 'string', 5))
  t(name, type, position)
cross join (select count(*) as n_rows from events) n""")
def table_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overview(adapters.table(spark, sf_dir, "events"))


# --- SQL over views --------------------------------------------------------------------


@query("""
select event_type, count(*) as n, round(sum(value), 2) as total from events
group by event_type""")
def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    text = """select event_type, count(*) as n, round(sum(value), 2) as total from {view}
      group by event_type"""
    return query_source(lake, "events", text)


@query("select count(*) as n_rows from events")
def view_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _events_lake(spark, sf_dir)
    view, count = create_view(lake, "events", view_name=f"v{uuid.uuid4().hex}")
    spark.catalog.dropTempView(view)
    return count


def _drifting_lake(spark: SparkSession, sf_dir: str) -> tuple[Lake, str]:
    """Two batches of events that disagree, the second one also with itself."""
    lake = _new_lake(spark)
    events = adapters.table(spark, sf_dir, "events")
    first = events.where("user_id % 3 = 0").select("event_id", "value")
    first.write.parquet(lake.path("bronze", "drifting", "2024-01-01", "a.parquet"))
    batch = lake.path("bronze", "drifting", "2024-01-02", "b.parquet")
    plain = events.where("user_id % 3 = 1").selectExpr("event_id", "user_id as value")
    plain.write.parquet(batch)
    wide = events.where("user_id % 3 = 2").selectExpr("event_id", "user_id as value", "props")
    wide.write.mode("append").parquet(batch)
    return lake, batch


@query("""
select event_id, case when user_id % 3 = 0 then value else cast(user_id as double) end as value,
  case when user_id % 3 = 2 then props end as props
from events where user_id is not null""")
def view_over_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view without a contract has all columns of all files, wide enough for all values."""
    lake, _ = _drifting_lake(spark, sf_dir)
    return query_source(lake, "drifting", "select event_id, value, props from {view}")


@query("""
select event_id, user_id as value, case when user_id % 3 = 2 then props end as props
from events where user_id % 3 <> 0""")
def batch_with_mixed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, batch = _drifting_lake(spark, sf_dir)
    return lake.read_batch(batch).select("event_id", "value", "props")


@query("""
select 'lands' as name from nation union select 'regions' from region""")
def catalog_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, prefix = _new_lake(spark), _new_prefix()
    for source, name in (("nation", "lands"), ("region", "regions")):
        rows = adapters.table(spark, sf_dir, source)
        publish_table(lake, rows, "silver", name, f"{prefix}silver")
    return catalog.list_tables(spark, f"{prefix}silver").select("name")


# SQL that both engines run unchanged.
SHARED_SQL = {
    "sql_join": """
select o_orderkey, c_name, n_name from orders join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey""",
    "sql_anti_join": """
select doc_id from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "sql_group": """
select event_type, cast(ts as date) as d, count(*) as n, min(value) as lo, max(value) as hi,
  count(distinct user_id) as u
from events group by 1, 2""",
    "sql_rollup": """
select l_returnflag, l_linestatus, count(*) as n from lineitem
group by rollup(l_returnflag, l_linestatus)""",
    "sql_window": """
select event_id, row_number() over (partition by user_id order by ts, event_id) as rn,
  lag(value) over (partition by user_id order by ts, event_id) as pv
from events""",
    "sql_top_k": """
select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 10""",
    "sql_intersect": """
select l_partkey as k from lineitem intersect select p_partkey from part where p_size > 40""",
    "sql_functions": """
select p_partkey, upper(p_brand) as b, substr(p_name, 1, 5) as nm,
  round(p_retailprice, 1) as r, length(p_type) as l
from part""",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _over_views(text: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        parent, folder = os.path.split(sf_dir)
        lake = Lake(spark, parent)
        own, views = text, []
        for name in TABLES:
            word = rf"\b{name}\b"
            if re.search(word, text):
                views.append(f"{name}_{uuid.uuid4().hex}")
                create_view(lake, f"{name}.parquet", folder, view_name=views[-1])
                own = re.sub(word, views[-1], own)
        answer = spark.sql(own)
        # The analysed query holds the views' plans.
        for view in views:
            spark.catalog.dropTempView(view)
        return answer

    return run


for _name, _text in SHARED_SQL.items():
    _run = _over_views(_text)
    _run.__name__ = _name
    query(_text)(_run)

_json = _over_views(
    "select event_id, try_cast(get_json_object(props, '$.k') as bigint) as k from events"
)
_json.__name__ = "sql_json"
query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")(
    _json
)
