"""The test tables in the shape of the lake's sources.

SQL texts run unchanged in Spark and in the checking engine: table names are placeholders.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.contracts import BRONZE_COINGECKO
from marketlake.functions import conform
from marketlake.operators.normalize import stack
from marketlake.sinks.batches import write_batch
from marketlake.sources.lake import Lake

COINS = """
select case when p_partkey % 53 = 0 then null
       else concat('coin-', cast(p_partkey as varchar(20))) end as id, lower(p_brand) as symbol,
  p_name as name, p_retailprice as current_price,
  case when p_partkey % 47 = 0 then null when p_size % 4 = 0 then p_retailprice * 1e8
       when p_size % 4 = 1 then p_retailprice * 2e6 when p_size % 4 = 2 then p_retailprice * 2e5
       else p_retailprice * 1e3 end as market_cap,
  p_partkey as market_cap_rank, p_retailprice * p_size * 1000e0 as total_volume,
  p_retailprice * 1.05e0 as high_24h, p_retailprice * 0.95e0 as low_24h,
  case when p_size % 7 = 0 then 0e0 when p_size % 11 = 0 then null
       else p_size * 1e6 end as circulating_supply,
  case when p_size % 5 = 0 then null when p_size % 13 = 0 then 0e0
       else p_size * 2e6 end as total_supply,
  case when p_partkey % 43 = 0 then null
       else (p_partkey % 41 - 20) * 1e0 end as price_change_percentage_7d_in_currency,
  p_retailprice * 2e0 as ath, p_retailprice * 0.5e0 as atl,
  case when p_partkey % 10 = 0 then '2024-01-01T00:00:00.000Z'
       else '2024-01-02T00:00:00.000Z' end as last_updated,
  concat('https://img.example/', cast(p_partkey as varchar(20))) as image,
  p_size * 3e6 as max_supply, p_size * -1e0 as ath_change_percentage,
  concat('ath-', cast(p_size as varchar(20))) as ath_date,
  p_size * 10e0 as atl_change_percentage, concat('atl-', cast(p_size as varchar(20))) as atl_date,
  p_size * 0.25e0 as price_change_percentage_14d_in_currency,
  p_size * 0.5e0 as price_change_percentage_30d_in_currency,
  p_size * 4e0 as price_change_percentage_200d_in_currency,
  p_size * 8e0 as price_change_percentage_1y_in_currency
from {part}
"""

#: More fields of a market record; the last two are in no contract.
PAGE_FIELDS = {
    "name": "concat('name-', event_id)",
    "image": "concat('img-', event_id)",
    "ath_date": "concat('ath-', event_id)",
    "atl_date": "concat('atl-', event_id)",
    "last_updated": "concat('at-', event_id)",
    "total_volume": "user_id + 1",
    "high_24h": "value + 2e0",
    "low_24h": "value + 3e0",
    "circulating_supply": "value + 4e0",
    "total_supply": "value + 5e0",
    "max_supply": "value + 6e0",
    "ath": "value + 7e0",
    "ath_change_percentage": "value + 8e0",
    "atl": "value + 9e0",
    "atl_change_percentage": "value + 10e0",
    "price_change_percentage_7d_in_currency": "value + 11e0",
    "price_change_percentage_14d_in_currency": "value + 12e0",
    "price_change_percentage_30d_in_currency": "value + 13e0",
    "price_change_percentage_200d_in_currency": "value + 14e0",
    "price_change_percentage_1y_in_currency": "value + 15e0",
    "properties": "props",
    "number": "event_id",
}

PAGE_BITS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin market records from ``part``; some have no id."""
    known = spark.sql(COINS, part=table(spark, sf_dir, "part"))
    return conform(known, BRONZE_COINGECKO)


def protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protocol records from ``supplier``, with a chain list and a value per chain."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.selectExpr(
        "if(s_suppkey % 29 = 0, null, cast(s_suppkey as string)) as id",
        "s_name as name",
        "lower(s_name) as slug",
        "upper(substr(n_name, 1, 3)) as symbol",
        "r_name as category",
        "n_name as chain",
        "s_acctbal as tvl",
        "s_acctbal * 2e0 as mcap",
        "s_nationkey * 0.5e0 as change_1h",
        "s_nationkey * 1e0 as change_1d",
        "s_nationkey * 7e0 as change_7d",
        "concat('https://p.example/', s_suppkey) as url",
        "concat('https://l.example/', s_suppkey) as logo",
        "concat('gecko-', s_suppkey) as gecko_id",
        "s_suppkey as listedAt",
        "array(n_name, r_name) as chains",
        "map(n_name, n_nationkey, r_name, r_regionkey) as chainTvls",
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price bars from ``events``."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts as `Date`",
        "if(event_id % 31 = 0, null, event_type) as Symbol",
        "value + 0.5e0 as Open",
        "value + 1e0 as High",
        "value - 1e0 as Low",
        "value as Close",
        "user_id as Volume",
        "event_id % 3 * 0.25e0 as Dividends",
        "event_id % 5 * 1e0 as `Stock Splits`",
    )


# --- landed answers -------------------------------------------------------------------


def _landed(bodies: DataFrame, source: str) -> DataFrame:
    return bodies.select(
        F.lit(source).alias("source"),
        F.col("request_key").cast("string"),
        F.lit(datetime(2024, 2, 1)).alias("fetched_at"),
        F.lit(200).alias("status"),
        "body",
    )


def _pages(records: DataFrame, *keys: str) -> DataFrame:
    """JSON arrays of at most 256 records.

    Rows are numbered per scan partition, so no page grows with the data or with one key.
    """
    numbered = records.withColumn("page", F.shiftright(F.monotonically_increasing_id(), PAGE_BITS))
    grouped = numbered.groupBy(*keys, "page")
    joined = F.array_join(F.collect_list("json"), ",")
    return grouped.agg(F.concat(F.lit("["), joined, F.lit("]")).alias("list"))


def _wrap(before: str, after: str) -> Column:
    return F.concat(F.lit(before), F.col("list"), F.lit(after)).alias("body")


def _event_records(events: DataFrame) -> DataFrame:
    record = F.to_json(
        F.struct(
            F.concat(F.lit("ev-"), "event_id").alias("id"),
            F.col("event_type").alias("symbol"),
            F.col("value").alias("current_price"),
            F.col("user_id").alias("market_cap"),
            F.col("event_id").alias("market_cap_rank"),
            *(F.expr(text).alias(name) for name, text in PAGE_FIELDS.items()),
        )
    )
    return events.select(record.alias("json"))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market pages from ``events``, and answers of another shape from ``nation``."""
    pages = _pages(_event_records(table(spark, sf_dir, "events"))).select(
        F.col("page").alias("request_key"), F.col("list").alias("body")
    )
    return stack([_landed(pages, "coingecko"), _landed(_odd_answers(spark, sf_dir), "coingecko")])


def write_event_array(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """All events as market records in one JSON array in one file, a record a line."""
    records = _event_records(table(spark, sf_dir, "events")).select(
        F.monotonically_increasing_id().alias("place"), "json"
    )
    ends = spark.createDataFrame([(-1, "["), (2**62, "]")], "place long, json string")
    # The file is what is tested; rows pass through the one task that writes it, none is held there.
    whole = records.unionByName(ends).repartition(1).sortWithinPartitions("place")
    # Lines are counted where they are written: the first part of a scan may have no record.
    numbered = whole.withColumn("line", F.monotonically_increasing_id())
    comma = F.when((F.col("line") < 2) | (F.col("place") == 2**62), "").otherwise(",")
    numbered.select(F.concat(comma, "json")).write.text(folder)


def landed_lot(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """Market pages of one of the three batches of ``events``, fetched on the batch's day."""
    day, condition = BATCHES[number]
    pages = _pages(_event_records(table(spark, sf_dir, "events").where(condition)))
    pages = pages.select(F.col("page").alias("request_key"), F.col("list").alias("body"))
    return _landed(pages, "coingecko").withColumn("fetched_at", F.lit(day))


def _odd_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.to_json(F.struct(F.col("n_name").alias("message")))
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("request_key"), message.alias("body")
    )


def landed_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price bars from ``region`` whose close is no number."""
    bar = F.struct(F.lit("2024-01-01").alias("Date"), F.col("r_name").alias("Close"))
    rows = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("request_key"), F.to_json(F.array(bar)).alias("body")
    )
    return _landed(rows, "yahoo_finance")


def landed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market pages from ``nation`` that the server did not give."""
    return _odd_answers(spark, sf_dir).select(
        F.lit("coingecko").alias("source"),
        "request_key",
        F.lit(datetime(2024, 2, 1)).alias("fetched_at"),
        F.lit(503).alias("status"),
        "body",
    )


def landed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protocol lists, envelopes and single records from ``supplier``; bare texts from ``nation``."""
    record = F.to_json(
        F.struct(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("tvl"),
            F.array("s_name").alias("chains"),
            F.create_map("s_name", "s_nationkey").alias("chainTvls"),
        )
    )
    kind = (
        F.when(F.col("s_nationkey") < 10, "list")
        .when(F.col("s_nationkey") < 20, "envelope")
        .otherwise("single")
    )
    records = table(spark, sf_dir, "supplier").select(
        "s_suppkey", kind.alias("kind"), record.alias("json")
    )
    paged = _pages(records.where("kind <> 'single'"), "kind")
    listed = paged.where("kind = 'list'").select(
        F.concat(F.lit("list-"), "page").alias("request_key"), F.col("list").alias("body")
    )
    wrapped = paged.where("kind = 'envelope'").select(
        F.concat(F.lit("envelope-"), "page").alias("request_key"), _wrap('{"protocols":', "}")
    )
    single = records.where("kind = 'single'").select(
        F.concat(F.lit("single-"), "s_suppkey").alias("request_key"), F.col("json").alias("body")
    )
    bare = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("request_key"),
        F.concat(F.lit('"'), "n_name", F.lit('"')).alias("body"),
    )
    return stack([_landed(d, "defillama") for d in (listed, wrapped, single, bare)])


def landed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations per event type from ``events``; broken and empty answers from ``nation``."""
    record = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.col("user_id").cast("string").alias("value"),
        )
    )
    records = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("request_key"), record.alias("json")
    )
    good = _pages(records, "request_key").select(
        "request_key", _wrap('{"observations":', "}")
    )
    odd = F.when(F.col("n_nationkey") < 10, '{"observations":[').otherwise('{"count":0}')
    rest = table(spark, sf_dir, "nation").select(F.col("n_name").alias("request_key"), odd.alias("body"))
    return stack([_landed(good, "fred"), _landed(rest, "fred")])


def landed_query_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of query 7 from ``events``; answers without rows from ``region``."""
    record = F.to_json(F.struct(F.col("event_id").alias("a"), F.col("value").alias("b")))
    records = table(spark, sf_dir, "events").select(record.alias("json"))
    good = _pages(records).select(
        F.lit("7").alias("request_key"), _wrap('{"result":{"rows":', "}}")
    )
    empty = table(spark, sf_dir, "region").select(
        F.lit("7").alias("request_key"),
        F.when(F.col("r_regionkey") < 2, "{}").otherwise('{"result":{}}').alias("body"),
    )
    return stack([_landed(good, "dune"), _landed(empty, "dune")])


def landed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price bars per symbol from ``events``; symbols without data from ``nation``."""
    numbered = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("request_key"),
        F.to_json(
            F.struct(
                F.col("ts").cast("string").alias("Date"),
                F.col("value").alias("Open"),
                (F.col("value") + 1).alias("High"),
                (F.col("value") - 1).alias("Low"),
                F.col("value").alias("Close"),
                F.col("user_id").alias("Volume"),
                F.lit(0).alias("Dividends"),
                F.lit(0).alias("Stock Splits"),
            )
        ).alias("json"),
    )
    good = _pages(numbered, "request_key").select(
        "request_key", F.col("list").alias("body")
    )
    none = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("request_key"), F.lit("[]").alias("body")
    )
    return stack([_landed(good, "yahoo_finance"), _landed(none, "yahoo_finance")])


# --- bronze batches --------------------------------------------------------------------

# three batches that together hold all events
BATCHES = (
    (datetime(2024, 1, 10), "ts < timestamp_ntz'2024-01-11'"),
    (datetime(2024, 1, 20), "ts >= timestamp_ntz'2024-01-11' and ts < timestamp_ntz'2024-01-21'"),
    (datetime(2024, 1, 31), "ts >= timestamp_ntz'2024-01-21' or ts is null"),
)
BATCH_DAY = """case when ts < timestamp '2024-01-11' then date '2024-01-10'
  when ts < timestamp '2024-01-21' then date '2024-01-20' else date '2024-01-31' end"""


def write_events(lake: Lake, sf_dir: str, fmt: str = "parquet") -> None:
    events = table(lake.spark, sf_dir, "events")
    for date, condition in BATCHES:
        write_batch(lake, events.where(condition), "events", date, fmt=fmt)
