import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake import contracts
from marketlake.functions import (
    cap_label,
    conform,
    keys_first,
    lake_path,
    lake_path_column,
    model_location,
    nested_to_json,
    parse_lake_path,
    ratio,
    ratio_pct,
    trend_label,
)

WHEN = datetime(2025, 1, 17, 12, 30, 5)


def values(df):
    return [r[0] for r in df.collect()]


def test_ratio_is_null_safe(spark):
    pairs = [(1.0, 4.0), (1.0, 0.0), (1.0, -0.0), (None, 2.0), (1.0, None), (0.0, 2.0), (None, 0.0)]
    df = spark.createDataFrame(pairs, "n double, d double")
    assert values(df.select(ratio("n", "d"))) == [0.25, None, None, None, None, 0.0, None]
    assert values(df.select(ratio_pct("n", "d")))[0] == 25.0


def test_ratio_of_integers_divides_fully(spark):
    df = spark.createDataFrame([(1, 3)], "n bigint, d bigint")
    assert values(df.select(ratio("n", "d"))) == [pytest.approx(1 / 3)]


def test_trend_bounds_are_exclusive(spark):
    changes = [10.1, 10.0, 5.0, -5.0, -10.0, None, math.nan]
    df = spark.createDataFrame([(c,) for c in changes], "c double")
    assert values(df.select(trend_label(F.col("c")))) == [
        "strong_uptrend",
        "uptrend",
        "sideways",
        "downtrend",
        "strong_downtrend",
        "strong_downtrend",
        "strong_uptrend",
    ]


def test_cap_bounds_are_inclusive(spark):
    caps = [1e10, 1e10 - 1, 1e9, 1e8, 1e8 - 1, None]
    df = spark.createDataFrame([(c,) for c in caps], "c double")
    assert values(df.select(cap_label(F.col("c")))) == [
        "large_cap",
        "mid_cap",
        "mid_cap",
        "small_cap",
        "micro_cap",
        "micro_cap",
    ]


def test_labels_are_the_accepted_values():
    assert contracts.TRENDS == (
        "strong_uptrend", "uptrend", "sideways", "downtrend", "strong_downtrend",
    )
    assert contracts.CAPS == ("large_cap", "mid_cap", "small_cap", "micro_cap")


@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({"filename": "markets"}, "bronze/coingecko/2025-01-17/markets.parquet"),
        ({"filename": "markets.parquet"}, "bronze/coingecko/2025-01-17/markets.parquet"),
        ({}, "bronze/coingecko/2025-01-17/coingecko_20250117_123005.parquet"),
        (
            {"filename": "a.parquet", "fmt": "json", "layer": "gold"},
            "gold/coingecko/2025-01-17/a.parquet.json",
        ),
    ],
)
def test_lake_path(spark, options, expected):
    assert lake_path("coingecko", WHEN, **options) == expected
    name = F.lit(options.pop("filename", None)).cast("string")
    df = spark.createDataFrame([("coingecko", WHEN)], "s string, d timestamp")
    assert values(df.select(lake_path_column(F.col("s"), F.col("d"), name, **options))) == [expected]


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("bronze/coingecko/2025-01-17/markets.parquet", ("markets", "parquet")),
        ("/bronze/coingecko/2025-01-17/a.b.parquet/", ("a.b", "parquet")),
        ("bronze/coingecko/2025-01-17/markets", ("markets", "unknown")),
        ("bronze/coingecko/2025-01-17/.hidden", ("", "hidden")),
        ("bronze/coingecko/2025-01-17/run.parquet/part-0.parquet", ("run", "parquet")),
    ],
)
def test_parse_lake_path(spark, path, expected):
    df = spark.createDataFrame([(path,)], "p string").select(parse_lake_path(F.col("p")).alias("x"))
    row = df.first()["x"]
    assert (row["layer"], row["source"], row["date"]) == ("bronze", "coingecko", "2025-01-17")
    assert (row["filename"], row["format"], row["full_path"]) == (*expected, path)


def test_parse_lake_path_needs_four_parts(spark):
    df = spark.createDataFrame([("bronze/coingecko/x.parquet",)], "p string")
    with pytest.raises(Exception, match="Invalid lake path"):
        df.select(parse_lake_path(F.col("p"))).collect()


def test_model_location():
    expected = "s3a://b/silver/coingecko/coingecko.parquet"
    assert model_location("s3a://b/", "silver", "coingecko") == expected


def test_keys_first_keeps_the_rest_in_order(spark):
    df = spark.sql("select 1 as a, 2 as `Stock Splits`, 3 as Symbol, 4 as Date")
    assert keys_first(df, "Date", "Symbol").columns == ["Date", "Symbol", "a", "Stock Splits"]


def test_nested_to_json(spark):
    df = spark.sql(
        """select 'x' as id, array('a', 'b') as chains, map('k', 1) as tvls,
        named_struct('u', 1) as s, parse_json('[1700000001, "Start"]') as milestones,
        cast(null as array<int>) as none"""
    )
    row = nested_to_json(df).first()
    assert list(row) == ["x", '["a","b"]', '{"k":1}', '{"u":1}', '[1700000001,"Start"]', None]


def test_conform_converts_to_the_contract(spark):
    df = spark.sql(
        """select 5 as current_price, named_struct('E', 1, 'A', cast(null as int)) as chainTvls,
        '["x","y"]' as chains, 7 as extra"""
    )
    fields = {f.name: f for c in contracts.BRONZE.values() for f in c.fields}
    wanted = type(contracts.LANDED)([fields[n] for n in ("chainTvls", "chains", "current_price", "id")])
    row = conform(df, wanted).first()
    assert row.asDict() == {
        "chainTvls": {"E": 1.0}, "chains": ["x", "y"], "current_price": 5.0, "id": None,
    }


def test_conform_nanoseconds_round_down(spark):
    df = spark.createDataFrame([(1_500,), (-1,)], "at bigint")
    wanted = type(contracts.LANDED)([f for f in contracts.LANDED.fields if f.name == "fetched_at"])
    renamed = df.withColumnRenamed("at", "fetched_at")
    out = conform(renamed, wanted, frozenset({"fetched_at"}))
    assert values(out.select(F.unix_micros("fetched_at"))) == [1, -1]


def test_column_and_plain_paths_agree_and_parse_back(spark):
    rng = random.Random(11)
    letters = "ab.-_9"
    rows = []
    for _ in range(300):
        name = "".join(rng.choice(letters) for _ in range(rng.randint(1, 8)))
        at = datetime(2020, 1, 1) + timedelta(seconds=rng.randrange(200_000_000))
        rows.append((rng.choice(["fred", "dune"]), at, rng.choice([None, name, f"{name}.parquet"])))
    df = spark.createDataFrame(rows, "s string, d timestamp, n string")
    path = lake_path_column(F.col("s"), F.col("d"), F.col("n"))
    got = df.select(path.alias("path")).select("path", parse_lake_path(F.col("path")).alias("p"))
    for (source, at, name), row in zip(rows, got.collect(), strict=True):
        assert row["path"] == lake_path(source, at, name)
        stem = row["path"].split("/")[3].removesuffix(".parquet")
        assert tuple(row["p"])[:5] == ("bronze", source, f"{at:%Y-%m-%d}", stem, "parquet")
