"""State as of a moment against a plain search, hot keys, ties and odd rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators import asof
from marketlake.operators.asof import as_of, newest_per_key, state_at

START = datetime(2025, 1, 1)


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def frames(spark, rows, values):
    left = spark.createDataFrame([(i, k, at(t)) for i, (k, t) in enumerate(rows)], "n int, key string, moment timestamp")
    right = spark.createDataFrame(
        [(k, at(t), v) for k, t, v in values], "key string, seen timestamp, value int"
    )
    return left.repartition(5), right.repartition(3)


def searched(rows, values):
    out = []
    for i, (k, t) in enumerate(rows):
        fit = [(u, v) for key, u, v in values if None not in (k, t, u) and key == k and u <= t]
        out.append((i, max(fit)[1] if fit else None))
    return out


def matched(spark, rows, values, **options):
    left, right = frames(spark, rows, values)
    got = as_of(left, right, ["key"], "moment", "seen", ["value"], ties=("value",), **options)
    assert got.columns[:4] == ["n", "key", "moment", "value"]
    return sorted((r["n"], r["value"]) for r in got.collect())


@pytest.mark.parametrize("buckets", [1, 3, 40, None])
def test_matches_are_those_of_a_search(spark, buckets):
    rng = random.Random(buckets)
    times = [None, *range(60)]
    rows = [(rng.choice(["hot", "hot", "a", "b", "none", None]), rng.choice(times)) for _ in range(400)]
    values = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice(times), rng.randint(0, 9)) for _ in range(300)]
    values = [(k, t, v) for k, t, v in values if k != "b" or (t is not None and t > 30)]
    assert matched(spark, rows, values, buckets=buckets) == searched(rows, values)


def test_values_far_before_their_rows_are_carried_over_empty_buckets(spark):
    rows = [("a", 1000), ("a", 5000), ("b", 5000), ("a", 0)]
    values = [("a", 1, 7), ("b", 4999, 8), ("c", 2, 9)]
    assert matched(spark, rows, values, buckets=100) == [(0, 7), (1, 7), (2, 8), (3, None)]


def test_one_time_empty_tables_and_the_time_of_the_match(spark):
    rows, values = [("a", 5), ("a", None), (None, 5)], [("a", 5, 1), ("a", 5, 3), ("a", 5, 2)]
    assert matched(spark, rows, values) == [(0, 3), (1, None), (2, None)]
    assert matched(spark, rows, []) == [(0, None), (1, None), (2, None)]
    assert matched(spark, [], values) == []
    left, right = frames(spark, [("a", 9)], [("a", 4, 1)])
    (row,) = as_of(left, right, ["key"], "moment", "seen", ["value"], matched_time="since").collect()
    assert row["since"] == at(4)
    with pytest.raises(ValueError, match="both tables have key"):
        as_of(left, right, ["key"], "moment", "seen", ["key"])


def test_a_hot_key_is_dealt_out_by_time(spark):
    """Half of all rows have one key; the largest group is a small part of them."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
        # Most of them within a short time.
        F.timestamp_seconds(F.when(F.col("id") % 10 == 0, F.col("id") * 50).otherwise(F.col("id"))).alias("_at"),
    )
    groups = rows.withColumn("bucket", asof._bucket(rows.select("_at"), 200)).groupBy("key", "bucket").count()
    most = groups.agg(F.max("count")).first()[0]
    assert most < 40_000 / 50
    values = rows.select("key", F.col("_at").alias("seen"), F.col("_at").cast("long").alias("v"))
    got = as_of(rows.withColumnRenamed("_at", "t"), values, ["key"], "t", "seen", ["v"], buckets=200)
    assert got.where("v <=> cast(t as long)").count() == 40_000
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in text.split("hashpartitioning(")[1].split(")")[0]


def test_newest_rows_are_combined_before_the_shuffle(spark):
    rows = [("a", at(1), 1, None), ("a", at(3), 2, "x"), ("a", at(3), 1, "y"), ("b", None, 5, "z"), (None, at(2), 6, "n")]
    df = spark.createDataFrame(rows, "key string, seen timestamp, value int, note string")
    newest = newest_per_key(df, ["key"], "seen", ("value",))
    assert newest.columns == df.columns
    got = {r["key"]: (r["value"], r["note"]) for r in newest.collect()}
    assert got == {"a": (2, "x"), "b": (5, "z"), None: (6, "n")}
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in text
    then = {r["key"]: r["value"] for r in state_at(df, ["key"], "seen", F.lit(at(2))).collect()}
    assert then == {"a": 1, None: 6}
