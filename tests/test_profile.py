import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import profile

LABELS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def described(df, *columns, **options):
    rows = profile.describe(df, list(columns) or None, **options).collect()
    return {r["column"]: [r[x] for x in LABELS] for r in rows}


def expected(values):
    return list(pd.Series(values, dtype="float64").describe())


def same(got, want):
    return all(
        (a is None and (b is None or math.isnan(b))) or a == pytest.approx(b, rel=1e-12)
        for a, b in zip(got, want, strict=True)
    )


def shapes():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(3000)],
        "heavy": [10 ** rng.uniform(-150, 150) for _ in range(3000)],
        "hot": [5.0] * 2500 + [rng.random() * 10 for _ in range(500)],
        "two": [1.0] * 1500 + [2.0] * 1500,
        "signed": [rng.gauss(0, 1e-9) for _ in range(2999)] + [1e12],
    }


@pytest.mark.parametrize("limit", [100_000, 40])
def test_describe_is_exact(spark, monkeypatch, limit):
    """With a low limit, ranks are found by narrowing buckets; the results stay the same."""
    monkeypatch.setattr(profile, "SORT_LIMIT", limit)
    monkeypatch.setattr(profile, "BUCKETS", 500 if limit < 100 else 10_000)
    data = shapes()
    rows = list(zip(*data.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in data)).repartition(5)
    for name, got in described(df).items():
        want = expected(data[name])
        assert got[3:] == want[3:] or same(got[3:], want[3:]), name
        assert got[0] == want[0]
        assert got[1] == pytest.approx(want[1], rel=1e-9)


def test_describe_ignores_missing_values(spark):
    values = [1.0, None, math.nan, 3.0, 2.0]
    df = spark.createDataFrame([(v, "t", i) for i, v in enumerate(values)], "v double, s string, i int")
    got = described(df)
    assert list(got) == ["v", "i"]
    assert same(got["v"], expected([1.0, 3.0, 2.0]))
    assert same(got["i"], expected([0, 1, 2, 3, 4]))


def test_describe_small_and_odd_columns(spark):
    df = spark.sql("select 1 as one, cast(null as double) as none, 2.5 as `a b`")
    got = described(df)
    assert got["one"][:1] + got["one"][3:] == [1, 1.0, 1.0, 1.0, 1.0, 1.0] and got["one"][2] is None
    assert got["none"] == [0] + [None] * 7
    assert got["a b"][5] == 2.5
    with pytest.raises(ValueError, match="no numeric column"):
        profile.describe(spark.sql("select 'x' as s"))


def test_few_passes_are_enough(spark, monkeypatch):
    """Values over 300 decades, zeros and both signs: two looks find every rank."""
    monkeypatch.setattr(profile, "SORT_LIMIT", 20)
    passes = []
    count = profile._count_buckets
    monkeypatch.setattr(
        profile, "_count_buckets", lambda *a: passes.append(len(a[1])) or count(*a)
    )
    rng = random.Random(3)
    values = [0.0] * 50 + [rng.choice((-1, 1)) * 10 ** rng.uniform(-150, 150) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    assert described(df)["v"][4:7] == list(pd.Series(values).quantile([0.25, 0.5, 0.75]))
    assert len(passes) <= 2


def test_infinite_values(spark, monkeypatch):
    monkeypatch.setattr(profile, "SORT_LIMIT", 3)
    values = [-math.inf, *map(float, range(20)), math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert described(df)["v"][3:] == [-math.inf, 4.25, 9.5, 14.75, math.inf]


def test_approximate_describe(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    got = described(df, approximate=True)["v"]
    assert got[0] == 1001 and got[4:7] == [250.0, 500.0, 750.0]


def test_counts_rows_types_sizes(spark, lake):
    df = spark.sql("select id, cast(id as string) as `s t` from range(12)")
    assert profile.row_count(df).collect() == [(12,)]
    assert profile.first_rows(df).count() == 10
    assert [r["id"] for r in profile.first_rows(df, 2, [F.desc("id")]).collect()] == [11, 10]
    assert profile.column_types(df).collect() == [("id", "bigint", 0), ("s t", "string", 1)]
    assert profile.rough_size(df).collect() == [(12, 2, 192)]
    assert profile.overview(df).collect() == [
        ("id", "bigint", 0, 12, 2, 192), ("s t", "string", 1, 12, 2, 192),
    ]
    df.write.parquet(lake.path("bronze", "x"))
    size = profile.exact_size(lake.list_files("bronze", "x")).first()
    assert size["bytes"] > 0 and size["n_files"] >= 1
    assert profile.exact_size(lake.list_files("bronze", "y")).collect() == [(0, 0)]


def test_many_columns_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(profile, "LISTS_PER_TASK", 4)
    rng = random.Random(1)
    data = {f"c{k}": [rng.gauss(k, 3) for _ in range(60)] for k in range(12)}
    got = described(spark.createDataFrame(pd.DataFrame(data)))
    assert all(same(got[name], expected(values)) for name, values in data.items())
