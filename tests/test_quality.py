from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlake import contracts
from marketlake.contracts import Check, accepted_range, accepted_values, not_null, unique
from marketlake.operators import quality
from marketlake.plans.models import gold_crypto_prices, silver_coingecko
from tests.conftest import plan
from workload import adapters


@pytest.fixture
def df(spark):
    rows = [("a", 1.0, "x"), ("a", None, "y"), ("b", 20.0, None), (None, -5.0, "z"), (None, 7.0, "z")]
    return spark.createDataFrame(rows, "k string, v double, `my label` string")


def failures(df, *checks):
    rows = quality.check_model(df, "m", checks).collect()
    assert [(r["model"], r["column"], r["check"]) for r in rows] != []
    return {(r["column"], r["check"]): (r["failures"], r["status"]) for r in rows}


def test_each_check(df):
    got = failures(
        df,
        *not_null("k", "v"),
        *unique("k"),
        accepted_values("my label", ("x", "y")),
        accepted_range("v", 0, 10),
        accepted_range("v", low=-10),
    )
    assert got[("k", "not_null")] == (2, "fail")
    assert got[("v", "not_null")] == (1, "fail")
    assert got[("k", "unique")] == (1, "fail")  # NULL keys do not count
    assert got[("my label", "accepted_values")] == (1, "fail")  # NULL passes


def test_ranges_include_their_bounds_and_pass_null(df):
    assert failures(df, accepted_range("v", 0, 10)) == {("v", "accepted_range"): (2, "fail")}
    assert failures(df, accepted_range("v", -5, 20)) == {("v", "accepted_range"): (0, "pass")}
    assert failures(df, accepted_range("v", high=7)) == {("v", "accepted_range"): (1, "fail")}


def test_failing_rows(df):
    assert quality.failing_rows(df, not_null("v")[0]).collect() == [("a", None, "y")]
    assert quality.failing_rows(df, unique("k")[0]).collect() == [("a", 2)]
    odd = quality.failing_rows(df, accepted_values("my label", ("x", "y")))
    assert odd.collect() == [("z", 2)]
    out = quality.failing_rows(df, accepted_range("v", 0, 10))
    assert sorted(r["v"] for r in out.collect()) == [-5.0, 20.0]
    with pytest.raises(ValueError, match="Unknown check"):
        quality.failing_rows(df, Check("k", "other"))


def test_declared_checks():
    kinds = [c.kind for checks in contracts.CHECKS.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 21, "unique": 2, "accepted_values": 2,
    }


def test_two_snapshots_fail_the_unique_check(spark, sf_dir):
    silver = silver_coingecko(adapters.coins(spark, sf_dir), date(2025, 1, 1))
    twice = gold_crypto_prices(silver.unionAll(silver))
    got = failures(twice, *contracts.CHECKS["crypto_prices"])
    assert got[("coin_id", "unique")] == (silver.count(), "fail")
    assert got[("trend_7d", "accepted_values")] == (0, "pass")


def test_selection_skipping_and_failing(df):
    checks = {"good": not_null("my label")[:0] + unique("v"), "bad": not_null("k")}
    read = {"good": df, "bad": df}.__getitem__
    assert quality.run_checks(read, checks, skip=True) is None
    good = quality.run_checks(read, checks, select=["good"])
    assert [r["status"] for r in quality.require_pass(good)] == ["pass"]
    with pytest.raises(quality.CheckFailure, match=r"1 of 2 checks failed: bad.k not_null: 2"):
        quality.require_pass(quality.run_checks(read, checks))
    with pytest.raises(ValueError, match="no model"):
        quality.run_checks(read, checks, select=["other"])


def test_plans(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("label")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    rows = plan(quality.check_model(stored, "m", not_null("id", "label")))
    assert rows.count("FileScan") == 1 and "hashpartitioning" not in rows
    values = plan(quality.check_model(stored, "m", [accepted_values("label", ("x",))]))
    assert "Not(EqualTo(label,x))" in values or "Not(In(label" in values
    keys = plan(quality.check_model(stored, "m", unique("id")))
    assert keys.count("hashpartitioning") == 1 and "partial_count" in keys
