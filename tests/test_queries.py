"""Every registered query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from workload.registry import ENTRIES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(file)[:-8]} as select * from '{file}'")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat().replace("T00:00:00", "")
    return value.item() if hasattr(value, "item") else value


def rows(frame):
    ordered = frame[sorted(frame.columns)]
    return sorted(
        (tuple(map(plain, r)) for r in ordered.itertuples(index=False, name=None)), key=repr
    )


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_matches_its_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    want = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.toPandas()) == rows(want)


def test_entry(spark):
    flagship = entry_points.entry(spark)
    assert len(flagship.columns) == 25 and flagship.count() > 0


@pytest.mark.parametrize("name", ["sql_join", "sql_json", "view_row_count"])
def test_queries_leave_no_view(spark, name):
    def views():
        return {t.name for t in spark.catalog.listTables() if t.isTemporary}

    before = views()
    answer = ENTRIES[name].run(spark, SF_DIR)
    assert views() == before and answer.count() > 0
