import json

import pytest
from pyspark.sql import types as T

from marketlake import contracts
from marketlake.operators.normalize import (
    read_records,
    request_status,
    require_records,
    stack,
    to_table,
)
from marketlake.sources.landing import (
    RULES,
    decode,
    decode_query_result,
    read_landed,
    read_landed_documents,
    rejects,
)
from tests.conftest import plan

COINS = [
    {"id": "bitcoin", "symbol": "btc", "current_price": 50000, "market_cap": 1e12, "max_supply": None},
    {"id": "ethereum", "symbol": "eth", "current_price": 3000.5, "market_cap": 360000000000},
]
PROTOCOL = {"id": "1", "name": "Aave", "tvl": 1000000.0, "chains": ["A", "B"], "chainTvls": {"A": 1.5}}


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def reasons(df):
    return {r["request_key"]: r["reason"] for r in df.collect()}


# --- paged lists ---------------------------------------------------------------------


def test_pages_give_one_row_per_record(landed):
    pages = landed(
        "coingecko", ("1", 200, json.dumps(COINS)), ("2", 200, json.dumps([{"id": "dogecoin"}]))
    )
    records = decode(pages, "coingecko")
    assert records.schema == contracts.BRONZE_COINGECKO
    assert ids(records) == ["bitcoin", "dogecoin", "ethereum"]
    prices = {r["id"]: r["current_price"] for r in records.collect()}
    assert prices == {"bitcoin": 50000.0, "ethereum": 3000.5, "dogecoin": None}


def test_page_of_another_shape_is_skipped(landed):
    pages = landed(
        "coingecko", ("1", 200, json.dumps(COINS)), ("2", 200, '{"status": "busy"}'), ("3", 200, "[]")
    )
    assert ids(decode(pages, "coingecko")) == ["bitcoin", "ethereum"]
    assert reasons(rejects(pages, "coingecko")) == {"2": "ignored"}


@pytest.mark.parametrize("status, body", [(500, "oops"), (200, '[{"id":'), (200, None), (404, "[]")])
def test_failed_page_stops_the_run(landed, status, body):
    pages = landed("coingecko", ("1", 200, json.dumps(COINS)), ("2", status, body))
    with pytest.raises(Exception, match="coingecko: answer 2 is (failed|malformed)"):
        decode(pages, "coingecko").collect()


def test_rejects_are_reported_without_failing(landed):
    pages = landed(
        "coingecko",
        ("list", 200, json.dumps(COINS)),
        ("cut", 200, '[{"id":"x"},'),
        ("html", 200, "<html>"),
        ("down", 503, "[]"),
        ("gone", 200, None),
    )
    assert reasons(rejects(pages, "coingecko")) == {
        "cut": "malformed", "html": "malformed", "down": "failed", "gone": "failed",
    }
    envelopes = landed(
        "defillama",
        ("text", 200, '"text"'),
        ("cut", 200, '{"protocols":[{"id":"1"}'),
        ("odd", 200, '{"protocols":5}'),
        ("one", 200, '{"id":"1"}'),
    )
    assert reasons(rejects(envelopes, "defillama")) == {
        "text": "ignored", "cut": "malformed", "odd": "unexpected",
    }


def test_value_that_does_not_fit_stops_the_run(landed):
    pages = landed("coingecko", ("1", 200, '[{"id":"x","current_price":"n/a"}]'))
    with pytest.raises(Exception, match="coingecko: answer 1 is misfit"):
        decode(pages, "coingecko").collect()
    # Also where the column is not asked for, and the lists of answers say so too.
    with pytest.raises(Exception, match="misfit"):
        decode(pages, "coingecko").select("id").collect()
    assert reasons(rejects(pages, "coingecko")) == {"1": "misfit"}
    (status,) = request_status(pages, "coingecko").collect()
    assert tuple(status) == ("1", 1, 1, 0, "skipped")


@pytest.mark.parametrize("rank", ["1.7", "1.75", '"x"', "1e30", "true", "{}"])
def test_a_fraction_or_large_number_is_no_integer(landed, rank):
    pages = landed("coingecko", ("1", 200, f'[{{"id":"x","market_cap_rank":{rank}}}]'))
    assert reasons(rejects(pages, "coingecko")) == {"1": "misfit"}


def test_fields_outside_the_contract_are_kept(landed):
    body = '[{"id":"x","roi":{"times":2},"change_24h":-1.5,"note":null},{"id":"y"}]'
    kept = decode(landed("coingecko", ("1", 200, body)), "coingecko", rest="rest")
    assert kept.columns == [*contracts.BRONZE_COINGECKO.fieldNames(), "rest"]
    assert [r["rest"] for r in kept.collect()] == [
        {"roi": '{"times":2}', "change_24h": "-1.5", "note": None}, None,
    ]
    one = '{"id":"7","milestones":[[1,"start"]]}'
    (row,) = decode(landed("defillama", ("p", 200, one)), "defillama", rest="rest").collect()
    assert (row["id"], row["rest"]) == ("7", {"milestones": '[[1,"start"]]'})
    series = '{"observations":[{"date":"d","value":"1","since":"e"}]}'
    (row,) = decode(landed("fred", ("GDP", 200, series)), "fred", rest="rest").collect()
    assert tuple(row) == ("d", "1", "GDP", {"since": "e"})


def test_wider_contract_keeps_more_fields(landed):
    pages = landed("coingecko", ("1", 200, '[{"id":"x","roi":{"times":2},"rank":3.0}]'))
    wider = T.StructType().add("id", "string").add("roi", "string").add("rank", "long")
    assert decode(pages, "coingecko", wider).collect() == [("x", '{"times":2}', 3)]


def test_large_integers_are_exact(landed):
    big = 2**63 - 1
    pages = landed("coingecko", ("1", 200, json.dumps([{"id": "x", "market_cap_rank": big}])))
    assert decode(pages, "coingecko").first()["market_cap_rank"] == big
    bars = landed("yahoo_finance", ("A", 200, json.dumps([dict(bar("2025-01-01", 1), Volume=big)])))
    assert decode(bars, "yahoo_finance").first()["Volume"] == big


def test_bar_value_that_does_not_fit_skips_its_symbol(landed):
    frames = landed(
        "yahoo_finance",
        ("A", 200, json.dumps([bar("2025-01-01", "n/a")])),
        ("B", 200, json.dumps([bar("2025-01-01", 2)])),
    )
    assert ids(decode(frames, "yahoo_finance"), "Symbol") == ["B"]
    assert reasons(rejects(frames, "yahoo_finance")) == {"A": "misfit"}


def test_bar_without_a_date_leaves_the_others(landed):
    bars = [bar("2025-01-01", 2), dict(bar("2025-01-02", 3), Date=None), {"Close": 4}]
    kept = decode(landed("yahoo_finance", ("A", 200, json.dumps(bars))), "yahoo_finance")
    assert sorted((str(r["Date"])[:10], r["Close"]) for r in kept.collect()) == [
        ("2025-01-01", 2.0), ("None", 3.0), ("None", 4.0),
    ]


@pytest.mark.parametrize("body", ['"text"', "[]", '{"observations": null}', '{"observations": 5}'])
def test_series_of_another_shape_stop_the_run(landed, body):
    with pytest.raises(Exception, match="fred: answer GDP is unexpected"):
        decode(landed("fred", ("GDP", 200, body)), "fred").collect()


@pytest.mark.parametrize("body", ['{"result": null}', '{"result": {"rows": null}}', "[]"])
def test_results_of_another_shape_stop_the_run(landed, body):
    with pytest.raises(Exception, match="dune: answer 7 is unexpected"):
        decode(landed("dune", ("7", 200, body)), "dune").collect()


def test_each_body_is_parsed_once(landed, spark, tmp_path):
    landed("coingecko", ("1", 200, json.dumps(COINS))).write.parquet(str(tmp_path / "a"))
    for source in RULES:
        text = plan(decode(read_landed(spark, str(tmp_path / "a")), source))
        assert "Exchange" not in text and "Python" not in text
        # a list, an envelope and a single record are read by expressions of their own
        assert text.count("body#") and text.count("from_json(ArrayType") <= 3


def test_other_sources_are_left_alone(landed):
    both = stack(
        [
            landed("coingecko", ("1", 200, json.dumps(COINS))),
            landed("defillama", ("1", 500, None)),
        ]
    )
    assert decode(both, "coingecko").count() == 2


# --- envelopes -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "body, names",
    [
        (json.dumps([PROTOCOL, PROTOCOL]), ["Aave", "Aave"]),
        (json.dumps({"protocols": [PROTOCOL]}), ["Aave"]),
        (json.dumps({"protocols": []}), []),
        (json.dumps({"tvl": 1000000.0, "chain": "Ethereum"}), [None]),
        (json.dumps({"name": "other"}), ["other"]),
        ('"a text of its own"', []),
        ("12", []),
        ("null", []),
    ],
)
def test_envelope_shapes(landed, body, names):
    records = decode(landed("defillama", ("protocols", 200, body)), "defillama")
    assert [r["name"] for r in records.collect()] == names


def test_envelope_keeps_nested_values(landed):
    records = decode(landed("defillama", ("p", 200, json.dumps([PROTOCOL]))), "defillama")
    row = records.first()
    assert (row["chains"], row["chainTvls"]) == (["A", "B"], {"A": 1.5})


def test_envelope_without_a_list_inside_stops_the_run(landed):
    for body in ('{"protocols": 5}', '{"protocols": null}'):
        with pytest.raises(Exception, match="unexpected"):
            decode(landed("defillama", ("p", 200, body)), "defillama").collect()


# --- observations --------------------------------------------------------------------


def observations(*pairs):
    return json.dumps({"observations": [{"date": d, "value": v} for d, v in pairs]})


def test_observations_carry_their_series(landed):
    series = landed(
        "fred",
        ("GDP", 200, observations(("2025-01-01", "1.5"), ("2025-02-01", "."))),
        ("UNRATE", 200, observations(("2025-01-01", "4.1"))),
        ("NONE", 200, '{"count": 0}'),
        ("BROKEN", 200, "{"),
        ("DOWN", 503, "unavailable"),
    )
    rows = sorted(tuple(r) for r in decode(series, "fred").collect())
    assert rows == [
        ("2025-01-01", "1.5", "GDP"), ("2025-01-01", "4.1", "UNRATE"), ("2025-02-01", ".", "GDP"),
    ]
    assert reasons(rejects(series, "fred")) == {"BROKEN": "malformed", "DOWN": "failed"}


def test_all_series_empty_is_an_error(landed):
    series = landed("fred", ("GDP", 200, "{}"), ("UNRATE", 500, None))
    with pytest.raises(ValueError, match="No data extracted for any series"):
        require_records(decode(series, "fred"), "fred")


def test_request_status_covers_missing_keys(spark, landed):
    series = landed("fred", ("GDP", 200, observations(("d", "1"), ("e", "2"))), ("BAD", 200, "{"))
    keys = spark.createDataFrame([("GDP",), ("BAD",), ("UNASKED",)], "request_key string")
    rows = {r["request_key"]: tuple(r)[1:] for r in request_status(series, "fred", keys).collect()}
    assert rows == {
        "GDP": (1, 0, 2, "fetched"), "BAD": (1, 1, 0, "skipped"), "UNASKED": (0, 0, 0, "skipped"),
    }


# --- query results -------------------------------------------------------------------


def test_query_rows(spark, landed):
    results = landed(
        "dune",
        ("7", 200, '{"result": {"rows": [{"a": 1}, {"a": 2}]}}'),
        ("7", 200, '{"result": {}}'),
        ("7", 200, "{}"),
        ("8", 200, '{"result": {"rows": [{"a": 3}]}}'),
    )
    wanted = type(contracts.LANDED).fromJson(
        {"type": "struct", "fields": [{"name": "a", "type": "long", "nullable": True, "metadata": {}}]}
    )
    rows = decode_query_result(spark, results, 7, wanted).collect()
    assert sorted(r["a"] for r in rows) == [1, 2]
    untyped = decode_query_result(spark, results, 8)
    assert [json.loads(str(r["record"].toJson())) for r in untyped.collect()] == [{"a": 3}]


def test_no_query_id_is_an_empty_table(spark, landed):
    assert decode_query_result(spark, landed("dune"), None).count() == 0


# --- price bars ----------------------------------------------------------------------


def bar(day, close):
    return {"Date": f"{day} 00:00:00+00:00", "Open": 1, "Close": close, "Volume": 10, "Stock Splits": 0}


def test_bars_are_stacked_with_key_columns_first(landed):
    frames = landed(
        "yahoo_finance",
        ("AAPL", 200, json.dumps([bar("2025-01-01", 2.5), bar("2025-01-02", 3)])),
        ("MSFT", 200, json.dumps([bar("2025-01-01", 4)])),
        ("EMPTY", 200, "[]"),
        ("INTRADAY", 200, json.dumps([{"Datetime": "2025-01-01 10:00:00"}])),
        ("DOWN", 500, None),
    )
    bars = decode(frames, "yahoo_finance")
    assert bars.columns[:2] == ["Date", "Symbol"]
    assert sorted((r["Symbol"], r["Close"]) for r in bars.collect()) == [
        ("AAPL", 2.5), ("AAPL", 3.0), ("MSFT", 4.0),
    ]
    assert reasons(rejects(frames, "yahoo_finance")) == {"INTRADAY": "ignored", "DOWN": "failed"}


def test_all_symbols_empty_is_an_error(landed):
    with pytest.raises(ValueError, match="No data extracted for any symbol"):
        require_records(decode(landed("yahoo_finance", ("X", 200, "[]")), "yahoo_finance"), "yahoo_finance")


def test_unknown_source(landed):
    with pytest.raises(ValueError, match="Unknown source"):
        decode(landed("x"), "x")


# --- landed storage ------------------------------------------------------------------


def test_landed_table_and_documents(spark, landed, tmp_path):
    answers = landed("coingecko", ("1", 200, json.dumps(COINS)))
    answers.write.parquet(str(tmp_path / "answers"))
    assert decode(read_landed(spark, str(tmp_path / "answers")), "coingecko").count() == 2
    folder = tmp_path / "docs" / "2025-01-17"
    folder.mkdir(parents=True)
    (folder / "AAPL.json").write_text(json.dumps([bar("2025-01-01", 2.5)], indent=2))
    docs = read_landed_documents(spark, str(tmp_path / "docs"), "yahoo_finance")
    assert ids(decode(docs, "yahoo_finance"), "Symbol") == ["AAPL"]


# --- tables from records ---------------------------------------------------------------


def test_to_table(spark):
    df = spark.range(3)
    assert to_table(spark, df) is df
    assert to_table(spark, {"id": "test", "value": 123}).collect() == [("test", 123)]
    many = to_table(spark, [{"id": "a", "value": 1}, {"id": "b", "value": 2}])
    assert many.collect() == [("a", 1), ("b", 2)]
    assert to_table(spark, []).count() == 0
    for bad in ("text", 5, None):
        with pytest.raises(ValueError, match="Unsupported data type"):
            to_table(spark, bad)


def test_to_table_with_nested_values(spark):
    record = {
        "id": "1",
        "chains": ["Ethereum", "Base"],
        "milestones": [[1700000001, "Start"], [1700000002, "End"]],
    }
    row = to_table(spark, [record]).first()
    assert json.loads(row["milestones"]) == record["milestones"]
    assert json.loads(row["chains"]) == record["chains"]
    del record["milestones"]
    assert to_table(spark, [record]).first()["chains"] == record["chains"]


def test_read_records_takes_objects_and_arrays(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(COINS[0], indent=1))
    (tmp_path / "many.json").write_text(json.dumps(COINS, indent=1))
    records = read_records(spark, str(tmp_path), contracts.BRONZE_COINGECKO)
    assert ids(records) == ["bitcoin", "bitcoin", "ethereum"]


def test_stack_fills_missing_columns(spark):
    a, b = spark.sql("select 1 as x, 'a' as y"), spark.sql("select 'b' as y, 2.5D as z")
    assert stack([a, b]).collect() == [(1, "a", None), (None, "b", 2.5)]
