"""Landed API answers as typed records.

An answer is one row: source, request key, status, body. Each source has a rule that says where
its records are, and what happens to answers that failed or look different. A body is parsed
once, into the text of each field of the contract, and each text is cast once; only if the fields
that the contract does not name are to be kept, a second pass finds them. Nothing is shuffled. An
answer with a value that does not fit its column is a misfit, for whichever columns are selected:
``answers``, ``rejects`` and ``decode`` agree on it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import contracts
from marketlake.functions.records import NESTED

# What became of an answer.
FAILED, MALFORMED, UNEXPECTED, IGNORED = "failed", "malformed", "unexpected", "ignored"
MISFIT, EMPTY, RECORDS = "misfit", "empty", "records"
REJECTED = (FAILED, MALFORMED, UNEXPECTED, IGNORED, MISFIT)

# All fields of a record by name, as text.
FIELDS = T.MapType(T.StringType(), T.StringType())
# The column for fields that a contract does not name.
REST = "other_fields"

# Set by the JSON reader when a body does not fit the schema.
_BAD = "_bad"
# Wide enough for every 64-bit integer, also when it is written as 1.0.
_WHOLE = T.DecimalType(38, 18)


@dataclass(frozen=True)
class Parsed:
    """Columns of one answer: its records, NULL if it has none, and why it has none."""

    records: Column
    trouble: Column


@dataclass(frozen=True)
class Rule:
    """How one source's answers are read.

    ``find`` gives the records from the columns ``listed`` (a body that is a list) and
    ``keyed`` (a body that is an object, read with ``fields``). ``stops`` lists the outcomes
    that fail the whole run; the others skip the answer. ``needed`` names the request keys in
    the error raised when no answer holds any record.
    """

    find: Callable[[T.DataType], Parsed]
    stops: tuple[str, ...]
    fields: Callable[[T.DataType], list[T.StructField]] | None = None
    needed: str | None = None
    key_column: str | None = None
    contract: T.StructType | None = None


# --- where the records are ---------------------------------------------------------------


def _starts_with(bracket: str) -> Column:
    return F.left(F.ltrim("body", F.lit(" \n\r\t")), F.lit(1)) == bracket


def _no_json() -> Column:
    return F.try_parse_json("body").isNull()


def _has_key(text: Column | str, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))


def _none_of(element: T.DataType) -> Column:
    return F.array().cast(T.ArrayType(element))


def _sound() -> Column:
    return F.col("keyed").isNotNull() & F.col(f"keyed.{_BAD}").isNull()


def _inside(path: str) -> Column:
    return F.when(_sound(), F.col(f"keyed.{path}"))


def _pages(element: T.DataType) -> Parsed:
    broken = _starts_with("[") | _no_json()
    return Parsed(F.col("listed"), F.when(broken, MALFORMED).otherwise(IGNORED))


def _envelope_fields(element: T.DataType) -> list[T.StructField]:
    return [T.StructField("protocols", T.ArrayType(element))]


def _envelopes(element: T.DataType) -> Parsed:
    """A list, an object with a list inside, or an object that is itself the record."""
    itself = F.array(F.from_json("body", element))
    single = F.when(_sound() & ~_has_key("body", "protocols"), itself)
    trouble = (
        F.when(_starts_with("[") | _no_json(), MALFORMED)
        .when(_starts_with("{"), UNEXPECTED)
        .otherwise(IGNORED)
    )
    return Parsed(F.coalesce("listed", _inside("protocols"), single), trouble)


def _observation_fields(element: T.DataType) -> list[T.StructField]:
    return [T.StructField("observations", T.ArrayType(element))]


def _observations(element: T.DataType) -> Parsed:
    absent = F.when(_sound() & ~_has_key("body", "observations"), _none_of(element))
    trouble = F.when(_no_json(), MALFORMED).otherwise(UNEXPECTED)
    return Parsed(F.coalesce(_inside("observations"), absent), trouble)


def _result_fields(element: T.DataType) -> list[T.StructField]:
    rows = T.StructType([T.StructField("rows", T.ArrayType(element))])
    return [T.StructField("result", rows)]


def _result_rows(element: T.DataType) -> Parsed:
    result = F.get_json_object("body", "$.result")
    rowless = F.json_object_keys(result).isNotNull() & ~_has_key(result, "rows")
    no_rows = ~_has_key("body", "result") | rowless
    absent = F.when(_sound() & no_rows, _none_of(element))
    trouble = F.when(_no_json(), MALFORMED).otherwise(UNEXPECTED)
    return Parsed(F.coalesce(_inside("result.rows"), absent), trouble)


def _bars(element: T.DataType) -> Parsed:
    """A list of bars; without any date field it is no such list. A single empty date stays.

    Names of fields without a value are looked for only if no bar has a date.
    """
    dated = F.exists(
        F.from_json("body", T.ArrayType(FIELDS)), lambda bar: F.map_contains_key(bar, F.lit("Date"))
    )
    if isinstance(element, T.StructType) and "Date" in element.fieldNames():
        dated = F.exists("listed", lambda bar: bar["Date"].isNotNull()) | dated
    trouble = F.when(_no_json(), MALFORMED).otherwise(IGNORED)
    return Parsed(F.when(dated | (F.size("listed") == 0), F.col("listed")), trouble)


_ANY_ERROR = (FAILED, MALFORMED, UNEXPECTED, MISFIT)

RULES: dict[str, Rule] = {
    # pages: a list of records; another shape is skipped, a failed page stops the run
    "coingecko": Rule(_pages, _ANY_ERROR, contract=contracts.BRONZE_COINGECKO),
    # a list, an envelope around one, or a single record
    "defillama": Rule(
        _envelopes, _ANY_ERROR, _envelope_fields, contract=contracts.BRONZE_DEFILLAMA
    ),
    # one answer per series; failed series are skipped, all empty is an error
    "fred": Rule(
        _observations,
        (UNEXPECTED,),
        _observation_fields,
        needed="series",
        key_column="series_id",
        contract=contracts.BRONZE_FRED,
    ),
    # rows of a saved query; the caller knows their schema
    "dune": Rule(_result_rows, _ANY_ERROR, _result_fields),
    # one list of price bars per symbol; failed symbols are skipped, all empty is an error
    "yahoo_finance": Rule(
        _bars,
        (),
        needed="symbol",
        key_column="Symbol",
        contract=contracts.BRONZE_YAHOO_FINANCE,
    ),
}


def rule_of(source: str) -> Rule:
    if source not in RULES:
        raise ValueError(f"Unknown source: {source}. Use one of {', '.join(RULES)}")
    return RULES[source]


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed answers stored as a table."""
    return spark.read.schema(contracts.LANDED).format(fmt).load(path)


def read_landed_documents(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Landed answers stored as one JSON document per file; the file name is the request key."""
    docs = spark.read.option("wholetext", True).option("recursiveFileLookup", True)
    docs = docs.option("pathGlobFilter", "*.json").format("text").load(path)
    return docs.select(
        F.lit(source).alias("source"),
        F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("request_key"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.col("value").alias("body"),
    )


def answers(
    landed: DataFrame, source: str, contract: T.StructType | None = None, rest: str | None = None
) -> DataFrame:
    """Each answer of a source with its ``outcome`` and its ``records``; nothing is raised.

    With a contract a record has its fields as ``text`` and ``typed``, and the others under the
    name ``rest``, if one is given.
    """
    rule = rule_of(source)
    contract = contract or rule.contract
    own = [] if contract is None else [f for f in contract.fields if f.name != rule.key_column]
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in own])
    element = T.VariantType() if contract is None else texts
    usable = F.col("body").isNotNull() & (F.coalesce("status", F.lit(200)) < 400)
    read = landed.where(F.col("source") == source).select(
        "request_key", "fetched_at", "body", usable.alias("usable"), *_shapes(rule, element, usable)
    )
    parsed = rule.find(element)
    outcome = (
        F.when(~F.col("usable"), FAILED)
        .when(F.col("records").isNull(), F.col("trouble"))
        .when(F.size("records") == 0, EMPTY)
    )
    read = read.withColumns({"records": parsed.records, "trouble": parsed.trouble})
    if contract is not None:
        if rest:
            found = F.col("records").isNotNull()
            shapes = {c: expression for c, expression in _named_shapes(rule, FIELDS, found)}
            read = read.withColumns(shapes)
            maps = F.coalesce(rule.find(FIELDS).records, _none_of(FIELDS))
            names = [f.name for f in own]
            pairs = F.zip_with(
                "records", maps, lambda r, m: _typed(r, own, _others(m, names).alias(rest))
            )
        else:
            pairs = F.transform("records", lambda r: _typed(r, own))
        read = read.withColumn("records", pairs)
        outcome = outcome.when(F.exists("records", lambda r: _unfit(r, own)), MISFIT)
    outcome = outcome.otherwise(RECORDS)
    return read.select("request_key", "fetched_at", outcome.alias("outcome"), "records")


def _named_shapes(rule: Rule, element: T.DataType, usable: Column) -> list[tuple[str, Column]]:
    """A body as a list and, if the rule asks for it, as an object."""
    as_list = F.from_json("body", T.ArrayType(element))
    shapes = [("listed", F.when(usable & _starts_with("["), as_list))]
    if rule.fields:
        schema = T.StructType([*rule.fields(element), T.StructField(_BAD, T.StringType())])
        as_object = F.from_json("body", schema, {"columnNameOfCorruptRecord": _BAD})
        shapes.append(("keyed", F.when(usable & _starts_with("{"), as_object)))
    return shapes


def _shapes(rule: Rule, element: T.DataType, usable: Column) -> list[Column]:
    return [shape.alias(name) for name, shape in _named_shapes(rule, element, usable)]


def _typed(record: Column, fields: list[T.StructField], *more: Column) -> Column:
    """The record's texts beside what they are as the columns' types."""
    typed = F.struct(*(_cast(record[f.name], f.dataType).alias(f.name) for f in fields))
    return F.struct(record.alias("text"), typed.alias("typed"), *more)


def _others(fields: Column, named: list[str]) -> Column:
    others = F.map_filter(fields, lambda name, _: ~name.isin(named))
    return F.when(F.size(others) > 0, others)


def _unfit(record: Column, fields: list[T.StructField]) -> Column:
    """Whether the record is no object, or a field has a value that its column cannot hold."""
    text, typed = record["text"], record["typed"]
    found = text.isNull()
    for field in fields:
        if not isinstance(field.dataType, T.StringType):
            found = found | (text[field.name].isNotNull() & typed[field.name].isNull())
    return found


def _cast(text: Column, kind: T.DataType) -> Column:
    """The text of a JSON value as a column's type; NULL if it does not fit."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, NESTED):
        return F.from_json(text, kind)
    if isinstance(kind, T.IntegralType):
        number = text.try_cast(_WHOLE)
        return F.when(number == F.floor(number), number.try_cast(kind))
    return text.try_cast(kind)


def decode(
    landed: DataFrame,
    source: str,
    contract: T.StructType | None = None,
    counted: Observation | None = None,
    rest: str | None = None,
    day_column: str | None = None,
    skip: bool = False,
) -> DataFrame:
    """Records of a source, with the columns of its contract.

    ``rest`` names a column for all other fields of a record, as a map from name to text; it is
    NULL where there are none. ``day_column`` adds the date on which an answer was fetched. For a
    source without a contract the record is one variant column, ``record``. A stopping answer fails
    the job that evaluates the result, unless rejected answers are to be skipped. ``counted`` learns
    the number of ``answers`` and of ``rejected`` ones from the first job that evaluates the result.
    """
    rule = rule_of(source)
    contract = contract or rule.contract
    read = answers(landed, source, contract, rest)
    if counted is not None:
        rejected = F.count_if(F.col("outcome").isin(*REJECTED))
        read = read.observe(
            counted, F.count(F.lit(1)).alias("answers"), rejected.alias("rejected")
        )
    usable = F.when(F.col("outcome") == RECORDS, F.col("records"))
    if rule.stops and not skip:
        problem = F.concat_ws(
            " ", F.lit(f"{source}: answer"), F.col("request_key"), F.lit("is"), F.col("outcome")
        )
        stop = F.raise_error(problem).cast(read.schema["records"].dataType)
        usable = F.when(F.col("outcome").isin(*rule.stops), stop).otherwise(usable)
    days = [F.to_date("fetched_at").alias(day_column)] if day_column else []
    rows = read.select("request_key", *days, F.explode(usable).alias("record"))
    days = [day_column] if day_column else []
    if contract is None:
        return rows.select("record", *days)
    columns = [
        F.col("request_key").cast(f.dataType).alias(f.name)
        if f.name == rule.key_column
        else F.col("record.typed")[f.name].alias(f.name)
        for f in contract.fields
    ]
    if rest:
        columns.append(F.col("record")[rest].alias(rest))
    return rows.select(*columns, *days)


def decode_query_result(
    spark: SparkSession,
    landed: DataFrame,
    query_id: str | int | None,
    contract: T.StructType | None = None,
) -> DataFrame:
    """Rows of one saved query; no query id means an empty table."""
    if not query_id:
        empty = contract or T.StructType([T.StructField("record", T.VariantType())])
        return spark.createDataFrame([], empty)
    return decode(landed.where(F.col("request_key") == str(query_id)), "dune", contract)


def rejects(landed: DataFrame, source: str) -> DataFrame:
    """Answers that gave no rows although they were no empty list."""
    read = answers(landed, source).where(F.col("outcome").isin(*REJECTED))
    return read.select(
        F.lit(source).alias("source"), "request_key", "fetched_at", F.col("outcome").alias("reason")
    )


