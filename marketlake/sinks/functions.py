"""Functions of the lake in the catalog, so that SQL texts can use them by name.

They are SQL functions: their bodies are put into the plan of the query that calls them, so nothing
is called per row, filters reach the scan, and only the needed columns are read. Those of tables take
the days to read. A table function has no database before its name in SQL, so texts that use one
are run with the database of the function as the current one (``run_sql``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketlake.contracts import CAP_ELSE, CAP_FROM, TREND_ABOVE, TREND_ELSE
from marketlake.functions.paths import DAY, STAMP
from marketlake.functions.records import quoted
from marketlake.sources.lake import Lake


def _case(cases: list[tuple[float, str]], column: str, sign: str, default: str) -> str:
    branches = " ".join(f"when {column} {sign} {bound!r}D then '{label}'" for bound, label in cases)
    return f"case {branches} else '{default}' end"


def scalar_functions() -> dict[str, str]:
    """Parameters, type and body of each function, by name."""
    stem = f"coalesce(filename, concat(source, '_', date_format(at, '{STAMP[1]}')))"
    entry = f"concat(regexp_replace({stem}, concat('\\\\.', format, '$'), ''), '.', format)"
    ratio = "(numerator double, denominator double) returns double return try_divide(numerator, denominator)"
    return {
        "calculate_ratio": ratio,
        "calculate_ratio_pct": f"{ratio} * 100",
        "trend_label": "(change_pct double) returns string return "
        + _case(TREND_ABOVE, "change_pct", ">", TREND_ELSE),
        "cap_label": "(market_cap double) returns string return "
        + _case(CAP_FROM, "market_cap", ">=", CAP_ELSE),
        "lake_path": "(source string, at timestamp, filename string default null, "
        "format string default 'parquet', layer string default 'bronze') returns string return "
        f"concat(layer, '/', source, '/', date_format(at, '{DAY[1]}'), '/', {entry})",
        "model_location": "(root string, layer string, name string) returns string return "
        "concat(rtrim('/', root), '/', layer, '/', name, '/', name, '.parquet')",
    }


def create_functions(lake: Lake, database: str) -> list[str]:
    """Create the scalar functions in a database; returns their names."""
    made = scalar_functions()
    for name, definition in made.items():
        lake.spark.sql(f"CREATE OR REPLACE FUNCTION `{database}`.`{name}`{definition}")
    return list(made)


def create_day_function(lake: Lake, database: str, table: str, day_column: str = "batch_day") -> str:
    """Create ``{table}_between(first_day, last_day)``, the rows of these days; returns its name."""
    fields = lake.spark.table(f"`{database}`.`{table}`").schema.fields
    listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    names = ", ".join(quoted(f.name) for f in fields)
    name = f"{table}_between"
    lake.spark.sql(
        f"CREATE OR REPLACE FUNCTION `{database}`.`{name}`(first_day date, last_day date) "
        f"RETURNS TABLE ({listed}) RETURN SELECT {names} FROM `{database}`.`{table}` "
        f"WHERE {quoted(day_column)} BETWEEN first_day AND last_day"
    )
    return name


def run_sql(lake: Lake, database: str, text: str) -> DataFrame:
    """A SQL text with a database as the current one, whose functions need no prefix."""
    catalog = lake.spark.catalog
    before = catalog.currentDatabase()
    catalog.setCurrentDatabase(database)
    try:
        return lake.spark.sql(text)
    finally:
        catalog.setCurrentDatabase(before)
