"""Views over a source's files, and any SQL on them."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.operators.profile import first_rows, row_count
from marketlake.sources.drift import scan_any_schema
from marketlake.sources.lake import Lake

log = logging.getLogger(__name__)

#: Rows shown where no query is given.
SHOWN = 10
#: Where a text has the source's rows.
ROWS = "{view}"


def create_view(
    lake: Lake,
    source: str,
    layer: str = "bronze",
    view_name: str | None = None,
    contract: T.StructType | None = None,
) -> tuple[str, DataFrame]:
    """Register ``{source}_{layer}`` over all files of a source; gives its name and row count.

    Files may disagree on their schema: the view has the columns of all of them, or those of
    the contract. The count is a query of its own and runs when the caller reads it.
    """
    name = view_name or f"{source}_{layer}"
    table = scan_any_schema(lake, source, contract, layer)
    table.createOrReplaceTempView(name)
    return name, row_count(table)


def query_source(
    lake: Lake,
    source: str,
    query: str | None = None,
    layer: str = "bronze",
    contract: T.StructType | None = None,
) -> DataFrame:
    """Run SQL over a source, whose rows stand where the text has ``{view}`` or its view's name.

    A text without the former gets a view of that name, which is dropped, with a warning, if the
    analysed query reads no such thing. Other braces of the text stay. No query shows the first rows.
    """
    rows = scan_any_schema(lake, source, contract, layer)
    if query is None:
        return first_rows(rows, SHOWN)
    if ROWS in query:
        literal = query.replace("{", "{{").replace("}", "}}").replace(f"{{{ROWS}}}", ROWS)
        return lake.spark.sql(literal, view=rows)
    name = f"{source}_{layer}"
    rows.createOrReplaceTempView(name)
    answer = lake.spark.sql(query)
    if f"SubqueryAlias {name}\n" not in answer._jdf.queryExecution().analyzed().toString():
        lake.spark.catalog.dropTempView(name)
        log.warning("query does not use the view %s: %s", name, query)
    return answer
