"""Column-level record shaping: key columns first, nested values as JSON text, contract casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keys_first(df: DataFrame, *keys: str) -> DataFrame:
    """Move the key columns to the front; keep the order of the rest."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*(quoted(c) for c in (*keys, *rest)))


def tag(df: DataFrame, name: str, value: Column | str) -> DataFrame:
    """Add the request key to every record."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def json_text(name: str, kind: T.DataType) -> str:
    """SQL for the JSON text of a nested column; text stays as it is."""
    column = quoted(name)
    return f"to_json({column})" if isinstance(kind, NESTED) else f"cast({column} as string)"


def nested_to_json(df: DataFrame) -> DataFrame:
    """Replace every array, map, struct and variant column by its JSON text."""
    return df.selectExpr(
        *(
            f"to_json({quoted(f.name)}) as {quoted(f.name)}"
            if isinstance(f.dataType, NESTED)
            else quoted(f.name)
            for f in df.schema.fields
        )
    )


def as_json_text(contract: T.StructType) -> T.StructType:
    """The contract with its nested columns declared as JSON text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, NESTED) else f.dataType)
            for f in contract.fields
        ]
    )


def conform(
    df: DataFrame, contract: T.StructType, nanosecond_columns: frozenset[str] = frozenset()
) -> DataFrame:
    """Cast to the contract: missing columns become NULL, JSON text and nested values convert.

    ``nanosecond_columns`` names the timestamps that arrive as a count of nanoseconds.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(
        *(
            f"{_converted(f, found.get(f.name), f.name in nanosecond_columns)} as {quoted(f.name)}"
            for f in contract.fields
        )
    )


def _converted(field: T.StructField, found: T.DataType | None, nanos: bool) -> str:
    wanted, column = field.dataType, quoted(field.name)
    kind = wanted.simpleString()
    if found is None:
        return f"cast(null as {kind})"
    if nanos and isinstance(wanted, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        micros = f"({column} - pmod({column}, 1000)) div 1000"  # rounds down before 1970 too
        return f"cast(timestamp_micros({micros}) as {kind})"
    if found == wanted:
        return column
    nested = isinstance(found, NESTED)
    if isinstance(wanted, T.StringType) and nested:
        return f"to_json({column})"
    if isinstance(wanted, NESTED) and (nested or isinstance(found, T.StringType)):
        text = f"to_json({column})" if nested else column
        return f"from_json({text}, '{kind}')"
    return f"cast({column} as {kind})"
