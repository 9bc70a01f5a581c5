"""Bronze whose files disagree on their schema, read as one table.

The footer of every file is read, on executors. Files whose schemas can be read together share
one native scan; a lake without drift is a single scan of its root. What reaches the driver is
metadata: a row per date folder and schema, a row per batch of mixed folders, and a row per file
of mixed batches. Footers are opened by pyarrow, so a scheme it cannot open fails with its name.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.paths import DAY_FOLDER, day_of
from marketlake.functions.records import conform
from marketlake.sources import files as storage
from marketlake.sources.lake import Lake, batch_of, finished_only

#: So many footers are read where the plan is made, without a job.
FEW_FILES = 32

FOOTERS = "path string, batch string, day_folder string, schema string, nanos string"

#: Where Spark notes its own schema in a footer.
SPARK_NOTE = b"org.apache.spark.sql.parquet.row.metadata"


@dataclass(frozen=True)
class Variant:
    """A schema that a set of files can be read with.

    ``nanos`` names the columns that hold a count of nanoseconds.
    """

    schema: T.StructType
    nanos: frozenset[str]

    def with_(self, other: Variant) -> Variant | None:
        shared = {f.name for f in self.schema} & {f.name for f in other.schema}
        if (self.nanos & shared) != (other.nanos & shared):
            return None
        merged = merge_types(self.schema, other.schema)
        return merged and Variant(merged, self.nanos | other.nanos)


def scan_any_schema(
    lake: Lake,
    source: str,
    contract: T.StructType | None = None,
    layer: str = "bronze",
    folders: list[str] | None = None,
    day_column: str | None = None,
    path_column: str | None = None,
) -> DataFrame:
    """All Parquet files of a source as one table; a column a file lacks is NULL.

    Rows are cast to the contract, or else to the union of all files' columns. ``folders``
    limits the scan to some day folders or batches; ``day_column`` adds the date of a row's folder, or
    ``path_column`` its file.
    """
    batch = batch_of(F.col("path"), layer, source)
    folder = F.regexp_extract("batch", f"^(.*/{layer}/{source}/{DAY_FOLDER})/[^/]+$", 1)
    roots = folders or [lake.path(layer, source)]
    listed = reduce(DataFrame.unionByName, (lake.list_folder(f) for f in roots))
    files = listed.select("path", batch.alias("batch")).withColumn("day_folder", folder)
    place = F.col("_metadata.file_path")
    if path_column:
        return _read(lake.spark, files, contract, roots, path_column, place, T.StringType())
    return _read(lake.spark, files, contract, roots, day_column, day_of(place, layer, source))


def read_any_schema(
    lake: Lake, path: str, contract: T.StructType | None = None
) -> DataFrame:
    """The files of one batch, which need not agree either."""
    files = lake.list_folder(path, whole=False).select(
        "path", F.lit(path).alias("batch"), F.lit("").alias("day_folder")
    )
    return _read(lake.spark, files, contract, [path], None, None)


def _read(
    spark: SparkSession,
    files: DataFrame,
    contract: T.StructType | None,
    roots: list[str],
    day_column: str | None,
    day,
    day_type: T.DataType = T.DateType(),
) -> DataFrame:
    names = contract and contract.fieldNames()
    few = storage.first_files(spark, roots, ".parquet", FEW_FILES + 1)
    footers = None
    if len(few) <= FEW_FILES:
        unfinished = set(storage.unfinished_folders(spark, roots))
        own = [f for f in few if f.rpartition("/")[0] not in unfinished]
        frame = pd.DataFrame({"path": own, "batch": own, "day_folder": own})
        found = [r for part in _footer_reader(names)(iter([frame])) for r in part.to_dict("records")]
    else:
        footers = file_schemas(files, names)
        found = footers.select("day_folder", "schema", "nanos").distinct().collect()
    if not found:
        if contract is None:
            raise ValueError(f"no files below {', '.join(roots)}")
        empty = spark.createDataFrame([], contract)
        return empty.withColumn(day_column, F.lit(None).cast(day_type)) if day_column else empty
    variants, owner = group_variants({(r["schema"], r["nanos"]) for r in found})
    wanted = contract or union_of([(r["schema"], r["nanos"]) for r in found])
    if day_column:
        wanted = T.StructType([*wanted.fields, T.StructField(day_column, day_type)])

    def part(index: int, paths: list[str]) -> DataFrame:
        variant = variants[index]
        reader = spark.read.schema(variant.schema)
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        rows = finished_only(reader.parquet(*paths), spark, roots)
        if day_column:
            rows = rows.select("*", day.alias(day_column))
        return conform(rows, wanted, variant.nanos)

    if len(variants) == 1:
        return part(0, roots)
    paths: dict[int, list[str]] = {i: [] for i in range(len(variants))}
    mixed = _place(found, "day_folder", owner, paths)
    if mixed and footers is not None:
        loose = footers.where(F.col("day_folder").isin(sorted(mixed)))
        by_batch = loose.select("batch", "schema", "nanos").distinct()
        odd = _place(by_batch.toLocalIterator(), "batch", owner, paths)
        if odd:
            single = loose.where(F.col("batch").isin(sorted(odd))).select("path", "schema", "nanos")
            _place(single.toLocalIterator(), "path", owner, paths)
    return reduce(DataFrame.unionByName, (part(i, own) for i, own in paths.items() if own))


def read_placed(
    lake: Lake,
    source: str,
    layer: str,
    placed: list,
    everything: list,
    contract: T.StructType | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """One table over files whose schemas are known: rows of path, schema and nanos.

    Without a contract it has the columns of ``everything``, rows of schema and nanos.
    """
    spark = lake.spark
    wanted = contract
    if wanted is None:
        if not everything:
            raise ValueError(f"no files of {layer}/{source} are indexed")
        wanted = union_of([(r["schema"], r["nanos"]) for r in everything])
    if day_column:
        wanted = T.StructType([*wanted.fields, T.StructField(day_column, T.DateType())])
    if not placed:
        return spark.createDataFrame([], wanted)
    variants, owner = group_variants({(r["schema"], r["nanos"]) for r in placed})
    paths: dict[int, list[str]] = {}
    for r in placed:
        paths.setdefault(owner[r["schema"], r["nanos"]], []).append(r["path"])
    day = day_of(F.col("_metadata.file_path"), layer, source) if day_column else None
    parts = []
    for index, own in sorted(paths.items()):
        rows = spark.read.schema(variants[index].schema).parquet(*sorted(own))
        if day_column:
            rows = rows.select("*", day.alias(day_column))
        parts.append(conform(rows, wanted, variants[index].nanos))
    return reduce(DataFrame.unionByName, parts)


def _place(rows, column: str, owner: dict, paths: dict[int, list[str]]) -> set[str]:
    """Give each place to the one variant it has; the places that have several are returned."""
    used: dict[str, set[int]] = {}
    for r in rows:
        used.setdefault(r[column], set()).add(owner[r["schema"], r["nanos"]])
    mixed = set()
    for place, indexes in used.items():
        if place and len(indexes) == 1:
            paths[min(indexes)].append(place)
        else:
            mixed.add(place)
    return mixed


def file_schemas(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Schema of each of the files (path, batch, day_folder), cut to the wanted columns.

    A batch outside date folders has the empty text as its folder.
    """
    # a fixed number of partitions: the rows are few and short, but each costs a file access
    parallel = files.sparkSession.sparkContext.defaultParallelism
    spread = files.select("path", "batch", "day_folder").repartition(parallel, "path")
    return spread.mapInPandas(_footer_reader(columns), FOOTERS)


def describe_footer(path: str, columns: list[str] | None = None):
    """A file's schema as JSON, its nanosecond columns as JSON, and what else its footer says."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_type

    def without_nulls(kind: pa.DataType) -> pa.DataType:
        if pa.types.is_null(kind):
            return pa.int32()
        if pa.types.is_list(kind) or pa.types.is_large_list(kind):
            return pa.list_(without_nulls(kind.value_type))
        if pa.types.is_struct(kind):
            return pa.struct([(f.name, without_nulls(f.type)) for f in kind])
        return kind

    try:
        system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"footers cannot be opened at {path}: {error}") from error
    with system.open_input_file(inner) as handle:
        footer = pq.ParquetFile(handle)
        found, stored, metadata = footer.schema_arrow, footer.schema, footer.metadata
        leaves = [stored.column(i) for i in range(len(stored))]
        noted = json.loads((metadata.metadata or {}).get(SPARK_NOTE, b'{"fields": []}'))
    # a variant looks like a struct of two binaries to others
    variants = {f["name"] for f in noted["fields"] if f["type"] == "variant"}
    # the old 96-bit timestamps look like nanoseconds, but Spark reads them itself
    old_style = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
    fields, nanos = [], []
    for name in found.names if columns is None else sorted(set(found.names) & set(columns)):
        kind = found.field(name).type
        if pa.types.is_null(kind):
            continue
        if name in variants:
            fields.append(T.StructField(name, T.VariantType()))
            continue
        if name in old_style:
            kind = pa.timestamp("us", tz="UTC")
        elif pa.types.is_timestamp(kind) and kind.unit == "ns":
            nanos.append([name, kind.tz is not None])
            kind = pa.int64()
        spark_type = from_arrow_type(without_nulls(kind), prefer_timestamp_ntz=True)
        fields.append(T.StructField(name, spark_type))
    return T.StructType(fields).json(), json.dumps(nanos), metadata


def _footer_reader(columns: list[str] | None):
    def read(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            described = [describe_footer(path, columns) for path in chunk["path"]]
            yield pd.DataFrame(
                {
                    "path": chunk["path"],
                    "batch": chunk["batch"],
                    "day_folder": chunk["day_folder"],
                    "schema": [d[0] for d in described],
                    "nanos": [d[1] for d in described],
                }
            )

    return read


def group_variants(
    distinct: Iterable[tuple[str, str]],
) -> tuple[list[Variant], dict[tuple[str, str], int]]:
    """Merge schemas that can share a scan; tell which merged one each schema went to."""
    variants: list[Variant] = []
    owner: dict[tuple[str, str], int] = {}
    for schema, nanos in sorted(distinct):
        new = Variant(T.StructType.fromJson(json.loads(schema)), frozenset(n for n, _ in json.loads(nanos)))
        for index, known in enumerate(variants):
            merged = known.with_(new)
            if merged is not None:
                variants[index] = merged
                owner[schema, nanos] = index
                break
        else:
            owner[schema, nanos] = len(variants)
            variants.append(new)
    return variants, owner


def union_of(distinct: list[tuple[str, str]]) -> T.StructType:
    """All columns of all schemas, each with a type that holds every file's values.

    The widest schema gives the order; columns it lacks follow by name. A count of nanoseconds
    is a timestamp. Numbers widen to numbers, dates to timestamps; what has nothing in common,
    as an array and its JSON text, becomes text.
    """
    kinds: dict[str, T.DataType] = {}
    schemas = []
    for schema, nanos in sorted(set(distinct)):
        parsed = T.StructType.fromJson(json.loads(schema))
        schemas.append(parsed)
        zoned = dict(json.loads(nanos))
        for field in parsed.fields:
            kind = field.dataType
            if field.name in zoned:
                kind = T.TimestampType() if zoned[field.name] else T.TimestampNTZType()
            kinds[field.name] = wider(kinds.get(field.name, kind), kind)
    first = max(schemas, key=lambda x: (len(x.fields), x.json())).fieldNames()
    order = [*first, *sorted(kinds.keys() - set(first))]
    return T.StructType([T.StructField(name, kinds[name]) for name in order])


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """A type that holds the values of both."""
    merged = merge_types(left, right)
    if merged is not None:
        return merged
    for order in (_WHOLE, _TIMES):
        if isinstance(left, order) and isinstance(right, order):
            return max((left, right), key=lambda kind: order.index(type(kind)))
    numbers = (T.NumericType,)
    if isinstance(left, numbers) and isinstance(right, numbers):
        decimals = [k for k in (left, right) if isinstance(k, T.DecimalType)]
        whole = [k for k in (left, right) if isinstance(k, _WHOLE)]
        if decimals and (whole or len(decimals) == 2):
            digits = max(19 if isinstance(k, _WHOLE) else k.precision - k.scale for k in (left, right))
            scale = max(k.scale for k in decimals)
            return T.DecimalType(min(38, digits + scale), scale)
        return T.DoubleType()
    return T.StringType()


def merge_types(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """A type that reads both; structs are joined field by field, other types must be equal."""
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        fields = {f.name: f.dataType for f in left.fields}
        for f in right.fields:
            merged = merge_types(fields.get(f.name, f.dataType), f.dataType)
            if merged is None:
                return None
            fields[f.name] = merged
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        element = merge_types(left.elementType, right.elementType)
        return element and T.ArrayType(element)
    return left if left == right else None
