"""Reading models and tables by name, and listing what the catalog holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES").select(F.col("namespace").alias("database"))


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database; session views are left out."""
    shown = spark.sql(f"SHOW TABLES IN `{database}`").where("NOT isTemporary")
    return shown.select(F.col("namespace").alias("database"), F.col("tableName").alias("name"))


def database_location(spark: SparkSession, database: str) -> str | None:
    """Where a database is stored, or None if there is no such database."""
    if not spark.catalog.databaseExists(database):
        return None
    return spark.catalog.getDatabase(database).locationUri


def table_sizes(spark: SparkSession, database: str) -> DataFrame:
    """Row count of every table of a database; the names come from the catalog's own list."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    if not names:
        return spark.createDataFrame([], "database string, name string, n_rows bigint")
    counts = [
        table(spark, database, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(database).alias("database"), F.lit(name).alias("name"), "n_rows"
        )
        for name in sorted(names)
    ]
    return reduce(DataFrame.unionByName, counts)
