"""Catalog verbs: databases, views, external tables, listings, SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A possibly qualified name as a SQL identifier."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_catalog(
    spark: SparkSession, name: str, implementation: str, options: dict[str, str] | None = None
) -> None:
    """Make a catalog plugin of the deployment known under ``name``; it loads on first use."""
    spark.conf.set(f"spark.sql.catalog.{name}", implementation)
    for option, value in (options or {}).items():
        spark.conf.set(f"spark.sql.catalog.{name}.{option}", value)


def use_catalog(spark: SparkSession, name: str = "spark_catalog") -> None:
    spark.catalog.setCurrentCatalog(name)


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is absent and make it current."""
    create_database(spark, name, location)
    spark.catalog.setCurrentDatabase(name)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = "" if location is None else f" LOCATION {text_literal(location)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Name and kind of the tables and views of a database."""
    tables = spark.catalog.listTables(database)
    rows = [(t.name, t.tableType, t.isTemporary) for t in tables]
    return spark.createDataFrame(rows, "name string, kind string, temporary boolean")


def external_table(
    spark: SparkSession, name: str, location: str, schema: T.StructType | None = None
) -> bool:
    """Map Parquet files to a table unless it exists; True if it was created.

    Without a schema the files' own is used. Partition folders are found on reading.
    """
    if spark.catalog.tableExists(name):
        return False
    columns = "" if schema is None else f"({_columns(schema)}) "
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(name)} {columns}"
        f"USING parquet LOCATION {text_literal(location)}"
    )
    return True


def temp_view(df: DataFrame, name: str) -> None:
    """Name a batch or streaming DataFrame for use in SQL."""
    df.createOrReplaceTempView(name)


def table_as_select(
    spark: SparkSession, name: str, query: str, location: str | None = None
) -> DataFrame:
    """Store the whole result of a query as a table."""
    where = "" if location is None else f" LOCATION {text_literal(location)}"
    spark.sql(f"CREATE TABLE {quoted(name)} USING parquet{where} AS {query}")
    return spark.table(name)


def count_tables(spark: SparkSession, database: str) -> DataFrame:
    """Row count of every table of a database, in one plan."""
    parts = [
        spark.table(f"{database}.{t.name}").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(t.name).alias("table_name"), "n_rows")
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema)


def quoted_column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
