"""Namespaces and tables of the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

# Table property: the location a table was created for.
_HOME = "feedloom.location"


def create_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """A database, if there is none of that name; by default in the session's warehouse."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, location: str | None = None
) -> None:
    """A Parquet table, if there is none of that name.

    One that was created for another ``location`` is refused with a ValueError.
    """
    home = _home(spark, table)
    if location and home not in (None, location):
        raise ValueError(f"table {table} was created for {home or 'the warehouse'}, not for {location}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f" LOCATION '{location}' TBLPROPERTIES ('{_HOME}' = '{location}')" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{where}")


def _home(spark: SparkSession, table: str) -> str | None:
    """The location a table was created for, empty if none was named; None without such a table."""
    if not spark.catalog.tableExists(table):
        return None
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return properties.get(_HOME, "")


def replace_table(rows: DataFrame, table: str, schema: T.StructType, location: str) -> None:
    """``rows`` as the content of a catalog table, created below ``location`` if there is none.

    They are written to a folder of their own and the table is then pointed at it, so readers see
    the old content or the new one, and the old folder stays for those that still read it.
    """
    spark = rows.sparkSession
    create_table(spark, table, schema, location)
    folder = f"{location}/version-{uuid.uuid4().hex}"
    rows.select(*schema.fieldNames()).write.parquet(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
