"""Tables by catalog name, and SQL over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changeloom.functions.columns import quoted
from changeloom.storage import Storage


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_files(spark: SparkSession, name: str, path: str, format: str = "parquet") -> None:
    """Catalog entry for files that are already there; nothing is copied."""
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {format} LOCATION '{location}'")


def named(name: str) -> str:
    """``database.table`` as SQL text can hold it."""
    return ".".join(map(quoted, name.split(".")))


def ensure_database(spark: SparkSession, database: str, path: str) -> None:
    """The database, with a folder of its own beside the files of the table that asks for it."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION '{path.rstrip('/')}/_catalog'")


def location_of(spark: SparkSession, name: str) -> str | None:
    """Folder of a table in the catalog; nothing if there is no such table."""
    if not spark.catalog.tableExists(named(name)):
        return None
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {named(name)}").collect()}
    return Storage(spark).plain(told.get("Location", ""))


def enter_partition(spark: SparkSession, name: str, path: str, schema: T.StructType, column: str, value: str) -> None:
    """Let the external table ``name`` be the folders below ``path``, the one of this value included."""
    held = location_of(spark, name)
    if held != path:
        ensure_database(spark, name.rpartition(".")[0], path)
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {named(name)}")  # external: no file goes
        spark.sql(
            f"CREATE TABLE {named(name)} ({columns}, {column} STRING) USING parquet "
            f"PARTITIONED BY ({column}) LOCATION '{path}'"
        )
        spark.sql(f"ALTER TABLE {named(name)} RECOVER PARTITIONS")
    spark.sql(f"ALTER TABLE {named(name)} ADD IF NOT EXISTS PARTITION ({column}='{value}')")
    spark.catalog.refreshTable(named(name))


def drop_partitions(spark: SparkSession, name: str, column: str, values: Sequence[str]) -> None:
    """Take partitions out of an external table; their files are the caller's."""
    for value in values:
        spark.sql(f"ALTER TABLE {named(name)} DROP IF EXISTS PARTITION ({column}='{value}')")
    spark.catalog.refreshTable(named(name))


def run_sql(
    spark: SparkSession,
    query: str,
    *,
    database: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    result_location: str | None = None,
) -> DataFrame:
    """Result of a SQL query.

    database: where unqualified names are looked up. tables: frames the query may name in braces,
    as in ``SELECT * FROM {orders}``. result_location: write the result there as Parquet and
    return the written rows.
    """
    previous = spark.catalog.currentDatabase()
    if database:
        spark.catalog.setCurrentDatabase(database)
    try:
        result = spark.sql(query, **(tables or {}))
    finally:
        if database:
            spark.catalog.setCurrentDatabase(previous)
    if result_location:
        result.write.mode("overwrite").parquet(result_location)
        return spark.read.schema(result.schema).parquet(result_location)
    return result
