"""Tables of relational databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

# How each dialect spells a table and its catalog.
DIALECTS = {
    "sqlserver": {
        "table": "[{database}].[dbo].[{table}]",
        "catalog": "(select table_name as table_nm, table_type from information_schema.tables) t",
        "columns": "(select table_name as table_nm, ordinal_position as pos, column_name as column_nm,"
        " data_type as native_type, coalesce(character_maximum_length, 0) as precision"
        " from information_schema.columns) c",
    },
    "oracle": {
        "table": "{database}.{table}",
        "catalog": "(select table_name as table_nm, 'BASE TABLE' as table_type from {dictionary}"
        " where owner = '{database}') t",
        "columns": "(select table_name as table_nm, column_id as pos, column_name as column_nm,"
        " data_type as native_type, data_length as precision from all_tab_columns"
        " where owner = '{database}') c",
    },
}


def jdbc_options(
    url: str,
    properties: Mapping[str, str],
    dbtable: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options of a table scan.

    With a partition column and its bounds the scan runs as ``partitions``
    parallel range queries. Credentials come from the caller only.
    """
    options = {"url": url, "dbtable": dbtable, "fetchsize": str(fetch_size), **properties}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_table(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    database: str,
    table: str,
    *,
    dialect: str = "sqlserver",
    predicate: str | None = None,
    **split,
) -> DataFrame:
    """A whole table, or its rows kept by ``predicate``, which Spark pushes down."""
    name = DIALECTS[dialect]["table"].format(database=database, table=table)
    df = spark.read.format("jdbc").options(**jdbc_options(url, properties, name, **split)).load()
    return df.where(F.expr(predicate)) if predicate else df


def jdbc_catalog(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    database: str,
    *,
    dialect: str = "sqlserver",
    dictionary: str = "all_tables",
) -> DataFrame:
    """Tables and views of a database; ``dictionary`` names the owner's dictionary view."""
    query = DIALECTS[dialect]["catalog"].format(database=database, dictionary=dictionary)
    return spark.read.format("jdbc").options(**jdbc_options(url, properties, query)).load()


def native_types(
    spark: SparkSession, url: str, properties: Mapping[str, str], database: str, *, dialect: str = "sqlserver"
) -> DataFrame:
    """Native type names and declared lengths, which Spark's own schema loses."""
    query = DIALECTS[dialect]["columns"].format(database=database)
    return spark.read.format("jdbc").options(**jdbc_options(url, properties, query)).load()
