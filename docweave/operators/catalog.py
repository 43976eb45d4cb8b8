"""Operators over a catalog: which tables to import, and how much is left."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docweave.operators.tables import LARGE_TEXT


def list_tables(
    catalog: DataFrame,
    name_like: str | None = None,
    predicate: str | None = None,
    types: Sequence[str] = ("BASE TABLE", "VIEW"),
) -> DataFrame:
    """Base tables and views by name, optionally narrowed."""
    out = catalog.where(F.col("table_type").isin(*types))
    if name_like is not None:
        out = out.where(F.col("table_nm").like(name_like))
    if predicate is not None:
        out = out.where(F.expr(predicate))
    return out.orderBy("table_nm")


def exclude_tables(catalog: DataFrame, names: Iterable[str] | DataFrame) -> DataFrame:
    """Drop listed tables, ignoring case."""
    if isinstance(names, DataFrame):
        banned = names.select(F.lower(F.col("table_nm")).alias("_name")).distinct()
        return catalog.join(banned, F.lower(catalog["table_nm"]) == banned["_name"], "left_anti")
    return catalog.where(~F.lower(F.col("table_nm")).isin(*[n.lower() for n in names]))


def resume_from_table(catalog: DataFrame, start: str) -> DataFrame:
    """Tables from ``start`` on in name order; none when it does not occur.

    The start name is looked up by a scalar subquery, so there is no global
    window over the catalog.
    """
    met = catalog.where(F.lower(F.col("table_nm")) == start.lower())
    first = met.agg(F.min("table_nm").alias("n")).scalar()
    return catalog.where(F.col("table_nm") >= first)


def range_bucket(name: Column, bounds: Sequence[str] = ("c", "h", "k", "s", "u")) -> Column:
    """Bucket of a name: up to the first bound, between bounds, from the last on.

    The first bound belongs to the first bucket, every other to the next one.
    """
    bucket = F.when(name <= bounds[0], F.lit(0))
    for n, bound in enumerate(bounds[1:], start=1):
        bucket = bucket.when(name < bound, F.lit(n))
    return bucket.otherwise(F.lit(len(bounds)))


def split_selection(spec: Column) -> Column:
    """``"<table> and <predicate>"`` as ``struct(name, predicate)``."""
    parts = F.split(spec, " and ", 2)
    return F.struct(
        F.trim(parts[0]).alias("name"),
        F.when(F.size(parts) > 1, F.trim(F.get(parts, F.lit(1)))).alias("predicate"),
    )


def select_rows(df: DataFrame, spec: str) -> DataFrame:
    """Rows of a table kept by the predicate of its selection, pushed to the scan."""
    _, _, predicate = spec.partition(" and ")
    return df.where(F.expr(predicate)) if predicate else df


def column_types(df: DataFrame, table_nm: str) -> DataFrame:
    """Position, name, type, measured length and large-text flag of each column.

    Files carry no declared text length, so it is measured in one aggregate
    pass over the text columns.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    sizes = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.length(F.col(f"`{c}`"))).alias(f"_len_{i}") for i, c in enumerate(texts)],
    )
    entries = []
    for pos, f in enumerate(df.schema.fields, start=1):
        size = F.col(f"_len_{texts.index(f.name)}") if f.name in texts else F.lit(None)
        entries.append(
            F.struct(
                F.lit(pos).alias("pos"),
                F.lit(f.name).alias("column_nm"),
                F.lit(f.dataType.simpleString()).alias("native_type"),
                size.cast("long").alias("precision"),
            )
        )
    rows = sizes.select(F.lit(table_nm).alias("table_nm"), F.inline(F.array(*entries)))
    large = (F.col("native_type") == "string") & (F.col("precision") >= LARGE_TEXT)
    return rows.withColumn("kind", F.when(large, F.lit("LARGE_VARCHAR")).otherwise(F.col("native_type")))


def count_rows(df: DataFrame, table_nm: str) -> DataFrame:
    """Row count of a source table."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(table_nm).alias("table_nm"), "n")


def counted(rows: DataFrame, known: Sequence[tuple] = ()) -> DataFrame:
    """Number of rows of each name of a union of tables, in one exchange.

    ``rows`` holds a row per source row with the names alone; names in ``known``
    are listed with 0 where they have none.
    """
    names = rows.columns
    each = rows.withColumn("_one", F.lit(1))
    if known:
        schema = ", ".join(f"{n} string" for n in names)
        each = each.unionByName(rows.sparkSession.createDataFrame(list(known), schema).withColumn("_one", F.lit(0)))
    return each.groupBy(*names).agg(F.sum("_one").alias("n"))


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of many source tables in one exchange."""
    rows = [df.select(F.lit(name).alias("table_nm")) for name, df in tables.items()]
    return counted(reduce(DataFrame.unionByName, rows), [(name,) for name in tables])


def index_count(documents: DataFrame) -> DataFrame:
    """Documents already stored, per table."""
    return documents.groupBy("table_nm").agg(F.count(F.lit(1)).alias("n"))


def delta_import_plan(sources: DataFrame, stored: DataFrame) -> DataFrame:
    """Which tables still need an import.

    ``sources`` holds (table_nm, source_n), ``stored`` (table_nm, n). A table is
    skipped when something is stored and not less than the source holds. Counts
    miss changed rows; see :func:`missing_documents`.
    """
    counts = stored.select("table_nm", F.col("n").alias("stored_n"))
    joined = sources.join(counts, "table_nm", "left")
    held = F.coalesce(F.col("stored_n"), F.lit(0))
    done = (held > 0) & (held >= F.col("source_n"))
    return joined.select(
        "table_nm",
        "source_n",
        held.alias("stored_n"),
        F.when(done, F.lit("skip")).otherwise(F.lit("import")).alias("action"),
    )


def missing_documents(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose id is not stored yet."""
    return documents.join(stored.select("unique_id"), "unique_id", "left_anti")


def spark_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names and types of the tables Spark itself knows."""
    query = "SHOW TABLES" + (f" IN `{database}`" if database else "")
    return spark.sql(query).select(
        F.col("tableName").alias("table_nm"),
        F.when(F.col("isTemporary"), F.lit("VIEW")).otherwise(F.lit("BASE TABLE")).alias("table_type"),
    )
