"""The stored document table: written by source and table, replaced by id."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from docweave.functions.text import strip
from docweave.operators.tables import greatest_sql, quoted
from docweave.operators.upsert import latest_of
from docweave.schema import BOUNDS, DOCUMENT, STORED, with_bounds
from docweave.session import new_path, remove_path

PARTITIONS = ("database_nm", "table_nm")
# Names while rows are put in order; no column is called these.
_DATE, _MONEY, _PLACE = "__docweave_date", "__docweave_money", "__docweave_place"


def clustered(documents: DataFrame, bits: int = 6) -> DataFrame:
    """Documents in an order that keeps near dates and near amounts together, within each table.

    The greatest date and the greatest amount of a document are each reduced to
    their place among ``2**bits`` quantiles; the bits of both places take turns,
    so a range of either leaves out files and row groups. Documents without a
    date or an amount take the lowest place. Ties are split by id, so no place
    is one task. Quantiles come from one pass over the two columns. Missing names
    of the database or table become empty, which is the same folder in a store:
    where they may be null the writer sorts anew and the order is lost.
    """
    # nothing of the id is added: a constant name would be folded out of the order, with the same effect
    nothing = F.left(F.coalesce("unique_id", F.lit("")), F.lit(0))
    named = documents.withColumns({c: F.concat(F.coalesce(c, F.lit("")), nothing) for c in PARTITIONS})
    bounded = named.selectExpr("*", f"double({BOUNDS['micros_max']}) AS {_DATE}", f"{BOUNDS['money_max']} AS {_MONEY}")
    keyed = bounded.withColumn(_PLACE, _place(_cuts(bounded, bits), bits))
    ranged = keyed.repartitionByRange(*PARTITIONS, _PLACE, "unique_id")
    return ranged.sortWithinPartitions(*PARTITIONS, _PLACE).drop(_DATE, _MONEY, _PLACE)


def clustered_tables(
    tables: Sequence[tuple[DataFrame, Mapping[str, str] | None, Callable[[DataFrame], DataFrame]]], bits: int = 6
) -> DataFrame:
    """Documents of whole tables in the order of ``clustered``; what travels are the rows of the tables.

    For each table its rows, the kinds of its columns, and what makes documents of
    rows, a projection. A document is many times its row, so rows are put in order
    and documents are made behind the shuffle. Ties are split by a hash of the row.
    Each task has documents of one table: write them with ``folders``, else the
    writer sorts them anew.
    """
    bounded = []
    for rows, kinds, _ in tables:
        date, money = greatest_sql(rows, kinds)
        bounded.append(rows.selectExpr("*", f"double({date}) AS {_DATE}", f"{money} AS {_MONEY}"))
    place = _place(_cuts(reduce(DataFrame.union, [b.select(_DATE, _MONEY) for b in bounded]), bits), bits)
    parts = []
    for keyed, (rows, _, documents) in zip(bounded, tables):
        plain = [quoted(f.name) for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        keyed = keyed.withColumn(_PLACE, place).drop(_DATE, _MONEY)
        ranged = keyed.repartitionByRange(_PLACE, F.xxhash64(*plain) if plain else F.lit(0))
        parts.append(documents(ranged.sortWithinPartitions(_PLACE).drop(_PLACE)))
    return reduce(DataFrame.unionByName, parts)


def _cuts(bounded: DataFrame, bits: int):
    """Quantiles of the greatest dates and amounts."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    return bounded.agg(*[F.percentile_approx(c, shares, 100 * parts).alias(c) for c in (_DATE, _MONEY)]).first()


def _place(cuts, bits: int) -> Column:
    """Places among the quantiles of both columns, their bits taking turns."""

    def place(name: str):
        if not cuts[name]:
            return F.lit(0)
        return F.when(F.col(name).isNull(), 0).otherwise(F.size(F.filter(F.lit(cuts[name]), lambda cut: cut <= F.col(name))))

    places = [F.shiftright(place(c), i).bitwiseAND(1) * (1 << (2 * i + k)) for k, c in enumerate((_DATE, _MONEY)) for i in range(bits)]
    return sum(places[1:], places[0])


def write_documents(documents: DataFrame, path: str, mode: str = "append", row_group: int | None = None, folders: int | None = None) -> None:
    """Store documents, a folder per database and table.

    Facets and delta counts then read only the folders they name. Rows are not
    gathered by table first: every task writes its own files, so a table holding
    most rows is no bottleneck. Bounds of dates and amounts are stored beside them;
    ``clustered`` documents let a range filter leave out most files and row groups.
    ``row_group``: bytes of a row group, where the default is not wanted. ``folders``:
    a task with documents of so many folders at most writes them as they come,
    without sorting them by folder; one with more sorts.
    """
    documents = with_bounds(documents.drop(*BOUNDS))
    # ids are hex digits, which only an entropy coder makes smaller
    sized = {"compression": "zstd"} | ({"parquet.block.size": row_group} if row_group else {})
    conf, name = documents.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    try:
        conf.set(name, str(folders or before))
        documents.write.mode(mode).options(**sized).partitionBy(*PARTITIONS).parquet(path)
    finally:
        conf.set(name, before)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(DOCUMENT).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem):
            return False
        raise
    return True


def folders_of(rows: DataFrame) -> list[tuple]:
    """Database and table names that rows have: one entry a folder."""
    return [tuple(r) for r in rows.select(*PARTITIONS).distinct().collect()]


def in_folders(folders: list[tuple]) -> Column:
    """Whether a row is in one of the folders; a missing database or table name is a folder too.

    A condition on the names alone, so that a scan reads these folders only and no
    rows are brought together by folder.
    """
    tables: dict = {}
    for database, name in folders:
        tables.setdefault(database, []).append(name)
    database, name = (F.col(c) for c in PARTITIONS)
    held = F.lit(False)
    for key, names in tables.items():
        named = F.coalesce(name.isin([n for n in names if n is not None]), F.lit(False))
        held = held | (database.eqNullSafe(F.lit(key)) & (named | name.isNull() if None in names else named))
    return held


def upsert_documents(
    incoming: DataFrame, path: str, order: Sequence[str] = (), staging: str | None = None
) -> None:
    """Add or replace documents of the stored table by id.

    An id is replaced wherever it is stored, in another folder too. Only the
    folders that hold such an id or get new rows are rewritten. The merged rows
    are staged first, then swapped in, so the table is never read and overwritten
    by one plan; a failure leaves the staged rows behind, success removes them.
    """
    spark = incoming.sparkSession
    newest = latest_of(incoming, order).select(*[f.name for f in DOCUMENT.fields])
    if not exists(spark, path):
        write_documents(newest, path, mode="errorifexists")
        return
    staging = staging or new_path(spark, "staged")
    write_documents(newest, f"{staging}/new", mode="errorifexists")
    newest = read_documents(spark, f"{staging}/new")
    ids = newest.select("unique_id")
    stored = read_documents(spark, path)
    touched = stored.select("unique_id", *PARTITIONS).join(ids, "unique_id", "left_semi").select(*PARTITIONS)
    touched = in_folders(folders_of(touched.union(newest.select(*PARTITIONS))))
    kept = stored.where(touched).join(ids, "unique_id", "left_anti").select(*newest.columns)
    merged = kept.unionByName(newest).hint("rebalance", *PARTITIONS)
    write_documents(merged, f"{staging}/merged", mode="errorifexists")
    merged = read_documents(spark, f"{staging}/merged")
    left = stored.select(*PARTITIONS, F.col("_metadata.file_path").alias("file")).where(touched)
    emptied = left.where(~in_folders(folders_of(merged))).select("file").distinct().collect()
    merged.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *PARTITIONS
    ).parquet(path)
    for row in emptied:  # files of folders whose last document moved away
        remove_path(spark, row.file)
    remove_path(spark, staging)


def observed(documents: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Documents with counters that fill while they are written.

    Rows, rows with text, dates and amounts are counted in the same pass.
    """
    seen = Observation(name)
    return (
        documents.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.size("text") > 0).alias("rows_with_text"),
            F.sum(F.size("date_text")).alias("dates"),
            F.sum(F.size("money_text")).alias("amounts"),
        ),
        seen,
    )


def rendered(documents: DataFrame, kind: str = "html") -> DataFrame:
    """Formatted copies as rows: output path and content, empty ones left out."""
    out = documents.where(strip(F.col("content")) != "")
    return out.select(
        F.concat(F.col("output_path"), F.lit("/"), F.substring_index("path", "/", -1), F.lit(f".{kind}")).alias("copy_path"),
        "content",
    )


def write_rendered(documents: DataFrame, path: str, kind: str = "html", as_text: bool = False) -> None:
    """Store formatted copies.

    By default as one table of copies, which stays fast for millions of files.
    ``as_text`` writes a folder per copy instead, for a web server.
    """
    copies = rendered(documents, kind)
    if as_text:
        copies.write.mode("append").partitionBy("copy_path").text(path)
    else:
        copies.write.mode("append").parquet(path)
