"""Inputs of the registered queries, all derived from the given tables.

The tables stand in for a relational database, files, spreadsheets, slides,
mail and laid-out pages. Each derived input has its SQL twin beside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.operators.catalog import counted
from docweave.operators.tables import table_to_documents

DATABASE = "warehouse"
TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
)

# Spark has no money type: these columns are money, as the source would say.
KINDS = {
    "orders": {"o_totalprice": "money"},
    "customer": {"c_acctbal": "money"},
    "supplier": {"s_acctbal": "money"},
    "part": {"p_retailprice": "money"},
    "lineitem": {"l_extendedprice": "money"},
    "documents": {"text": "large_string"},
}
KEYS = {
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "nation": ["n_nationkey"],
    "region": ["r_regionkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over as many tasks as a shuffle has: for work that is heavy per row."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def documents_of(spark: SparkSession, d: str, name: str, df: DataFrame | None = None) -> DataFrame:
    """A given table as documents."""
    return table_to_documents(
        table(spark, d, name) if df is None else df,
        name,
        DATABASE,
        kinds=KINDS.get(name),
        key_columns=KEYS.get(name),
        vendor="given",
        categories=("tables", name),
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def sql_id(name: str) -> str:
    """SQL of the hashed id of a table with a key."""
    keys = ", ".join(f"CAST({k} AS VARCHAR)" for k in KEYS[name])
    return f"sha256(concat_ws(chr(31), '{name}', {keys}))"


# --- catalog: the tables, and a view per value of some columns -----------------

_VIEWS = [
    ("customer", "lower(c_mktsegment) || '_customers'"),
    ("part", "p_type || '_parts'"),
    ("events", "event_type || '_events'"),
    ("documents", "'documents_' || source"),
    ("orders", "'Orders_' || o_orderstatus"),
    ("lineitem", "'kept_lines_' || l_returnflag"),
]


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """(table_nm, table_type, source_n) of every table and view."""
    kind = lambda name: F.lit(name).alias("table_type")
    rows = [table(spark, d, t).select(F.lit(t).alias("table_nm"), kind("BASE TABLE")) for t in TABLES]
    rows += [table(spark, d, t).select(F.expr(name).alias("table_nm"), kind("VIEW")) for t, name in _VIEWS]
    return counted(union_all(rows), [(t, "BASE TABLE") for t in TABLES]).withColumnRenamed("n", "source_n")


CATALOG_SQL = " UNION ALL ".join(
    [f"SELECT '{t}' AS table_nm, 'BASE TABLE' AS table_type, count(*) AS source_n FROM {t}" for t in TABLES]
    + [f"SELECT {name} AS table_nm, 'VIEW' AS table_type, count(*) AS source_n FROM {t} GROUP BY 1" for t, name in _VIEWS]
)

# An earlier import stored orders up to a date, all customers, and so on.
STORED_ROWS = {
    "orders": "o_orderdate < TIMESTAMP '1999-01-01'",
    "customer": "true",
    "nation": "true",
    "supplier": "s_acctbal >= 0",
    "documents": "lang = 'en'",
    "part": "p_retailprice > 0",
}


def stored_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents left by an earlier, partial import."""
    return union_all(
        [documents_of(spark, d, t, table(spark, d, t).where(F.expr(rows))) for t, rows in STORED_ROWS.items()]
    )


STORED_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_nm, count(*) AS n FROM {t} WHERE {rows} GROUP BY 1" for t, rows in STORED_ROWS.items()
)


# --- cells: three sheets of one workbook ---------------------------------------


def _cell(row, col: str, value: Column | str) -> Column:
    number = ord(col) - 64
    return F.struct(
        (row if isinstance(row, Column) else F.lit(row)).cast("int").alias("row"),
        F.lit(col).alias("col"),
        F.lit(number).alias("col_no"),
        (value if isinstance(value, Column) else F.lit(value)).cast("string").alias("value"),
    )


def _sheet(df: DataFrame, sheet: str, *cells: Column) -> DataFrame:
    rows = df.select(F.inline(F.array_compact(F.array(*cells))))
    return rows.select(F.lit("accounts.xlsx").alias("doc"), F.lit(sheet).alias("sheet"), "row", "col", "col_no", "value")


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Customers, suppliers and nations as sheets.

    Column C of customers has no header; negative balances are empty cells; the
    segment cell of BUILDING rows is missing; suppliers have blank rows above
    their header and a header used twice; names are quoted.
    """
    c, s, n = (table(spark, d, t) for t in ("customer", "supplier", "nation"))
    one = spark.range(1)
    amount = lambda x: F.when(F.col(x) >= 0, F.col(x).cast("decimal(12,2)"))
    crow, srow, nrow = F.col("c_custkey") + 2, F.col("s_suppkey") + 4, F.col("n_nationkey") + 2
    return union_all(
        [
            _sheet(one, "customer", _cell(1, "A", "key"), _cell(1, "B", "name"), _cell(1, "D", "balance DT"), _cell(1, "E", "segment")),
            _sheet(
                c, "customer",
                _cell(crow, "A", F.col("c_custkey")),
                _cell(crow, "B", F.concat(F.lit('"'), F.col("c_name"), F.lit('"'))),
                _cell(crow, "C", F.col("c_nationkey")),
                _cell(crow, "D", amount("c_acctbal")),
                F.when(F.col("c_mktsegment") != "BUILDING", _cell(crow, "E", F.col("c_mktsegment"))),
            ),
            _sheet(one, "supplier", _cell(2, "B", " "), _cell(3, "A", "key"), _cell(3, "B", "label"), _cell(3, "C", "label")),
            _sheet(
                s, "supplier",
                _cell(srow, "A", F.col("s_suppkey")),
                _cell(srow, "B", F.col("s_name")),
                _cell(srow, "C", amount("s_acctbal")),
            ),
            _sheet(one, "nation", _cell(1, "A", "key"), _cell(1, "B", "name")),
            _sheet(n, "nation", _cell(nrow, "A", F.col("n_nationkey")), _cell(nrow, "B", F.col("n_name"))),
        ]
    )


def _sql_cell(table_: str, sheet: str, row: str, col: str, value: str, where: str = "true") -> str:
    return (
        f"SELECT 'accounts.xlsx' AS doc, '{sheet}' AS sheet, CAST({row} AS INTEGER) AS row, '{col}' AS col, "
        f"{ord(col) - 64} AS col_no, CAST({value} AS VARCHAR) AS value FROM {table_} WHERE {where}"
    )


def _sql_amount(c: str) -> str:
    return f"CASE WHEN {c} >= 0 THEN CAST({c} AS DECIMAL(12,2)) END"


_ONE = "(SELECT 1) one"
CELLS_SQL = " UNION ALL ".join(
    [
        _sql_cell(_ONE, "customer", "1", "A", "'key'"),
        _sql_cell(_ONE, "customer", "1", "B", "'name'"),
        _sql_cell(_ONE, "customer", "1", "D", "'balance DT'"),
        _sql_cell(_ONE, "customer", "1", "E", "'segment'"),
        _sql_cell("customer", "customer", "c_custkey + 2", "A", "c_custkey"),
        _sql_cell("customer", "customer", "c_custkey + 2", "B", "'\"' || c_name || '\"'"),
        _sql_cell("customer", "customer", "c_custkey + 2", "C", "c_nationkey"),
        _sql_cell("customer", "customer", "c_custkey + 2", "D", _sql_amount("c_acctbal")),
        _sql_cell("customer", "customer", "c_custkey + 2", "E", "c_mktsegment", "c_mktsegment <> 'BUILDING'"),
        _sql_cell(_ONE, "supplier", "2", "B", "' '"),
        _sql_cell(_ONE, "supplier", "3", "A", "'key'"),
        _sql_cell(_ONE, "supplier", "3", "B", "'label'"),
        _sql_cell(_ONE, "supplier", "3", "C", "'label'"),
        _sql_cell("supplier", "supplier", "s_suppkey + 4", "A", "s_suppkey"),
        _sql_cell("supplier", "supplier", "s_suppkey + 4", "B", "s_name"),
        _sql_cell("supplier", "supplier", "s_suppkey + 4", "C", _sql_amount("s_acctbal")),
        _sql_cell(_ONE, "nation", "1", "A", "'key'"),
        _sql_cell(_ONE, "nation", "1", "B", "'name'"),
        _sql_cell("nation", "nation", "n_nationkey + 2", "A", "n_nationkey"),
        _sql_cell("nation", "nation", "n_nationkey + 2", "B", "n_name"),
    ]
)


# --- slides: a conversation is a deck, a turn a slide ---------------------------


def _picture(line: Column) -> Column:
    size = F.length(line)
    return F.when(size < 30, "jpg").when(size < 60, "png").when(size < 90, "gif").otherwise("emf")


def slides(spark: SparkSession, d: str) -> DataFrame:
    """The first line of a turn is an author's comment, the last an unsigned one;
    the second is the notes; each line stands for a picture."""
    lines = F.split("text", "\n", -1)
    return table(spark, d, "conversations").select(
        F.concat(F.lit("/srv/media/decks/deck "), F.col("conv_id"), F.lit(".ppt")).alias("doc"),
        (F.col("turn") + 1).cast("int").alias("slide_number"),
        F.col("role").alias("header"),
        F.when(F.col("role") == "assistant", F.lit("reviewed")).alias("footer"),
        F.col("text").alias("content"),
        F.array(
            F.struct(F.col("role").alias("author"), F.get(lines, F.lit(0)).alias("text")),
            F.struct(F.lit(None).cast("string").alias("author"), F.element_at(lines, -1).alias("text")),
        ).alias("comments"),
        F.get(lines, F.lit(1)).alias("notes"),
        F.transform(lines, lambda x: F.struct(_picture(x).alias("ext"))).alias("images"),
    )


SLIDES_SQL = """
SELECT '/srv/media/decks/deck ' || conv_id || '.ppt' AS doc, CAST(turn + 1 AS INTEGER) AS slide_number,
       role AS header, CASE WHEN role = 'assistant' THEN 'reviewed' END AS footer, text AS content,
       string_split(text, chr(10)) AS lines
FROM conversations
"""

# --- files: a page is a file -----------------------------------------------------

ROOT = "/srv/media"
PREFIX = "http://host.example/media"


def files(spark: SparkSession, d: str) -> DataFrame:
    """Pages as files: a name with spaces, dots and other letters, and a type by its length."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    size = F.length(title)
    kind = (
        F.when(size < 18, "application/vnd.ms-powerpoint")
        .when(size < 26, "application/vnd.ms-excel")
        .when(size < 34, "application/msword")
        .when(size < 42, "application/vnd.oasis.opendocument.spreadsheet")
        .when(size < 50, "application/vnd.oasis.opendocument.presentation")
        .when(size < 58, "application/WordPerfect")
        .when(size < 66, "text/html")
    )
    return table(spark, d, "pages").select(
        "page_id",
        "url",
        F.concat(F.lit(ROOT + "/site "), F.col("page_id"), F.lit("/"), title, F.lit(".html")).alias("path"),
        kind.alias("content_type"),
        F.when(F.contains("url", F.lit("//blog.")), F.lit("Microsoft Office PowerPoint")).alias("application_name"),
        F.when(F.startswith("url", F.lit("https")), F.substring_index(F.substring_index("url", "/", 3), "/", -1)).alias("author"),
        F.when(F.contains("url", F.lit(".org")), F.lit("last editor")).alias("last_author"),
        F.col("html").alias("content"),
    )


FILES_SQL = """
SELECT page_id, url, '/srv/media/site ' || page_id || '/' || title || '.html' AS path,
       CASE WHEN length(title) < 18 THEN 'application/vnd.ms-powerpoint'
            WHEN length(title) < 26 THEN 'application/vnd.ms-excel'
            WHEN length(title) < 34 THEN 'application/msword'
            WHEN length(title) < 42 THEN 'application/vnd.oasis.opendocument.spreadsheet'
            WHEN length(title) < 50 THEN 'application/vnd.oasis.opendocument.presentation'
            WHEN length(title) < 58 THEN 'application/WordPerfect'
            WHEN length(title) < 66 THEN 'text/html' END AS content_type,
       CASE WHEN contains(url, '//blog.') THEN 'Microsoft Office PowerPoint' END AS application_name,
       CASE WHEN url LIKE 'https%' THEN split_part(url, '/', 3) END AS author,
       CASE WHEN contains(url, '.org') THEN 'last editor' END AS last_author,
       html AS content, title
FROM (SELECT *, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages) p
"""

# --- paged documents --------------------------------------------------------------

LINES_PER_PAGE = 20
