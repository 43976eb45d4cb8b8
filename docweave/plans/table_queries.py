"""Queries over the catalog and over tables as documents."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from docweave.operators import catalog as cat, tables as tab, upsert as up
from docweave.plans import inputs as src
from docweave.plans.inputs import CATALOG_SQL, STORED_SQL, documents_of, sql_id, table, union_all
from docweave.plans.registry import query

# --- catalog -----------------------------------------------------------------------


@query("catalog_list", f"SELECT row_number() OVER (ORDER BY table_nm) AS position, table_nm, table_type FROM ({CATALOG_SQL}) c WHERE table_nm LIKE '%_s'")
def catalog_list(spark, d):
    """Tables of that name, numbered in the order in which they come."""
    listed = cat.list_tables(src.catalog(spark, d), name_like="%_s").withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(W.orderBy("_at")).cast("long").alias("position")  # a catalog, not a table
    return listed.select(position, "table_nm", "table_type")


def _sql_types() -> str:
    columns = {
        "customer": ["c_custkey bigint", "c_name string", "c_nationkey int", "c_acctbal double", "c_mktsegment string"],
        "documents": ["doc_id bigint", "text string", "lang string", "source string", "n_chars bigint"],
        "orders": [
            "o_orderkey bigint", "o_custkey bigint", "o_orderstatus string", "o_totalprice double",
            "o_orderdate timestamp_ntz", "o_orderpriority string",
        ],
        "pages": ["page_id bigint", "url string", "html string"],
        "region": ["r_regionkey int", "r_name string"],
        "nation": ["n_nationkey int", "n_name string", "n_regionkey int"],
        "supplier": ["s_suppkey bigint", "s_name string", "s_nationkey int", "s_acctbal double"],
        "benchmark": ["item_id bigint", "text string"],
        "labels": ["doc_id bigint", "quality int", "toxic int"],
        "conversations": ["conv_id bigint", "turn bigint", "role string", "text string"],
        "embeddings": ["vec_id bigint", "embedding array<float>", "label int"],
        "part": ["p_partkey bigint", "p_name string", "p_brand string", "p_type string", "p_size int", "p_retailprice double"],
        "lineitem": [
            "l_orderkey bigint", "l_partkey bigint", "l_suppkey bigint", "l_linenumber int", "l_quantity double",
            "l_extendedprice double", "l_discount double", "l_tax double", "l_returnflag string", "l_linestatus string",
            "l_shipdate timestamp_ntz",
        ],
        "events": ["event_id bigint", "ts timestamp_ntz", "user_id bigint", "event_type string", "value double", "props string"],
    }
    rows = []
    for name, cols in columns.items():
        for pos, col in enumerate(cols, start=1):
            c, kind = col.split()
            size = f"max(length({c}))" if kind == "string" else "CAST(max(NULL) AS BIGINT)"
            rows.append(
                f"SELECT '{name}' AS table_nm, {pos} AS pos, '{c}' AS column_nm, '{kind}' AS native_type, "
                f"{size} AS precision FROM {name}"
            )
    return (
        "SELECT *, CASE WHEN native_type = 'string' AND precision >= 200 THEN 'LARGE_VARCHAR' ELSE native_type END AS kind "
        f"FROM ({' UNION ALL '.join(rows)}) t"
    )


@query("catalog_column_types", _sql_types())
def catalog_column_types(spark, d):
    return union_all([cat.column_types(table(spark, d, n), n) for n in src.TABLES])


@query(
    "exclude_tables",
    f"SELECT table_nm, source_n FROM ({CATALOG_SQL}) c "
    "WHERE lower(table_nm) NOT IN ('embeddings', 'orders_f', 'promo_parts', 'nation')",
)
def exclude_tables(spark, d):
    denied = ["Embeddings", "ORDERS_F", "promo_parts", "nation"]
    return cat.exclude_tables(src.catalog(spark, d), denied).select("table_nm", "source_n")


@query(
    "resume_from_table",
    f"WITH c AS ({CATALOG_SQL}), w AS (SELECT table_nm, max(CASE WHEN lower(table_nm) = 'household_customers' THEN 1 ELSE 0 END) "
    "OVER (ORDER BY table_nm ROWS UNBOUNDED PRECEDING) AS met FROM c) SELECT table_nm FROM w WHERE met = 1",
)
def resume_from_table(spark, d):
    return cat.resume_from_table(src.catalog(spark, d), "Household_Customers").select("table_nm")


@query(
    "table_range_buckets",
    f"SELECT table_nm, CASE WHEN table_nm <= 'c' THEN 0 WHEN table_nm < 'h' THEN 1 WHEN table_nm < 'k' THEN 2 "
    f"WHEN table_nm < 's' THEN 3 WHEN table_nm < 'u' THEN 4 ELSE 5 END AS bucket FROM ({CATALOG_SQL}) c",
)
def table_range_buckets(spark, d):
    names = src.catalog(spark, d)
    return names.select("table_nm", cat.range_bucket(F.col("table_nm")).alias("bucket"))


@query(
    "table_predicate_split",
    f"SELECT table_nm AS name, CASE WHEN table_type = 'VIEW' THEN 'n > ' || source_n || ' and n < 9' END AS predicate "
    f"FROM ({CATALOG_SQL}) c",
)
def table_predicate_split(spark, d):
    spec = F.when(
        F.col("table_type") == "VIEW",
        F.concat("table_nm", F.lit(" and n > "), F.col("source_n").cast("string"), F.lit(" and n < 9")),
    ).otherwise(F.col("table_nm"))
    return src.catalog(spark, d).select(cat.split_selection(spec).alias("s")).select("s.*")


@query(
    "select_rows",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 250000 GROUP BY 1",
)
def select_rows(spark, d):
    kept = cat.select_rows(table(spark, d, "orders"), "orders and o_totalprice > 250000")
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("count_rows", " UNION ALL ".join(f"SELECT '{t}' AS table_nm, count(*) AS n FROM {t}" for t in src.TABLES))
def count_rows(spark, d):
    return cat.count_tables({t: table(spark, d, t) for t in src.TABLES})


@query("index_count", STORED_SQL)
def index_count(spark, d):
    return cat.index_count(src.stored_documents(spark, d))


@query(
    "delta_import_plan",
    f"SELECT c.table_nm, source_n, coalesce(n, 0) AS stored_n, "
    "CASE WHEN coalesce(n, 0) > 0 AND n >= source_n THEN 'skip' ELSE 'import' END AS action "
    f"FROM ({CATALOG_SQL}) c LEFT JOIN ({STORED_SQL}) s ON c.table_nm = s.table_nm",
)
def delta_import_plan(spark, d):
    stored = cat.index_count(src.stored_documents(spark, d))
    return cat.delta_import_plan(src.catalog(spark, d), stored)


@query(
    "missing_documents",
    f"SELECT {sql_id('orders')} AS unique_id, o_orderkey FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1999-01-01')",
)
def missing_documents(spark, d):
    held = documents_of(spark, d, "orders", table(spark, d, "orders").where(src.STORED_ROWS["orders"]))
    missing = cat.missing_documents(documents_of(spark, d, "orders"), held)
    return missing.select("unique_id", F.col("fields")["o_orderkey_l"].cast("long").alias("o_orderkey"))


# --- tables as documents ---------------------------------------------------------------

@query(
    "column_rename",
    """
    SELECT o_orderkey AS o_orderkey_l, o_orderstatus AS table_nm_s, o_orderpriority AS Vendor_s,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed_dt_tdt,
           strftime(o_orderdate, '%Y-%m-%d') AS label_date, o_orderstatus || o_orderpriority AS old_dates
    FROM orders
    """,
)
def column_rename(spark, d):
    named = table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("table_nm"),
        F.col("o_orderpriority").alias("Vendor"),
        F.col("o_orderdate").alias("placed_dt"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("label_dt"),
        F.concat("o_orderstatus", "o_orderpriority").alias("old_dts"),
    )
    out = tab.rename_columns(named)
    return out.withColumn("placed_dt_tdt", F.date_format("placed_dt_tdt", "yyyy-MM-dd HH:mm:ss"))


def _sql_typed() -> str:
    columns = [
        ("o_orderkey_l", "long", "CAST(o_orderkey AS VARCHAR)", 1, 0, 0),
        ("o_custkey_l", "long", "CAST(o_custkey AS VARCHAR)", 1, 0, 0),
        ("o_orderstatus", "string", "o_orderstatus", 1, 0, 0),
        ("o_totalprice", "money", "CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS VARCHAR)", 0, 0, 1),
        ("o_orderdate_tdt", "timestamp", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", 0, 1, 0),
        ("o_orderpriority", "string", "o_orderpriority", 1, 0, 0),
    ]
    return " UNION ALL ".join(
        f"SELECT o_orderkey, '{f}' AS field_nm, '{k}' AS value_kind, {v} AS value, {t} = 1 AS in_text, "
        f"{dt} = 1 AS in_date, {m} = 1 AS in_money FROM orders"
        for f, k, v, t, dt, m in columns
    )


@query("typed_fields", _sql_typed())
def typed_fields(spark, d):
    return tab.typed_fields(table(spark, d, "orders"), "o_orderkey", src.KINDS["orders"])


@query(
    "number_fields",
    """
    WITH p AS (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) = floor(p_retailprice) AS whole FROM part)
    SELECT p_partkey, 'p_size_i' AS field, true AS in_text FROM part
    UNION ALL SELECT p_partkey, CASE WHEN whole THEN 'price_i' ELSE 'price' END, whole FROM p
    """,
)
def number_fields(spark, d):
    """The dialect whose numbers are told apart by their decimal point."""
    amount = F.col("p_retailprice").cast("decimal(12,2)")
    parts = table(spark, d, "part").select(
        "p_partkey",
        "p_size",
        F.when(amount == F.floor(amount), F.floor(amount).cast("string")).otherwise(amount.cast("string")).alias("price"),
    )
    docs = tab.table_to_documents(
        parts, "part", "ora", id_column="p_partkey", dialect="oracle",
        native={"p_partkey": ("VARCHAR2", 40), "p_size": ("NUMBER", 22), "price": ("NUMBER", 22)},
    )
    flat = docs.select("unique_id", "text", F.explode("fields").alias("field", "value")).where("field != 'p_partkey'")
    return flat.select(
        F.col("unique_id").cast("long").alias("p_partkey"),
        "field",
        F.array_contains("text", F.col("value")).alias("in_text"),
    )


@query(
    "row_unique_id",
    f"SELECT {sql_id('customer')} AS unique_id, 'warehouse' AS database_nm, 'hashed' AS table_nm FROM customer "
    "UNION ALL SELECT c_name, 'warehouse', 'named' FROM customer",
)
def row_unique_id(spark, d):
    hashed = documents_of(spark, d, "customer").withColumn("table_nm", F.lit("hashed"))
    named = tab.table_to_documents(table(spark, d, "customer"), "named", src.DATABASE, id_column="c_name")
    return hashed.unionByName(named).select("unique_id", "database_nm", "table_nm")


_ORDER_TEXT = (
    f"concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority, {sql_id('orders')})"
)


@query(
    "table_to_documents",
    f"SELECT {sql_id('orders')} AS unique_id, 'warehouse' AS database_nm, 'orders' AS table_nm, "
    f"{_ORDER_TEXT} AS text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_text, o_totalprice AS money_text, "
    "'o_custkey_l=' || o_custkey || '|o_orderdate_tdt=' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '|o_orderkey_l=' "
    "|| o_orderkey || '|o_orderpriority=' || o_orderpriority || '|o_orderstatus=' || o_orderstatus || '|o_totalprice=' "
    "|| CAST(o_totalprice AS DECIMAL(19,4)) AS fields FROM orders",
)
def table_to_documents(spark, d):
    docs = documents_of(spark, d, "orders")
    pairs = F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return docs.select(
        "unique_id",
        "database_nm",
        "table_nm",
        F.array_join("text", "|").alias("text"),
        F.array_join(F.transform("date_text", lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")), "|").alias("date_text"),
        F.get("money_text", F.lit(0)).alias("money_text"),
        F.array_join(F.sort_array(pairs), "|").alias("fields"),
    )


@query(
    "text_collect",
    f"SELECT {sql_id('customer')} AS unique_id, concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), "
    f"c_mktsegment, {sql_id('customer')}) AS text FROM customer",
)
def text_collect(spark, d):
    return documents_of(spark, d, "customer").select("unique_id", F.array_join("text", "|").alias("text"))


# SQL of how many values a row has for each catch-all field.
_COUNTS = {"customer": (5, 0, 1), "supplier": (4, 0, 1), "part": (6, 0, 1), "orders": (5, 1, 1), "nation": (4, 0, 0), "region": (3, 0, 0)}


@query(
    "unified_catalog",
    " UNION ALL ".join(
        f"SELECT {sql_id(t)} AS unique_id, '{t}' AS table_nm, CAST({a} AS BIGINT) AS n_text, CAST({b} AS BIGINT) AS n_date, "
        f"CAST({c} AS BIGINT) AS n_money FROM {t}"
        for t, (a, b, c) in _COUNTS.items()
    ),
)
def unified_catalog(spark, d):
    whole = union_all([documents_of(spark, d, t) for t in _COUNTS])
    return whole.select(
        "unique_id",
        "table_nm",
        F.size("text").cast("long").alias("n_text"),
        F.size("date_text").cast("long").alias("n_date"),
        F.size("money_text").cast("long").alias("n_money"),
    )


@query(
    "upsert_by_id",
    f"""
    WITH w AS (SELECT o_orderkey, o_totalprice, 0 AS seq FROM orders
      UNION ALL SELECT o_orderkey, o_totalprice + 10, 1 FROM orders WHERE o_orderstatus = 'O'
      UNION ALL SELECT o_orderkey, o_totalprice + 20, 2 FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT -1 - o_orderkey, o_totalprice, 1 FROM orders WHERE o_orderstatus = 'O')
    SELECT 'K' || o_orderkey AS unique_id, o_totalprice, seq FROM
      (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS r FROM w) t WHERE r = 1
    """,
)
def upsert_by_id(spark, d):
    """Stored orders; open ones repriced, urgent ones again, and some new."""
    orders = table(spark, d, "orders")

    def batch(rows, key, price, seq):
        return rows.select(F.concat(F.lit("K"), key).alias("unique_id"), price.alias("o_totalprice"), F.lit(seq).alias("seq"))

    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    open_, urgent = orders.where("o_orderstatus = 'O'"), orders.where("o_orderpriority = '1-URGENT'")
    stored = batch(orders, key, price, 0)
    incoming = union_all([batch(open_, key, price + 10, 1), batch(urgent, key, price + 20, 2), batch(open_, -1 - key, price, 1)])
    return up.upsert(stored, incoming, order=["seq"])


@query(
    "latest_by_id",
    """
    SELECT user_id, event_id, event_type FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) t WHERE r = 1
    """,
)
def latest_by_id(spark, d):
    return up.latest_by_id(table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).drop("ts")
