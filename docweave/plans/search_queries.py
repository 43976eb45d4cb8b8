"""Facets, filters and search over documents."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import search
from docweave.plans.inputs import KEYS, KINDS, TABLES, documents_of, spread, sql_id, table, union_all
from docweave.plans.registry import query
from docweave.session import new_path
from docweave.sinks import store

DATED = ("orders", "lineitem", "events")
PRICED = ("customer", "supplier", "part", "orders", "lineitem")


def unified(spark, d, names):
    return union_all([documents_of(spark, d, n) for n in names])


@query(
    "facet_terms",
    "WITH t AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_nm FROM {t}" for t in TABLES) + """)
    SELECT 'table_nm' AS facet, table_nm AS value, count(*) AS n FROM t GROUP BY 2
    UNION ALL SELECT 'database_nm', 'warehouse', count(*) FROM t
    UNION ALL SELECT 'source_nm', 'warehouse', count(*) FROM t
    UNION ALL SELECT 'media_format', 'Database', count(*) FROM t""",
)
def facet_terms(spark, d):
    return search.facet_terms(unified(spark, d, TABLES))


@query(
    "facet_date_range",
    "SELECT strftime(date_trunc('month', x), '%Y-%m-%d') AS month, count(*) AS n_docs FROM "
    "(SELECT o_orderdate AS x FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events) t GROUP BY 1",
)
def facet_date_range(spark, d):
    out = search.facet_date_range(unified(spark, d, DATED), "month")
    return out.select(F.date_format("bucket", "yyyy-MM-dd").alias("month"), "n_docs")


@query(
    "facet_money_range",
    "SELECT CAST(floor(x / 10000) * 10000 AS BIGINT) AS bucket_low, count(*) AS n_docs FROM "
    "(SELECT c_acctbal AS x FROM customer UNION ALL SELECT s_acctbal FROM supplier UNION ALL SELECT p_retailprice FROM part "
    "UNION ALL SELECT o_totalprice FROM orders UNION ALL SELECT l_extendedprice FROM lineitem) t GROUP BY 1",
)
def facet_money_range(spark, d):
    out = search.facet_money_range(unified(spark, d, PRICED), 10000)
    return out.select(F.col("bucket_low").cast("long").alias("bucket_low"), "n_docs")


DATE_COLUMNS = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
MONEY_COLUMNS = (
    ("customer", "c_acctbal"), ("supplier", "s_acctbal"), ("part", "p_retailprice"), ("orders", "o_totalprice"), ("lineitem", "l_extendedprice"),
)


def _sql_within(columns, low: str, high: str) -> str:
    """Ids and tables of the rows in a range; rows of a table without a key have no id here."""
    parts = [
        f"SELECT {sql_id(t) if t in KEYS else 'NULL'} AS unique_id, '{t}' AS table_nm FROM {t} WHERE {c} >= {low} AND {c} < {high}"
        for t, c in columns
    ]
    return " UNION ALL ".join(parts)


def _found(documents):
    keyed = F.col("table_nm").isin(*KEYS)
    return documents.select(F.when(keyed, F.col("unique_id")).alias("unique_id"), "table_nm")


_SQL_DATES = _sql_within(DATE_COLUMNS, "TIMESTAMP '1997-03-01'", "TIMESTAMP '1997-09-01'")
_SQL_MONEY = _sql_within(MONEY_COLUMNS, "1000", "2500")


@query("filter_any_date", _SQL_DATES)
def filter_any_date(spark, d):
    return _found(search.filter_any_date(unified(spark, d, DATED), "1997-03-01", "1997-09-01"))


@query("filter_any_money", _SQL_MONEY)
def filter_any_money(spark, d):
    return _found(search.filter_any_money(unified(spark, d, PRICED), 1000, 2500))


@query("filter_stored", f"SELECT 'date' AS kind, * FROM ({_SQL_DATES}) t UNION ALL SELECT 'money', * FROM ({_SQL_MONEY}) t")
def filter_stored(spark, d):
    """Both filters over stored documents of all tables with dates or amounts, in the order that serves both."""
    path = new_path(spark, "clustered")
    names = sorted({*DATED, *PRICED})
    tables = [(table(spark, d, n), KINDS.get(n), partial(documents_of, spark, d, n)) for n in names]
    store.write_documents(store.clustered_tables(tables), path, folders=len(names))
    held = store.read_documents(spark, path)
    dates = _found(search.filter_any_date(held, "1997-03-01", "1997-09-01")).select(F.lit("date").alias("kind"), "*")
    return dates.union(_found(search.filter_any_money(held, 1000, 2500)).select(F.lit("money").alias("kind"), "*"))


_HITS = "CAST(len(list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}]+'), lambda x: x = 'ring')) AS BIGINT)"


def _sql_hits() -> str:
    parts = []
    for t, columns in (("documents", ("text", "lang", "source")), ("part", ("p_name", "p_brand", "p_type")), ("customer", ("c_name", "c_mktsegment"))):
        hits = " + ".join(_HITS.format(c=c) for c in columns)
        parts.append(f"SELECT '{t}' AS table_nm, {sql_id(t)} AS unique_id, {hits} AS hits FROM {t}")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) t WHERE hits > 0"


@query("keyword_search", _sql_hits())
def keyword_search(spark, d):
    whole = union_all(
        [documents_of(spark, d, t, spread(table(spark, d, t))) for t in ("documents", "part", "customer")]
    )
    return search.keyword_search(whole, "Ring").select("table_nm", "unique_id", "hits")


@query(
    "leading_wildcard",
    r"""
    SELECT DISTINCT doc_id, token FROM
      (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM documents) t
    WHERE token LIKE '%tion'
    """,
)
def leading_wildcard(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    path = new_path(spark, "tokens")
    search.write_reversed_index(search.reversed_tokens(docs, "doc_id", "text"), path)
    return search.leading_wildcard(spark.read.parquet(path), "Tion").select("doc_id", "token")


@query(
    "term_vectors",
    r"""
    SELECT doc_id, token, count(*) AS freq, min(pos) AS first_pos, string_agg(CAST(pos AS VARCHAR), '|' ORDER BY pos) AS positions
    FROM (SELECT doc_id, unnest(w) AS token, unnest(generate_series(0, len(w) - 1)) AS pos
          FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents) a WHERE len(w) > 0) t
    GROUP BY doc_id, token
    """,
)
def term_vectors(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    out = search.term_vectors(docs, "doc_id", "text", offsets=False)
    return out.withColumn("positions", F.array_join("positions", "|"))


@query(
    "term_offsets",
    r"""
    WITH w AS (SELECT doc_id, lower(text) AS t, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w,
                      regexp_split_to_array(lower(text), '[\p{L}\p{N}]+') AS g FROM documents),
    p AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS token, unnest(g[1:len(w)]) AS gap FROM w WHERE len(w) > 0),
    o AS (SELECT doc_id, token, i - 1 AS pos, sum(length(gap) + length(token)) OVER (PARTITION BY doc_id ORDER BY i) - length(token) AS off FROM p)
    SELECT doc_id, token, string_agg(CAST(CAST(off AS BIGINT) AS VARCHAR), '|' ORDER BY pos) AS offsets FROM o GROUP BY 1, 2
    """,
)
def term_offsets(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    out = search.term_vectors(docs, "doc_id", "text")
    return out.select("doc_id", "token", F.array_join("offsets", "|").alias("offsets"))


@query(
    "highlight",
    "SELECT doc_id, regexp_replace(text, '(?i)(tion)', '<em>\\1</em>', 'g') AS content FROM documents WHERE lower(text) LIKE '%tion%'",
)
def highlight(spark, d):
    docs = table(spark, d, "documents").where(F.contains(F.lower("text"), F.lit("tion")))
    return docs.select("doc_id", tx.highlight(F.col("text"), "tion").alias("content"))


# --- text functions ---------------------------------------------------------------------

_LIST_SQL = " ".join(
    f"WHEN regexp_full_match(w, '{p}') THEN '{k}'"
    for k, p in (
        ("dot", r"\."), ("number_dot", r"\d+\."), ("number_brackets", r"\[\d+\]"), ("number_paren", r"\d+\)"),
        ("upper_dot", r"[A-Z]\."), ("lower_dot", r"[a-z]\."), ("upper_paren", r"[A-Z]\)"), ("lower_paren", r"[a-z]\)"),
        ("upper_roman", r"[IVXL]+\."), ("lower_roman", r"[ivxl]+\."),
    )
)


@query(
    "list_item_kind",
    f"""
    SELECT doc_id, kind, count(*) AS n FROM (SELECT doc_id, coalesce(CASE {_LIST_SQL} END, 'none') AS kind FROM (
      SELECT doc_id, unnest([split_part(line, ' ', 1), '(' || n || ')', n || ')', '[' || n || ']', substr(line, 1, 1) || '.']) AS w
      FROM (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS n
            FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) a) b) c) e GROUP BY 1, 2
    """,
)
def list_item_kind(spark, d):
    """The first word of each line, and lines numbered and lettered in several ways."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    n = (F.col("i") + 1).cast("string")
    words = F.array(
        F.substring_index("line", " ", 1),
        F.concat(F.lit("("), n, F.lit(")")),
        F.concat(n, F.lit(")")),
        F.concat(F.lit("["), n, F.lit("]")),
        F.concat(F.substring("line", 1, 1), F.lit(".")),
    )
    kind = F.coalesce(tx.list_item_kind(F.col("w")), F.lit("none")).alias("kind")
    flat = lines.select("doc_id", F.explode(words).alias("w"))
    return flat.groupBy("doc_id", kind).agg(F.count(F.lit(1)).alias("n"))


_LATIN, _HEBREW, _ARABIC = "abcdefghijklmnopqrst", "אבגדהוזחטיכלמנסעפצקר", "ابتثجحخدذرزسشصضطظعغف"


@query(
    "rtl_dominant",
    f"""
    SELECT doc_id, length(regexp_replace(t, '[^\\p{{Arabic}}\\p{{Hebrew}}]', '', 'g')) AS n_rtl,
      length(regexp_replace(t, '[^\\p{{Arabic}}\\p{{Hebrew}}]', '', 'g'))
      > length(regexp_replace(t, '[^\\p{{L}}]|[\\p{{Arabic}}\\p{{Hebrew}}]', '', 'g')) AS rtl
    FROM (SELECT doc_id, CASE lang WHEN 'de' THEN translate(text, '{_LATIN}', '{_HEBREW}')
      WHEN 'fr' THEN translate(text, 'aeiou', 'ابتثج') ELSE text END AS t FROM documents) x
    """,
)
def rtl_dominant(spark, d):
    """German texts in Hebrew letters, French vowels in Arabic ones."""
    text = (
        F.when(F.col("lang") == "de", F.translate("text", _LATIN, _HEBREW))
        .when(F.col("lang") == "fr", F.translate("text", "aeiou", "ابتثج"))
        .otherwise(F.col("text"))
    )
    docs = table(spark, d, "documents").select("doc_id", text.alias("t"))
    return docs.select("doc_id", tx.rtl_count(F.col("t")).cast("long").alias("n_rtl"), tx.rtl_dominant(F.col("t")).alias("rtl"))


@query(
    "reverse_if_rtl",
    f"""
    SELECT conv_id, turn, string_agg(CASE WHEN regexp_full_match(w, '\\p{{Arabic}}{{2,}}') THEN reverse(w) ELSE w END, ' ' ORDER BY i) AS text
    FROM (SELECT conv_id, turn, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i FROM (
      SELECT conv_id, turn, string_split(translate(text, '{_LATIN}', '{_ARABIC}'), ' ') AS ws FROM conversations) a) b GROUP BY 1, 2
    """,
)
def reverse_if_rtl(spark, d):
    words = F.split(F.translate("text", _LATIN, _ARABIC), " ", -1)
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.array_join(F.transform(words, tx.reverse_if_rtl), " ").alias("text")
    )


@query("fold_ligatures", "SELECT doc_id, replace(replace(text, 'et', 'ffl'), 'er', 'fi') AS text FROM documents")
def fold_ligatures(spark, d):
    """Letter pairs set as ligatures, then spelled out."""
    set_ = F.replace(F.replace("text", F.lit("et"), F.lit("ﬄ")), F.lit("er"), F.lit("ﬁ"))
    return table(spark, d, "documents").select("doc_id", tx.fold_ligatures(set_).alias("text"))
