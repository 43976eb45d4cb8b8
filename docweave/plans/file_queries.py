"""Queries over files: links, formats, tags, content and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import media, paths
from docweave.operators import files as fl, metadata as meta, pages as pg, slides as sl
from docweave.plans import inputs as src
from docweave.plans.inputs import FILES_SQL, PREFIX, ROOT, SLIDES_SQL, documents_of, spread, table, union_all
from docweave.plans.registry import query
from docweave.session import new_path
from docweave.sinks import store
from docweave.sources import folder, markup


def _encode_sql(c: str) -> str:
    # form encoding keeps the star and encodes the tilde; DuckDB's does the opposite
    return (
        f"array_to_string(list_transform(string_split(rtrim({c}, '/'), '/'), "
        f"lambda s: replace(replace(replace(url_encode(s), '%3A', ':'), '%2A', '*'), '~', '%7E')), '/')"
    )


_WEB_SQL = _encode_sql("'http://host.example/media/' || substr(path, 12)")
_STEM = "regexp_replace(split_part(path, '/', -1), '\\.[^.]*$', '')"
_DIR = "regexp_extract(path, '^(.*)/[^/]*$', 1)"


@query("url_path_encode", f"SELECT page_id, {_encode_sql('url')} AS result FROM pages")
def url_path_encode(spark, d):
    return table(spark, d, "pages").select("page_id", paths.url_path_encode(F.col("url")).alias("result"))


@query("web_link", f"SELECT page_id, {_WEB_SQL} AS result FROM ({FILES_SQL}) f")
def web_link(spark, d):
    return src.files(spark, d).select("page_id", paths.web_link(F.col("path"), PREFIX, ROOT).alias("result"))


@query(
    "output_path",
    f"SELECT page_id, {_DIR} || '/PROCESSED_FILES/' || {_STEM} AS result, "
    f"'/out/' || split_part(split_part(path, '.', 1), '/', -1) AS in_folder FROM ({FILES_SQL}) f",
)
def output_path(spark, d):
    return src.files(spark, d).select(
        "page_id",
        paths.output_path(F.col("path")).alias("result"),
        paths.output_path(F.col("path"), "/out/").alias("in_folder"),
    )


_HTML_SQL = _encode_sql(
    f"'http://host.example/media' || substr({_DIR}, 11) || '/PROCESSED_FILES/' || {_STEM} || '/' || split_part(path, '/', -1) || '.html'"
)


@query(
    "html_link",
    f"SELECT page_id, CASE WHEN contains(url, '?') THEN NULL ELSE {_HTML_SQL} END AS result FROM ({FILES_SQL}) f",
)
def html_link(spark, d):
    """Pages with a query string have an empty body, so no copy."""
    body = F.when(F.contains("url", F.lit("?")), F.lit("<html><body/></html>")).otherwise(F.col("content"))
    return src.files(spark, d).select("page_id", paths.html_link(F.col("path"), body, PREFIX, ROOT).alias("result"))


@query(
    "asset_url",
    f"""
    SELECT page_id, 'http://host.example/' || CASE
        WHEN strpos(name, 'media') > 1 THEN substr(name, strpos(name, 'media'))
        WHEN name LIKE '/web/root%' THEN substr(name, 10)
        WHEN folder LIKE '/web/root%' THEN substr(folder, 10) || '/' || name
        ELSE name END AS result
    FROM (SELECT page_id, CASE WHEN url LIKE 'https%' THEN path WHEN contains(url, '.org') THEN '/web/root/' || page_id || '.png'
                 ELSE page_id || '.png' END AS name,
                 CASE WHEN contains(url, '.com') THEN '/web/root/out' ELSE '/tmp/out' END AS folder FROM ({FILES_SQL}) f) x
    """,
)
def asset_url(spark, d):
    small = F.concat(F.col("page_id"), F.lit(".png"))
    name = (
        F.when(F.startswith("url", F.lit("https")), F.col("path"))
        .when(F.contains("url", F.lit(".org")), F.concat(F.lit("/web/root/"), small))
        .otherwise(small)
    )
    out = F.when(F.contains("url", F.lit(".com")), F.lit("/web/root/out")).otherwise(F.lit("/tmp/out"))
    return src.files(spark, d).select(
        "page_id", paths.asset_url(name, "http://host.example", "/web/root", out).alias("result")
    )


@query(
    "record_id",
    f"SELECT page_id, replace(substr(path, 11), ' ', '') AS whole, "
    f"replace(substr(path, 11), ' ', '') || 'Slide' || page_id AS slide, "
    f"replace(substr(path, 11), ' ', '') || '#Sheet1#Row' || page_id AS in_sheet FROM ({FILES_SQL}) f",
)
def record_id(spark, d):
    p, n = F.col("path"), F.col("page_id")
    return src.files(spark, d).select(
        "page_id",
        paths.record_id(p, ROOT).alias("whole"),
        paths.record_id(p, ROOT, "Slide", n).alias("slide"),
        paths.record_id(p, ROOT, "Row", n, F.lit("Sheet 1")).alias("in_sheet"),
    )


_FORMAT_SQL = """CASE WHEN lower(raw) LIKE '%powerpoint%' THEN 'PowerPoint' WHEN lower(raw) LIKE '%excel%' THEN 'Excel'
  WHEN lower(raw) LIKE '%word%' THEN 'Word' WHEN lower(raw) LIKE '%spreadsheet%' THEN 'spreadsheet'
  WHEN lower(raw) LIKE '%presentation%' THEN ' office presentation' ELSE raw END"""


@query(
    "media_format",
    f"SELECT page_id, {_FORMAT_SQL} AS result FROM (SELECT page_id, coalesce(application_name, content_type) AS raw FROM ({FILES_SQL}) f) g",
)
def media_format(spark, d):
    return src.files(spark, d).select(
        "page_id", media.media_format(F.col("application_name"), F.col("content_type")).alias("result")
    )


@query(
    "author_coalesce",
    f"SELECT page_id, coalesce(author, last_author) AS result, CASE WHEN coalesce(author, last_author) IS NULL THEN path "
    f"ELSE coalesce(author, last_author) || '|' || path END AS text FROM ({FILES_SQL}) f",
)
def author_coalesce(spark, d):
    who = meta.author(F.col("author"), F.col("last_author"))
    return src.files(spark, d).select(
        "page_id", who.alias("result"), F.array_join(F.array_compact(F.array(who, F.col("path"))), "|").alias("text")
    )


@query(
    "last_modified",
    "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS result FROM events",
)
def last_modified(spark, d):
    """A readable time for some events, something else or nothing for others."""
    given = F.when(F.col("event_type").isin("view", "click"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(
        F.col("event_type") == "error", F.lit("last week")
    )
    return table(spark, d, "events").select(
        "event_id", F.date_format(meta.last_modified(given), "yyyy-MM-dd HH:mm:ss").alias("result")
    )


# Rules of the source-tag queries: contained word, source, categories.
TAG_RULES = [("blog.", "Blogs", ["web log", "opinion"]), (".org", "Organisations", ["public"]), ("m.", "Mobile", [])]


@query(
    "source_tags",
    """
    SELECT page_id, CASE WHEN lower(h) LIKE '%blog.%' THEN 'Blogs' WHEN lower(h) LIKE '%.org%' THEN 'Organisations'
                         WHEN lower(h) LIKE '%m.%' THEN 'Mobile' ELSE h END AS result,
           CASE WHEN lower(h) LIKE '%blog.%' THEN 'web log|opinion' WHEN lower(h) LIKE '%.org%' THEN 'public' ELSE '' END AS categories
    FROM (SELECT page_id, split_part(url, '/', 3) AS h FROM pages) p
    """,
)
def source_tags(spark, d):
    host = F.split_part(F.col("url"), F.lit("/"), F.lit(3))
    tags = meta.source_tags(F.col("h"), TAG_RULES)
    return (
        table(spark, d, "pages")
        .select("page_id", host.alias("h"))
        .select("page_id", tags["source_nm"].alias("result"), F.array_join(tags["categories_nm"], "|").alias("categories"))
    )


@query(
    "content_sanitize",
    """
    SELECT page_id, replace(replace(replace(regexp_replace(html, '(?is)<title>.*?</title>', '<title/>'),
      '<title/>', '<title>Untitled</title>'), '<body>', '<body><pre>'), '</body>', '</pre></body>') AS content FROM pages
    """,
)
def content_sanitize(spark, d):
    """Pages whose title was emptied first."""
    emptied = F.regexp_replace("html", r"(?is)<title>.*?</title>", "<title/>")
    return table(spark, d, "pages").select("page_id", media.sanitize_content(emptied).alias("content"))


@query(
    "empty_content_filter",
    "SELECT page_id, CASE WHEN contains(url, '?') OR contains(url, '#') THEN NULL ELSE html END AS content FROM pages",
)
def empty_content_filter(spark, d):
    """Pages emptied in two ways keep their row and lose their content."""
    body = (
        F.when(F.contains("url", F.lit("?")), F.lit("<html><body/></html>"))
        .when(F.contains("url", F.lit("#")), F.lit(" \t\r\n"))
        .otherwise(F.col("html"))
    )
    return table(spark, d, "pages").select("page_id", media.kept_content(body).alias("content"))


_SIBLINGS_SQL = f"""
WITH f AS ({FILES_SQL}), a AS (
  SELECT page_id, path FROM f
  UNION ALL SELECT page_id, {_DIR} || '/en/' || {_STEM} || '.docx' FROM f WHERE url LIKE 'https%'
  UNION ALL SELECT page_id, {_DIR} || '/' || {_STEM} || '.pdf' FROM f WHERE contains(url, '?')),
w AS (SELECT page_id, path, contains(path, '/en/') AS is_copy,
  CASE WHEN contains(path, '/en/') THEN regexp_replace(replace(path, '/en/', '/'), '\\.docx$', '.pdf')
       ELSE {_DIR} || '/en/' || {_STEM} || '.docx' END AS wanted FROM a),
j AS (SELECT w.*, t.path AS there FROM w LEFT JOIN (SELECT DISTINCT path FROM a) t ON wanted = t.path)
SELECT page_id, path, CASE WHEN NOT is_copy THEN link END AS translated_link, CASE WHEN is_copy THEN link END AS original_link
FROM (SELECT *, {_encode_sql("'http://host.example/media/' || substr(there, 12)")} AS link FROM j) k
"""


@query("sibling_links", _SIBLINGS_SQL)
def sibling_links(spark, d):
    """Files, translated copies of some, and originals of some of those."""
    files = src.files(spark, d)
    p = F.col("path")
    copies = files.where("url like 'https%'").select("page_id", paths.translated_path(p, "en").alias("path"))
    originals = files.where(F.contains("url", F.lit("?"))).select(
        "page_id", F.regexp_replace(p, r"\.[^./]*$", ".pdf").alias("path")
    )
    every = files.select("page_id", "path").unionByName(copies).unionByName(originals)
    return fl.sibling_links(every, "en", PREFIX, ROOT)


_TEXT_SQL = r"""trim(regexp_replace({entities}, '[\s\x{{00A0}}]+', ' ', 'g'))"""


def _sql_entities(c: str) -> str:
    for name, ch in markup.ENTITIES:
        q = ch.replace("'", "''")
        c = f"replace({c}, '{name}', '{q}')"
    return c


_BARE = (
    r"regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<head\b.*?</head\s*>', ' ', 'g'), "
    r"'(?s)<[^>]*>', ' ', 'g')"
)


@query(
    "html_extract",
    "SELECT page_id, trim("
    + _sql_entities("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    + ") AS title, CAST(len(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)) AS BIGINT) AS n_links, "
    + "array_to_string(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1), '|') AS links, "
    + "trim(regexp_replace("
    + _sql_entities(_BARE)
    + r", '[\s\x{00A0}]+', ' ', 'g')) AS text FROM pages",
)
def html_extract(spark, d):
    out = markup.html_extract(spread(table(spark, d, "pages")))
    return out.select(
        "page_id",
        "title",
        F.size("links").cast("long").alias("n_links"),
        F.array_join("links", "|").alias("links"),
        "text",
    )


@query(
    "html_meta",
    "SELECT page_id, lang AS description, split_part(url, '/', 3) AS author FROM "
    "(SELECT *, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages) p",
)
def html_meta(spark, d):
    """Named meta tags put into the head of each page and read back."""
    head = F.concat(
        F.lit('<meta name="author" content="'),
        F.split_part(F.col("url"), F.lit("/"), F.lit(3)),
        F.lit("\"><META content='"),
        F.regexp_extract("html", '<html lang="([^"]*)"', 1),
        F.lit("' name='description'/>"),
        F.col("html"),
    )
    tags = markup.meta_tags(F.col("head"))
    return (
        table(spark, d, "pages")
        .select("page_id", head.alias("head"))
        .select("page_id", tags.alias("m"))
        .select(
            "page_id",
            F.array_join(F.try_element_at("m", F.lit("description")), "|").alias("description"),
            F.array_join(F.try_element_at("m", F.lit("author")), "|").alias("author"),
        )
    )


# --- metadata ---------------------------------------------------------------------------


@query(
    "metadata_collect",
    r"""
    SELECT page_id, 'link' AS key, array_to_string(l, '|') AS value FROM
      (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages) a WHERE len(l) > 0
    UNION ALL SELECT page_id, 'heading', array_to_string(h, '|') FROM
      (SELECT page_id, regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1) AS h FROM pages) b WHERE len(h) > 0
    UNION ALL SELECT page_id, 'url', 'set' FROM pages
    """,
)
def metadata_collect(spark, d):
    """Repeated keys from page markup; the address is overwritten."""
    found = F.concat(
        F.transform(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)), lambda v: F.struct(F.lit("link").alias("key"), v.alias("value"))),
        F.transform(F.regexp_extract_all("html", F.lit("(?s)<h1>(.*?)</h1>"), F.lit(1)), lambda v: F.struct(F.lit("heading").alias("key"), v.alias("value"))),
        F.array(F.struct(F.lit("url").alias("key"), F.col("url").alias("value"))),
    )
    rows = table(spark, d, "pages").select("page_id", found.alias("e"))
    collected = rows.select("page_id", meta.set_metadata(meta.collect_metadata(F.col("e")), "url", F.lit("set")).alias("m"))
    return collected.select("page_id", F.explode("m").alias("key", "v")).select(
        "page_id", "key", F.array_join("v", "|").alias("value")
    )


@query(
    "doc_info_metadata",
    """
    SELECT doc_id, 'page_count' AS key, CAST(ceil(len(string_split(text, chr(10))) / 20.0) AS BIGINT)::VARCHAR AS value FROM documents
    UNION ALL SELECT doc_id, 'title', split_part(text, chr(10), 1) FROM documents
    UNION ALL SELECT doc_id, 'creator', source FROM documents
    UNION ALL SELECT doc_id, 'keywords', lang FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, 'Reviewed-By', source FROM documents
    """,
)
def doc_info_metadata(spark, d):
    docs = table(spark, d, "documents")
    info = F.create_map(
        F.lit("Title"), F.substring_index("text", "\n", 1),
        F.lit("Author"), F.col("source"),
        F.lit("Keywords"), F.when(F.col("lang") != "en", F.col("lang")),
        F.lit("Reviewed-By"), F.col("source"),
    )
    pages = F.ceil(F.size(F.split("text", "\n", -1)) / src.LINES_PER_PAGE).cast("long")
    out = docs.select("doc_id", info.alias("i"), pages.alias("n")).select("doc_id", meta.document_info(F.col("i"), F.col("n")).alias("m"))
    return out.select("doc_id", F.explode("m").alias("key", "value"))


@query(
    "external_metadata",
    """
    SELECT event_id, 'xmpDM:audioCompressor' AS key, event_type AS value FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, 'xmpDM:audioChannelType', CASE WHEN user_id < 50 THEN 'mono' ELSE 'stereo' END FROM events
      WHERE event_type IN ('view', 'click')
    """,
)
def external_metadata(spark, d):
    """Tool output made from events: no audio stream for errors, channels for some."""
    channels = F.when(F.col("user_id") < 50, F.lit("mono")).otherwise(F.lit("stereo"))
    audio = F.concat(F.lit("  Stream #0.1: Audio: "), F.col("event_type"), F.lit(", 44100 Hz"))
    line = F.when(F.col("event_type") == "error", F.lit("  Stream #0.0: Video: h264, 25 fps")).when(
        F.col("event_type").isin("view", "click"), F.concat(audio, F.lit(", "), channels, F.lit(", s16"))
    ).otherwise(audio)
    rows = table(spark, d, "events").select("event_id", F.inline(meta.tool_metadata(line)))
    return rows


# --- images and errors ----------------------------------------------------------------------

_PAGE_DOCS = src.LINES_PER_PAGE


@query(
    "asset_manifest",
    f"""
    SELECT doc, slide_number, pos, name, 'http://host.example/' || substr(name, strpos(name, 'media')) AS url FROM (
      SELECT doc, slide_number, pos, '/x/media/slide_' || slide_number || CASE WHEN k > 0 THEN '_' || k ELSE '' END
             || CASE WHEN ext <> 'gif' THEN '.' || ext ELSE '' END AS name FROM (
        SELECT *, CAST(coalesce(sum(CASE WHEN ext <> 'gif' THEN 1 ELSE 0 END) OVER
                (PARTITION BY doc, slide_number ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS k
        FROM (SELECT doc, slide_number, pos, CASE WHEN length(line) < 30 THEN 'jpg' WHEN length(line) < 60 THEN 'png'
                     WHEN length(line) < 90 THEN 'gif' ELSE 'emf' END AS ext
              FROM (SELECT doc, slide_number, unnest(lines) AS line, unnest(generate_series(0, len(lines) - 1)) AS pos
                    FROM ({SLIDES_SQL}) s) a) b) c) e
    """,
)
def asset_manifest(spark, d):
    named = F.transform(
        sl.image_names(F.col("slide_number"), F.col("images")["ext"]), lambda n: F.concat(F.lit("/x/media/"), n)
    )
    return pg.asset_manifest(
        src.slides(spark, d),
        ["doc", "slide_number"],
        named,
        lambda n: paths.asset_url(n, "http://host.example", "/web", F.lit("/out")),
    )


@query(
    "quarantine",
    "SELECT page_id, CASE WHEN contains(html, '</html>') THEN 'good' ELSE 'bad' END AS part, "
    "CASE WHEN NOT contains(html, '</html>') THEN 'page is cut off' END AS error FROM pages",
)
def quarantine(spark, d):
    """Pages without an end are set apart, the others go on."""
    cut = F.when(~F.contains("html", F.lit("</html>")), F.lit("page is cut off"))
    good, bad = fl.quarantine(table(spark, d, "pages"), cut)
    return good.select("page_id", F.lit("good").alias("part"), F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("page_id", F.lit("bad").alias("part"), "error")
    )


@query(
    "folder_scan",
    "SELECT name || '.parquet' AS name, true AS has_bytes, 'application/vnd.apache.parquet' AS content_type FROM (VALUES "
    + ", ".join(f"('{t}')" for t in src.TABLES)
    + ") AS t(name)",
)
def folder_scan(spark, d):
    """The folder of given tables itself as a folder of files."""
    files = folder.with_media_type(folder.folder_scan(spark, d))
    name = F.regexp_extract("path", r"([^/]+\.parquet)(?:/[^/]*)?$", 1).alias("name")
    return files.select(name, (F.col("length") > 0).alias("has_bytes"), "content_type")


@query(
    "file_documents",
    f"SELECT replace(substr(path, 11), ' ', '') AS unique_id, CASE WHEN contains(path, 'site') THEN 'Web' END AS source_nm, {_WEB_SQL} AS web_link, "
    f"{_HTML_SQL} AS html_link, coalesce(author, last_author) AS author, "
    f"CAST(2 + CASE WHEN coalesce(author, last_author) IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_text FROM ({FILES_SQL}) f",
)
def file_documents(spark, d):
    files = src.files(spark, d).withColumn("last_modified", F.lit(None).cast("string")).withColumn(
        "metadata", F.create_map(F.lit("url"), F.array("url"))
    )
    docs = fl.file_documents(files, prefix=PREFIX, root=ROOT, collection="my site", rules=[("site", "Web", ["pages"])])
    return docs.select("unique_id", "source_nm", "web_link", "html_link", "author", F.size("text").cast("long").alias("n_text"))


# --- stored documents -------------------------------------------------------------------------


@query(
    "write_documents",
    "SELECT 'orders' AS table_nm, count(*) AS n, count(*) AS n_ids FROM orders UNION ALL SELECT 'customer', count(*), count(*) FROM customer",
)
def write_documents(spark, d):
    """Written by table, a part of the orders written again by id, and read back."""
    path = new_path(spark, "documents")
    store.write_documents(union_all([documents_of(spark, d, t) for t in ("orders", "customer")]), path)
    again = documents_of(spark, d, "orders", table(spark, d, "orders").where("o_orderstatus = 'O'"))
    store.upsert_documents(again, path)
    held = store.read_documents(spark, path)
    return held.groupBy("table_nm").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("unique_id").alias("n_ids")
    )


@query(
    "write_rendered",
    f"SELECT {_DIR} || '/PROCESSED_FILES/' || {_STEM} || '/' || split_part(path, '/', -1) || '.html' AS copy_path, "
    f"CAST(length(content) AS BIGINT) AS n_chars FROM ({FILES_SQL}) f",
)
def write_rendered(spark, d):
    path = new_path(spark, "copies")
    files = src.files(spark, d)
    store.write_rendered(files.withColumn("output_path", paths.output_path(F.col("path"))), path)
    return spark.read.parquet(path).select("copy_path", F.length("content").cast("long").alias("n_chars"))


@query(
    "ingest_metrics",
    "SELECT count(*) AS rows, count(*) AS rows_with_text, count(*) AS dates, count(*) AS amounts FROM orders",
)
def ingest_metrics(spark, d):
    """Counters filled in the pass that writes the documents."""
    docs, seen = store.observed(documents_of(spark, d, "orders"))
    docs.write.format("noop").mode("overwrite").save()
    counts = {k: int(v) for k, v in seen.get.items()}
    return spark.createDataFrame([counts], "rows long, rows_with_text long, dates long, amounts long")
