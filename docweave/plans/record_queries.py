"""Queries over spreadsheets, slides, pages and outlines."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from docweave.functions import paths
from docweave.operators import outline, pages as pg, sheets as sh, slides as sl
from docweave.plans import inputs as src
from docweave.plans.inputs import CELLS_SQL, LINES_PER_PAGE, SLIDES_SQL, table
from docweave.plans.registry import query
from docweave.schema import conform
from docweave.operators.files import inherit_fields

# --- cells ----------------------------------------------------------------------------


@query(
    "cell_ref_split",
    f"SELECT sheet, col, row, col_no, CAST(CASE WHEN row % 2 = 0 THEN 26 + col_no ELSE col_no END AS INTEGER) AS wide_no FROM ({CELLS_SQL}) c".replace(
        "row % 2 = 0", "value IS NULL"
    ),
)
def cell_ref_split(spark, d):
    """References put together from cells and taken apart again; empty cells in AA to AE."""
    made = src.cells(spark, d).select(
        "sheet", "col_no", F.concat("col", "row").alias("ref"),
        F.concat(F.when(F.col("value").isNull(), "A").otherwise(""), "col").alias("wide"),
    )
    parts = sh.split_cell_ref(F.col("ref"))
    return made.select("sheet", parts["col"].alias("col"), parts["row"].alias("row"), "col_no", sh.column_number(F.col("wide")).alias("wide_no"))


@query(
    "header_row",
    f"SELECT doc, sheet, min(row) AS header_row FROM ({CELLS_SQL}) c WHERE trim(coalesce(value, '')) <> '' GROUP BY 1, 2",
)
def header_row(spark, d):
    return sh.header_row(src.cells(spark, d))


_PLACED = f"""
c AS ({CELLS_SQL}),
h AS (SELECT doc, sheet, min(row) AS header_row FROM c WHERE trim(coalesce(value, '')) <> '' GROUP BY 1, 2),
n AS (SELECT c.doc, c.sheet, col_no, value AS header FROM c JOIN h ON c.doc = h.doc AND c.sheet = h.sheet AND row = header_row
      WHERE trim(coalesce(value, '')) <> ''),
j AS (SELECT c.doc, c.sheet, row, col, c.col_no, value, coalesce(header, 'column_' || col) AS header
      FROM c JOIN h ON c.doc = h.doc AND c.sheet = h.sheet AND row > header_row
      LEFT JOIN n ON c.doc = n.doc AND c.sheet = n.sheet AND c.col_no = n.col_no)
"""


@query("header_join", f"WITH {_PLACED} SELECT doc, sheet, row, col, col_no, value, header FROM j")
def header_join(spark, d):
    return sh.header_join(src.cells(spark, d)).select("doc", "sheet", "row", "col", "col_no", "value", "header")


@query(
    "sort_cells",
    f"SELECT doc, sheet, row, col_no, value, row_number() OVER (PARTITION BY doc, sheet, row ORDER BY col_no) AS place FROM ({CELLS_SQL}) c",
)
def sort_cells(spark, d):
    """Cells numbered in the order in which the sort delivers them."""
    ordered = sh.sort_cells(src.cells(spark, d)).withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(W.partitionBy("doc", "sheet", "row").orderBy("_at")).cast("long").alias("place")
    return ordered.select("doc", "sheet", "row", "col_no", "value", place)


def _sql_rows(header: str, value: str, kept: str) -> str:
    return f"""
    WITH {_PLACED},
    k AS (SELECT doc, sheet, row, col_no, {header} AS header, {value} AS value FROM j WHERE {kept}),
    w AS (SELECT *, row_number() OVER (PARTITION BY doc, sheet, row, header ORDER BY col_no DESC) AS r FROM k)
    SELECT doc, sheet, row AS row_number, string_agg(header || '=' || value, '|' ORDER BY header) FILTER (r = 1) AS record,
           string_agg(value, '|' ORDER BY col_no) AS text FROM w GROUP BY 1, 2, 3
    """


def _flat_rows(rows):
    pairs = F.sort_array(F.map_entries("record"))
    return rows.select(
        "doc",
        "sheet",
        "row_number",
        F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("record"),
        F.array_join("text", "|").alias("text"),
    )


@query("sheet_rows", _sql_rows("header", "value", "value IS NOT NULL"))
def sheet_rows(spark, d):
    return _flat_rows(sh.sheet_rows(src.cells(spark, d)))


@query(
    "xls_sheet_rows",
    _sql_rows(
        "replace(replace(header, '\"', ''), 'DT', 'date')", "replace(value, '\"', '')", "trim(replace(coalesce(value, ''), '\"', '')) <> ''"
    ),
)
def xls_sheet_rows(spark, d):
    return _flat_rows(sh.sheet_rows(src.cells(spark, d), legacy=True))


@query(
    "row_documents",
    f"WITH {_PLACED} SELECT DISTINCT '/accounts.xlsx#' || sheet || '#Row' || row AS unique_id, 'Excel' AS media_format FROM j WHERE value IS NOT NULL",
)
def row_documents(spark, d):
    """Row records with the fields of their workbook."""
    rows = sh.sheet_rows(src.cells(spark, d))
    books = src.cells(spark, d).select("doc").distinct().select(
        "doc", F.concat(F.lit("/srv/media/"), F.col("doc")).alias("path"), F.lit("Excel").alias("media_format"), F.lit("body").alias("content")
    )
    out = sh.row_documents(
        rows, books, paths.record_id(F.col("path"), src.ROOT, "Row", F.col("row_number"), F.col("sheet"))
    )
    return conform(out.withColumn("fields", F.col("record"))).select("unique_id", "media_format")


@query(
    "extra_cells",
    "SELECT 'accounts.xlsx' AS doc, 'customer' AS sheet, r_name AS content FROM region "
    "UNION ALL SELECT 'accounts.xlsx', 'part', p_name FROM part",
)
def extra_cells(spark, d):
    """Regions and part names as text boxes beside the grid of cells."""

    def boxes(name, sheet, column):
        return table(spark, d, name).select(
            F.lit("accounts.xlsx").alias("doc"), F.lit(sheet).alias("sheet"), F.lit(None).cast("int").alias("row"),
            F.lit(None).cast("string").alias("col"), F.lit(None).cast("int").alias("col_no"), F.col(column).alias("value"),
        )

    every = src.union_all([src.cells(spark, d), boxes("region", "customer", "r_name"), boxes("part", "part", "p_name")])
    return sh.extra_cells(every)


_ESC = "replace(replace(replace({v}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    "render_sheet_html",
    f"""
    WITH c AS ({CELLS_SQL}), m AS (SELECT doc, sheet, max(row) AS last FROM c GROUP BY 1, 2),
    r AS (SELECT doc, sheet, row, max(col_no) AS width FROM c GROUP BY 1, 2, 3),
    s AS (SELECT doc, sheet, unnest(generate_series(1, last)) AS line_no FROM m),
    t AS (SELECT s.doc, s.sheet, s.line_no, unnest(generate_series(1, coalesce(width, 1))) AS col_no
          FROM s LEFT JOIN r ON s.doc = r.doc AND s.sheet = r.sheet AND s.line_no = r.row),
    b AS (SELECT t.doc, t.sheet, t.line_no, '<tr>' || string_agg('<td>' || {_ESC.format(v="coalesce(value, '')")} || '</td>', '' ORDER BY t.col_no) || '</tr>' AS html
          FROM t LEFT JOIN c ON t.doc = c.doc AND t.sheet = c.sheet AND t.line_no = c.row AND t.col_no = c.col_no GROUP BY 1, 2, 3)
    SELECT doc, sheet, CAST(line_no AS BIGINT) AS line_no, html FROM b
    UNION ALL SELECT doc, sheet, 0, '<h1>' || sheet || '</h1><table>' FROM m
    UNION ALL SELECT doc, sheet, last + 1, '</table>' FROM m
    """,
)
def render_sheet_html(spark, d):
    out = sh.render_sheet_html(src.cells(spark, d))
    return out.withColumn("line_no", F.col("line_no").cast("long"))


# --- slides ---------------------------------------------------------------------------------

_COMMENTS = "['Author: ' || header || chr(10) || 'comment: ' || lines[1], 'comment: ' || lines[len(lines)]]"
_NOTES = "CASE WHEN lines[2] IS NOT NULL THEN concat_ws(chr(10), header, lines[2], footer) END"


@query(
    "slide_records",
    f"""
    SELECT replace(substr(doc, 11), ' ', '') || 'Slide' || slide_number AS unique_id, slide_number AS page_number, header, footer, content,
           array_to_string(list_filter(list_concat({_COMMENTS}, [{_NOTES}, content, header, footer]), lambda x: x IS NOT NULL), '|') AS text
    FROM ({SLIDES_SQL}) s
    """,
)
def slide_records(spark, d):
    out = sl.slide_records(src.slides(spark, d), src.ROOT)
    return out.select("unique_id", "page_number", "header", "footer", "content", F.array_join("text", "|").alias("text"))


@query(
    "slide_comments",
    f"SELECT doc, slide_number, array_to_string({_COMMENTS}, '|') AS comments FROM ({SLIDES_SQL}) s",
)
def slide_comments(spark, d):
    out = src.slides(spark, d)
    return out.select("doc", "slide_number", F.array_join(F.transform("comments", sl.comment_text), "|").alias("comments"))


@query("slide_notes", f"SELECT doc, slide_number, {_NOTES} AS notes FROM ({SLIDES_SQL}) s")
def slide_notes(spark, d):
    notes = sl.notes_text(F.col("header"), F.col("notes"), F.col("footer"))
    return src.slides(spark, d).select("doc", "slide_number", notes.alias("notes"))


@query(
    "slide_image_names",
    f"""
    SELECT doc, slide_number, string_agg('slide_' || slide_number || CASE WHEN k > 0 THEN '_' || k ELSE '' END
             || CASE WHEN ext <> 'gif' THEN '.' || ext ELSE '' END, '|' ORDER BY pos) AS names FROM (
      SELECT *, CAST(coalesce(sum(CASE WHEN ext <> 'gif' THEN 1 ELSE 0 END) OVER
              (PARTITION BY doc, slide_number ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS k
      FROM (SELECT doc, slide_number, pos, CASE WHEN length(line) < 30 THEN 'jpg' WHEN length(line) < 60 THEN 'png'
                   WHEN length(line) < 90 THEN 'gif' ELSE 'emf' END AS ext
            FROM (SELECT doc, slide_number, unnest(lines) AS line, unnest(generate_series(0, len(lines) - 1)) AS pos
                  FROM ({SLIDES_SQL}) s) a) b) c GROUP BY 1, 2
    """,
)
def slide_image_names(spark, d):
    names = sl.image_names(F.col("slide_number"), F.col("images")["ext"])
    return src.slides(spark, d).select("doc", "slide_number", F.array_join(names, "|").alias("names"))


@query(
    "slide_run_text",
    f"SELECT doc, slide_number, content AS on_slide, concat_ws(chr(10), lines[2], footer) AS on_master FROM ({SLIDES_SQL}) s",
)
def slide_run_text(spark, d):
    """Text runs of a slide and of its master, which hides title and body runs."""

    def run(kind, c):
        return F.struct(F.lit(kind).alias("run_type"), c.alias("text"))

    lines = F.split("content", "\n", -1)
    master = F.array(run(0, F.col("header")), run(1, F.col("content")), run(4, F.col("notes")), run(6, F.col("footer")))
    on_slide = F.transform(lines, lambda x: F.struct(F.lit(1).alias("run_type"), x.alias("text")))
    return src.slides(spark, d).select(
        "doc", "slide_number", sl.run_text(on_slide).alias("on_slide"), sl.run_text(master, master=True).alias("on_master")
    )


# --- pages -------------------------------------------------------------------------------------

_PAGES_SQL = """
SELECT doc_id, lang, source, text, CAST(p + 1 AS INTEGER) AS page_number, array_to_string(ls[p * 20 + 1 : p * 20 + 20], chr(10)) AS content
FROM (SELECT *, unnest(generate_series(0, CAST(ceil(len(ls) / 20.0) AS BIGINT) - 1)) AS p
      FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents) a) b
"""


def _paged(spark, d, *columns):
    docs = table(spark, d, "documents").select("doc_id", *columns, "text")
    return docs.withColumn("pages", pg.paginate(F.col("text"), LINES_PER_PAGE)).drop("text")


@query(
    "page_records",
    f"SELECT 'd' || doc_id || 'Page' || page_number AS unique_id, doc_id, page_number, content, lang, source FROM ({_PAGES_SQL}) p",
)
def page_records(spark, d):
    out = pg.page_records(_paged(spark, d, "lang", "source"))
    path = F.concat(F.lit("d"), F.col("doc_id"))
    return out.select(
        paths.record_id(path, "", "Page", F.col("page_number")).alias("unique_id"),
        "doc_id", "page_number", "content", "lang", "source",
    )


@query(
    "page_numbering",
    f"""
    SELECT doc_id, page_number FROM ({_PAGES_SQL}) p
    WHERE page_number >= CASE lang WHEN 'en' THEN 2 ELSE 1 END AND page_number <= CASE lang WHEN 'en' THEN 4 WHEN 'fr' THEN 1 ELSE 3 END
    """,
)
def page_numbering(spark, d):
    """Pages up to the third or up to a bookmark, from the first or a bookmark."""
    pages = pg.page_records(_paged(spark, d)).withColumnRenamed("doc_id", "doc")
    lang = F.col("lang")
    marks = table(spark, d, "documents").where(lang.isin("en", "fr")).select(
        F.col("doc_id").alias("doc"),
        F.when(lang == "en", 2).alias("start_page"),
        F.when(lang == "en", 4).otherwise(1).alias("end_page"),
    )
    marked = pg.select_pages(pages, 1, None, marks)
    open_ended = table(spark, d, "documents").where(~lang.isin("en", "fr")).select(F.col("doc_id").alias("doc"))
    third = pg.select_pages(marked.join(open_ended, "doc", "left_semi"), 1, 3)
    return marked.join(open_ended, "doc", "left_anti").unionByName(third).select(F.col("doc").alias("doc_id"), "page_number")


@query(
    "whole_document",
    f"""
    SELECT doc_id, page_number, content, source FROM ({_PAGES_SQL}) p WHERE len(string_split(text, chr(10))) > 20
    UNION ALL SELECT doc_id, NULL, text, source FROM documents WHERE len(string_split(text, chr(10))) <= 20
    """,
)
def whole_document(spark, d):
    """Documents of a single page have no page records and stay whole."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.col("text").alias("content"))
    parts = pg.paginate(F.col("content"), LINES_PER_PAGE)
    split = docs.withColumn("pages", F.when(F.size(F.split("content", "\n", -1)) > LINES_PER_PAGE, parts))
    return pg.with_fallback(split, "pages").select("doc_id", "page_number", "content", "source")


@query(
    "doc_field_copy",
    f"SELECT 'd' || doc_id || 'Page' || page_number AS unique_id, content, source AS source_nm, "
    f"'lang=' || lang AS metadata, page_number FROM ({_PAGES_SQL}) p",
)
def doc_field_copy(spark, d):
    """Page records joined back to their documents: every field but the content."""
    docs = table(spark, d, "documents")
    whole = docs.select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("path"),
        F.col("source").alias("source_nm"),
        F.create_map(F.lit("lang"), F.array("lang")).alias("metadata"),
        F.col("text").alias("content"),
    )
    pages = pg.page_records(_paged(spark, d)).select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("path"), "page_number", "content"
    )
    out = inherit_fields(pages, whole, "path")
    return out.select(
        paths.record_id(F.col("path"), "", "Page", F.col("page_number")).alias("unique_id"),
        "content", "source_nm",
        F.concat(F.lit("lang="), F.array_join(F.element_at("metadata", "lang"), "|")).alias("metadata"),
        "page_number",
    )


@query(
    "page_images",
    f"""
    SELECT doc_id, page_number, coalesce(string_agg(url, '|' ORDER BY pos), '') AS image_links FROM (
      SELECT doc_id, page_number, pos, CASE WHEN length(line) > 300 THEN 'img_' || page_number || '_' || pos || '.png' END AS url FROM (
        SELECT doc_id, page_number, unnest(ls) AS line, unnest(generate_series(0, len(ls) - 1)) AS pos
        FROM (SELECT doc_id, page_number, string_split(content, chr(10)) AS ls FROM ({_PAGES_SQL}) p) a) b) c GROUP BY 1, 2
    """,
)
def page_images(spark, d):
    """Long lines stand for images; pages without one keep an empty list."""
    pages = pg.page_records(_paged(spark, d))
    lines = pages.select("doc_id", "page_number", F.posexplode(F.split("content", "\n", -1)).alias("pos", "line"))
    images = lines.where(F.length("line") > 300).select(
        "doc_id", "page_number", "pos",
        F.concat(F.lit("img_"), F.col("page_number"), F.lit("_"), F.col("pos"), F.lit(".png")).alias("url"),
    )
    out = pg.attach_images(pages.drop("content"), images, ["doc_id", "page_number"])
    return out.select("doc_id", "page_number", F.array_join("image_links", "|").alias("image_links"))


@query(
    "annotations",
    """
    SELECT page_id, 'link' AS kind, a AS uri, NULL AS title, NULL AS contents FROM
      (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS a FROM pages) x
    UNION ALL SELECT page_id, 'markup', NULL, CASE WHEN contains(url, '#') THEN 'anchor' END, CASE WHEN contains(url, '?') THEN url END
      FROM pages WHERE contains(url, '#') OR contains(url, '?')
    """,
)
def annotations(spark, d):
    """Links of a page, one without address, and a markup that may be empty."""
    none = F.lit(None).cast("string")

    def annot(kind, uri=none, title=none, contents=none):
        return F.struct(
            F.lit(kind).alias("kind"), uri.alias("uri"), title.alias("title"), none.alias("subject"), contents.alias("contents")
        )

    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    made = F.concat(
        F.transform(hrefs, lambda a: annot("link", uri=a)),
        F.array(
            annot("link"),
            annot(
                "markup",
                title=F.when(F.contains("url", F.lit("#")), F.lit("anchor")),
                contents=F.when(F.contains("url", F.lit("?")), F.col("url")),
            ),
        ),
    )
    pages = table(spark, d, "pages").select("page_id", made.alias("annots"))
    return pg.annotations(pages, ["page_id"]).select("page_id", "kind", "uri", "title", "contents")


# --- outline ---------------------------------------------------------------------------------------


@query(
    "outline_flatten",
    """
    WITH RECURSIVE n AS (SELECT 'R' || r_regionkey AS id, NULL AS parent, r_regionkey AS ord, r_name AS title FROM region
      UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_nationkey, n_name FROM nation
      UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_custkey, c_name FROM customer
      UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey, o_orderkey, o_orderstatus FROM orders),
    t AS (SELECT id, title, 0 AS depth, lpad(CAST(ord AS VARCHAR), 19, '0') AS path FROM n WHERE parent IS NULL
      UNION ALL SELECT n.id, n.title, depth + 1, path || '/' || lpad(CAST(ord AS VARCHAR), 19, '0') FROM t JOIN n ON n.parent = t.id)
    SELECT 'world' AS doc, id, title, depth, path FROM t
    """,
)
def outline_flatten(spark, d):
    """Regions, nations, customers and orders as a bookmark tree."""

    def level(name, id_, parent, ord_, title):
        return table(spark, d, name).select(
            F.lit("world").alias("doc"), F.expr(id_).alias("id"), F.expr(parent).cast("string").alias("parent"),
            F.col(ord_).cast("long").alias("ord"), F.col(title).alias("title"),
        )

    nodes = src.union_all(
        [
            level("region", "'R' || r_regionkey", "NULL", "r_regionkey", "r_name"),
            level("nation", "'N' || n_nationkey", "'R' || n_regionkey", "n_nationkey", "n_name"),
            level("customer", "'C' || c_custkey", "'N' || c_nationkey", "c_custkey", "c_name"),
            level("orders", "'O' || o_orderkey", "'C' || o_custkey", "o_orderkey", "o_orderstatus"),
        ]
    )
    return outline.flatten_outline(nodes)


