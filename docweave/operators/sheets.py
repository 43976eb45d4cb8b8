"""Spreadsheet cells to row records and formatted sheets.

Input is one long table of cells, whatever read them:
``cells(doc, sheet, row, col, col_no, value)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions.text import bind, not_blank

SHEET = ["doc", "sheet"]


def split_cell_ref(ref: Column) -> Column:
    """``AB12`` as ``struct(col, row)``."""
    return F.struct(
        F.regexp_replace(ref, r"\d", "").alias("col"),
        F.regexp_replace(ref, r"\D", "").try_cast("int").alias("row"),
    )


def column_number(letters: Column) -> Column:
    """1-based number of a column from its letters."""
    return F.aggregate(
        F.regexp_extract_all(F.upper(letters), F.lit("[A-Z]"), F.lit(0)),
        F.lit(0),
        lambda acc, ch: acc * 26 + F.ascii(ch) - 64,
    )


def header_row(cells: DataFrame) -> DataFrame:
    """Number of the first non-empty row of each sheet.

    An aggregate with map-side combine; no window over a whole sheet.
    """
    filled = cells.where(F.col("row").isNotNull() & not_blank(F.col("value")).isNotNull())
    return filled.groupBy(*SHEET).agg(F.min("row").alias("header_row"))


def _with_header(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("row").isNotNull()).join(header_row(cells), SHEET)


def header_join(cells: DataFrame) -> DataFrame:
    """Every data cell with the header of its column, ``column_<ref>`` without one."""
    placed = _with_header(cells)
    names = (
        placed.where((F.col("row") == F.col("header_row")) & not_blank(F.col("value")).isNotNull())
        .groupBy(*SHEET, "col_no")
        .agg(F.max("value").alias("header"))
    )
    data = placed.where(F.col("row") > F.col("header_row")).drop("header_row")
    joined = data.join(names, [*SHEET, "col_no"], "left")
    return joined.withColumn("header", F.coalesce("header", F.concat(F.lit("column_"), F.col("col"))))


def sort_cells(cells: DataFrame) -> DataFrame:
    """Cells by sheet, then row, then column: a range sort."""
    return cells.orderBy("doc", "sheet", "row", "col_no")


def _last_per_header(entries: Column) -> Column:
    # one entry per header, the one in the last column
    return bind(
        F.sort_array(entries),
        lambda s: F.filter(s, lambda e, i: (i == F.size(s) - 1) | (F.get(s, i + 1)["header"] != e["header"])),
    )


def sheet_rows(cells: DataFrame, legacy: bool = False) -> DataFrame:
    """One record per data row: header to value, and the values in column order.

    The first non-empty row is the header. Missing values are left out, a
    column without header is named after its letters, and of columns sharing a
    header the last one wins. ``legacy`` applies the rules of the old binary
    format: quotes are dropped and ``DT`` in a header reads ``date``.

    Cells meet once, by row (a row is as wide as its sheet); the header is then
    picked from those rows and joined back, spread over rows of a large sheet.
    Where cells have a ``date``, the times of a row are its ``date_text``.
    """
    dated = "date" in cells.columns
    held = F.struct("col_no", "col", "value", *(["date"] if dated else []))
    by_row = cells.where(F.col("row").isNotNull()).groupBy(*SHEET, "row").agg(F.collect_list(held).alias("_cells"))
    filled = F.exists("_cells", lambda e: not_blank(e["value"]).isNotNull())
    headers = by_row.where(filled).groupBy(*SHEET).agg(
        F.min("row").alias("_header_row"), F.min_by("_cells", "row").alias("_header")
    )
    headers = headers.withColumn("_names", _filled(F.col("_header"))).drop("_header")
    placed = by_row.join(headers, SHEET).where(
        F.col("row") > F.col("_header_row")
    )

    def named(e: Column) -> Column:
        own = not_blank(F.get("_names", e["col_no"] - 1))
        name = F.coalesce(own, F.concat(F.lit("column_"), e["col"]))
        value = e["value"]
        if legacy:
            name = F.replace(F.replace(name, F.lit('"'), F.lit("")), F.lit("DT"), F.lit("date"))
            value = not_blank(F.replace(value, F.lit('"'), F.lit("")))
        return F.struct(name.alias("header"), e["col_no"].alias("col_no"), value.alias("value"))

    entries = F.filter(F.transform("_cells", named), lambda e: e["value"].isNotNull())
    times = F.transform(F.sort_array(F.filter("_cells", lambda e: e["date"].isNotNull())), lambda e: e["date"]) if dated else None
    kept = [*SHEET, "row", *([times.alias("date_text")] if dated else [])]
    rows = placed.select(*kept, entries.alias("_entries")).where(F.size("_entries") > 0)
    record = F.map_from_entries(
        F.transform(_last_per_header(F.col("_entries")), lambda e: F.struct(e["header"], e["value"]))
    )
    in_order = F.sort_array(F.transform("_entries", lambda e: F.struct(e["col_no"], e["value"])))
    return rows.select(
        *SHEET,
        F.col("row").alias("row_number"),
        record.alias("record"),
        in_order["value"].alias("text"),
        *(["date_text"] if dated else []),
    )


def extra_cells(cells: DataFrame) -> DataFrame:
    """Text outside the grid (chart titles, text boxes), kept as blocks of its own.

    Where cells have a ``kind``, page headers, flags and cells that only lack a
    reference are no such text.
    """
    if "kind" in cells.columns:
        cells = cells.where(F.col("kind") == "shape")
    return cells.where(F.col("row").isNull() & not_blank(F.col("value")).isNotNull()).select(
        *SHEET, F.col("value").alias("content")
    )


def escape_html(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def render_sheet_html(cells: DataFrame) -> DataFrame:
    """A sheet as numbered lines of HTML.

    Line 0 opens the table, line *n* is row *n* with every gap filled, the last
    line closes it. A sheet is never built in one value, so its size is free.
    """
    by_row = cells.where(F.col("row").isNotNull()).groupBy(*SHEET, "row").agg(
        F.collect_list(F.struct("col_no", F.coalesce("value", F.lit("")).alias("value"))).alias("_cells")
    )
    rows = by_row.select(
        *SHEET,
        F.col("row").alias("line_no"),
        _filled(F.col("_cells")).alias("_values"),
    )
    ends = by_row.groupBy(*SHEET).agg(F.max("row").alias("_last"))
    every = ends.select(*SHEET, F.explode(F.sequence(F.lit(1), "_last")).alias("line_no"))
    body = every.join(rows, [*SHEET, "line_no"], "left").select(
        *SHEET,
        "line_no",
        F.concat(
            F.lit("<tr>"),
            F.array_join(
                F.transform(
                    F.coalesce("_values", F.array(F.lit(""))),
                    lambda v: F.concat(F.lit("<td>"), escape_html(v), F.lit("</td>")),
                ),
                "",
            ),
            F.lit("</tr>"),
        ).alias("html"),
    )
    top = F.concat(F.lit("<h1>"), escape_html(F.col("sheet")), F.lit("</h1><table>"))
    return body.unionByName(ends.select(*SHEET, F.lit(0).alias("line_no"), top.alias("html"))).unionByName(
        ends.select(*SHEET, (F.col("_last") + 1).alias("line_no"), F.lit("</table>").alias("html"))
    )


def _filled(entries: Column) -> Column:
    # values by column number from 1 to the last column, gaps as empty text
    return bind(
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["col_no"], e["value"]))),
        lambda m: F.transform(
            F.sequence(F.lit(1), F.array_max(F.map_keys(m))),
            lambda c: F.coalesce(F.try_element_at(m, c), F.lit("")),
        ),
    )


def row_documents(rows: DataFrame, parents: DataFrame, id_of: Column) -> DataFrame:
    """Row records with the fields of their file, all but content and metadata."""
    inherited = [c for c in parents.columns if c not in ("content", "metadata")]
    joined = rows.join(parents.select(*inherited), "doc", "left")
    return joined.withColumn("unique_id", id_of)
