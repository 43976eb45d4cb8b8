"""Pages of a document to one record each, and whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions.text import not_blank

# What a sub-record does not inherit from its document.
NOT_INHERITED = ("content",)


def paginate(text: Column, lines_per_page: int) -> Column:
    """Text cut into pages of a fixed number of lines."""
    lines = F.split(text, "\n", -1)
    pages = F.sequence(F.lit(0), F.ceil(F.size(lines) / lines_per_page).cast("int") - 1)
    return F.transform(
        pages, lambda p: F.array_join(F.slice(lines, p * lines_per_page + 1, lines_per_page), "\n")
    )


def page_records(docs: DataFrame, pages: str = "pages") -> DataFrame:
    """One row per page, numbered from 1, with every document column but content."""
    rest = [c for c in docs.columns if c not in (pages, *NOT_INHERITED)]
    return docs.select(*rest, F.posexplode(pages).alias("_pos", "content")).select(
        *rest, (F.col("_pos") + 1).alias("page_number"), "content"
    )


def join_sections(sections: Column) -> Column:
    """Sections of a page as one content, a line each."""
    return F.array_join(F.filter(sections, lambda s: not_blank(s).isNotNull()), "\n")


def select_pages(
    pages: DataFrame, start: int = 1, end: int | None = None, bookmarks: DataFrame | None = None
) -> DataFrame:
    """Pages from ``start`` to ``end``.

    ``bookmarks(doc, start_page, end_page)`` narrows the range per document; a
    missing bound leaves that side open.
    """
    out = pages.where(F.col("page_number") >= start)
    if end is not None:
        out = out.where(F.col("page_number") <= end)
    if bookmarks is not None:
        out = out.join(bookmarks, "doc", "left").where(
            (F.col("page_number") >= F.coalesce("start_page", F.lit(1)))
            & (F.col("end_page").isNull() | (F.col("page_number") <= F.col("end_page")))
        ).drop("start_page", "end_page")
    return out


def attach_images(pages: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """Each page with the links of its own images, in order.

    ``images`` holds the page keys, ``pos`` and ``url``; a page's images are few.
    """
    per_page = images.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "url"))).alias("_images"))
    joined = pages.join(per_page, keys, "left")
    links = F.coalesce(F.col("_images")["url"], F.array().cast("array<string>"))
    return joined.withColumn("image_links", links).drop("_images")


def with_fallback(docs: DataFrame, records: str, record_type: str = "string") -> DataFrame:
    """Sub-records of each document, or the document itself where it has none.

    ``page_number`` is null for a whole document; it keeps its content, which
    sub-records do not inherit.
    """
    rest = [c for c in docs.columns if c not in (records, "content")]
    return docs.select(*rest, "content", F.posexplode_outer(records).alias("_pos", "_record")).select(
        *rest,
        (F.col("_pos") + 1).alias("page_number"),
        F.when(F.col("_pos").isNull(), F.col("content")).otherwise(F.col("_record")).alias("content"),
    )


def annotations(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Links with an address, and markups with any of title, subject, contents.

    Input holds ``annots array<struct<kind,uri,title,subject,contents>>``.
    """
    flat = pages.select(*keys, F.posexplode("annots").alias("pos", "_a")).select(*keys, "pos", "_a.*")
    link = (F.col("kind") == "link") & F.col("uri").isNotNull()
    markup = (F.col("kind") == "markup") & F.coalesce("title", "subject", "contents").isNotNull()
    return flat.where(link | markup)


def asset_manifest(pages: DataFrame, keys: list[str], names: Column, url) -> DataFrame:
    """One row per extracted image: page, file name and public address."""
    flat = pages.select(*keys, F.posexplode(names).alias("pos", "name"))
    return flat.withColumn("url", url(F.col("name")))
