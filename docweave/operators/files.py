"""Documents from files: descriptive fields, sibling links, errors set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions import paths
from docweave.functions.media import has_content, kept_content, media_format
from docweave.operators import metadata as meta
from docweave.schema import conform


def sibling_links(files: DataFrame, location: str, prefix: str, root: str) -> DataFrame:
    """Original files linked to their translated copy, and copies to their original.

    A file is looked up by its computed path, once for both directions, in one
    join on the path.
    """
    is_copy = F.contains(F.col("path"), F.lit(f"/{location}/"))
    wanted = F.when(is_copy, paths.original_path(F.col("path"), location)).otherwise(
        paths.translated_path(F.col("path"), location)
    )
    there = files.select(F.col("path").alias("_there")).distinct()
    joined = files.withColumn("_wanted", wanted).join(there, F.col("_wanted") == F.col("_there"), "left")
    link = paths.web_link(F.col("_there"), prefix, root)
    return joined.withColumn("translated_link", F.when(~is_copy, link)).withColumn(
        "original_link", F.when(is_copy, link)
    ).drop("_wanted", "_there")


def file_documents(
    files: DataFrame,
    *,
    prefix: str,
    root: str,
    out_dir: str | None = None,
    collection: str | None = None,
    rules=(),
) -> DataFrame:
    """One document per file, before it is split into records.

    ``files`` holds path, content, content_type, application_name, author,
    last_author, last_modified and metadata.
    """
    path, content = F.col("path"), F.col("content")
    who = meta.author(F.col("author"), F.col("last_author"))
    tags = meta.source_tags(F.lit(collection).cast("string"), rules)
    body = kept_content(content)
    return conform(
        files.select(
            paths.record_id(path, root).alias("unique_id"),
            tags["source_nm"].alias("source_nm"),
            tags["categories_nm"].alias("categories_nm"),
            media_format(F.col("application_name"), F.col("content_type")).alias("media_format"),
            "path",
            paths.web_link(path, prefix, root).alias("web_link"),
            paths.html_link(path, content, prefix, root, out_dir).alias("html_link"),
            who.alias("author"),
            meta.last_modified(F.col("last_modified")).alias("last_modified"),
            "metadata",
            body.alias("content"),
            F.array_compact(F.array(who, path, body)).alias("text"),
            F.array_compact(F.array(body)).alias("text_rev"),
        )
    )


def inherit_fields(records: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Sub-records with every field of their document but content and those they set."""
    own = [c for c in records.columns if c != key]
    rest = [c for c in documents.columns if c not in own and c != "content"]
    return records.join(documents.select(*rest), key, "left")


def quarantine(parsed: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and rows that did not with the reason; neither stops the other."""
    marked = parsed.withColumn("error", error)
    return marked.where(F.col("error").isNull()).drop("error"), marked.where(F.col("error").isNotNull())


def non_empty(documents: DataFrame) -> DataFrame:
    """Documents with a usable content (for writing formatted copies)."""
    return documents.where(has_content(F.col("content")))
