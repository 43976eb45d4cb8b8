"""Slides of a presentation to one record each.

``slides(doc, slide_number, header, footer, content, comments, notes, images)``
with ``comments array<struct<author,text>>`` and ``images array<struct<name?,ext>>``
in drawing order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions.paths import record_id

# Picture types that are numbered and get an extension.
PICTURE_TYPES = ("jpg", "png", "emf", "wmf", "pict")

# Text-run types left out on a master slide (title and body).
MASTER_RUNS = (0, 1)


def run_text(runs: Column, master: bool = False) -> Column:
    """Text of ``array<struct<run_type,text>>``, a line per run."""
    shown = F.filter(runs, lambda r: r["text"].isNotNull())
    if master:
        shown = F.filter(shown, lambda r: ~r["run_type"].isin(*MASTER_RUNS))
    return F.array_join(shown["text"], "\n")


def comment_text(comment: Column) -> Column:
    """Author and text of a comment, both optional."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Author: "), comment["author"]),
        F.concat(F.lit("comment: "), comment["text"]),
    )


def notes_text(header: Column, notes: Column, footer: Column) -> Column:
    """Notes between their header and footer; null without notes."""
    return F.when(notes.isNotNull(), F.concat_ws("\n", header, notes, footer))


def image_names(slide_number: Column, extensions: Column) -> Column:
    """``slide_<n>[_<k>].<ext>`` for each image of a slide.

    *k* counts the recognised images before it and is left out for the first.
    An unknown type gets no extension.
    """

    def known(e: Column) -> Column:
        return e.isin(*PICTURE_TYPES)

    def name(e: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(extensions, 1, i), known))
        return F.concat(
            F.lit("slide_"),
            slide_number.cast("string"),
            F.when(before > 0, F.concat(F.lit("_"), before.cast("string"))).otherwise(F.lit("")),
            F.when(known(e), F.concat(F.lit("."), e)).otherwise(F.lit("")),
        )

    return F.transform(extensions, name)


def slide_records(slides: DataFrame, root: str = "") -> DataFrame:
    """One record per slide; ``text`` holds every part that is present.

    A projection: slides already are rows, so a huge deck is no hot group.
    """
    comments = F.transform("comments", comment_text)
    notes = notes_text(F.col("header"), F.col("notes"), F.col("footer"))
    parts = F.concat(
        F.coalesce(comments, F.array().cast("array<string>")),
        F.array(notes, F.col("content"), F.col("header"), F.col("footer")),
    )
    return slides.select(
        record_id(F.col("doc"), root, "Slide", F.col("slide_number")).alias("unique_id"),
        F.col("doc").alias("path"),
        F.col("slide_number").alias("page_number"),
        "header",
        "footer",
        "content",
        comments.alias("comments"),
        F.array_compact(F.array(notes)).alias("notes"),
        image_names(F.col("slide_number"), F.col("images")["ext"]).alias("image_links"),
        F.array_compact(parts).alias("text"),
    )
