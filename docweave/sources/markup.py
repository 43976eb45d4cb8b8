"""HTML pages, feeds and XML metadata."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.functions.text import bind, strip
from docweave.operators.metadata import collect_metadata

# Entities resolved in visible text; the ampersand comes last.
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&amp;", "&"),
]

# What is not visible text, and what ends a word.
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<head\b.*?</head\s*>"
TAG = r"(?s)<[^>]*>"
SPACES = r"[\s\x{00A0}]+"


# Named entities as the standard library lists them, by code point in hex.
_NAMED = ",".join(f"{name}:{point:X}" for name, point in name2codepoint.items() if name not in ("nbsp", "amp"))
_ENTITY = r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z]\w{1,15});"


def unescape(c: Column) -> Column:
    """Resolve named and numeric entities; unknown ones stay, the ampersand comes last."""

    def resolved(text: Column, entity: Column) -> Column:
        name = F.btrim(entity, F.lit("&;"))
        point = (
            F.when(F.rlike(name, F.lit("^#[xX]")), F.substr(name, F.lit(3)))
            .when(F.startswith(name, F.lit("#")), F.conv(F.substr(name, F.lit(2)), 10, 16))
            .otherwise(F.try_element_at(F.expr(f"str_to_map('{_NAMED}', ',', ':')"), name))
        )
        number = F.conv(point, 16, 10).cast("long")
        valid = number.between(9, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(point, 8, "0")), "UTF-32"))
        return F.coalesce(F.replace(text, entity, char), text)

    common = c
    for name, ch in ENTITIES[:-1]:
        common = F.replace(common, F.lit(name), F.lit(ch))
    all_ = bind(common, lambda t: F.aggregate(F.array_distinct(F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0))), t, resolved))
    return F.replace(F.when(F.contains(common, F.lit("&")), all_).otherwise(common), F.lit("&amp;"), F.lit("&"))


def plain_sections(c: Column) -> Column:
    """CDATA sections as escaped text."""
    sections = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?s)<!\[CDATA\[.*?\]\]>"), F.lit(0)))

    def escaped(text: Column, section: Column) -> Column:
        body = F.regexp_extract(section, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1)
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            body = F.replace(body, F.lit(raw), F.lit(safe))
        return F.replace(text, section, body)

    return F.when(F.contains(c, F.lit("<![CDATA[")), F.aggregate(sections, c, escaped)).otherwise(c)


def visible_text(html: Column) -> Column:
    """Text a reader sees, with runs of white space as one space."""
    bare = F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), TAG, " ")
    return F.trim(F.regexp_replace(unescape(bare), SPACES, " "))


def title(html: Column) -> Column:
    return strip(unescape(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def links(html: Column) -> Column:
    """Targets of links in order."""
    target = r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    found = F.regexp_extract_all(html, F.lit(target), F.lit(1))
    return F.transform(found, lambda t: unescape(F.regexp_replace(t, "^[\"']|[\"']$", "")))


def meta_tags(html: Column) -> Column:
    """Named meta tags as ``map<string,array<string>>``."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))

    def entry(tag: Column) -> Column:
        name = F.regexp_extract(tag, r"""(?is)\b(?:name|http-equiv|property)\s*=\s*["']([^"']*)["']""", 1)
        value = F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*["']([^"']*)["']""", 1)
        return F.struct(F.nullif(name, F.lit("")).alias("key"), unescape(value).alias("value"))

    return collect_metadata(F.transform(tags, entry))


def html_extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with title, meta tags, links and visible text; all in the JVM."""
    h = F.col(html)
    rest = [c for c in pages.columns if c != html]
    return pages.select(
        *rest, title(h).alias("title"), meta_tags(h).alias("meta"), links(h).alias("links"), visible_text(h).alias("text")
    )


def _element(block: Column, name: str) -> Column:
    raw = F.regexp_extract(block, rf"(?is)<{name}\b[^>]*>(.*?)</{name}>", 1)
    plain = F.regexp_replace(raw, r"(?s)^\s*<!\[CDATA\[(.*)\]\]>\s*$", "$1")
    return F.when(F.rlike(block, F.lit(rf"(?i)<{name}\b")), strip(F.when(plain != raw, plain).otherwise(unescape(raw))))


def feed_items(feeds: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """One row per item or entry of feeds held in rows."""
    blocks = F.regexp_extract_all(F.col(content), F.lit(r"(?is)<(item|entry)\b.*?</\1>"), F.lit(0))
    items = feeds.select(F.col(path).alias("path"), F.posexplode(blocks).alias("_pos", "_item"))
    item = F.col("_item")
    href = F.regexp_extract(item, r"""(?is)<link\b[^>]*\bhref\s*=\s*["']([^"']*)["']""", 1)
    return items.select(
        "path",
        (F.col("_pos") + 1).alias("item_no"),
        _element(item, "title").alias("title"),
        F.coalesce(F.nullif(_element(item, "link"), F.lit("")), F.nullif(unescape(href), F.lit(""))).alias("link"),
        F.coalesce(_element(item, "description"), _element(item, "summary")).alias("description"),
    )


def read_feed(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Items of feed files through the XML reader, which splits large files."""
    schema = "title string, link string, description string"
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def xml_metadata(docs: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Leaf elements of XML by local name, repeated ones multi-valued, and the text."""
    c = plain_sections(F.regexp_replace(F.col(content), r"(?s)<!--.*?-->|<\?.*?\?>", ""))
    leaf = r"(?s)<((?:[\w.-]+:)?[\w.-]+)(?:\s[^<>]*)?>[^<>]*</\1\s*>"
    found = F.regexp_extract_all(c, F.lit(leaf), F.lit(0))

    def entry(e: Column) -> Column:
        name = F.regexp_extract(e, r"^<(?:[\w.-]+:)?([\w.-]+)", 1)
        value = strip(unescape(F.regexp_replace(e, r"(?s)^<[^>]*>|</[^>]*>$", "")))
        return F.struct(name.alias("key"), F.nullif(value, F.lit("")).alias("value"))

    return docs.select(
        F.col(path).alias("path"),
        collect_metadata(F.transform(found, entry)).alias("metadata"),
        visible_text(c).alias("text"),
    )
