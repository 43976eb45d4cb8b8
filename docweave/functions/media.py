"""Media types, encodings and clean-up of formatted content."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docweave.functions import charsets
from docweave.functions.text import strip

# Contained word and the format it stands for, in matching order.
FORMATS = [
    ("powerpoint", "PowerPoint"),
    ("excel", "Excel"),
    ("word", "Word"),
    ("spreadsheet", "spreadsheet"),
    ("presentation", " office presentation"),
]

# Leading bytes (hex) and media type.
MAGIC = [
    ("25504446", "application/pdf"),
    ("D0CF11E0A1B11AE1", "application/x-ole-storage"),
    ("504B0304", "application/zip"),
    ("7B5C727466", "application/rtf"),
    ("89504E470D0A1A0A", "image/png"),
    ("FFD8FF", "image/jpeg"),
    ("47494638", "image/gif"),
    ("46726F6D20", "application/mbox"),
    ("3C3F786D6C", "application/xml"),
    ("50415231", "application/vnd.apache.parquet"),
]

# File extension and media type.
EXTENSIONS = [
    ("xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    ("docx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    ("pptx", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
    ("xls", "application/vnd.ms-excel"),
    ("doc", "application/msword"),
    ("ppt", "application/vnd.ms-powerpoint"),
    ("html", "text/html"),
    ("htm", "text/html"),
    ("csv", "text/csv"),
    ("tsv", "text/tab-separated-values"),
    ("eml", "message/rfc822"),
    ("rss", "application/rss+xml"),
    ("txt", "text/plain"),
]

# Leading bytes that are looked at.
HEAD = 64

# Bytes (hex) that text does not have: control bytes but blanks, form feed and escape.
CONTROL = "^(?:..)*(?:0[0-8EF]|1[0-9ACDEF]|7F)"

# Containers whose content alone does not tell the type apart.
_CONTAINERS = ("application/zip", "application/x-ole-storage", "application/xml")


def media_format(application_name: Column, content_type: Column) -> Column:
    """Readable format name; the raw type when no rule matches, null without one."""
    raw = F.coalesce(application_name, content_type)
    low = F.lower(raw)
    out = raw
    for word, label in reversed(FORMATS):
        out = F.when(F.contains(low, F.lit(word)), F.lit(label)).otherwise(out)
    return out


def media_type(content: Column, path: Column) -> Column:
    """Media type from leading bytes, refined by the file extension.

    ``content`` is binary. Only the first bytes are looked at.
    """
    head = F.hex(F.substring(content, 1, HEAD))
    ext = F.lower(F.regexp_extract(path, r"\.([^./?#]+)(?:[?#].*)?$", 1))
    by_ext = F.lit(None).cast("string")
    for name, kind in reversed(EXTENSIONS):
        by_ext = F.when(ext == name, F.lit(kind)).otherwise(by_ext)
    by_magic = F.lit(None).cast("string")
    for prefix, kind in reversed(MAGIC):
        by_magic = F.when(F.startswith(head, F.lit(prefix)), F.lit(kind)).otherwise(by_magic)
    is_html = F.lower(F.decode(F.unhex(head), "ISO-8859-1")).rlike(r"^\s*<(!doctype html|html|head|body)")
    return F.coalesce(
        F.when(by_magic.isin(*_CONTAINERS), F.coalesce(by_ext, by_magic)).otherwise(by_magic),
        F.when(is_html, F.lit("text/html")),
        by_ext,
        F.when(F.rlike(head, F.lit("^(FFFE|FEFF)")) | ~F.rlike(head, F.lit(CONTROL)), F.lit("text/plain")),
        F.lit("application/octet-stream"),
    )


def decoded(content: Column, declared: Column | None = None) -> Column:
    """``struct(charset, text, named)`` of a text file.

    In this order: a byte order mark, a declared charset, the one that the
    document names, UTF-8 if the bytes are valid, the likeliest by its bytes, and
    ISO-8859-1, which accepts any. A charset that does not exist or cannot read
    the bytes is passed over; ``named`` keeps what was declared or named, so a
    ``charset`` that differs tells of it. A byte order mark is no part of the text.

    Contents in valid UTF-8 that name nothing else stay in the JVM; Python sees
    only the others.
    """
    text = content.cast("string")
    given = F.lit(None).cast("string") if declared is None else F.nullif(strip(declared), F.lit(""))
    named = F.coalesce(charsets.order_mark(content), given, charsets.named_charset(content))
    # Charsets in seven bits and wide ones look like valid UTF-8.
    plain = F.is_valid_utf8(text) & ~F.contains(text, F.lit("\x1b$")) & ~F.contains(text, F.lit("\x00"))
    here = plain & F.coalesce(F.upper(named).isin("UTF-8", "UTF8"), F.lit(True))
    other = charsets.read_undeclared(F.when(~here, content), F.when(~here, named))
    return F.struct(
        F.when(here, F.lit("UTF-8")).otherwise(other["charset"]).alias("charset"),
        F.regexp_replace(F.when(here, text).otherwise(other["text"]), "^\ufeff", "").alias("text"),
        named.alias("named"),
    )


def has_content(content: Column) -> Column:
    """Content that is not blank and has a body."""
    return F.coalesce((strip(content) != "") & ~F.contains(content, F.lit("<body/>")), F.lit(False))


def kept_content(content: Column) -> Column:
    """The content, or null where it is empty; the document itself is kept."""
    return F.when(has_content(content), content)


def sanitize_content(content: Column, default_title: str = "Untitled") -> Column:
    """Fill an empty title and keep the layout of the body."""
    out = F.replace(content, F.lit("<title/>"), F.lit(f"<title>{default_title}</title>"))
    for tag in ("body", "BODY"):
        out = F.replace(out, F.lit(f"<{tag}>"), F.lit(f"<{tag}><pre>"))
        out = F.replace(out, F.lit(f"</{tag}>"), F.lit(f"</pre></{tag}>"))
    return out
