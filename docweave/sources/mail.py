"""Mailboxes and mail messages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docweave.functions.text import bind, strip


def split_mailbox(mailbox: Column) -> Column:
    """Messages of a mailbox, each without its ``From `` line kept as ``envelope``.

    ``array<struct<envelope,headers,body>>``; folded headers are joined.
    """
    parts = F.filter(F.split(F.replace(mailbox, F.lit("\r\n"), F.lit("\n")), r"(?m)^(?=From )"), lambda p: strip(p) != "")
    return F.transform(parts, message_parts)


def message_parts(message: Column) -> Column:
    """``struct(envelope, headers, body)`` of one mailbox message."""
    has_envelope = F.startswith(message, F.lit("From "))
    first = F.substring_index(message, "\n", 1)
    rest = F.when(has_envelope, F.substr(message, F.length(first) + 2)).otherwise(message)

    def cut(rest: Column) -> Column:
        # headers end at the first blank line, or never
        headers = F.when(F.startswith(rest, F.lit("\n")), F.lit("")).otherwise(F.substring_index(rest, "\n\n", 1))
        body = F.substr(rest, F.length(headers) + F.when(F.startswith(rest, F.lit("\n")), 2).otherwise(3))
        plain = F.rtrim(F.replace(headers, F.lit("\r"), F.lit("")), F.lit(" \t\n\x0b\f"))
        return F.struct(
            F.when(has_envelope, F.substr(first, F.lit(6))).alias("envelope"), unfold(plain).alias("headers"), body.alias("body")
        )

    return bind(rest, cut)


def unfold(headers: Column) -> Column:
    """Header lines continued over a line break joined by one space."""
    return F.regexp_replace(headers, r"\r?\n[ \t]+", " ")


def mailbox_messages(boxes: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """One row per message of mailboxes held in rows."""
    return boxes.select(F.col(path).alias("path"), F.posexplode(split_mailbox(F.col(content))).alias("_pos", "_m")).select(
        "path", (F.col("_pos") + 1).alias("msg_no"), "_m.*"
    )


def read_mailbox(spark: SparkSession, path: str) -> DataFrame:
    """One row per message of mailbox files.

    The separator is the record delimiter of the scan, so one large mailbox is
    read by many tasks and never held whole. ``at`` orders messages of a file.
    """
    raw = spark.read.option("lineSep", "\nFrom ").text(path)
    first = F.startswith(F.col("value"), F.lit("From "))
    message = F.when(first, F.col("value")).otherwise(F.concat(F.lit("From "), F.col("value")))
    cleaned = F.replace(message, F.lit("\r\n"), F.lit("\n"))
    return (
        raw.where(strip(F.col("value")) != "")
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.monotonically_increasing_id().alias("at"),
            message_parts(cleaned).alias("_m"),
        )
        .select("path", "at", "_m.*")
    )


def decode_words(c: Column) -> Column:
    """Decode encoded words of header values."""

    @F.pandas_udf(T.StringType())
    def decoded(values: pd.Series) -> pd.Series:
        from email.errors import HeaderParseError
        from email.header import decode_header, make_header

        def one(value):
            if "=?" not in value:
                return value
            try:
                return str(make_header(decode_header(value)))
            except (LookupError, ValueError, HeaderParseError):
                return value

        # a line at a time: decoding joins the lines it is given
        return values.map(lambda v: v if v is None else "\n".join(map(one, v.split("\n"))))

    return decoded(c)


def header_values(headers: Column, name: str) -> Column:
    """Values of one header of an unfolded header block, in order."""
    return F.regexp_extract_all(headers, F.lit(rf"(?mi)^{name}:[ \t]*(.*)$"), F.lit(1))


def addresses(headers: Column, name: str) -> Column:
    """Addresses of one header; commas within quotes or encoded words do not separate."""
    joined = F.array_join(header_values(headers, name), ",")
    parts = F.regexp_extract_all(joined, F.lit(r'(?:"[^"]*"|[^",])+'), F.lit(0))
    # an address holds no line break, so all are decoded as the lines of one text
    plain = decode_words(F.array_join(F.transform(parts, strip), "\n"))
    return F.filter(F.transform(F.split(plain, "\n"), strip), lambda a: a != "")


def message_headers(messages: DataFrame, headers: str = "headers") -> DataFrame:
    """Sender, recipients, subject, date and ids of messages.

    Headers are cut before encoded words are decoded, so a decoded comma or line
    break separates nothing. Values pass through Python in Arrow batches; one
    that cannot be decoded stays as it is written.
    """
    rest = [c for c in messages.columns if c not in (headers, "body")]
    h = F.col(headers)

    def one(name: str) -> Column:
        return decode_words(F.get(header_values(h, name), F.lit(0)))

    return messages.select(
        *rest,
        strip(one("From")).alias("from_addr"),
        addresses(h, "To").alias("to"),
        addresses(h, "Cc").alias("cc"),
        addresses(h, "Bcc").alias("bcc"),
        strip(one("Subject")).alias("subject"),
        strip(F.coalesce(one("Date"), one("Sent"))).alias("date"),
        strip(one("Message-ID")).alias("message_id"),
        strip(one("In-Reply-To")).alias("in_reply_to"),
    )


PARTS = (
    "path string, part_no int, depth int, content_type string, charset string, "
    "encoding string, filename string, text string"
)


def mime_parts(messages: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Leaf parts of multipart messages with their decoded text.

    Nesting and transfer encodings are left to the standard mail parser, a
    message at a time inside Arrow batches.
    """

    def leaves(part, depth: int):
        if part.is_multipart():
            for child in part.get_payload():
                yield from leaves(child, depth + 1)
        else:
            yield part, depth

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from email import message_from_bytes

        names = [c.split()[0] for c in PARTS.split(", ")]
        for batch in batches:
            out = []
            for where, raw in zip(batch["path"], batch["content"]):
                if raw is None:
                    continue
                message = message_from_bytes(raw.encode())
                for number, (part, depth) in enumerate(leaves(message, 0), start=1):
                    charset = part.get_content_charset()
                    text = None
                    if part.get_content_maintype() == "text":
                        payload = part.get_payload(decode=True) or b""
                        try:
                            text = payload.decode(charset or "utf-8")
                        except (LookupError, UnicodeDecodeError):
                            text = payload.decode("iso-8859-1")
                    encoding = part.get("Content-Transfer-Encoding")
                    out.append(
                        (
                            where,
                            number,
                            depth,
                            part.get_content_type(),
                            charset,
                            encoding.strip().lower() if encoding else None,
                            part.get_filename(),
                            text,
                        )
                    )
            yield pd.DataFrame(out, columns=names, dtype=object)

    return messages.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, PARTS)
