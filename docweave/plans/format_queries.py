"""Queries that read text and mail formats, workbooks and streams.

The formats are written from the given tables first, a file per row, and read
back; the SQL states what must come out.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F, types as T

from docweave.functions import media
from docweave.plans.inputs import documents_of, spread, sql_id, table
from docweave.plans.registry import query
from docweave.session import new_path
from docweave.sources import delimited, mail, markup, workbook
from docweave.streaming import ingest


def _concat(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


# --- delimited text --------------------------------------------------------------------


@query(
    "csv_dialect_read",
    """
    SELECT c_custkey, concat_ws('~', CAST(c_custkey AS VARCHAR), c_name || ' "' || c_mktsegment || '", Inc', 'bc"' || c_mktsegment || '"ef',
      'C:dir', c_name, 'a"b\\c', '', c_mktsegment || ',1') AS fields FROM customer
    """.replace("\\\\", "\\"),
)
def csv_dialect_read(spark, d):
    """Doubled, embedded, escaped and unterminated quotes, a lone escape, space before a quote."""
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    line = _concat(
        F.col("c_custkey").cast("string"), ',"', name, ' ""', seg, '"", Inc",bc"', seg, '"ef,C:\\dir, "', name,
        '","a\\"b\\\\c",,"', seg, ",1",
    )
    return table(spark, d, "customer").select(
        "c_custkey", F.array_join(delimited.csv_fields(line), "~").alias("fields")
    )


@query(
    "csv_strict_read",
    "SELECT c_custkey, concat_ws('~', '', c_name, c_mktsegment || ';x') AS fields FROM customer",
)
def csv_strict_read(spark, d):
    """Other separator and quote; with strict quotes text outside them is dropped."""
    line = _concat(F.col("c_custkey").cast("string"), ";x'", F.col("c_name"), "'y;'", F.col("c_mktsegment"), ";x'")
    fields = delimited.csv_fields(line, separator=";", quote="'", strict_quotes=True)
    return table(spark, d, "customer").select("c_custkey", F.array_join(fields, "~").alias("fields"))


def _text_file(spark, rows, label):
    """Lines written as text files, for readers that start from a path."""
    path = new_path(spark, label)
    rows.write.text(path)
    return path


LONGEST = 4096


@query(
    "csv_quoted_records",
    f"""
    SELECT 'row' AS kind, CAST(doc_id AS VARCHAR) AS key, replace(coalesce(text, ''), chr(13), ' ') AS value, CAST(1 AS BIGINT) AS n FROM documents
    UNION ALL SELECT 'stray', source, 'open', count(DISTINCT source) FROM documents GROUP BY source
    UNION ALL SELECT 'plain', 'x', '', {LONGEST} * count(DISTINCT source) FROM documents
    """,
)
def csv_quoted_records(spark, d):
    """A file per source: whole texts with their line breaks as quoted fields, and a stray quote before many plain lines."""
    docs = table(spark, d, "documents")
    text = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("\r"), F.lit(" ")), F.lit("\\"), F.lit("\\\\"))
    rows = docs.select("source", _concat(F.col("doc_id").cast("string"), ',"', F.replace(text, F.lit('"'), F.lit('""')), '",', F.col("lang")).alias("value"))
    stray = docs.select("source").distinct().select("source", _concat(F.col("source"), ',"open', "\nx" * LONGEST).alias("value"))
    path = new_path(spark, "records")
    rows.union(stray).repartition("source").write.partitionBy("source").text(path)
    records = delimited.read_csv(spark, f"{path}/*", multi_line=True, most=LONGEST)
    key, value = F.get("fields", F.lit(0)), F.coalesce(F.get("fields", F.lit(1)), F.lit(""))
    kind = F.when(F.col("error").isNotNull(), "stray").when(F.size("fields") == 1, "plain").otherwise("row")
    return records.groupBy(kind.alias("kind"), key.alias("key"), value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "csv_skip_lines",
    "SELECT source, count(*) - 3 AS n, count(*) AS last FROM documents GROUP BY 1 HAVING count(*) > 4",
)
def csv_skip_lines(spark, d):
    """A text file per source, three lines after the first left out of each."""
    path = new_path(spark, "lines")
    rows = table(spark, d, "documents").select("source", F.concat("source", F.lit(","), "lang").alias("value"))
    rows.repartition("source").write.partitionBy("source").text(path)
    kept = delimited.skip_lines(delimited.read_lines(spark, f"{path}/*"), 3)
    per_file = kept.groupBy("path", F.substring_index("line", ",", 1).alias("source")).agg(
        F.count_distinct("line_no").alias("n"), F.max("line_no").alias("last"), F.min_by("line_no", "line_no").alias("first"),
        F.count_if(F.col("line_no").between(2, 4)).alias("skipped"),
    )
    return per_file.where((F.col("last") > 4) & (F.col("first") == 1) & (F.col("skipped") == 0)).select("source", "n", "last")


@query(
    "csv_skip_rows",
    """
    SELECT doc_id, CAST(i AS BIGINT) AS line_no FROM (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents) t
    WHERE i = 1 OR i > 4
    """,
)
def csv_skip_rows(spark, d):
    """Three lines after the header of each document left out."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "line"))
    kept = delimited.skip_lines(lines.withColumn("line_no", (F.col("p") + 1).cast("long")), 3)
    return kept.select("doc_id", "line_no")


@query(
    "tsv_read",
    "SELECT event_id, event_type || '~' || '' || '~' || user_id AS fields, CAST(3 AS BIGINT) AS n FROM events WHERE event_type <> 'error'",
)
def tsv_read(spark, d):
    """Cells at either end of a line that are empty are lost; blank lines are left out."""
    line = F.when(F.col("event_type") == "error", F.lit(" \t ")).otherwise(
        _concat("\t ", F.col("event_type"), "\t\t", F.col("user_id").cast("string"), "\t\t")
    )
    rows = table(spark, d, "events").select("event_id", line.alias("line")).where(delimited.strip(F.col("line")) != "")
    fields = delimited.tsv_fields(F.col("line"))
    return rows.select("event_id", F.array_join(fields, "~").alias("fields"), F.size(fields).cast("long").alias("n"))


@query(
    "tsv_files",
    "SELECT p_brand || '~' || p_type AS fields, count(*) AS n FROM part GROUP BY 1",
)
def tsv_files(spark, d):
    """Parts written as a tab-separated file and read back."""
    path = _text_file(spark, table(spark, d, "part").select(F.concat_ws("\t", "p_brand", "p_type")), "tsv")
    rows = delimited.read_tsv(spark, path)
    return rows.groupBy(F.array_join("fields", "~").alias("fields")).agg(F.count(F.lit(1)).alias("n"))


# --- mail --------------------------------------------------------------------------------


def _mailboxes(spark, d):
    # a document is a mailbox, each of its lines a message, quoted where it looks like a separator
    lines = F.split(F.regexp_replace("text", "(?m)^From ", ">From "), "\n", -1)
    message = lambda x, i: _concat(
        "From author@", F.col("source"), " Mon Jan 1\nSubject: line ", i.cast("string"), "\nX-Route: over two\n   lines to ",
        F.col("lang"), "\n\n", x, "\n",
    )
    return table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("path"), F.array_join(F.transform(lines, message), "").alias("content")
    )


@query(
    "mbox_messages",
    """
    SELECT CAST(doc_id AS VARCHAR) AS path, CAST(i AS INTEGER) AS msg_no, 'author@' || source || ' Mon Jan 1' AS envelope,
           'Subject: line ' || (i - 1) || chr(10) || 'X-Route: over two lines to ' || lang AS headers,
           CASE WHEN line LIKE 'From %' THEN '>' ELSE '' END || line || chr(10) AS body
    FROM (SELECT doc_id, source, lang, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS i
          FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents) a) b
    """,
)
def mbox_messages(spark, d):
    return mail.mailbox_messages(_mailboxes(spark, d))


@query(
    "mbox_files",
    "SELECT 'author@' || source || ' Mon Jan 1' AS envelope, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n FROM documents GROUP BY 1",
)
def mbox_files(spark, d):
    """The mailboxes written to files and read message by message."""
    path = _text_file(spark, _mailboxes(spark, d).select("content"), "mbox")
    return mail.read_mailbox(spark, path).groupBy("envelope").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rfc822_headers",
    """
    SELECT CAST(doc_id AS VARCHAR) AS path, 'Düsseldorf <' || lang || '@example.com>' AS from_addr,
           source || '@example.com|"Doe, J." <j@example.com>' AS to, 'cc' || doc_id || '@example.com' AS cc, '' AS bcc,
           'Re: ' || source || ' ' || lang AS subject, 'Mon, 1 Jan 2024' AS date, '<' || doc_id || '@host>' AS message_id
    FROM documents
    """,
)
def rfc822_headers(spark, d):
    """Folded recipient lists, quoted names with commas, encoded words."""
    key = F.col("doc_id").cast("string")
    headers = _concat(
        "From: =?ISO-8859-1?Q?D=FCsseldorf?= <", F.col("lang"), "@example.com>\r\nto: ", F.col("source"),
        "@example.com,\r\n\t\"Doe, J.\" <j@example.com>\r\nCC: cc", key, "@example.com\r\nSubject: Re: ", F.col("source"),
        "\r\n ", F.col("lang"), "\r\nDate: Mon, 1 Jan 2024\r\nMessage-Id: <", key, "@host>",
    )
    rows = table(spark, d, "documents").select(key.alias("path"), mail.unfold(headers).alias("h"))
    out = mail.message_headers(rows.withColumn("headers", F.replace("h", F.lit("\r"), F.lit(""))).drop("h"))
    flat = [F.array_join(c, "|").alias(c) for c in ("to", "cc", "bcc")]
    return out.select("path", "from_addr", *flat, "subject", "date", "message_id")


@query(
    "mime_parts",
    """
    SELECT CAST(doc_id AS VARCHAR) AS path, 1 AS part_no, 'text/plain' AS content_type, 'base64' AS encoding, NULL AS filename, text FROM documents
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 2, 'text/html', 'quoted-printable', NULL, '<p>Düsseldorf ' || lang || '</p>' FROM documents
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 3, 'image/gif', 'base64', source || '.gif', NULL FROM documents
    """,
)
def mime_parts(spark, d):
    """Nested multipart messages: text as base64, quoted-printable HTML with a soft break, an image."""
    body = F.base64(F.encode("text", "UTF-8"))
    content = _concat(
        'MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="outer"\n\n--outer\n'
        'Content-Type: multipart/alternative; boundary="inner"\n\n--inner\n'
        "Content-Type: text/plain; charset=UTF-8\nContent-Transfer-Encoding: base64\n\n", body,
        "\n--inner\nContent-Type: text/html; charset=ISO-8859-1\nContent-Transfer-Encoding: quoted-printable\n\n<p>D=FCssel=\ndorf ",
        F.col("lang"), "</p>\n--inner--\n\n--outer\nContent-Type: image/gif\nContent-Transfer-Encoding: base64\n"
        'Content-Disposition: attachment; filename="', F.col("source"), '.gif"\n\nR0lGODlh\n--outer--\n',
    )
    rows = spread(table(spark, d, "documents")).select(F.col("doc_id").cast("string").alias("path"), content.alias("content"))
    return mail.mime_parts(rows).select("path", "part_no", "content_type", "encoding", "filename", "text")


# --- markup --------------------------------------------------------------------------------

def _safe(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@query(
    "feed_items",
    """
    SELECT CAST(page_id AS VARCHAR) AS path, CAST(i AS INTEGER) AS item_no, trim(a, ' ' || chr(9) || chr(10) || chr(13)) AS title,
           'http://host.example' || a AS link, CASE WHEN i > 1 THEN url END AS description
    FROM (SELECT page_id, url, unnest(l) AS a, unnest(generate_series(1, len(l))) AS i
          FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages) p) q
    """,
)
def feed_items(spark, d):
    """Links of a page as items of a feed; the first has no description."""
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    item = lambda a, i: _concat(
        "<item>\n<title> ", _safe(a), "</title><link>http://host.example", _safe(a), "</link>",
        F.when(i > 0, _concat("<description><![CDATA[", F.col("url"), "]]></description>")).otherwise(""), "</item>",
    )
    feed = _concat("<rss><channel><title>feed</title>", F.array_join(F.transform(hrefs, item), ""), "</channel></rss>")
    feeds = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("path"), feed.alias("content"))
    return markup.feed_items(feeds)


@query(
    "dc_xml_metadata",
    """
    SELECT doc_id, 'title' AS key, trim(replace(split_part(text, chr(10), 1), chr(13), '')) AS value FROM documents WHERE trim(split_part(text, chr(10), 1)) <> ''
    UNION ALL SELECT doc_id, 'subject', lang || '|' || source FROM documents
    UNION ALL SELECT doc_id, 'language', lang FROM documents
    """,
)
def dc_xml_metadata(spark, d):
    """Dublin Core of a document: subject occurs twice, a comment holds an element."""
    xml = _concat(
        '<?xml version="1.0"?>\n<record xmlns:dc="http://purl.org/dc/elements/1.1/"><!-- <dc:date>1</dc:date> -->\n<dc:title>',
        _safe(F.substring_index("text", "\n", 1)), '</dc:title><dc:subject>', F.col("lang"), "</dc:subject>\n<dc:subject>", F.col("source"),
        '</dc:subject><dc:language lang="x">', F.col("lang"), "</dc:language></record>",
    )
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("path"), xml.alias("content"))
    out = markup.xml_metadata(docs).select(F.col("path").alias("doc_id"), F.explode("metadata").alias("key", "v"))
    return out.select("doc_id", "key", F.array_join("v", "|").alias("value"))


# --- types and encodings ----------------------------------------------------------------------


@query(
    "media_type_detect",
    """
    SELECT page_id, CASE WHEN url LIKE 'https://blog.%' THEN 'application/pdf' WHEN url LIKE 'https://m.%' THEN
      'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' WHEN url LIKE 'http://m.%' THEN 'application/zip'
      WHEN url LIKE 'http://blog.%' THEN 'text/csv' WHEN url LIKE '%#%' THEN 'text/plain' ELSE 'text/html' END AS content_type FROM pages
    """,
)
def media_type_detect(spark, d):
    """Page contents behind other leading bytes and other names."""
    u = F.col("url")
    text = lambda c: F.encode(c, "UTF-8")
    zipped = F.concat(F.unhex(F.lit("504B0304")), text(F.col("html")))
    content = (
        F.when(F.startswith(u, F.lit("https://blog.")), text(_concat("%PDF-1.4 ", F.col("html"))))
        .when(F.contains(u, F.lit("://m.")), zipped)
        .when(F.startswith(u, F.lit("http://blog.")), text(u))
        .when(F.contains(u, F.lit("#")), text(u))
        .otherwise(text(F.col("html")))
    )
    name = (
        F.when(F.startswith(u, F.lit("https://m.")), F.lit("a/b.XLSX"))
        .when(F.startswith(u, F.lit("http://blog.")), F.lit("a.d/b.csv"))
        .otherwise(F.lit("a/b"))
    )
    return table(spark, d, "pages").select("page_id", media.media_type(content, name).alias("content_type"))


@query(
    "encoding_detect",
    """
    SELECT doc_id, CASE WHEN lang = 'fr' AND regexp_matches(text, '[^\\x00-\\x7F]') THEN 'ISO-8859-1'
      WHEN lang = 'de' THEN 'UTF-16' ELSE 'UTF-8' END AS charset,
      CASE WHEN lang = 'fr' THEN regexp_replace(text, '[^\\x00-\\x{FF}]', '?', 'g') ELSE text END AS text FROM documents
    """.replace("\\\\", "\\"),
)
def encoding_detect(spark, d):
    """French in Latin-1 and undeclared, German declared as UTF-16, the rest in UTF-8 and wrongly declared."""
    lang = F.col("lang")
    latin = F.regexp_replace("text", r"[^\x00-\xFF]", "?")
    raw = (
        F.when(lang == "fr", F.encode(latin, "ISO-8859-1"))
        .when(lang == "de", F.encode("text", "UTF-16"))
        .otherwise(F.encode("text", "UTF-8"))
    )
    declared = F.when(lang == "de", F.lit("utf-16")).when(lang == "es", F.lit("x-unknown"))
    rows = table(spark, d, "documents").select("doc_id", raw.alias("raw"), declared.alias("declared"))
    out = media.decoded(F.col("raw"), F.col("declared"))
    return rows.select("doc_id", out.alias("o")).select("doc_id", "o.charset", "o.text")


# Letters of other scripts, in the order of _FROM, so that derived texts have the letter counts of prose.
_FROM = "etaoinshrdlucmfwygpbvkxjqz"
_SCRIPTS = [
    ("KOI8-R", "оеаинтсрвлкмдпуяыьгзбчйхжш", ""),
    ("windows-1251", "оеаинтсрвлкмдпуяыьгзбчйхжш", ""),
    ("windows-1253", "αοιετσνηυρπκμλςωίάόέδήγχθύ", ""),
    ("Shift_JIS", "のいしるとなはにたをてがでかすらっこれりもさまくあけ", ""),
    ("GB18030", "的一是不了在人有我他这个们中来上大为和国地到以说时要", ""),
    ("EUC-KR", "이다는에의가을로하고지한은도들사자기리를시서인해대어", ""),
    ("windows-1252", None, "– "),
    ("ISO-8859-15", None, "cœur "),
]


def _script_cases(sql: bool) -> str:
    """Text and charset of a document: by its id another script, or Latin letters and a mark that tells the charset.

    The SQL is the same in both dialects but for how characters are written in a pattern.
    """
    other = "[^\\\\x00-\\\\x7F]" if not sql else "[^\\x00-\\x7F]"
    wide = "[^\\\\x00-\\\\x7F\\\\u00C0-\\\\u00FF]" if not sql else "[^\\x00-\\x7F\\x{C0}-\\x{FF}]"
    every = ", 'g'" if sql else ""
    body = "CASE doc_id % 8"
    for k, (_, letters, mark) in enumerate(_SCRIPTS):
        if letters:
            plain = f"translate(lower(regexp_replace(text, '{other}', '?'{every})), '{_FROM}', '{letters}')"
        else:
            plain = f"'{mark}' || regexp_replace(text, '{wide}', '?'{every})"
        body += f" WHEN {k} THEN {plain}"
    return body + " END"


_CHARSET_OF = "CASE doc_id % 8 " + " ".join(f"WHEN {k} THEN '{c}'" for k, (c, _, _) in enumerate(_SCRIPTS)) + " END"


@F.pandas_udf(T.BinaryType())
def _written(text: pd.Series, charset: pd.Series) -> pd.Series:
    from docweave.functions.charsets import CODECS

    return pd.Series([t.encode(CODECS[c]) for t, c in zip(text, charset)], dtype=object)


@query(
    "encoding_by_bytes",
    f"""
    SELECT doc_id, named, CASE WHEN regexp_matches(body, '[^\\x00-\\x7F]') THEN charset ELSE 'UTF-8' END AS charset,
           md5(CASE WHEN named IS NULL THEN body ELSE '<meta charset="' || named || '">' || body END) AS text_md5
    FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lower(charset) END AS named, charset, body
          FROM (SELECT doc_id, {_CHARSET_OF} AS charset, {_script_cases(True)} AS body FROM documents) a) b
    """.replace("\\\\", "\\"),
)
def encoding_by_bytes(spark, d):
    """Documents in eight charsets and six scripts, a third naming its charset, the others told by their bytes."""
    rows = table(spark, d, "documents").select(
        "doc_id", F.expr(_CHARSET_OF).alias("charset"), F.expr(_script_cases(False)).alias("body")
    )
    named = F.when(F.col("doc_id") % 3 == 0, F.lower("charset"))
    text = F.concat(F.coalesce(F.concat(F.lit('<meta charset="'), named, F.lit('">')), F.lit("")), F.col("body"))
    raw = rows.select("doc_id", _written(text, F.col("charset")).alias("raw"))
    found = raw.select("doc_id", media.decoded(F.col("raw")).alias("o"))
    ascii_ = ~F.rlike("o.text", F.lit(r"[^\x00-\x7F]"))
    return found.select(
        "doc_id",
        F.col("o.named").alias("named"),
        F.when(ascii_, F.lit("UTF-8")).otherwise(F.col("o.charset")).alias("charset"),
        F.md5(F.encode("o.text", "UTF-8")).alias("text_md5"),
    )


# --- workbooks ------------------------------------------------------------------------------------


def _workbook(lines: list[str], author: str) -> bytes:
    """A small workbook: lines as shared strings in column A, lengths in column C."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    pack = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
    rows = "".join(
        f'<row r="{n}"><c r="A{n}" t="s"><v>{n - 1}</v></c><c r="C{n}" s="2"><v>{len(line)}</v></c></row>'
        for n, line in enumerate(lines, start=1)
    )
    parts = {
        "xl/workbook.xml": f'<workbook {ns} {rel}><sheets><sheet name="Lines" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships {pack}><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet {ns}><sheetData>{rows}</sheetData>"
        "<headerFooter><oddHeader>top</oddHeader></headerFooter></worksheet>",
        "xl/worksheets/_rels/sheet1.xml.rels": f'<Relationships {pack}><Relationship Id="rId1" Target="../comments1.xml"/></Relationships>',
        "xl/comments1.xml": f"<comments {ns}><authors><author>{escape(author)}</author></authors><commentList>"
        '<comment ref="A1" authorId="0"><text><r><t>first </t></r><r><t>line</t></r></text></comment></commentList></comments>',
        "xl/sharedStrings.xml": f"<sst {ns}>" + "".join(f"<si><t>{escape(line)}</t></si>" for line in lines) + "</sst>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, body in parts.items():
            book.writestr(name, body)
    return out.getvalue()


def _write_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        books = [_workbook(text.split("\n"), who) for text, who in zip(batch["text"], batch["source"])]
        yield pd.DataFrame({"path": batch["path"], "content": books})


@query(
    "xlsx_cells",
    """
    WITH l AS (SELECT doc_id, source, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS i
               FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents) a)
    SELECT CAST(doc_id AS VARCHAR) AS doc, 'Lines' AS sheet, CAST(i AS INTEGER) AS row, 'A' AS col, 1 AS col_no, line AS value, 'cell' AS kind,
           CASE WHEN i = 1 THEN source END AS comment_author, CASE WHEN i = 1 THEN 'first line' END AS comment FROM l WHERE line <> '' OR i = 1
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'Lines', CAST(i AS INTEGER), 'C', 3, CAST(length(line) AS VARCHAR), 'cell', NULL, NULL FROM l
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'Lines', NULL, NULL, NULL, 'top', 'header', NULL, NULL FROM documents
    """,
)
def xlsx_cells(spark, d):
    """Documents written as workbooks, a line per row, and read back as cells."""
    docs = spread(table(spark, d, "documents")).select(F.col("doc_id").cast("string").alias("path"), "text", "source")
    books = docs.mapInPandas(_write_workbooks, "path string, content binary")
    out = workbook.workbook_cells(books)
    return out.select("doc", "sheet", "row", "col", "col_no", "value", "kind", "comment_author", "comment")


# Column, format code, what is stored (in SQL over orders) and what is shown (in DuckDB).
_DAYS = "datediff(CAST(o_orderdate AS DATE), DATE '1899-12-30')"
_FORMATS = [
    ("A", "yyyy-mm-dd", _DAYS, "strftime(o_orderdate, '%Y-%m-%d')"),
    ("B", "d-mmm-yy", _DAYS, "strftime(o_orderdate, '%-d-%b-%y')"),
    ("C", "dddd, mmmm dd", _DAYS, "strftime(o_orderdate, '%A, %B %d')"),
    ("D", "h:mm:ss", "o_orderkey % 86400 / 86400D", "(o_orderkey % 86400 // 3600) || strftime(TIMESTAMP '2000-01-01' + to_seconds(o_orderkey % 3600), ':%M:%S')"),
    ("E", "[h]:mm", "o_orderkey / 1440D", "(o_orderkey // 60) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')"),
    ("F", "#,##0.00", "o_totalprice", "format('{:,.2f}', CAST(o_totalprice AS DOUBLE))"),
    ("G", "000000000", "o_orderkey", "lpad(CAST(o_orderkey AS VARCHAR), 9, '0')"),
    ("H", "0.0%", "o_orderkey % 1000 / 1000D", "printf('%d.%d%%', o_orderkey % 1000 // 10, o_orderkey % 10)"),
    ("I", "#,##0_);(#,##0)", "o_custkey - 700", "CASE WHEN o_custkey < 700 THEN format('({:,})', 700 - o_custkey) ELSE format('{:,} ', o_custkey - 700) END"),
    (
        "J",
        "# ?/8",
        "o_orderkey % 64 / 8D",
        "CASE WHEN o_orderkey % 8 = 0 THEN '' || o_orderkey % 64 // 8 WHEN o_orderkey % 64 < 8 THEN o_orderkey % 8 || '/8' "
        "ELSE (o_orderkey % 64 // 8) || ' ' || o_orderkey % 8 || '/8' END",
    ),
    ("K", "0.00E+00", "o_orderkey * 8", "printf('%.2E', CAST(o_orderkey * 8 AS DOUBLE))"),
    ("L", "000-00-0000", "o_orderkey", "regexp_replace(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), '^(.{3})(.{2})', '\\1-\\2-')"),
    (
        "M",
        '[>=1000]0.0,"k";0',
        "o_custkey",
        "CASE WHEN o_custkey >= 1000 THEN printf('%d.%dk', (o_custkey + 50) // 1000, (o_custkey + 50) // 100 % 10) ELSE CAST(o_custkey AS VARCHAR) END",
    ),
    ("N", '@" only"', "o_orderpriority", "o_orderpriority || ' only'"),
    ("O", None, "o_orderkey", "CAST(o_orderkey AS VARCHAR)"),
]
_PER_BOOK = 500


def _formatted_workbook(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of the stored values as a workbook with a style for each column."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    pack = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
    body = []
    for n, values in enumerate(rows.sort_values("o_orderkey")[[c for c, *_ in _FORMATS]].itertuples(index=False), start=1):
        cells = [
            f'<c r="{c}{n}" s="{k}" t="inlineStr"><is><t>{escape(v)}</t></is></c>' if c == "N" else f'<c r="{c}{n}" s="{k}"><v>{v}</v></c>'
            for k, ((c, *_), v) in enumerate(zip(_FORMATS, values), start=1)
        ]
        body.append(f'<row r="{n}">{"".join(cells)}</row>')
    own = "".join(f'<numFmt numFmtId="{164 + k}" formatCode="{escape(code, {chr(34): "&quot;"})}"/>' for k, (_, code, *_) in enumerate(_FORMATS) if code)
    styles = "".join(f'<xf numFmtId="{164 + k if code else 0}"/>' for k, (_, code, *_) in enumerate(_FORMATS))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><sheets><sheet name="Orders" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships {pack}><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/styles.xml", f"<styleSheet {ns}><numFmts>{own}</numFmts><cellXfs><xf/>{styles}</cellXfs></styleSheet>")
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{''.join(body)}</sheetData></worksheet>")
    return pd.DataFrame({"path": [str(key[0])], "content": [out.getvalue()]})


@query(
    "xlsx_formats",
    f"""
    WITH n AS (SELECT *, o_orderkey // {_PER_BOOK} AS book,
                      row_number() OVER (PARTITION BY o_orderkey // {_PER_BOOK} ORDER BY o_orderkey) AS i FROM orders)
    """
    + " UNION ALL ".join(
        f"SELECT CAST(book AS VARCHAR) AS doc, CAST(i AS INTEGER) AS row, '{c}' AS col, {shown} AS value, "
        f"{'CAST(o_orderdate AS TIMESTAMP)' if c in 'ABC' else 'CAST(NULL AS TIMESTAMP)'} AS date FROM n"
        for c, _, _, shown in _FORMATS
        if c != "D"
    )
    + f" UNION ALL SELECT CAST(book AS VARCHAR), CAST(i AS INTEGER), 'D', {_FORMATS[3][3]}, "
    "TIMESTAMP '1899-12-31' + to_seconds(o_orderkey % 86400) FROM n",
)
def xlsx_formats(spark, d):
    """Orders written as workbooks of 500 keys with fifteen formats, and read back as a sheet shows them."""
    orders = table(spark, d, "orders")
    stored = orders.select(
        "o_orderkey", F.expr(f"o_orderkey div {_PER_BOOK}").alias("book"), *(F.expr(f"CAST({value} AS STRING)").alias(c) for c, _, value, _ in _FORMATS)
    )
    books = stored.groupBy("book").applyInPandas(_formatted_workbook, "path string, content binary")
    return workbook.workbook_cells(books).select("doc", "row", "col", "value", "date")


# --- stream --------------------------------------------------------------------------------------


@query(
    "ingest_stream",
    f"SELECT {sql_id('orders')} AS unique_id, o_totalprice AS money FROM orders",
)
def ingest_stream(spark, d):
    """Orders arriving as files of a stream, stored once, compacted by id."""
    root = new_path(spark, "stream")
    rows = ingest.stream_table(spark, d, table(spark, d, "orders").schema, "orders.parquet")
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        ingest.ingest_stream(rows, lambda b: documents_of(spark, d, "orders", b), f"{root}/docs", f"{root}/state").awaitTermination()
    ingest.compact(spark, f"{root}/docs", f"{root}/compacted")
    held = spark.read.parquet(f"{root}/compacted")
    return held.select("unique_id", F.get("money_text", F.lit(0)).alias("money"))


