"""Delimited text, mail, markup, workbooks, the store and the stream."""

import pytest
from pyspark.sql import functions as F

from docweave.functions.media import media_type
from docweave.operators import layout as lay
from docweave.operators.tables import table_to_documents
from docweave.session import new_path
from docweave.sinks import store
from docweave.sources import database, delimited, folder, mail, markup, workbook
from docweave.streaming import ingest


@pytest.mark.parametrize(
    "line, want",
    [
        ("a,b,c", ["a", "b", "c"]),
        ("", [""]),
        (",", ["", ""]),
        ('"a,b",c', ["a,b", "c"]),
        ('"a ""q"" b",c', ['a "q" b', "c"]),
        ('a,bc"d"ef,g', ["a", 'bc"d"ef', "g"]),
        ('abc, "d",e', ["abc", "d", "e"]),
        ('a,"open,1', ["a", "open,1"]),
        ("C:\\dir,x", ["C:dir", "x"]),
        ('"a\\"b\\\\c",d', ['a"b\\c', "d"]),
        ("\\a", ["a"]),
        ('x"y"', ["xy"]),
    ],
)
def test_csv_dialect(spark, line, want):
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(delimited.csv_fields(F.col("l")).alias("f")).first().f == want


def test_csv_options(spark):
    df = spark.createDataFrame([("abcd  'x' y;'z'",)], "l string")
    got = df.select(
        delimited.csv_fields(F.col("l"), ";", "'", "\\", strict_quotes=True).alias("s"),
        delimited.csv_fields(F.col("l"), ";", "'", "\\").alias("n"),
    ).first()
    assert got.s == ["x", "z"] and got.n[1] == "z"
    for bad in ({"separator": '"'}, {"quote": "\\"}, {"separator": "\0"}):
        with pytest.raises(ValueError):
            delimited.csv_fields(F.col("l"), **bad)


@pytest.mark.parametrize("skip, want", [(0, ["h", "1", "2", "3", "4"]), (1, ["1", "2", "3", "4"]), (2, ["h", "3", "4"])])
def test_skipping(spark, tmp_path, skip, want):
    (tmp_path / "a.csv").write_text("h\n1\n2\n3\n4\n")
    rows = delimited.read_csv(spark, str(tmp_path), skip=skip)
    assert sorted(r.fields[0] for r in rows.collect()) == sorted(want)


def test_tsv_and_multi_line_csv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("\ta\t\tb\t\n \t \nc\n")
    assert [r.fields for r in delimited.read_tsv(spark, str(tmp_path / "a.tsv")).collect()] == [["a", "", "b"], ["c"]]
    (tmp_path / "b.csv").write_text('x,"two\nlines"\n')
    assert delimited.read_csv(spark, str(tmp_path / "b.csv"), multi_line=True).first().fields == ["x", "two\nlines"]


MBOX = "From a@x Mon\nSubject: one\nReceived: from xxx\n  by xxx; date\n\nTest 1\n> quoted\n\nFrom b@x Tue\n\nTest 2\n"


def test_mailbox(spark, tmp_path):
    df = spark.createDataFrame([("m", MBOX)], "path string, content string")
    rows = mail.mailbox_messages(df).orderBy("msg_no").collect()
    assert [(r.msg_no, r.envelope) for r in rows] == [(1, "a@x Mon"), (2, "b@x Tue")]
    assert rows[0].headers == "Subject: one\nReceived: from xxx by xxx; date"
    assert rows[0].body == "Test 1\n> quoted\n\n" and rows[1].headers == "" and rows[1].body == "Test 2\n"
    (tmp_path / "m.mbox").write_text(MBOX)
    read = mail.read_mailbox(spark, str(tmp_path / "m.mbox")).orderBy("at").collect()
    assert [(r.envelope, r.headers) for r in read] == [(r.envelope, r.headers) for r in rows]


def test_headers(spark):
    block = 'From: =?ISO-8859-1?Q?Keld_J=F8rn?= <k@x>\nTo: "A, B" <a@x>, c@x\nSent: today\nIn-Reply-To: <1@x>'
    row = mail.message_headers(spark.createDataFrame([("p", block)], "path string, headers string")).first()
    assert row.from_addr == "Keld Jørn <k@x>" and row.to == ['"A, B" <a@x>', "c@x"]
    assert row.cc == [] and row.subject is None and row.date == "today" and row.in_reply_to == "<1@x>"


def test_parts(spark):
    body = "Content-Type: text/plain; charset=ISO-8859-1\nContent-Transfer-Encoding: quoted-printable\n\nD=FCssel=\ndorf\n"
    row = mail.mime_parts(spark.createDataFrame([("p", body)], "path string, content string")).first()
    assert row.text == "Düsseldorf\n" and row.charset == "iso-8859-1" and row.depth == 0


def test_html(spark):
    page = (
        "<html><head><title> A &amp; B </title><META content='me' name=\"Author\"></head><body><script>var a='<p>';</script>"
        "Hi<br>there&nbsp;<a class=x href='http://x/?a=1&amp;b=2'>go</a><!-- <a href='no'> --></body>"
    )
    row = markup.html_extract(spark.createDataFrame([(1, page)], "page_id int, html string")).first()
    assert row.title == "A & B" and row.meta == {"Author": ["me"]} and row.text == "Hi there go"
    assert row.links[0] == "http://x/?a=1&b=2"


def test_feeds(spark, tmp_path):
    rss = "<rss><channel><item><title>t1</title><link>l1</link></item>\n<item><title>t&lt;2</title><link>l2</link><description>d</description></item></channel></rss>"
    atom = "<feed><entry><title>t</title><link href='http://a'/><summary>s</summary></entry></feed>"
    df = spark.createDataFrame([("r", rss), ("a", atom)], "path string, content string")
    got = sorted((r.path, r.item_no, r.title, r.link, r.description) for r in markup.feed_items(df).collect() if r.description or r.path == "a")
    assert got == [("a", 1, "t", "http://a", "s"), ("r", 2, "t<2", "l2", "d")]
    (tmp_path / "f.rss").write_text(rss)
    assert sorted(r.link for r in markup.read_feed(spark, str(tmp_path / "f.rss")).collect()) == ["l1", "l2"]


def test_xml(spark):
    xml = "<r xmlns:dc='u'><dc:subject>Java</dc:subject><dc:subject>XML</dc:subject><e/><dc:language>Fr</dc:language></r>"
    row = markup.xml_metadata(spark.createDataFrame([("p", xml)], "path string, content string")).first()
    assert row.metadata == {"subject": ["Java", "XML"], "language": ["Fr"]} and row.text == "Java XML Fr"


def test_types(spark):
    def kind(data, name):
        return spark.range(1).select(media_type(F.lit(data), F.lit(name)).alias("k")).first().k

    assert kind(b"%PDF-1.4", "a.txt") == "application/pdf"
    assert kind(b"PK\x03\x04..", "a.xlsx").endswith("spreadsheetml.sheet") and kind(b"PK\x03\x04", "a") == "application/zip"
    assert kind(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "a.ppt") == "application/vnd.ms-powerpoint"
    assert kind(b"  <HTML>", "x") == "text/html" and kind(b"hello", "x") == "text/plain"


def test_a_broken_workbook_is_reported(spark):
    df = spark.createDataFrame([("bad.xlsx", bytearray(b"no zip"))], "path string, content binary")
    row = workbook.workbook_cells(df).first()
    assert row.kind == "error" and "BadZipFile" in row.error


def test_folder_leaves_out_copies(spark, tmp_path):
    for name in ("a.txt", "x/b.txt", "x/PROCESSED_FILES/b/b.txt.html"):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("body")
    files = folder.folder_scan(spark, str(tmp_path))
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.collect()) == ["a.txt", "b.txt"]
    registry = folder.ReaderRegistry()
    registry.register("text/plain", lambda df: df.select("path"))
    assert registry.read(files)["text/plain"].count() == 2


def test_jdbc_options():
    got = database.jdbc_options("jdbc:x", {"user": "u"}, "t", partition_column="id", bounds=("0", "9"), partitions=4)
    assert got["numPartitions"] == "4" and got["partitionColumn"] == "id" and got["user"] == "u"
    with pytest.raises(ValueError):
        database.jdbc_options("jdbc:x", {}, "t", partition_column="id")
    assert database.DIALECTS["sqlserver"]["table"].format(database="d", table="t") == "[d].[dbo].[t]"


def docs(spark, low, high, label):
    rows = spark.range(low, high).selectExpr("CAST(id AS STRING) AS id", f"'{label}' AS v")
    return table_to_documents(rows, "t", "db", id_column="id")


def test_store(spark):
    path = new_path(spark, "test-store")
    store.upsert_documents(docs(spark, 0, 10, "a"), path)
    other = table_to_documents(spark.range(3), "other", "db", key_columns=["id"])
    store.upsert_documents(other, path)
    store.upsert_documents(docs(spark, 5, 15, "b"), path)
    held = store.read_documents(spark, path)
    counts = {r.table_nm: r["count"] for r in held.groupBy("table_nm").count().collect()}
    assert counts == {"t": 15, "other": 3}
    assert held.where("fields['v'] = 'b'").count() == 10
    store.upsert_documents(docs(spark, 5, 15, "b"), path)
    assert store.read_documents(spark, path).count() == 18


def test_rendered(spark):
    df = spark.createDataFrame([("/a/b.txt", "/a/PROCESSED_FILES/b", "x"), ("/a/c.txt", "/a/PROCESSED_FILES/c", " ")], "path string, output_path string, content string")
    assert [r.copy_path for r in store.rendered(df).collect()] == ["/a/PROCESSED_FILES/b/b.txt.html"]
    path = new_path(spark, "test-copies")
    store.write_rendered(df, path, as_text=True)
    assert [r.value for r in spark.read.text(path).collect()] == ["x"]


def test_stream_equals_batch(spark, tmp_path):
    source, root = tmp_path / "in", new_path(spark, "test-stream")
    source.mkdir()

    def run():
        files = ingest.stream_files(spark, str(source))
        made = lambda b: table_to_documents(b.selectExpr("path", "CAST(content AS STRING) AS body"), "f", "db", key_columns=["path"])
        ingest.ingest_stream(files, made, f"{root}/docs", f"{root}/state").awaitTermination()

    (source / "a.txt").write_text("one")
    run()
    (source / "b.txt").write_text("two")
    run()
    run()
    ingest.compact(spark, f"{root}/docs", f"{root}/out")
    got = spark.read.parquet(f"{root}/out")
    assert sorted(r.b for r in got.selectExpr("fields['body'] AS b").collect()) == ["one", "two"]


GLYPH = "doc_id long, page int, seq int, ch string, x double, y double, w double, h double, space_w double, font string, font_size double"


def glyphs(spark, lines):
    rows = []
    for x0, y, line in lines:
        rows += [(1, 0, len(rows) + n, ch, x0 + 6.0 * n, float(y), 6.0, 10.0, 6.0, "f", 10.0) for n, ch in enumerate(line) if ch != " "]
    return spark.createDataFrame(rows, GLYPH)


def test_layout_paragraphs(spark):
    df = glyphs(spark, [(0, 12, "1."), (0, 24, "2."), (0, 60, "gap"), (18, 72, "hang"), (18, 84, "same"), (0, 96, "out"), (18, 108, "in")])
    rows = lay.paragraphs(lay.page_lines(lay.arrange(df))).orderBy("line_no").collect()
    assert [r.opens_paragraph for r in rows] == [True, True, True, False, False, True, False]


def test_layout_text(spark):
    df = glyphs(spark, [(0, 12, "two words"), (0, 24, "שלום abc"), (0, 36, "אבגד הו")])
    assert lay.glyphs_to_text(df).first().content == "two words\nםולש abc\nדגבא וה"
    hebrew = glyphs(spark, [(0, 12, "abc ﬁ"), (0, 24, "שלום אב"), (0, 36, "אבגד הו")])
    assert lay.glyphs_to_text(hebrew).first().content == "fi abc\nבא םולש\nוה דגבא"


def test_layout_sections_and_fonts(spark):
    df = glyphs(spark, [(0, 12, "left"), (300, 12, "right")]).withColumn(
        "beads", F.expr("array(named_struct('left',200D,'bottom',0D,'right',900D,'top',90D))")
    )
    placed = lay.assign_sections(df)
    assert {r.section for r in placed.collect()} == {0, 1}
    assert lay.glyphs_to_text(df, beads="beads").first().content == "left\nright"
    assert lay.glyphs_to_text(glyphs(spark, [(0, 24, "b"), (0, 12, "a")]), by_position=True).first().content == "a\nb"


def test_layout_dedup_counts_kept_glyphs_only(spark):
    rows = [(1, 0, n, "a", x, 12.0, 6.0, 10.0, 6.0, "f", 10.0) for n, x in enumerate((0.0, 1.5, 3.0))]
    kept = lay.drop_overprints(lay.arrange(spark.createDataFrame(rows, GLYPH)))
    assert [r.x for r in kept.orderBy("seq").collect()] == [0.0, 3.0]
