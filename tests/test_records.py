"""Cells, slides, pages, metadata, outline, files."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from urllib.parse import unquote

from docweave.functions import media, paths, text as tx
from docweave.joins import number_within
from docweave.operators import files as fl, metadata as meta, outline, pages as pg, sheets as sh, slides as sl
from docweave.plans.imports import import_files


def cells(spark, *rows):
    made = [("d", s, r, c, ord(c) - 64, v) for s, r, c, v in rows]
    return spark.createDataFrame(made, "doc string, sheet string, row int, col string, col_no int, value string")


def test_sheet_rules(spark):
    df = cells(
        spark,
        ("S", 1, "A", "  "), ("S", 3, "A", "k"), ("S", 3, "B", "v"), ("S", 3, "C", "v"),
        ("S", 4, "A", "1"), ("S", 4, "B", "x"), ("S", 4, "C", None), ("S", 4, "D", "loose"),
        ("S", 6, "A", "2"), ("S", 6, "B", "x"), ("S", 6, "C", "y"),
        ("T", 1, "A", "k"), ("T", 4, "A", "other"),
    )
    got = {(r.sheet, r.row_number): (r.record, r.text) for r in sh.sheet_rows(df).collect()}
    assert got == {
        ("S", 4): ({"k": "1", "v": "x", "column_D": "loose"}, ["1", "x", "loose"]),
        ("S", 6): ({"k": "2", "v": "y"}, ["2", "x", "y"]),
        ("T", 4): ({"k": "other"}, ["other"]),
    }


def test_legacy_rules(spark):
    df = cells(spark, ("S", 1, "A", '"OPEN DT"'), ("S", 1, "B", "b"), ("S", 2, "A", '"x"'), ("S", 2, "B", '""'))
    row = sh.sheet_rows(df, legacy=True).first()
    assert row.record == {"OPEN date": "x"} and row.text == ["x"]


def test_sheet_with_a_hot_share_of_rows(spark):
    big = spark.range(2, 5002).selectExpr("'d' doc", "'big' sheet", "CAST(id AS INT) row", "'A' col", "1 col_no", "CAST(id AS STRING) value")
    head = cells(spark, ("big", 1, "A", "h"))
    out = sh.sheet_rows(big.unionByName(head))
    assert out.count() == 5000
    assert out.where("record['h'] = CAST(row_number AS STRING)").count() == 5000


def test_rendered_sheet_fills_gaps(spark):
    df = cells(spark, ("S", 1, "B", "a<b"), ("S", 3, "A", "z"))
    html = [r.html for r in sh.render_sheet_html(df).orderBy("line_no").collect()]
    assert html == [
        "<h1>S</h1><table>", "<tr><td></td><td>a&lt;b</td></tr>", "<tr><td></td></tr>", "<tr><td>z</td></tr>", "</table>",
    ]


def test_cell_refs(spark):
    row = spark.range(1).select(sh.split_cell_ref(F.lit("AB12")).alias("r"), sh.column_number(F.lit("AB")).alias("n")).first()
    assert tuple(row.r) == ("AB", 12) and row.n == 28


def test_slide_parts(spark):
    schema = (
        "doc string, slide_number int, header string, footer string, content string, "
        "comments array<struct<author:string,text:string>>, notes string, images array<struct<ext:string>>"
    )
    df = spark.createDataFrame(
        [("/r/a b.ppt", 2, None, "foot", "body", [("me", None), (None, "hm")], "note", [("bmp",), ("jpg",), ("bmp",), ("png",)])], schema
    )
    row = sl.slide_records(df, "/r").first()
    assert row.unique_id == "/ab.pptSlide2"
    assert row.comments == ["Author: me", "comment: hm"] and row.notes == ["note\nfoot"]
    assert row.text == ["Author: me", "comment: hm", "note\nfoot", "body", "foot"]
    assert row.image_links == ["slide_2", "slide_2.jpg", "slide_2_1", "slide_2_1.png"]


def test_pages_and_fallback(spark):
    df = spark.createDataFrame([(1, "whole", ["p", "q"]), (2, "alone", None), (3, "none", [])], "doc int, content string, pages array<string>")
    got = sorted((r.doc, r.page_number or 0, r.content) for r in pg.with_fallback(df, "pages").collect())
    assert got == [(1, 1, "p"), (1, 2, "q"), (2, 0, "alone"), (3, 0, "none")]
    only = pg.select_pages(pg.page_records(df), start=2, end=2)
    assert [r.content for r in only.collect()] == ["q"]
    joined = spark.range(1).select(pg.join_sections(F.array(F.lit("a"), F.lit(" "), F.lit("b"))).alias("j")).first()
    assert joined.j == "a\nb"


def test_metadata(spark):
    df = spark.range(1).select(
        F.expr("array(named_struct('key','a','value','1'), named_struct('key','b','value',cast(null as string)),"
               "named_struct('key','a','value','2'))").alias("e")
    )
    m = df.select(meta.collect_metadata(F.col("e")).alias("m"))
    assert m.first().m == {"a": ["1", "2"]}
    assert m.select(meta.set_metadata(F.col("m"), "a", F.lit("9")).alias("m")).first().m == {"a": ["9"]}
    line = "    Stream #0.1(eng): Audio: aac, 48000 Hz, stereo, s16"
    found = spark.range(1).select(meta.tool_metadata(F.lit(line)).alias("f")).first().f
    assert {f.key: f.value for f in found} == {"xmpDM:audioChannelType": "stereo", "xmpDM:audioCompressor": "aac"}


def test_outline_with_a_hot_parent(spark):
    nodes = spark.range(1, 3001).selectExpr("'d' doc", "id", "CASE WHEN id = 1 THEN NULL WHEN id < 2000 THEN 1 ELSE id - 1 END parent", "id ord", "'t' title").where("id < 2010")
    out = outline.flatten_outline(nodes)
    assert out.count() == 2009 and out.agg(F.max("depth")).first()[0] == 11
    ids = [r.id for r in out.orderBy("path").collect()]
    assert ids[:3] == [1, 2, 3] and ids[-1] == 2009


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab /:+%é*~?#&=", min_size=1, max_size=12), min_size=1, max_size=20))
def test_encoding_can_be_undone(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "p string")
    for r in df.select("p", paths.url_path_encode(F.col("p")).alias("e")).collect():
        assert unquote(r.e) == r.p.rstrip("/")
        assert " " not in r.e


def test_paths(spark):
    p = F.lit("/r/a.b/c d.x.html")
    row = spark.range(1).select(
        paths.output_path(p).alias("beside"), paths.output_path(p, "/out").alias("given"),
        paths.web_link(p, "http://h/m/", "/r").alias("web"),
        paths.html_link(p, F.lit("<p>x</p>"), "http://h", "/r").alias("html"),
        paths.html_link(p, F.lit(" "), "http://h", "/r").alias("none"),
        paths.asset_url(F.lit("x"), None, "/r", F.lit("/r/o")).alias("same"),
    ).first()
    assert row.beside == "/r/a.b/PROCESSED_FILES/c d.x" and row.given == "/out/a"
    assert row.web == "http://h/m/a.b/c%20d.x.html"
    assert row.html == "http://h/a.b/PROCESSED_FILES/c%20d.x/c%20d.x.html.html"
    assert row.none is None and row.same == "x"


def test_media(spark):
    row = spark.range(1).select(
        media.media_format(F.lit(None).cast("string"), F.lit("application/WordPerfect")).alias("word"),
        media.media_format(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("none"),
        media.sanitize_content(F.lit("<title/><BODY>x</BODY>")).alias("clean"),
        media.has_content(F.lit("<body/>")).alias("empty"),
        media.decoded(F.unhex(F.lit("FC62")))["text"].alias("latin"),
        media.decoded(F.unhex(F.lit("C3BC")), F.lit("nonsense"))["charset"].alias("utf"),
    ).first()
    assert row.word == "Word" and row.none is None and row.empty is False
    assert row.clean == "<title>Untitled</title><BODY><pre>x</pre></BODY>"
    assert row.latin == "üb" and row.utf == "UTF-8"


def test_running_total(spark):
    for n in (0, 1, 7, 8, 9, 100, 1000):
        made = spark.range(1).select(F.expr(f"slice(sequence(1L, 1000L), 1, {n})").alias("a"))
        got = made.select(tx.running_total(F.col("a")).alias("t")).first().t
        assert got == [i * (i + 1) // 2 for i in range(n)]


def test_list_items_and_direction(spark):
    words = [".", "12.", "[3]", "4)", "A.", "b.", "C)", "d)", "IV.", "xi.", "word", "1", "I."]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.k for r in df.select(tx.list_item_kind(F.col("w")).alias("k")).collect()]
    assert got == [
        "dot", "number_dot", "number_brackets", "number_paren", "upper_dot", "lower_dot", "upper_paren", "lower_paren",
        "upper_roman", "lower_roman", None, None, "upper_dot",
    ]
    row = spark.range(1).select(
        tx.reverse_if_rtl(F.lit("سلام")).alias("r"), tx.reverse_if_rtl(F.lit("سa")).alias("n"),
        tx.fold_ligatures(F.lit("ﬁnd aﬄict")).alias("f"), tx.highlight(F.lit("a.b A.B axb"), "a.b").alias("h"),
    ).first()
    assert row.r == "مالس" and row.n == "سa" and row.f == "find afflict" and row.h == "<em>a.b</em> <em>A.B</em> axb"


def test_files_to_documents(spark):
    df = spark.createDataFrame(
        [("/r/a.xls", "<p>1</p>", "application/vnd.ms-excel", None, "w", "z", "2024-01-02T03:04:05", {"k": ["v"]}), ("/r/b.txt", " ", None, None, None, None, "?", {})],
        "path string, content string, content_type string, application_name string, author string, last_author string, last_modified string, metadata map<string,array<string>>",
    )
    rows = spark.createDataFrame([("/r/a.xls", f"/a.xls#S#Row{n}", n) for n in (2, 3)], "path string, unique_id string, row_number int")
    out = {r.unique_id: r for r in import_files(df, [rows], prefix="http://h", root="/r", collection="x").collect()}
    assert set(out) == {"/a.xls#S#Row2", "/a.xls#S#Row3", "/b.txt"}
    row = out["/a.xls#S#Row2"]
    assert row.content is None and row.author == "w" and row.media_format == "Excel" and row.last_modified.year == 2024
    assert out["/b.txt"].content is None and out["/b.txt"].last_modified is None and out["/b.txt"].source_nm == "x"


def test_siblings(spark):
    df = spark.createDataFrame([("/r/pdf/a.pdf",), ("/r/pdf/en/a.docx",), ("/r/b.pdf",)], "path string")
    got = {r.path: (r.translated_link, r.original_link) for r in fl.sibling_links(df, "en", "http://h", "/r").collect()}
    assert got == {
        "/r/pdf/a.pdf": ("http://h/pdf/en/a.docx", None),
        "/r/pdf/en/a.docx": (None, "http://h/pdf/a.pdf"),
        "/r/b.pdf": (None, None),
    }


def test_numbers_within_files(spark, tmp_path):
    for n, size in enumerate((5, 1, 40)):
        (tmp_path / f"f{n}.txt").write_text("".join(f"{i}\n" for i in range(1, size + 1)))
    lines = spark.read.text(str(tmp_path)).select(F.col("_metadata.file_name").alias("f"), "value")
    assert number_within(lines, ["f"], "n").where("n != CAST(value AS INT)").count() == 0
