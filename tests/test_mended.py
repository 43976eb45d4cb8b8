"""Faults that tidy input does not show."""

import os

import pytest
from pyspark.sql import functions as F

from docweave.functions import media
from docweave.operators import layout, search, sheets, tables
from docweave.operators.outline import flatten_outline, orphans
from docweave.schema import conform
from docweave.sinks import store
from docweave.sources import delimited, mail, markup
from docweave.streaming.ingest import compact


def documents(spark, rows):
    """(unique_id, database_nm, table_nm, header) as documents."""
    return conform(spark.createDataFrame(rows, "unique_id string, database_nm string, table_nm string, header string"))


def stored(spark, path):
    held = store.read_documents(spark, path)
    return {(r.unique_id, r.database_nm, r.table_nm, r.header) for r in held.collect()}


def test_upsert_keeps_rows_without_a_folder_and_moves_ids(spark, tmp_path):
    path, staging = str(tmp_path / "docs"), str(tmp_path / "staged")
    first = [("f1", None, None, "a"), ("f2", None, None, "b"), ("x", "d", "old", "c"), ("y", "d", "t", "d")]
    store.upsert_documents(documents(spark, first), path)
    store.upsert_documents(documents(spark, [("f3", None, None, "e"), ("x", "d", "new", "f"), ("f1", None, None, "g")]), path, staging=staging)
    assert stored(spark, path) == {
        ("f1", None, None, "g"), ("f2", None, None, "b"), ("f3", None, None, "e"), ("x", "d", "new", "f"), ("y", "d", "t", "d"),
    }
    assert not os.path.exists(staging)


def test_upsert_of_many_folders(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(f"i{n}", "d", f"t{n:03d}", "a") for n in range(520)]
    store.upsert_documents(documents(spark, rows + [("file", None, None, "a")]), path)
    store.upsert_documents(documents(spark, [(i, d, t, "b") for i, d, t, _ in rows]), path)
    held = stored(spark, path)
    assert len(held) == 521 and ("file", None, None, "a") in held and ("i7", "d", "t007", "b") in held
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 521 + 8


def test_range_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("unique_id"),
        F.array((F.col("id") * 10).cast("double")).alias("money_text"),
        F.array(F.timestamp_seconds(F.col("id") * 86400)).alias("date_text"),
    )
    store.write_documents(conform(rows), path)
    held = store.read_documents(spark, path)
    money = search.filter_any_money(held, 100, 200)
    dates = search.filter_any_date(held, "1970-01-05", "1970-01-08")
    assert money.count() == 10 and dates.count() == 3
    for found, column in ((money, "money_max"), (dates, "micros_max")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({column}" in plan.partition("PushedFilters")[2]


def test_range_filters_keep_rows_stored_without_bounds(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.range(20).select(
        F.col("id").cast("string").alias("unique_id"),
        F.array((F.col("id") * 10).cast("double")).alias("money_text"),
        F.array(F.timestamp_seconds(F.col("id") * 86400)).alias("date_text"),
    )
    conform(rows).drop("micros_min", "micros_max", "money_min", "money_max").write.parquet(path)
    held = store.read_documents(spark, path)
    assert search.filter_any_money(held, 100, 150).count() == 5
    assert search.filter_any_date(held, "1970-01-05", "1970-01-08").count() == 3


def test_compact_keeps_folder_names_and_the_last_batch(spark, tmp_path):
    path, target = str(tmp_path / "in"), str(tmp_path / "out")
    store.write_documents(documents(spark, [("a", "d", "007", "1"), ("b", "d", "008", "1")]), f"{path}/batch=0")
    store.write_documents(documents(spark, [("a", "d", "007", "2"), ("a", "d", "007", "3")]), f"{path}/batch=1")
    compact(spark, path, target)
    held = {r[:3]: r[3] for r in stored(spark, target)}
    assert set(held) == {("a", "d", "007"), ("b", "d", "008")} and held[("a", "d", "007")] in ("2", "3")


def test_long_orders_orphans_and_cycles(spark):
    rows = [
        ("d", "a", None, 12345678901, "A"), ("d", "b", None, 12345678902, "B"), ("d", "c", "a", 5, "C"),
        ("d", "e", "gone", 1, "E"), ("d", "x", "y", 1, "X"), ("d", "y", "x", 2, "Y"),
    ]
    nodes = spark.createDataFrame(rows, "doc string, id string, parent string, ord long, title string")
    got = {r.id: (r.depth, r.path) for r in flatten_outline(nodes).collect()}
    assert got["a"][1] < got["c"][1] < got["b"][1] and got["c"][0] == 1
    assert len(got) == 6 and got["e"][0] == 0 and got["x"][0] == 0
    assert [r.id for r in orphans(nodes).collect()] == ["e"]
    chain = spark.range(300).select(
        F.lit("d").alias("doc"), F.col("id").cast("string").alias("id"),
        F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent"), F.col("id").alias("ord"), F.lit("t").alias("title"),
    )
    assert {int(r.id): r.depth for r in flatten_outline(chain).collect()} == {n: n for n in range(300)}


def test_message_without_a_blank_line(spark):
    long = "From a b\n" + "\n".join(f"H{n}: v" for n in range(50_000))
    rows = [("p", long), ("q", "From x y\nSubject: s\n t\n\nbody\n\nmore"), ("r", "From z w\n\nonly body")]
    got = {r.path: r for r in mail.mailbox_messages(spark.createDataFrame(rows, "path string, content string")).collect()}
    assert got["p"].headers.endswith("H49999: v") and got["p"].body == ""
    assert (got["q"].envelope, got["q"].headers, got["q"].body) == ("x y", "Subject: s t", "body\n\nmore")
    assert (got["r"].headers, got["r"].body) == ("", "only body")


def test_bad_encoded_word_and_comma_in_a_name(spark):
    headers = "From: =?utf-8?B?abcde?=\nTo: =?utf-8?Q?Doe=2C_John?= <j@x>, k@y\nSubject: =?utf-8?Q?caf=C3=A9?="
    row = mail.message_headers(spark.createDataFrame([("p", headers)], "path string, headers string")).first()
    assert row["from_addr"] and row["subject"] == "café" and len(row["to"]) == 2 and row["to"][0] == "Doe, John <j@x>"


def test_undeclared_8_bit_part(spark):
    raw = "MIME-Version: 1.0\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n€ 東京"
    row = mail.mime_parts(spark.createDataFrame([("p", raw)], "path string, content string")).first()
    assert row.text == "€ 東京"


def test_amount_beyond_the_money_type(spark):
    rows = spark.createDataFrame([(1, 1e17), (2, 2.5)], "id long, amount double")
    docs = tables.table_to_documents(rows, "t", "d", key_columns=["id"], kinds={"amount": "money"})
    assert {v for r in docs.collect() for k, v in r.fields.items() if k.startswith("amount")} >= {"2.5000", "1.0E17"}
    assert sheets.split_cell_ref is not None
    assert spark.range(1).select(sheets.split_cell_ref(F.lit("AB")).alias("r")).first().r.row is None


@pytest.mark.parametrize(
    "head,kind",
    [
        (b"\x1f\x8b\x08\x00\x00", "application/octet-stream"), (b"\x7fELF\x02\x01", "application/octet-stream"),
        ("grün\n".encode(), "text/plain"), ("grün".encode("latin-1"), "text/plain"), ("﻿ab".encode("utf-16-le"), "text/plain"),
    ],
)
def test_binary_is_not_text(spark, head, kind):
    row = spark.createDataFrame([(bytearray(head), "name")], "c binary, p string").select(media.media_type(F.col("c"), F.col("p")).alias("t"))
    assert row.first().t == kind


def test_csv_over_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2\na,b\n1,2,3,4\n"x\ny",z\\",p ""q""\nlast,"open\nend')
    got = [r.fields for r in delimited.read_csv(spark, str(tmp_path), multi_line=True).orderBy("line_no").collect()]
    assert got[0] == ["h1", "h2"] and got[2] == ["1", "2", "3", "4"] and got[3][:2] == ["x\ny", 'z"'] and len(got) == 5
    skipped = delimited.read_csv(spark, str(tmp_path), skip=1, multi_line=True).orderBy("line_no").collect()
    assert [r.fields for r in skipped][0] == ["a", "b"] and len(skipped) == 4


def test_plain_lines_are_split_as_folded(spark):
    lines = ["a,b,c", ",a,,", "", " x , y ", "no separator", "a\tb,ü", ",,,"]
    plain = spark.createDataFrame([(x,) for x in lines], "v string")
    fast = [r[0] for r in plain.select(delimited.csv_fields(F.col("v"))).collect()]
    folded = [r[0][:-1] for r in plain.select(delimited.csv_fields(F.concat("v", F.lit(',"q"')))).collect()]
    assert fast == folded


def test_entities_sections_and_bare_links(spark):
    html = '<a href=/x/y>1</a> <a href=\'q\'>2</a> caf&eacute; &#8364; &#x41; &amp;lt; &nope; &#xD800; &Aacute;&lt;'
    row = spark.createDataFrame([(1, html)], "id long, html string")
    out = markup.html_extract(row).first()
    assert out.links == ["/x/y", "q"] and out.text == "1 2 café € A &lt; &nope; &#xD800; Á<"
    xml = "<r><dc:title><![CDATA[A <b> & c]]></dc:title><k>v</k></r>"
    meta = markup.xml_metadata(spark.createDataFrame([("p", xml)], "path string, content string")).first()
    assert meta.metadata == {"title": ["A <b> & c"], "k": ["v"]} and "A <b> & c" in meta.text


def test_extra_cells_by_kind(spark):
    rows = [("d", "s", None, "true", "protected"), ("d", "s", None, "head", "header"), ("d", "s", None, "words", "shape"), ("d", "s", None, "5", "cell")]
    cells = spark.createDataFrame(rows, "doc string, sheet string, row int, value string, kind string")
    assert [r.content for r in sheets.extra_cells(cells).collect()] == ["words"]


def lines_of(spark, rows):
    """(section, x, y, words) of one page."""
    data = [("d", 1, s, n, float(x), float(y), float(y), 10.0, 8.0, 4.0, w.split()) for n, (s, x, y, w) in enumerate(rows)]
    schema = "doc_id string, page int, section int, line_no int, x double, first_y double, last_y double, height double, first_w double, space_w double, words array<string>"
    return spark.createDataFrame(data, schema)


def test_paragraph_rules(spark):
    rows = [
        (0, 0, 0, "a"), (0, 0, 12, "level"), (0, 20, 24, "indent opens"), (0, 40, 36, "hangs"), (0, 40, 48, "hangs on"),
        (0, 0, 60, "out of a hang opens"), (0, -10, 72, "out of an opening does not"), (0, -10, 110, "far opens"),
        (1, -10, 120, "other section opens"), (1, -7, 132, "a little aside does not"),
    ]
    got = layout.paragraphs(lines_of(spark, rows)).orderBy("line_no").collect()
    assert [r.opens_paragraph for r in got] == [True, False, True, False, False, True, False, True, True, False]
    assert [r.paragraph_no for r in got] == [0, 0, 1, 1, 1, 2, 2, 3, 4, 4]
    text = layout.page_text(layout.paragraphs(lines_of(spark, rows)), paragraph_start="<p>", paragraph_end="</p>").first().content
    assert text.startswith("<p>a\nlevel\n</p><p>indent opens\nhangs\nhangs on\n</p><p>out of a hang") and text.endswith("</p>")


def test_sort_glyphs_ranks_by_place(spark):
    rows = [("d", 1, 3, 5.0, 0.0), ("d", 1, 1, 0.0, 10.0), ("d", 1, 2, 0.0, 0.0), ("e", 1, 1, 0.0, 0.0)]
    glyphs = spark.createDataFrame(rows, "doc_id string, page int, seq int, x double, y double")
    got = {(r.doc_id, r.seq): r["rank"] for r in layout.sort_glyphs(glyphs).collect()}
    assert got == {("d", 2): 1, ("d", 3): 2, ("d", 1): 3, ("e", 1): 1}
