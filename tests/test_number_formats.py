"""Number-format codes against what a spreadsheet shows."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

from docweave.functions import number_formats as nf
from docweave.operators import sheets
from docweave.sources import workbook

# code, stored number, text shown
CASES = [
    ("General", "12", "12"), ("General", "0.1", "0.1"), ("General", "-1234.5678", "-1234.5678"), ("General", "123456789012345", "1.23457E+14"),
    ("General", "0.30000000000000004", "0.3"), ("0", "2.5", "3"), ("0", "-2.5", "-3"), ("0.00", "1.005", "1.01"), ("0.00", "2", "2.00"),
    ("#,##0", "1234567.5", "1,234,568"), ("#,##0.00", "-1234.5", "-1,234.50"), ("#,##0", "0", "0"), ("#", "7", "7"), ("000", "7", "007"),
    ("0.0##", "1.5", "1.5"), ("0%", "0.256", "26%"), ("0.00%", "-0.1234", "-12.34%"), ("0.00E+00", "12345", "1.23E+04"), ("0.00E+00", "0.00012", "1.20E-04"),
    ("#,##0_);(#,##0)", "-1234", "(1,234)"), ("#,##0_);(#,##0)", "1234", "1,234 "), ("#,##0;[Red]-#,##0", "-5", "-5"), ('0.00;-0.00;"nil"', "0", "nil"),
    ('"EUR "0.00', "3.5", "EUR 3.50"), ("[$€-407] #,##0.00", "1000", "€ 1,000.00"), ('0.0,"k"', "12345", "12.3k"), ("0.0,,", "12345678", "12.3"),
    ("000-00-0000", "123456789", "123-45-6789"), ("(000) 000-0000", "5551234567", "(555) 123-4567"), ("000-00-0000", "12", "000-00-0012"),
    ("# ?/?", "1.5", "1 1/2"), ("# ?/?", "3", "3"), ("# ??/??", "0.3125", "5/16"), ("?/?", "1.25", "5/4"), ("# ?/8", "2.26", "2 2/8"), ("# ?/?", "0.99", "1"),
    ("[>=1000]0.0,\"k\";0", "1500", "1.5k"), ("[>=1000]0.0,\"k\";0", "15", "15"), ("[=1]\"one\";[=2]\"two\";0", "2", "two"), ("[=1]\"one\";[=2]\"two\";0", "9", "9"),
    ("yyyy-mm-dd", "44197", "2021-01-01"), ("m/d/yy", "44197.75", "1/1/21"), ("d-mmm-yy", "44260", "5-Mar-21"), ("mmmm d, yyyy", "44260", "March 5, 2021"),
    ("dddd", "44260", "Friday"), ("ddd dd.mm.yyyy", "44260", "Fri 05.03.2021"), ("h:mm AM/PM", "0.75", "6:00 PM"), ("hh:mm:ss", "44260.5001157407", "12:00:10"),
    ("m/d/yy h:mm", "44260.51", "3/5/21 12:14"), ("mm:ss.0", "0.000694444", "01:00.0"), ("[h]:mm:ss", "1.5", "36:00:00"), ("[mm]:ss", "0.0625", "90:00"),
    ("[hh]:mm", "0.0625", "01:30"), ("[s].00", "0.0001", "8.64"), ("yyyy\"y\" m\\m", "44260", "2021y 3m"), ("yyyy-mm-dd", "1", "1900-01-01"), ("yyyy-mm-dd", "59", "1900-02-28"),
    ("yyyy-mm-dd", "61", "1900-03-01"), ("yyyy-mm-dd", "-3", "-3"), ("0.00", "text", "text"), ('@" units"', "many", "many units"), ("0;-0;0;\"<\"@\">\"", "x", "<x>"), ("0.00", "1E+3", "1000.00"),
]


def test_codes(spark):
    rows = [(k, code, value, value not in ("text", "many", "x")) for k, (code, value, _) in enumerate(CASES)]
    cells = spark.createDataFrame(rows, "k int, code string, value string, number boolean")
    cells = cells.withColumn("from_1904", F.lit(False))
    got = {r.k: r.shown for r in nf.format_cells(cells, nf.compiled_codes(cells.select("code"))).collect()}
    wrong = [(*case, got[k]) for k, case in enumerate(CASES) if got[k] != case[2]]
    assert not wrong


def test_odd_codes(spark):
    """Whatever a file holds as a code, its cells are read."""
    odd = ["", ";;;", ";", '"open', "[", "\\", "_", "0;;", "[h", "%", "/", "AM/PM", "E+", "0.0.0", "é", "?", ",", "yyyyyyy", "[h]", "0E", "E+0", "0/0", "# ?/0"]
    for code in odd:
        rules = nf.compile_code(code)
        assert rules["numbers"] and rules["words"]
    rows = [(c, v, v != "x", False) for c in [*odd, None] for v in ("1.5", "-2", "0", "x", None, "1e300")]
    cells = spark.createDataFrame(rows, "code string, value string, number boolean, from_1904 boolean")
    assert len(nf.format_cells(cells, nf.compiled_codes(cells.select("code"))).collect()) == len(rows)


def book(cells, codes, flags=""):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    pack = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
    own = "".join(f'<numFmt numFmtId="{200 + k}" formatCode="{c}"/>' for k, c in enumerate(codes))
    styles = f"<styleSheet {ns}><numFmts>{own}</numFmts><cellXfs><xf/>" + "".join(f'<xf numFmtId="{200 + k}"/>' for k in range(len(codes))) + '<xf numFmtId="14"/></cellXfs></styleSheet>'
    body = "".join(f'<row r="{r}">' + "".join(cells_) + "</row>" for r, cells_ in enumerate(cells, start=1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><workbookPr {flags}/><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships {pack}><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/styles.xml", styles)
    return bytearray(out.getvalue())


def test_dates_reach_the_records(spark):
    """Formatted values, booleans, text that looks like a number, both date systems and a broken file beside them."""
    text = lambda ref, t: f'<c r="{ref}" t="inlineStr" s="1"><is><t>{t}</t></is></c>'
    cells = [
        [text("A1", "when"), text("B1", "sum"), text("C1", "seen")],
        ['<c r="A2" s="1"><v>44260</v></c>', '<c r="B2" s="2"><v>1234.5</v></c>', '<c r="C2" t="b"><v>1</v></c>'],
        [text("A3", "007"), '<c r="B3" s="3"><v>44260.25</v></c>', '<c r="C3" t="e"><v>#N/A</v></c>'],
        ['<c r="A4" s="99"><v>5</v></c>'],
    ]
    codes = ["dd.mm.yyyy", "#,##0.00"]
    files = spark.createDataFrame(
        [("a", book(cells, codes)), ("b", book(cells, codes, 'date1904="1"')), ("c", bytearray(b"PK broken")), ("d", None)], "path string, content binary"
    )
    found = workbook.workbook_cells(files.filter("path <> 'd'"))
    shown = {(r.doc, r.row, r.col): (r.value, r.raw, r.date) for r in found.where("kind = 'cell'").collect()}
    assert shown[("a", 2, "A")] == ("05.03.2021", "44260", dt.datetime(2021, 3, 5))
    assert shown[("b", 2, "A")] == ("06.03.2025", "44260", dt.datetime(2025, 3, 6))
    assert shown[("a", 2, "B")][0] == "1,234.50" and shown[("a", 2, "C")][0] == "TRUE" and shown[("a", 3, "C")][0] == "#N/A"
    assert shown[("a", 3, "A")] == ("007", "007", None) and shown[("a", 3, "B")][0] == "3/5/21" and shown[("a", 4, "A")][0] == "5"
    rows = {(r.doc, r.row_number): r for r in sheets.sheet_rows(found.where("kind = 'cell'")).collect()}
    assert rows[("a", 2)].date_text == [dt.datetime(2021, 3, 5)] and rows[("a", 2)].record["when"] == "05.03.2021"
    assert rows[("a", 3)].date_text == [dt.datetime(2021, 3, 5, 6)] and rows[("a", 4)].date_text == []
    assert [r.error is not None for r in found.where("doc = 'c'").collect()] == [True]
