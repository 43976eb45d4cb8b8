"""Open-format workbooks to a long table of cells."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docweave.functions.number_formats import BUILT_IN, compiled_codes, format_cells
from docweave.functions.text import strip
from docweave.operators.sheets import column_number, split_cell_ref

# Namespaces of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"

_RAW = (
    "doc string, sheet string, ref string, value string, style int, kind string, "
    "comment_author string, comment string, error string, code string, number boolean, from_1904 boolean"
)


def _text(node) -> str:
    # shared and inline strings hold plain text or formatted runs
    return "".join(t.text or "" for t in node.iter(MAIN + "t"))


def _parts_of(book: zipfile.ZipFile, part: str) -> dict[str, str]:
    folder, _, name = part.rpartition("/")
    rels = f"{folder}/_rels/{name}.rels"
    if rels not in book.namelist():
        return {}
    out = {}
    for rel in ET.fromstring(book.read(rels)).iter(PACKAGE + "Relationship"):
        target = rel.get("Target")
        path = target.lstrip("/") if target.startswith("/") else f"{folder}/{target}"
        while "/../" in path:
            head, _, tail = path.partition("/../")
            path = f"{head.rpartition('/')[0]}/{tail}".lstrip("/")
        out[rel.get("Id")] = path
    return out


def _comments(book: zipfile.ZipFile, parts: dict[str, str]) -> dict[str, tuple]:
    out = {}
    for path in parts.values():
        if "comments" in path and path in book.namelist():
            root = ET.fromstring(book.read(path))
            authors = [a.text for a in root.iter(MAIN + "author")]
            for c in root.iter(MAIN + "comment"):
                number = int(c.get("authorId", "0"))
                out[c.get("ref")] = (authors[number] if number < len(authors) else None, _text(c))
    return out


def _codes(book: zipfile.ZipFile) -> list[str]:
    """The number-format code of each style of a workbook."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode") for f in root.iter(MAIN + "numFmt")}
    styles = root.find(MAIN + "cellXfs")
    numbers = [int(x.get("numFmtId", "0")) for x in styles] if styles is not None else []
    return [own.get(n) or BUILT_IN.get(n, "General") for n in numbers]


def _cells(doc: str, data: bytes):
    book = zipfile.ZipFile(io.BytesIO(data))
    names = set(book.namelist())
    codes = _codes(book)
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = [_text(si) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(MAIN + "si")]
    targets = _parts_of(book, "xl/workbook.xml")
    root = ET.fromstring(book.read("xl/workbook.xml"))
    from_1904 = any(p.get("date1904") in ("1", "true") for p in root.iter(MAIN + "workbookPr"))
    for sheet in root.iter(MAIN + "sheet"):
        title, part = sheet.get("name"), targets[sheet.get(REL + "id")]
        linked = _parts_of(book, part)
        comments = _comments(book, linked)
        for _, el in ET.iterparse(io.BytesIO(book.read(part))):
            if el.tag == MAIN + "c":
                ref, kind, v = el.get("r"), el.get("t", "n"), el.find(MAIN + "v")
                if kind == "inlineStr":
                    value = _text(el)
                elif v is None or v.text is None:
                    value = None
                else:
                    value = shared[int(v.text)] if kind == "s" else v.text
                who, note = comments.pop(ref, (None, None))
                if value is not None or note is not None:
                    style = int(el.get("s") or 0)
                    number = kind == "n" and value is not None
                    # booleans, errors and stored dates have no format
                    code = codes[style] if kind in ("n", "s", "str", "inlineStr") and style < len(codes) else None
                    if kind == "b" and value is not None:
                        value = "TRUE" if value == "1" else "FALSE"
                    style = int(el.get("s")) if el.get("s") else None
                    yield (doc, title, ref, value, style, "cell", who, note, None, code, number, from_1904)
            elif el.tag in (MAIN + "oddHeader", MAIN + "oddFooter") and el.text:
                kind = "header" if el.tag.endswith("Header") else "footer"
                yield (doc, title, None, el.text, None, kind, None, None, None, None, False, False)
            elif el.tag == MAIN + "sheetProtection":
                yield (doc, title, None, "true", None, "protected", None, None, None, None, False, False)
            elif el.tag == MAIN + "row":
                el.clear()
        for path in linked.values():
            if "/drawings/" in path and path.endswith(".xml") and path in names:
                for block in ET.fromstring(book.read(path)).iter(DRAWING + "p"):
                    words = "".join(t.text or "" for t in block.iter(DRAWING + "t"))
                    if words:
                        yield (doc, title, None, words, None, "shape", None, None, None, None, False, False)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _RAW.split(", ")]
    for batch in batches:
        out = []
        for doc, data in zip(batch["doc"], batch["content"]):
            try:
                out.extend(_cells(doc, bytes(data)))
            except (zipfile.BadZipFile, KeyError, ET.ParseError, ValueError, IndexError) as problem:
                # a broken file is reported and the others go on
                out.append((doc, None, None, None, None, "error", None, None, repr(problem), None, False, False))
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)


def workbook_codes(files: DataFrame, content: str = "content") -> DataFrame:
    """(code) of every style of every workbook, each once; only their style parts are unpacked."""

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: set[str] = set()
            for data in batch["content"]:
                try:
                    found.update(_codes(zipfile.ZipFile(io.BytesIO(bytes(data)))))
                except (zipfile.BadZipFile, KeyError, ET.ParseError, ValueError, TypeError):
                    continue  # the reader of the cells reports it
            yield pd.DataFrame({"code": sorted(found)}, dtype=object)

    return files.select(F.col(content).alias("content")).mapInPandas(codes, "code string").distinct()


def workbook_cells(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Non-empty cells of workbooks, a row each, with their comments.

    ``value`` is what the sheet shows: number-format codes are compiled once for
    each distinct code and joined to the cells, which built-in expressions then
    format. ``raw`` is the stored text, ``date`` the time of a number shown as a
    date. ``kind`` tells cells from sheet headers and footers, text of shapes,
    the protected flag and files that could not be read (``error`` says why).
    """
    raw = files.select(F.col(path).alias("doc"), F.col(content).alias("content")).mapInPandas(_read, _RAW)
    raw = format_cells(raw, compiled_codes(workbook_codes(files, content)))
    ref = split_cell_ref(F.col("ref"))
    return raw.select(
        "doc",
        "sheet",
        ref["row"].alias("row"),
        ref["col"].alias("col"),
        column_number(ref["col"]).alias("col_no"),
        F.col("shown").alias("value"),
        "style",
        "kind",
        "comment_author",
        F.when(strip(F.col("comment")) != "", F.col("comment")).alias("comment"),
        "error",
        F.col("value").alias("raw"),
        "date",
    )
