"""Text from positioned glyphs: lines, words, paragraphs, pages.

Input is ``glyphs(doc_id, page, seq, ch, x, y, w, h, space_w, font, font_size)``.
The rules carry running state from glyph to glyph, so each page is read in
order. :func:`arrange` brings the pages of loose glyph rows together with one
shuffle and one sort; a :class:`Source` gives the glyphs of rows that hold them
inside the task, so that only those rows travel.
Every step after it is narrow and works on whole pages of Arrow batches at once.
What depends on the glyph before is an array operation over all of them; only
glyphs with an equal one close by, accents with their neighbours, and changes of
height within a line are looked at one by one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docweave.functions.text import fold_ligatures, list_item_kind, ltr_count, rtl_count

PAGE = ("doc_id", "page")

# Gap and indent limits.
SPACE_TOLERANCE = 0.5
CHAR_TOLERANCE = 0.3
LINE_TOLERANCE = 0.1
DROP = 2.5
INDENT = 2.0

# Side of the cells that kept glyphs are filed by.
CELL = 8.0


def arrange(glyphs: DataFrame) -> DataFrame:
    """Pages gathered, glyphs in drawing order: the one shuffle of the layout steps."""
    return gather_pages(glyphs).sortWithinPartitions(*PAGE, "seq")


def gather_pages(glyphs: DataFrame) -> DataFrame:
    """Glyphs of a page in one partition; AQE sizes the partitions by the data."""
    return glyphs.repartition(*PAGE)


def reorder(arranged: DataFrame, by_position: bool = False) -> DataFrame:
    """Arranged pages by section, then drawing order or place; sorts in place, no shuffle."""
    section = ["section"] if "section" in arranged.columns else []
    order = ["y", "x", "seq"] if by_position else ["seq"]
    return arranged.sortWithinPartitions(*PAGE, *section, *order)


def sort_glyphs(
    glyphs: DataFrame, *before: Callable[[T.StructType], Stage], after: Sequence[Callable[[T.StructType], Stage]] = (), source: Source | None = None
) -> DataFrame:
    """Glyphs with their rank by position on the page; ``before`` and ``after``: rules of the same pass, over glyphs as drawn and as ranked.

    Loose glyphs are gathered in drawing order; each page is then put in order by itself.
    """
    arranged = glyphs if source else arrange(glyphs)
    return scan_pages(arranged, *before, order_stage("y", "x", "seq"), rank_stage, *after, source=source)


@dataclass(frozen=True)
class Stage:
    """One rule over whole pages: ``run`` takes a table of pages, one after the other, and gives the next one."""

    run: Callable[[pa.Table], pa.Table]
    schema: T.StructType


@dataclass(frozen=True)
class Source:
    """Glyphs from rows that hold many: ``run`` takes batches of rows, gathered and in order, and gives glyphs in order."""

    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
    schema: T.StructType


# Glyphs of whole pages worked on at once, at least.
ROWS = 1 << 16


def scan_pages(arranged: DataFrame, *builders: Callable[[T.StructType], Stage], source: Source | None = None) -> DataFrame:
    """Run rules over arranged pages, all in one pass over the Arrow batches.

    Each builder gets the schema it reads and gives its stage; tables go from one
    stage to the next without leaving the task. A page that a batch ends in is
    held back until it is whole. With a ``source`` the rows are not glyphs but
    what it takes them from.
    """
    schema = source.schema if source else arranged.schema
    stages = []
    for build in builders:
        stages.append(build(schema))
        schema = stages[-1].schema
    runs = [s.run for s in stages]
    out_schema = to_arrow_schema(schema)

    def through(table: pa.Table):
        for run in runs:
            if table.num_rows:
                table = run(table)
        if table.num_rows:
            yield from table.select(out_schema.names).cast(out_schema).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in source.run(batches) if source else batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                whole = int(starts_of(table, PAGE)[-1])  # the last page may go on
                yield from through(table.slice(0, whole))
                rest = table.slice(whole)
                held, rows = rest.combine_chunks().to_batches(), 0
        if held:
            yield from through(pa.Table.from_batches(held).combine_chunks())

    return arranged.mapInArrow(run, schema)


def changes(table: pa.Table, names) -> np.ndarray:
    """Whether a row differs from the one before it in any of the columns; true for the first. Nulls are alike."""
    out = np.zeros(table.num_rows, bool)
    if table.num_rows:
        out[0] = True
    for name in names:
        column = table.column(name)
        if pa.types.is_floating(column.type):
            values = column.to_numpy()
            out[1:] |= (values[1:] != values[:-1]) & ~(np.isnan(values[1:]) & np.isnan(values[:-1]))
        elif pa.types.is_integer(column.type) and not column.null_count:
            values = column.to_numpy()
            out[1:] |= values[1:] != values[:-1]
        else:
            codes = column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            out[1:] |= codes[1:] != codes[:-1]
    return out


def starts_of(table: pa.Table, names) -> np.ndarray:
    return np.flatnonzero(changes(table, names))


def _floats(table: pa.Table, name: str) -> np.ndarray:
    """A column as floats, null as not a number."""
    return table.column(name).cast(pa.float64()).to_numpy()


def _texts(table: pa.Table, name: str = "ch") -> tuple[np.ndarray, list[str]]:
    """Codes of the texts of a column, and the texts by code; null counts as empty."""
    coded = table.column(name).combine_chunks().cast(pa.string()).fill_null("").dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def _replaced(table: pa.Table, name: str, values: pa.Array) -> pa.Table:
    return table.set_column(table.schema.get_field_index(name), name, values)


def count_stage(*keys: str) -> Callable[[T.StructType], Stage]:
    """Rows of each page counted by ``keys``, which name the page too; pages are whole, so these are all of them."""

    def build(schema: T.StructType) -> Stage:
        def run(table: pa.Table) -> pa.Table:
            counts = table.group_by(list(keys), use_threads=False).aggregate([([], "count_all")])
            return pa.table({**{k: counts.column(k) for k in keys}, "n": counts.column("count_all")})

        return Stage(run, T.StructType([*(schema[k] for k in keys), T.StructField("n", T.LongType())]))

    return build


def order_stage(*columns: str) -> Callable[[T.StructType], Stage]:
    """Glyphs of each page in order by section, if there is one, and by numeric ``columns``: nulls first, not-a-numbers last."""

    def build(schema: T.StructType) -> Stage:
        order = (["section"] if "section" in schema.fieldNames() else []) + list(columns)

        def run(table: pa.Table) -> pa.Table:
            keys = [np.cumsum(changes(table, PAGE))]
            for name in order:
                column = table.column(name).combine_chunks()
                known = column.is_valid().to_numpy(zero_copy_only=False)
                keys += [known, column.fill_null(0).to_numpy(zero_copy_only=False)] if column.null_count else [column.to_numpy()]
            return table.take(pa.array(np.lexsort(keys[::-1])))

        return Stage(run, schema)

    return build


def rank_stage(schema: T.StructType) -> Stage:
    def run(table: pa.Table) -> pa.Table:
        first = changes(table, PAGE)
        at = np.arange(table.num_rows)
        rank = at - np.maximum.accumulate(np.where(first, at, 0)) + 1
        return table.append_column("rank", pa.array(rank.astype(np.int32)))

    return Stage(run, T.StructType([*schema.fields, T.StructField("rank", T.IntegerType())]))


def _with_equal_close(page: np.ndarray, code: np.ndarray, x: np.ndarray, y: np.ndarray, near: float) -> np.ndarray:
    """Glyphs that may have an equal one within ``near`` in both directions: it lies in a cell they reach into."""
    side = max(2 * near, 1e-6)
    low_x, high_x = np.floor((x - near) / side), np.floor((x + near) / side)
    low_y, high_y = np.floor((y - near) / side), np.floor((y + near) / side)
    own_x, own_y = np.floor(x / side), np.floor(y / side)
    kind = page * (int(code.max()) + 1) + code

    def cell(cx, cy):
        # a hash: two cells that share a value only make more glyphs be looked at
        with np.errstate(over="ignore"):
            mixed = kind.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= cx.astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed += cy.astype(np.int64).view(np.uint64) * np.uint64(0x165667B19E3779F9)
            return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)

    # a hash table of cells with room to spare; the last glyph of a cell owns it
    bits = int(32 * len(x)).bit_length()
    place = lambda keys: (keys >> np.uint64(64 - bits)).astype(np.int64)
    owner = np.full(1 << bits, -1, np.int32)
    at, mine = place(cell(own_x, own_y)), np.arange(len(x), dtype=np.int32)
    owner[at] = mine
    shared = np.zeros(1 << bits, bool)
    shared[at[owner[at] != mine]] = True
    out = shared[at]
    for cx in (low_x, high_x):
        for cy in (low_y, high_y):
            other = np.flatnonzero(~out & ((cx != own_x) | (cy != own_y)))
            out[other] = owner[place(cell(cx, cy)[other])] >= 0
    return out


def overprint_stage(schema: T.StructType) -> Stage:
    def run(table: pa.Table) -> pa.Table:
        code, texts = _texts(table)
        x, y = _floats(table, "x"), _floats(table, "y")
        lengths = np.maximum([len(t) for t in texts], 1)[code]
        near = _floats(table, "w") / lengths / 3.0
        placed = np.isfinite(x) & np.isfinite(y) & (near > 0)
        if not placed.any():
            return table
        page = np.cumsum(changes(table, PAGE))
        at = np.flatnonzero(placed)
        for _ in range(2):  # the few glyphs found meet in a table of their own once more
            at = at[_with_equal_close(page[at], code[at], x[at], y[at], float(near[at].max()))]
            if not len(at):
                return table
        # glyphs far from all others of their kind in height, or in place, stand apart
        kind, order = page[at] * (int(code.max()) + 1) + code[at], np.arange(len(at))
        for value in (y[at], x[at]):
            order = order[np.lexsort((value[order], kind[order]))]
            parts = np.ones(len(at), bool)
            parts[1:] = (np.diff(kind[order]) != 0) | (np.diff(value[order]) > 1.5 * near[at].max())
            kind[order] = np.cumsum(parts)
        size = np.bincount(kind)[kind]
        # of two that meet the first is kept, whatever the others are
        pairs = np.flatnonzero(size == 2)
        pairs = pairs[np.argsort(kind[pairs], kind="stable")]
        one, two = at[pairs[::2]], at[pairs[1::2]]
        n = near[two]
        close = [(v[two] - n <= v[one]) & (v[one] < v[two] + n) for v in (x, y)]
        drop = two[close[0] & close[1]].tolist()
        at = at[size > 2]
        kept: dict[tuple, list] = {}
        current = None
        # in order, as only kept glyphs count
        for i, p, c, gx, gy, n in zip(at.tolist(), page[at].tolist(), code[at].tolist(), x[at].tolist(), y[at].tolist(), near[at].tolist()):
            if p != current:
                current, kept = p, {}
            found = False
            # kept glyphs are filed by cells, so only close ones are looked at
            for cx in range(int((gx - n) // CELL), int((gx + n) // CELL) + 1):
                for cy in range(int((gy - n) // CELL), int((gy + n) // CELL) + 1):
                    found = found or any(
                        gx - n <= kx < gx + n and gy - n <= ky < gy + n for kx, ky in kept.get((c, cx, cy), ())
                    )
            if found:
                drop.append(i)
            else:
                kept.setdefault((c, int(gx // CELL), int(gy // CELL)), []).append((gx, gy))
        if not drop:
            return table
        keep = np.ones(table.num_rows, bool)
        keep[drop] = False
        return table.filter(pa.array(keep))

    return Stage(run, schema)


def drop_overprints(arranged: DataFrame) -> DataFrame:
    """Without glyphs printed again over an equal one already kept.

    Two equal glyphs less than a third of a character width apart in both
    directions are one. Only kept glyphs count, so the rule is sequential.
    """
    return scan_pages(arranged, overprint_stage)


def assign_sections(glyphs: DataFrame, beads: str | None = "beads") -> DataFrame:
    """Section of each glyph from the page's article rectangles.

    ``beads`` is an ``array<struct<left,bottom,right,top>>`` column. Inside
    rectangle *i* gives 2i+1; else the first rectangle the glyph is left of or
    above gives 2i; else the last section. Without rectangles all is section 0.
    A plain expression: no range join.
    """
    if beads is None:
        return glyphs.withColumn("section", F.lit(0))
    x, y = F.col("x"), F.col("y")

    def inside(b: Column, i: Column) -> Column:
        hit = x.between(b["left"], b["right"]) & y.between(b["bottom"], b["top"])
        return F.when(b.isNull(), F.lit(0)).when(hit, i * 2 + 1)

    def beside(b: Column, i: Column) -> Column:
        return F.when((x < b["left"]) | (y < b["top"]), i * 2)

    first = lambda found: F.get(F.array_compact(F.transform(beads, found)), F.lit(0))
    return glyphs.withColumn("section", F.coalesce(first(inside), first(beside), F.size(beads) * 2, F.lit(0))).drop(beads)


def section_stage(schema: T.StructType) -> Stage:
    """As ``assign_sections`` by column ``beads``, over whole batches of glyphs."""

    def run(table: pa.Table) -> pa.Table:
        x, y = _floats(table, "x"), _floats(table, "y")
        beads = table.column("beads").combine_chunks()
        begin, none = beads.offsets.to_numpy()[:-1], beads.is_null().to_numpy(zero_copy_only=False)
        size = np.where(none, 0, np.diff(beads.offsets.to_numpy()))
        edge = {e: beads.values.field(e).cast(pa.float64()).to_numpy(zero_copy_only=False) for e in ("left", "bottom", "right", "top")}
        missing = beads.values.is_null().to_numpy(zero_copy_only=False)
        for values in edge.values():
            if missing.any():
                values[missing] = np.nan
        inside, beside = np.full(len(x), -1, np.int32), np.full(len(x), -1, np.int32)
        for i in range(int(size.max(initial=0))):
            at = np.flatnonzero(size > i)
            k = begin[at] + i
            left, bottom, right, top = (edge[e][k] for e in ("left", "bottom", "right", "top"))
            gx, gy = x[at], y[at]
            hit = (gx >= left) & (gx <= right) & (gy >= bottom) & (gy <= top)
            found = np.where(missing[k], 0, np.where(hit, 2 * i + 1, -1))
            inside[at] = np.where(inside[at] < 0, found, inside[at])
            beside[at] = np.where((beside[at] < 0) & ((gx < left) | (gy < top)), 2 * i, beside[at])
        section = np.where(inside >= 0, inside, np.where(beside >= 0, beside, 2 * size)).astype(np.int32)
        return table.drop_columns(["beads"]).append_column("section", pa.array(section))

    rest = [f for f in schema.fields if f.name != "beads"]
    return Stage(run, T.StructType([*rest, T.StructField("section", T.IntegerType())]))


def is_mark(ch: str) -> bool:
    """A single accent: combining mark, modifier letter or modifier symbol."""
    return len(ch) == 1 and (ch > "\x7f" or ch in "^`") and unicodedata.category(ch) in ("Mn", "Lm", "Sk")


def with_mark(base: str, mark: str) -> str:
    """Base and accent as one composed character where there is one."""
    combining = unicodedata.normalize("NFKD", mark).strip() or mark
    return unicodedata.normalize("NFC", base + combining)


def mark_stage(schema: T.StructType) -> Stage:
    apart = [*PAGE, *(["section"] if "section" in schema.fieldNames() else [])]

    def run(table: pa.Table) -> pa.Table:
        code, texts = _texts(table)
        mark = np.array([is_mark(t) for t in texts], bool)[code]
        if not mark.any():
            return table
        # only an accent and its neighbours in the same section can merge
        meets = np.zeros(table.num_rows, bool)
        meets[1:] = (mark[1:] | mark[:-1]) & ~changes(table, apart)[1:]
        at = np.flatnonzero(meets)
        x, y, w, h = (_floats(table, c) for c in ("x", "y", "w", "h"))

        def over(o: int, i: int) -> bool:
            return x[i] < x[o] + w[o] and x[i] + w[i] > x[o] and y[i] - h[i] < y[o] and y[i] > y[o] - h[o]

        keep = np.ones(table.num_rows, bool)
        text: dict[int, str] = {}
        held, last = -1, -2
        for i in at.tolist():
            if i != last + 1:
                held = i - 1  # a new run: the row before it stands as it is
            last = i
            one, other = text.get(held) or texts[code[held]], texts[code[i]]
            if is_mark(other) and over(held, i):
                text[held], keep[i] = with_mark(one, other), False
            elif is_mark(one) and over(i, held):
                text[i], keep[held] = with_mark(other, one), False
                held = i
            else:
                held = i
        if text:
            code[list(text)] = np.arange(len(texts), len(texts) + len(text))
            table = _replaced(table, "ch", pa.array([*texts, *text.values()], pa.string()).take(pa.array(code)))
        return table.filter(pa.array(keep))

    return Stage(run, schema)


def merge_marks(arranged: DataFrame) -> DataFrame:
    """Accents merged with the glyph just before or after that they lie within."""
    return scan_pages(arranged, mark_stage)


def _line_numbers(table: pa.Table, apart: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Number of the line of each glyph on its page.

    The band of a line is the greatest of its heights and places. Glyphs of one
    height and place after another never leave the band they entered, so it
    moves between such runs only. ``apart``: where a page or section begins.
    """
    y, h = _floats(table, "y"), _floats(table, "h")
    run = apart.copy()
    run[1:] |= (y[1:] != y[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(run)
    numbers = np.empty(len(at), np.int32)
    line, band_y, band_h = 0, 0.0, 0.0
    steps = zip(y[at].tolist(), h[at].tolist(), apart[at].tolist(), page[at].tolist())
    for k, (gy, gh, begins, new_page) in enumerate(steps):
        if new_page:
            line, band_y, band_h = 0, gy, gh
        elif begins or not _overlap(gy, gh, band_y, band_h):
            line, band_y, band_h = line + 1, gy, gh
        else:
            band_y, band_h = max(band_y, gy), max(band_h, gh)
        numbers[k] = line
    return numbers[np.cumsum(run) - 1]


def _running_mean(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Mean of each value and the mean before it, which begins anew where ``begins``."""
    out = values.copy()
    varies = np.zeros(len(values), bool)
    varies[1:] = (values[1:] != values[:-1]) & ~begins[1:]
    if varies.any():
        # only stretches whose values differ are summed up one by one
        part = np.cumsum(begins) - 1
        some = np.flatnonzero(np.bincount(part, varies)[part] > 0)
        means, mean = [], 0.0
        for value, new in zip(values[some].tolist(), begins[some].tolist()):
            mean = value if new else (mean + value) / 2.0
            means.append(mean)
        out[some] = means
    return out


def place_stage(schema: T.StructType) -> Stage:
    sections = ["section"] if "section" in schema.fieldNames() else []

    def run(table: pa.Table) -> pa.Table:
        page = changes(table, PAGE)
        apart = page | changes(table, sections) if sections else page
        line = _line_numbers(table, apart, page)
        code, texts = _texts(table)
        x, w, space = _floats(table, "x"), _floats(table, "w"), _floats(table, "space_w")
        per_char = w / np.maximum([len(t) for t in texts], 1)[code]
        mean = _running_mean(per_char, apart | changes(table, ["font", "font_size"]))
        before = np.concatenate(([np.nan], space[:-1]))
        unknown = apart | np.isnan(before)
        with np.errstate(invalid="ignore"):
            gap = SPACE_TOLERANCE * np.where(unknown, space, (space + before) / 2.0)
            gap = np.where(np.isnan(space) | (space == 0), np.inf, gap)
            gap = np.where(CHAR_TOLERANCE * mean < gap, CHAR_TOLERANCE * mean, gap)
            beyond = np.zeros(len(x), bool)
            beyond[1:] = x[1:] > (x + w)[:-1] + gap[1:]
        blank = np.array([t.endswith(" ") for t in texts], bool)[code]
        first = apart.copy()
        first[1:] |= line[1:] != line[:-1]
        spaced = beyond & ~first
        spaced[1:] &= ~blank[:-1]
        table = table.append_column("line_no", pa.array(line))
        return table.append_column("space_before", pa.array(spaced))

    placed = [T.StructField("line_no", T.IntegerType()), T.StructField("space_before", T.BooleanType())]
    return Stage(run, T.StructType([*schema.fields, *placed]))


def place_glyphs(arranged: DataFrame) -> DataFrame:
    """Line number of each glyph and whether a space comes before it.

    A glyph opens a line when it does not overlap the band of the current one.
    A space is due when it starts beyond the end of the last glyph by more than
    half a space width or three tenths of a character width, whichever is less.
    """
    return scan_pages(arranged, place_stage)


def _overlap(y1: float, h1: float, y2: float, h2: float) -> bool:
    return abs(y1 - y2) < LINE_TOLERANCE or y1 - h1 <= y2 <= y1 or y2 - h2 <= y1 <= y2


_LINE_FIELDS = [
    T.StructField("section", T.IntegerType()),
    T.StructField("line_no", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("first_y", T.DoubleType()),
    T.StructField("last_y", T.DoubleType()),
    T.StructField("height", T.DoubleType()),
    T.StructField("first_w", T.DoubleType()),
    T.StructField("space_w", T.DoubleType()),
    T.StructField("words", T.ArrayType(T.StringType())),
]


def line_stage(schema: T.StructType) -> Stage:
    has_section = "section" in schema.fieldNames()

    def run(table: pa.Table) -> pa.Table:
        begins = changes(table, [*PAGE, "line_no"])
        at = np.flatnonzero(begins)
        ends = np.append(at[1:], table.num_rows)
        code, texts = _texts(table)
        blank = np.array([t == " " for t in texts], bool)[code]
        opens = begins | table.column("space_before").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False) | blank
        # a blank opens a word without being part of it
        shown = pa.array(["" if t == " " else t for t in texts], pa.string()).take(pa.array(code))
        starts = np.flatnonzero(opens)
        glyphs = pa.ListArray.from_arrays(pa.array(np.append(starts, table.num_rows).astype(np.int32)), shown)
        words = pc.binary_join(glyphs, "")
        filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        owner = np.cumsum(begins)[starts[filled]] - 1
        offsets = np.zeros(len(at) + 1, np.int32)
        np.cumsum(np.bincount(owner, minlength=len(at)), out=offsets[1:])
        first = table.take(pa.array(at))
        columns = {
            **{k: first.column(k) for k in PAGE},
            "section": first.column("section") if has_section else pa.array(np.zeros(len(at), np.int32)),
            "line_no": first.column("line_no"),
            "x": first.column("x"),
            "first_y": first.column("y"),
            "last_y": table.column("y").take(pa.array(ends - 1)),
            "height": pa.array(np.maximum.reduceat(_floats(table, "h"), at)),
            "first_w": first.column("w"),
            "space_w": first.column("space_w"),
            "words": pa.ListArray.from_arrays(pa.array(offsets), words.filter(pa.array(filled))),
        }
        return pa.table(columns)

    keys = [f for f in schema.fields if f.name in PAGE]
    return Stage(run, T.StructType([*keys, *_LINE_FIELDS]))


def lines(placed: DataFrame) -> DataFrame:
    """One row per line, with its words in drawing order and its measures."""
    return scan_pages(placed, line_stage)


def page_lines(
    ordered: DataFrame, overprints: bool = True, marks: bool = True, *after: Callable[[T.StructType], Stage], source: Source | None = None
) -> DataFrame:
    """From glyphs in order to lines, in one pass over the columns that the rules read; ``after``: rules over the lines."""
    ordered = ordered if source else ordered.drop("seq")
    before = [overprint_stage] * overprints + [mark_stage] * marks
    return scan_pages(ordered, *before, place_stage, line_stage, *after, source=source)


# How a line stands to the one before it, and what that makes of it. States: plain,
# opening a paragraph, hanging below an opening line.
PLAIN, OPENING, HANGING = range(3)
STANDS = ("apart", "indented", "outdented", "level", "level_item", "other")
FOLLOWS = {
    "apart": (OPENING, OPENING, OPENING),
    "indented": (OPENING, HANGING, OPENING),
    "outdented": (OPENING, PLAIN, OPENING),
    "level": (PLAIN, PLAIN, HANGING),
    "level_item": (PLAIN, OPENING, HANGING),
    "other": (PLAIN, PLAIN, PLAIN),
}


def paragraphs(lines_in_order: DataFrame, drop: float = DROP, indent: float = INDENT) -> DataFrame:
    """Lines with the number of their paragraph on the page.

    Each line is compared with the one before it by a window: far below it or in
    another section, indented by more than ``indent`` spaces, outdented by more
    than one, level with it, or level and a list item of the same kind. What a
    line is follows from that and from what the line before was (``FOLLOWS``),
    folded over the lines of a page. A line that opens begins a paragraph.
    """
    page = W.partitionBy(*PAGE).orderBy("line_no")
    before = {c: F.lag(c).over(page) for c in ("section", "x", "last_y", "height", "_item")}
    marked = lines_in_order.withColumn("_item", list_item_kind(F.get("words", F.lit(0))))
    shift = F.col("x") - before["x"]
    far = F.abs(F.col("first_y") - before["last_y"]) > drop * before["height"]
    stands = (
        F.when(before["section"].isNull() | (before["section"] != F.col("section")) | far, "apart")
        .when(shift > indent * F.col("space_w"), "indented")
        .when(shift < -F.col("space_w"), "outdented")
        .when(F.abs(shift) >= 0.25 * F.col("first_w"), "other")
        .when(F.col("_item") == before["_item"], "level_item")
        .otherwise("level")
    )
    columns = lines_in_order.columns
    rest = [c for c in columns if c not in PAGE]
    rows = marked.withColumn("_stands", stands)
    pages = rows.groupBy(*PAGE).agg(
        F.sort_array(F.collect_list(F.struct("line_no", F.struct(*rest).alias("line"), "_stands"))).alias("_lines")
    )
    # one letter a line, so the list that grows with each step stays small
    table = F.create_map(*[x for name in STANDS for x in (F.lit(name), F.lit("".join(map(str, FOLLOWS[name]))))])

    def next_state(states: Column, line: Column) -> Column:
        before = F.right(states, F.lit(1)).cast("int")
        return F.concat(states, F.substr(table[line["_stands"]], before + 1, F.lit(1)))

    states = F.aggregate("_lines", F.lit(""), lambda s, line: F.when(s == "", F.lit(str(OPENING))).otherwise(next_state(s, line)))
    flat = pages.select(*PAGE, states.alias("_states"), F.posexplode("_lines").alias("_at", "_row"))
    opens = F.substr("_states", F.col("_at") + 1, F.lit(1)) == str(OPENING)
    number = F.sum(opens.cast("int")).over(W.partitionBy(*PAGE).orderBy("_at")) - 1
    out = flat.select(*PAGE, "_row.line.*", number.cast("int").alias("paragraph_no"), opens.alias("opens_paragraph"))
    return out.select(*columns, "paragraph_no", "opens_paragraph")


def line_text(words: Column, backwards: bool, word_separator: str = " ") -> Column:
    """Words of a line joined, back to front where the text runs right to left.

    Letters of a right-to-left word are drawn left to right, so such a word is
    turned round. Ligatures are spelled out.
    """
    logical = F.transform(
        words, lambda w: fold_ligatures(F.when(rtl_count(w) > 0, F.reverse(w)).otherwise(w))
    )
    return F.array_join(F.reverse(logical) if backwards else logical, word_separator)


def page_text(
    numbered: DataFrame,
    word_separator: str = " ",
    line_separator: str = "\n",
    paragraph_start: str = "",
    paragraph_end: str = "",
) -> DataFrame:
    """One text per page from lines with paragraph numbers.

    The direction in which most letters of a section run decides the order of
    words in all its lines, so both orders are kept until the section ends.
    """
    letters = F.array_join("words", "")
    text = numbered.select(
        *PAGE,
        "section",
        "line_no",
        "opens_paragraph",
        line_text(F.col("words"), False, word_separator).alias("_forwards"),
        line_text(F.col("words"), True, word_separator).alias("_backwards"),
        (rtl_count(letters) - ltr_count(letters)).alias("_rtl"),
    )
    backwards = F.sum("_rtl").over(W.partitionBy(*PAGE, "section")) > 0
    at = F.row_number().over(W.partitionBy(*PAGE).orderBy("line_no"))
    between = F.when(F.col("opens_paragraph"), line_separator + paragraph_end + paragraph_start).otherwise(line_separator)
    lead = F.when(at == 1, paragraph_start).otherwise(between)
    text = text.withColumn("_text", F.concat(lead, F.when(backwards, F.col("_backwards")).otherwise(F.col("_forwards"))))
    by_page = text.groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("line_no", "_text"))).alias("_lines"))
    return by_page.select(*PAGE, F.concat(F.array_join(F.col("_lines._text"), ""), F.lit(paragraph_end)).alias("content"))


def glyphs_to_text(
    glyphs: DataFrame, *, by_position: bool = False, overprints: bool = True, beads: str | None = None, **separators
) -> DataFrame:
    """All steps from glyphs to the text of each page: one shuffle, one pass over the glyphs."""
    ordered = arrange(assign_sections(glyphs, beads) if beads else glyphs)
    if beads:
        # sections are read one after the other once overprints are gone
        ordered = reorder(drop_overprints(ordered) if overprints else ordered)
        overprints = False
    if by_position:
        before = [overprint_stage] * overprints + [mark_stage]
        found = page_lines(reorder(scan_pages(ordered, *before), by_position=True), False, False)
    else:
        found = page_lines(ordered, overprints)
    return page_text(paragraphs(found), **separators)
