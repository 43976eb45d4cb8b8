"""Comma and tab separated text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from docweave.functions.text import bind, quote_regex, strip
from docweave.joins import number_within
from docweave.session import cut_lineage

_STATE = (
    "struct<fields:array<string>,cur:string,quoted:boolean,in_field:boolean,skip:boolean,at:int>"
)


def csv_fields(
    line: Column,
    separator: str = ",",
    quote: str = '"',
    escape: str = "\\",
    strict_quotes: bool = False,
    ignore_leading_space: bool = True,
) -> Column:
    """Fields of one line under the exact dialect, as ``array<string>``.

    A doubled quote is one quote. A quote inside an unquoted field is kept. The
    escape works only inside a started or quoted field and only before a quote
    or escape; elsewhere it is dropped. An open quote runs to the end of the line.

    The line is cut into special characters and runs of others, and those pieces
    are folded inside the row: a step per piece, not per character.
    """
    if len({separator, quote, escape}) < 3:
        raise ValueError("separator, quote and escape must differ")
    if not separator or separator == "\0":
        raise ValueError("the separator must be defined")
    special = "".join(quote_regex(c) for c in (separator, quote, escape))
    pieces = F.regexp_extract_all(line, F.lit(f"(?s)[{special}]|[^{special}]+"), F.lit(0))
    length = F.length(line)

    def step(s: Column, piece: Column) -> Column:
        # pieces carry their neighbours, so each step sees one character either way
        text, after, before = piece["text"], piece["after"], piece["before"]
        open_ = s["quoted"] | s["in_field"]
        is_escape, is_quote = text == escape, text == quote
        is_sep = (text == separator) & ~s["quoted"]
        plain = ~is_escape & ~is_quote & ~is_sep
        takes_next = (is_escape & open_ & after.isin(quote, escape)) | (is_quote & open_ & (after == quote))
        lone_quote = is_quote & ~takes_next
        embedded = (
            lone_quote
            & F.lit(not strict_quotes)
            & (s["at"] > 2)
            & (before != separator)
            & (s["at"] + 1 < length)
            & (after != separator)
        )
        blank = (F.length(s["cur"]) > 0) & (F.length(strip(s["cur"])) == 0) & F.lit(ignore_leading_space)
        kept = plain & (F.lit(not strict_quotes) | s["quoted"])
        cur = (
            F.when(takes_next, F.concat(s["cur"], after))
            .when(embedded & blank, F.lit(""))
            .when(embedded | kept, F.concat(s["cur"], text))
            .when(is_sep, F.lit(""))
            .otherwise(s["cur"])
        )
        moved = F.struct(
            F.when(is_sep, F.concat(s["fields"], F.array(s["cur"]))).otherwise(s["fields"]).alias("fields"),
            cur.alias("cur"),
            F.when(lone_quote, ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"),
            F.when(is_quote, ~s["in_field"]).when(is_sep, False).when(kept, True).otherwise(s["in_field"]).alias("in_field"),
            takes_next.alias("skip"),
            (s["at"] + F.length(text)).alias("at"),
        )
        passed = F.struct(
            s["fields"].alias("fields"),
            s["cur"].alias("cur"),
            s["quoted"].alias("quoted"),
            s["in_field"].alias("in_field"),
            F.lit(False).alias("skip"),
            (s["at"] + 1).alias("at"),
        )
        return F.when(s["skip"], passed).otherwise(moved).cast(_STATE)

    def neighbours(p: Column) -> Column:
        return F.transform(
            p,
            lambda text, i: F.struct(
                text.alias("text"),
                F.coalesce(F.left(F.get(p, i + 1), F.lit(1)), F.lit("")).alias("after"),
                F.when(i > 0, F.right(F.get(p, i - 1), F.lit(1))).otherwise(F.lit("")).alias("before"),
            ),
        )

    start = F.struct(
        F.array().cast("array<string>").alias("fields"),
        F.lit("").alias("cur"),
        F.lit(False).alias("quoted"),
        F.lit(False).alias("in_field"),
        F.lit(False).alias("skip"),
        F.lit(0).alias("at"),
    ).cast(_STATE)
    folded = F.aggregate(bind(pieces, neighbours), start, step, lambda s: F.concat(s["fields"], F.array(s["cur"])))
    if strict_quotes:
        return folded
    # without quote and escape a line is its pieces between separators
    plain = ~F.contains(line, F.lit(quote)) & ~F.contains(line, F.lit(escape))
    return F.when(plain, F.split(line, quote_regex(separator), -1)).otherwise(folded)


def tsv_fields(line: Column) -> Column:
    """Fields of a trimmed line; empty cells at either end are lost with the trim."""
    return F.split(strip(line), "\t")


def read_lines(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """Lines of text files as (path, line_no, line). Large files are split."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    return number_within(lines, ["path"], "line_no") if numbered else lines


def skip_lines(lines: DataFrame, skip: int) -> DataFrame:
    """Leave out lines at the start of each file.

    One drops the first line; more keep it as the header and drop that many
    lines after it; none keeps all.
    """
    if skip <= 0:
        return lines
    if skip == 1:
        return lines.where(F.col("line_no") > 1)
    return lines.where((F.col("line_no") == 1) | (F.col("line_no") > skip + 1))


def open_after(line: Column, open_before: bool, separator: str = ",", quote: str = '"', escape: str = "\\", strict_quotes: bool = False) -> Column:
    """Whether a quote is open at the end of a line that starts inside a quoted field, or outside.

    Without an escape the number of quotes decides: doubled ones go in pairs.
    Lines with both are folded piece by piece under the rules of ``csv_fields``.
    """
    special = "".join(quote_regex(c) for c in (separator, quote, escape))
    pieces = F.regexp_extract_all(line, F.lit(f"(?s)[{special}]|[^{special}]+"), F.lit(0))

    state = "struct<quoted:boolean,in_field:boolean,skip:boolean>"

    def step(s: Column, piece: Column) -> Column:
        text, after = piece["text"], piece["after"]
        is_quote, is_sep = text == quote, (text == separator) & ~s["quoted"]
        pair = ((text == escape) & after.isin(quote, escape)) | (is_quote & (after == quote))
        pair = pair & (s["quoted"] | s["in_field"])
        plain = ~is_quote & ~is_sep & (text != escape) & (F.lit(not strict_quotes) | s["quoted"])
        moved = F.struct(
            F.when(is_quote & ~pair, ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"),
            F.when(is_quote, ~s["in_field"]).when(is_sep, False).when(plain, True).otherwise(s["in_field"]).alias("in_field"),
            pair.alias("skip"),
        )
        passed = F.struct(s["quoted"].alias("quoted"), s["in_field"].alias("in_field"), F.lit(False).alias("skip"))
        return F.when(s["skip"], passed).otherwise(moved).cast(state)

    def with_next(p: Column) -> Column:
        return F.transform(
            p, lambda text, i: F.struct(text.alias("text"), F.coalesce(F.left(F.get(p, i + 1), F.lit(1)), F.lit("")).alias("after"))
        )

    # a line break inside quotes is text of the field, so the field has begun
    start = F.struct(F.lit(open_before).alias("quoted"), F.lit(open_before).alias("in_field"), F.lit(False).alias("skip")).cast(state)
    folded = F.aggregate(bind(pieces, with_next), start, step, lambda s: s["quoted"])
    odd = F.regexp_count(line, F.lit(f"[{quote_regex(quote)}]")) % 2 == 1
    counted = (odd != F.lit(open_before)) if open_before else odd
    both = F.contains(line, F.lit(quote)) & F.contains(line, F.lit(escape))
    return F.when(both, folded).otherwise(counted)


def _next_starts(code: np.ndarray, ends: bool, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines that leave a quote open, where the next record begins after them, and which of them are stray.

    ``code``: bit 0, the line opens a quote; bit 1, it closes an open one.
    ``ends``: no more lines follow in the file.
    """
    starts, closing = np.flatnonzero(code & 1), np.flatnonzero(code & 2)
    at = np.searchsorted(closing, starts, side="right")
    found = at < len(closing)
    end = np.full(len(starts), len(code))
    end[found] = closing[at[found]] + 1
    stray = (end - starts > most) | ~(found | ends)
    return starts, np.where(stray, starts + 1, end), stray


def _line_blocks(batches, size: int, most: int):
    """(path, block, entry or None, lines, its open lines, where each leads, which are stray) of blocks of line codes."""
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["codes"])
            code = np.frombuffer((row["codes"] + (row["ahead"] or "")).encode(), np.uint8) - 48
            starts, leads, stray = _next_starts(code, len(code) < size + most, most)
            inside = starts < n
            yield row["path"], row["block"], row.get("entry"), n, starts[inside], leads[inside], stray[inside]


def _exits(n: int, starts: np.ndarray, leads: np.ndarray, most: int) -> np.ndarray:
    """For each line that the block's first record may begin at, the line of the next block that its first one begins at."""
    out = np.zeros(len(starts) + 1, np.int32)
    following = np.searchsorted(starts, leads)
    for i in range(len(starts) - 1, -1, -1):  # open lines only
        out[i] = leads[i] - n if leads[i] >= n else out[following[i]]
    return out[np.searchsorted(starts, np.arange(most))]


def _entries(blocks: DataFrame, size: int, most: int) -> DataFrame:
    """(path, block, entry): the line of each block that its first record begins at."""

    def functions(batches):
        for path, block, _, n, starts, leads, _ in _line_blocks(batches, size, most):
            exits = _exits(n, starts, leads, most).tobytes()
            yield pa.RecordBatch.from_pylist([{"path": path, "block": block, "exits": exits}])

    def walk(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        entry, at = [], 0
        for exits in table.column("exits"):
            entry.append(at)
            at = int(np.frombuffer(exits.as_py(), np.int32)[at])
        return table.select(["path", "block"]).append_column("entry", pa.array(entry, pa.int32()))

    exits = blocks.mapInArrow(functions, "path string, block long, exits binary")
    return exits.groupBy("path").applyInArrow(walk, "path string, block long, entry int")


def _open_lines(blocks: DataFrame, size: int, most: int) -> DataFrame:
    """(path, line_no, record, stray) of the lines in records of several lines and of those with a stray quote."""

    def taken(batches):
        for path, block, now, _, starts, leads, stray in _line_blocks(batches, size, most):
            base, first, last, bad = block * size + 1, [], [], []
            while (k := int(np.searchsorted(starts, now))) < len(starts):
                now = int(leads[k])
                if stray[k] or now > starts[k] + 1:
                    first.append(base + int(starts[k]))
                    last.append(base + now - 1)
                    bad.append(bool(stray[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(first), pa.string()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(bad, pa.bool_())],
                ["path", "record", "last", "stray"],
            )

    spans = blocks.mapInArrow(taken, "path string, record long, last long, stray boolean")
    return spans.select("path", F.explode(F.sequence("record", "last")).alias("line_no"), "record", "stray")


def quoted_records(
    lines: DataFrame, separator: str = ",", quote: str = '"', escape: str = "\\", strict_quotes: bool = False,
    most: int = 256, block: int = 1 << 16,
) -> DataFrame:
    """Lines (path, line_no, line) as records (path, line_no, line, error), joined while a quote is open.

    ``line_no`` is that of the first line, ``line`` holds the lines and their
    breaks. A quote not closed within ``most`` lines is stray: its line stands
    alone with an ``error``, and the next record begins after it. One still open
    at the end of the file, within ``most`` lines, ends there. No lines, no rows.

    Each line is reduced to what it does to an open and to a closed quote. A
    block of lines is then a function from the line that its first record begins
    at to that of the next block. Only these functions, ``most`` numbers for
    ``block`` lines, meet in order; no task gets the lines of a whole file, and
    only records of several lines are grouped, ``most`` lines at most.
    """
    if not 0 < most <= block:
        raise ValueError("a block must hold the longest record")
    rule = (separator, quote, escape, strict_quotes)
    lines = lines.select("path", "line_no", "line")
    at = F.col("line_no") - 1
    opens = open_after(F.col("line"), False, *rule).cast("int")
    closes = (~open_after(F.col("line"), True, *rule)).cast("int")
    codes = lines.select(
        "path", F.floor(at / block).alias("block"), F.struct((at % block).cast("int").alias("at"), (opens + 2 * closes).cast("string").alias("code")).alias("c")
    )
    blocks = codes.groupBy("path", "block").agg(F.sort_array(F.collect_list("c")).alias("c"))
    blocks = cut_lineage(blocks.select("path", "block", F.array_join("c.code", "").alias("codes")), "line-codes")
    ahead = blocks.select("path", (F.col("block") - 1).alias("block"), F.left("codes", F.lit(most)).alias("ahead"))
    blocks = blocks.join(ahead, ["path", "block"], "left")
    entries = blocks.join(_entries(blocks, block, most), ["path", "block"])
    special = cut_lineage(_open_lines(entries, block, most), "open-lines")
    error = F.when(F.col("stray"), F.lit(f"quote not closed within {most} lines"))
    alone = lines.join(special, ["path", "line_no"], "left").where("record IS NULL OR stray").select("path", "line_no", "line", error.alias("error"))
    parts = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    several = lines.join(special.where("NOT stray"), ["path", "line_no"]).groupBy("path", "record").agg(parts.alias("l"))
    several = several.select("path", F.col("record").alias("line_no"), F.array_join("l.line", "\n").alias("line"), F.lit(None).cast("string").alias("error"))
    return alone.union(several)


def skip_records(records: DataFrame, skip: int, most: int) -> DataFrame:
    """As ``skip_lines``, by records of at most ``most`` lines each; only the heads of files are looked at."""
    if skip <= 0:
        return records
    head = records.where(F.col("line_no") <= (skip + 2) * most)
    rank = F.row_number().over(W.partitionBy("path").orderBy("line_no"))
    out = (F.col("_rank") == 1) if skip == 1 else F.col("_rank").between(2, skip + 1)
    return records.join(head.select("path", "line_no", rank.alias("_rank")).where(out), ["path", "line_no"], "left_anti")


def read_csv(spark: SparkSession, path: str, skip: int = 0, multi_line: bool = False, most: int = 256, **dialect) -> DataFrame:
    """CSV files as (path, line_no, fields); one physical line is one row.

    ``multi_line`` lets quoted fields run over ``most`` lines at most and adds
    ``error``, see ``quoted_records``; ``skip`` then counts records.
    """
    if multi_line:
        rule = {k: v for k, v in dialect.items() if k in ("separator", "quote", "escape", "strict_quotes")}
        records = skip_records(quoted_records(read_lines(spark, path), most=most, **rule), skip, most)
        return records.select("path", "line_no", csv_fields(F.col("line"), **dialect).alias("fields"), "error")
    lines = skip_lines(read_lines(spark, path, numbered=skip > 0), skip)
    return lines.select(*[c for c in lines.columns if c != "line"], csv_fields(F.col("line"), **dialect).alias("fields"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """TSV files as (path, fields), blank lines left out."""
    lines = read_lines(spark, path, numbered=False)
    return lines.where(strip(F.col("line")) != "").select("path", tsv_fields(F.col("line")).alias("fields"))
