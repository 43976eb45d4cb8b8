"""Number-format codes of workbooks, compiled to what column expressions can apply.

A code is compiled once for each distinct code to a few parameters (a pattern,
a scale, literals); the values are then formatted by built-in expressions with
those parameters as columns.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Codes that workbooks name by number only.
BUILT_IN = {
    0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 11: "0.00E+00", 12: "# ?/?",
    13: "# ??/??", 14: "m/d/yy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 18: "h:mm AM/PM", 19: "h:mm:ss AM/PM",
    20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm", 37: "#,##0_);(#,##0)", 38: "#,##0_);[Red](#,##0)",
    39: "#,##0.00_);(#,##0.00)", 40: "#,##0.00_);[Red](#,##0.00)", 45: "mm:ss", 46: "[h]:mm:ss", 47: "mm:ss.0",
    48: "##0.0E+0", 49: "@",
}

SECTION = (
    "struct<kind:string,op:string,than:double,signed:boolean,pattern:string,decimals:int,scale:double,prefix:string,"
    "suffix:string,search:string,most:int>"
)
COMPILED = f"struct<numbers:array<{SECTION}>,words:{SECTION}>"

_TOKEN = re.compile(
    r'"([^"]*)"?|\\(.)|_(.)|\*(.)|\[([^\]]*)\]|(General)|(AM/PM|A/P)|([yY]+|[mM]+|[dD]+|[hH]+|[sS]+)|([Ee][+-])|([0#?]+)|(.)',
    re.S,
)


def _tokens(section: str) -> list[tuple[str, str]]:
    """(kind, text) of a section: literal, bracket, general, half, date, exponent, digits or sign."""
    out = []
    for quoted, escaped, width, fill, bracket, general, half, date, exponent, digits, other in _TOKEN.findall(section):
        if width:
            out.append(("literal", " "))
        elif fill:
            continue
        elif bracket:
            out.append(("bracket", bracket))
        elif general:
            out.append(("general", general))
        elif half:
            out.append(("half", half))
        elif date:
            out.append(("date", date.lower()))
        elif exponent:
            out.append(("exponent", exponent[1]))
        elif digits:
            out.append(("digits", digits))
        elif other:
            out.append(("sign" if other in ".,%/@" else "literal", other))
        else:
            out.append(("literal", escaped or quoted))
    return out


def _split_sections(code: str) -> list[str]:
    """Sections between semicolons that are neither quoted, escaped nor bracketed."""
    return [m[0] for m in re.finditer(r'(?:"[^"]*"?|\\.|\[[^\]]*\]|[^;])+|(?<=;)(?=;|$)|^(?=;)', code, re.S)] or ["General"]


def _quoted(text: str) -> str:
    return "".join("''" if c == "'" else f"'{c}'" if c.isalpha() else c for c in text)


def _date_pattern(tokens: list[tuple[str, str]]) -> str:
    """Letters of a date code as those of ``date_format``; m after hours or before seconds means minutes."""
    letters = [(k, t) for k, t in tokens if k in ("date", "half", "digits")]
    half = any(k == "half" for k, _ in tokens)
    out, seen = [], -1
    for k, (kind, text) in enumerate(tokens):
        if kind in ("date", "half", "digits"):
            seen += 1
        if kind == "half":
            out.append("a")
        elif kind == "digits":
            # fractions of a second, after the point
            out.append("S" * len(text) if out and out[-1] == "." else text)
        elif kind == "date":
            n = len(text)
            if text[0] == "y":
                out.append("yy" if n <= 2 else "yyyy")
            elif text[0] == "d":
                out.append(["d", "dd", "EEE", "EEEE"][min(n, 4) - 1])
            elif text[0] == "h":
                out.append(("h" if half else "H") * min(n, 2))
            elif text[0] == "s":
                out.append("s" * min(n, 2))
            else:
                before = letters[seen - 1][1][0] if seen else ""
                after = letters[seen + 1][1][0] if seen + 1 < len(letters) else ""
                minutes = n <= 2 and (before == "h" or after == "s")
                out.append("m" * n if minutes else ["M", "MM", "MMM", "MMMM", "MMM"][min(n, 5) - 1])
        elif kind in ("literal", "sign"):
            out.append(_quoted(text))
    return "".join(out)


def _elapsed_pattern(tokens: list[tuple[str, str]], unit: str) -> tuple[str, int]:
    """Text with marks for total units and what is left below them, and the decimals of the seconds."""
    out, decimals = [], 0
    for kind, text in tokens:
        if kind == "bracket" and text.lower().strip("hms") == "" and text:
            out.append(f"\x01{text[0].upper()}{min(len(text), 9)}\x02")
        elif kind == "date" and text[0] in "hms":
            out.append(f"\x01{text[0]}{min(len(text), 2)}\x02")
        elif kind == "digits" and out and out[-1] == ".":
            decimals = len(text)
            out[-1] = f"\x01f{decimals}\x02"
        elif kind in ("literal", "sign"):
            out.append(text)
    return "".join(out), decimals


def _section(text: str, position: int, many: int) -> dict:
    out = {"kind": "number", "op": None, "than": None, "signed": True, "pattern": "", "decimals": 0, "scale": 1.0, "prefix": "", "suffix": "", "search": "", "most": 0}
    tokens = []
    unit = None
    for kind, token in _tokens(text):
        if kind == "bracket":
            condition = re.fullmatch(r"(<=|>=|<>|<|>|=)\s*(-?[\d.]+)", token)
            if condition:
                out["op"], out["than"] = condition[1], float(condition[2])
                continue
            if re.fullmatch(r"h+|m+|s+", token.lower()):
                unit = token[0].lower()
            elif token.startswith("$"):
                # currency and locale: the sign before the hyphen
                tokens.append(("literal", token[1:].partition("-")[0]))
                continue
            else:
                continue  # a colour or a calendar
        tokens.append((kind, token))
    if out["op"] is None and many >= 2 and position == 1:
        out["signed"] = False
    kinds = {k for k, _ in tokens}
    signs = {t for k, t in tokens if k == "sign"}
    if "@" in signs and "digits" not in kinds:
        at = tokens.index(("sign", "@"))
        words = lambda part: "".join(t for k, t in part if k in ("literal", "sign") and t != "@")
        out.update(kind="text", prefix=words(tokens[:at]), suffix=words(tokens[at + 1 :]))
    elif unit:
        pattern, decimals = _elapsed_pattern(tokens, unit)
        out.update(kind="elapsed", pattern=pattern, decimals=decimals, search=unit)
    elif "date" in kinds:
        out.update(kind="date", pattern=_date_pattern(tokens))
    elif "general" in kinds:
        at = next(k for k, t in enumerate(tokens) if t[0] == "general")
        words = lambda part: "".join(t for _, t in part)
        out.update(kind="general", prefix=words(tokens[:at]), suffix=words(tokens[at + 1 :]))
    elif "digits" not in kinds:
        out.update(kind="literal", prefix="".join(t for k, t in tokens if k in ("literal", "sign")))
    elif "/" in signs:
        _fraction(tokens, out)
    else:
        _number(tokens, out)
    return out


def _fraction(tokens: list[tuple[str, str]], out: dict) -> None:
    """Whole part or not, and the digits or the number below the line."""
    slash = tokens.index(("sign", "/"))
    before = [t for k, t in tokens[:slash] if k == "digits"]
    below = "".join(t for k, t in tokens[slash + 1 :] if k in ("digits", "literal")).strip()
    number = re.match(r"[0-9]*[1-9][0-9]*", below)
    digits = re.match(r"[0#?]+", below)
    out.update(
        kind="fraction" if len(before) > 1 else "improper",
        decimals=int(number[0]) if number else 0,
        most=10 ** min(len(digits[0]), 4) - 1 if digits and not number else 0,
    )


def _number(tokens: list[tuple[str, str]], out: dict) -> None:
    """A decimal pattern between literals; literals among the digits make a mask."""
    places = [k for k, (kind, t) in enumerate(tokens) if kind in ("digits", "exponent") or (kind == "sign" and t in ".,")]
    digits = [k for k, (kind, _) in enumerate(tokens) if kind == "digits"]
    first, last = min(digits[0], places[0]), max(places)
    core = tokens[first : last + 1]
    percent = sum(t == "%" for k, t in tokens if k == "sign")
    out["scale"] = 100.0**percent
    words = lambda part: "".join(t for k, t in part if k == "literal" or t in ("%", "/"))
    out["prefix"], out["suffix"] = words(tokens[:first]), words(tokens[last + 1 :])
    if any(k == "literal" for k, _ in core):
        # each run of places takes its digits from the right, the first run what is left
        runs = [len(t) for k, t in core if k == "digits"]
        order, parts = 0, []
        for k, t in core:
            if k == "digits":
                order += 1
                parts.append(f"${order}")
            elif k == "literal":
                parts.append(t.replace("\\", "\\\\").replace("$", "\\$"))
        search = "^(\\d+)" + "".join(f"(\\d{{{n}}})" for n in runs[1:]) + "$"
        out.update(kind="mask", search=search, pattern="".join(parts), most=sum(runs), decimals=0)
        return
    whole, point, part, exponent, commas = "", False, "", None, 0
    for k, (kind, t) in enumerate(core):
        if kind == "exponent":
            exponent = t
        elif t == ".":
            point = True
        elif t == ",":
            # between digits it groups, after them it divides by a thousand
            if any(x == "digits" for x, _ in core[k + 1 :]) and not point:
                commas += 1
            else:
                out["scale"] /= 1000.0
        elif kind == "digits" and exponent is not None:
            exponent += "0" * len(t)
        elif kind == "digits" and point:
            part += t.replace("?", "#")
        elif kind == "digits":
            whole += t.replace("?", "#")
    # zeros follow hashes in a pattern
    zeros = len(whole) - whole.index("0") if "0" in whole else 0
    whole = "#" * (len(whole) - zeros) + "0" * zeros or "#"
    if commas and exponent is None:
        whole = whole.rjust(4, "#")
        whole = whole[:-3] + "," + whole[-3:]
    part = "0" * (part.rindex("0") + 1 if "0" in part else 0) + "#" * (len(part) - (part.rindex("0") + 1 if "0" in part else 0))
    pattern = whole + ("." + part if point and part else "")
    out.update(pattern=pattern, decimals=len(part))
    if point and not part:
        out["suffix"] = "." + out["suffix"]
    if exponent is not None:
        out.update(kind="exponent", pattern=f"{pattern}E{exponent[1:]}", search=exponent[0])


def compile_code(code: str | None) -> dict:
    """Sections for numbers, in the order they are tried, and the one for text."""
    parts = _split_sections(code or "General")
    sections = [_section(p, k, len(parts)) for k, p in enumerate(parts)]
    plain = _section("@", 0, 1)
    words = sections[3] if len(sections) > 3 else next((s for s in sections if s["kind"] == "text"), plain)
    numbers = [s for s in sections[:3] if s["kind"] != "text"] or [_section("General", 0, 1)]
    if all(s["op"] is None for s in numbers):
        rules = {1: [None], 2: [(">=", 0.0), None], 3: [(">", 0.0), ("<", 0.0), None]}[len(numbers)]
        for section, rule in zip(numbers, rules):
            section["op"], section["than"] = rule or (None, None)
    return {"numbers": numbers, "words": words}


def compiled_codes(codes: DataFrame) -> DataFrame:
    """(code, rules) of each distinct value of the one column of ``codes``."""

    def compiled(batches):
        for batch in batches:
            yield pd.DataFrame({"code": batch["code"], "rules": [compile_code(c) for c in batch["code"]]})

    one = codes.select(F.col(codes.columns[0]).alias("code")).distinct()
    return one.mapInPandas(compiled, f"code string, rules {COMPILED}")


def serial_time(value: Column, from_1904: Column) -> Column:
    """Timestamp of a day count; the count from 1900 has a 29 February that year."""
    days = F.when(from_1904, value + 1462).otherwise(F.when(value < 60, value + 1).otherwise(value))
    millis = F.round(days * 86_400_000).cast("long") - F.lit(25_569).cast("long") * 86_400_000
    return F.when((days >= 0) & (days < 2_958_466), F.timestamp_millis(millis))


def _chosen(number: Column, rules: Column) -> Column:
    """The first section whose condition the number meets; the last one has none or takes the rest."""

    def meets(s: Column) -> Column:
        than = s["than"]
        return (
            F.when(s["op"].isNull(), F.lit(True))
            .when(s["op"] == ">", number > than)
            .when(s["op"] == ">=", number >= than)
            .when(s["op"] == "<", number < than)
            .when(s["op"] == "<=", number <= than)
            .when(s["op"] == "=", number == than)
            .otherwise(number != than)
        )

    return F.get(F.filter(rules["numbers"], meets), F.lit(0))


def _decimal(number: Column, pattern: Column) -> Column:
    return F.call_function("format_number", number, pattern)


def _half_up(size: Column, decimals: Column) -> Column:
    """Rounded half up in the decimal digits as written; null beyond fifteen digits."""
    written = size.cast("decimal(38,15)")
    out = F.lit(None).cast("double")
    for d in range(11):
        out = F.when(decimals == d, F.round(written, d).cast("double")).otherwise(out)
    return F.when(size < 1e15, out)


def _general(number: Column) -> Column:
    """Up to eleven digits, no trailing zeros; very large and small numbers with an exponent."""
    size = F.abs(number)
    far = ((size >= 1e11) | (size < 1e-9)) & (size != 0)
    whole = F.greatest(F.floor(F.log10(F.greatest(size, F.lit(1e-300)))), F.lit(0))
    places = F.least(F.lit(9), F.lit(10) - whole).cast("int")
    pattern = F.concat(F.lit("0."), F.call_function("repeat", F.lit("#"), places))
    short = F.regexp_replace(_decimal(number, pattern), r"\.$", "")
    return F.when(far, F.regexp_replace(_decimal(number, F.lit("0.#####E00")), "E(?!-)", "E+")).otherwise(short)


def _fraction_text(size: Column, section: Column) -> Column:
    """The nearest fraction within the denominators allowed, the smallest of those."""
    proper = section["kind"] == "fraction"
    whole = F.when(proper, F.floor(size)).otherwise(F.lit(0)).cast("long")
    rest = size - whole
    below = F.when(section["decimals"] > 0, F.array(section["decimals"])).otherwise(F.sequence(F.lit(1), F.greatest(section["most"], F.lit(1))))
    tried = F.transform(
        below,
        lambda d: F.struct(F.round(F.abs(rest - F.round(rest * d) / d), 12).alias("off"), d.alias("d"), F.round(rest * d).cast("long").alias("n")),
    )
    best = F.array_min(tried)
    carried = proper & (best["n"] == best["d"])
    up = whole + F.when(carried, 1).otherwise(0)
    n = F.when(carried, 0).otherwise(best["n"])
    line = F.concat_ws("/", n.cast("string"), best["d"].cast("string"))
    return F.when(proper & (n == 0), up.cast("string")).when(proper & (up > 0), F.concat_ws(" ", up.cast("string"), line)).otherwise(line)


def _elapsed_text(section: Column) -> Column:
    """Total units in the first place, what is left in the others."""
    seconds = F.col("_seconds")
    out = section["pattern"]
    marks = {"H": F.floor(seconds / 3600), "M": F.floor(seconds / 60), "S": seconds}
    marks |= {"h": F.floor(seconds / 3600) % 24, "m": F.floor(seconds / 60) % 60, "s": seconds % 60}
    for letter, units in marks.items():
        for width in range(1, 4):
            digits = F.greatest(F.length(units.cast("string")), F.lit(width))
            text = F.call_function("lpad", units.cast("string"), digits, F.lit("0"))
            out = F.replace(out, F.lit(f"\x01{letter}{width}\x02"), text)
    fraction = F.concat(F.lit("."), F.call_function("lpad", F.col("_part").cast("string"), section["decimals"], F.lit("0")))
    return F.regexp_replace(out, F.lit("\x01f\\d\x02"), fraction)


def format_cells(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """``cells`` (value, code, number, from_1904) with ``shown`` and ``date``, by the ``rules`` of their codes.

    ``number`` tells whether a cell holds a number and not text that reads like
    one; text passes through the section for text. A number that its section
    cannot show (a negative date) and a cell without a code stay as stored.
    ``date`` is the time of a number shown as one. Each step is a column of its
    own, so that nothing is computed twice.
    """
    own = cells.columns
    # cells without a code, and those of a code that most cells have, are dealt over all tasks
    salts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rules.select(F.col("code").alias("_code"), "rules", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_dealt"))
    salted = cells.withColumn("_salt", F.pmod(F.xxhash64(*own), F.lit(salts)).cast("int"))
    joined = salted.join(dealt, (F.col("code") == F.col("_code")) & (F.col("_salt") == F.col("_dealt")), "left")
    number, section = F.col("_number"), F.col("_section")
    steps = joined.withColumn("_number", F.when(F.col("number"), F.col("value").try_cast("double")))
    steps = steps.withColumn("_section", _chosen(number, F.col("rules")))
    steps = steps.withColumn("_size", F.abs(number * section["scale"]))
    size, kind = F.col("_size"), section["kind"]
    ticks = F.round(size * 86_400 * F.pow(F.lit(10.0), section["decimals"]))
    steps = steps.withColumn("_ticks", F.when((kind == "elapsed") & (size < 1e9), ticks.cast("long")))
    per = F.pow(F.lit(10.0), section["decimals"]).cast("long")
    steps = steps.withColumns(
        {
            "_seconds": F.floor(F.col("_ticks") / per).cast("long"),
            "_part": F.col("_ticks") % per,
            "_rounded": F.when(kind == "number", F.coalesce(_half_up(size, section["decimals"]), size)),
            "_digits": F.when((kind == "mask") & (size < 1e18), F.round(size).cast("long").cast("string")),
            "_time": F.when(kind == "date", serial_time(number, F.col("from_1904"))),
        }
    )
    power = _decimal(size, section["pattern"])
    width = F.greatest(F.length("_digits"), section["most"])
    body = (
        F.when(kind == "number", _decimal(F.col("_rounded"), section["pattern"]))
        .when((kind == "exponent") & (section["search"] == "+"), F.regexp_replace(power, "E(?!-)", "E+"))
        .when(kind == "exponent", power)
        .when(kind == "general", _general(size))
        .when(kind.isin("fraction", "improper") & (size < 1e15), _fraction_text(size, section))
        .when(kind == "elapsed", _elapsed_text(section))
        .when(kind == "mask", F.call_function("regexp_replace", F.call_function("lpad", F.col("_digits"), width, F.lit("0")), section["search"], section["pattern"]))
        .when(kind == "literal", F.lit(""))
    )
    steps = steps.withColumn("_body", body)
    minus = (number < 0) & section["signed"] & (F.rlike("_body", F.lit("[1-9]")) | (kind == "literal"))
    as_number = F.when(kind == "date", F.call_function("date_format", F.col("_time"), section["pattern"])).otherwise(
        F.concat(F.when(minus, F.lit("-")).otherwise(F.lit("")), section["prefix"], F.col("_body"), section["suffix"])
    )
    words = F.col("rules")["words"]
    as_text = F.when(words["kind"] == "text", F.concat(words["prefix"], F.col("value"), words["suffix"])).when(
        words["kind"] == "literal", words["prefix"]
    )
    shown = F.coalesce(F.when(number.isNotNull(), as_number).when(F.col("value").isNotNull(), as_text), F.col("value"))
    return steps.select(*own, shown.alias("shown"), F.col("_time").alias("date"))
