"""Text expressions: trimming, tokens, list items, direction, highlighting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what a blank test strips, all characters up to and including space.
CONTROL_AND_SPACE = "".join(chr(n) for n in range(33))

# Fixed value: a token is a run of letters and digits.
TOKEN = r"[\p{L}\p{N}]+"

# List-item openings in matching order, kind and pattern.
LIST_ITEMS = [
    ("dot", r"\."),
    ("number_dot", r"\d+\."),
    ("number_brackets", r"\[\d+\]"),
    ("number_paren", r"\d+\)"),
    ("upper_dot", r"[A-Z]\."),
    ("lower_dot", r"[a-z]\."),
    ("upper_paren", r"[A-Z]\)"),
    ("lower_paren", r"[a-z]\)"),
    ("upper_roman", r"[IVXL]+\."),
    ("lower_roman", r"[ivxl]+\."),
]

# Latin ligatures and what they stand for.
LIGATURES = {
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "st",
    "ﬆ": "st",
}


def strip(c: Column) -> Column:
    """Remove leading and trailing control characters and spaces.

    Spark's ``trim`` strips spaces only.
    """
    return F.btrim(c, F.lit(CONTROL_AND_SPACE))


def not_blank(c: Column) -> Column:
    """``c``, or null where it is blank."""
    return F.when(strip(c) != "", c)


def extract_tokens(c: Column) -> Column:
    """Tokens in order, as they are."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def tokens(c: Column) -> Column:
    """Lower-cased tokens in order."""
    return extract_tokens(F.lower(c))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside nested lambdas."""
    return F.transform(F.array(value), use)[0]


def running_total(c: Column) -> Column:
    """Sum of all elements before each element of an array of integers.

    Spark has no prefix sum over an array and folding into a growing array
    copies it each step, so totals are taken per block and then within blocks:
    about n**(4/3) additions, no shuffle and no growing accumulator.
    """
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda acc, x: acc + x)

    def blocks_of(a: Column) -> Column:
        width = F.greatest(F.lit(8), F.ceil(F.cbrt(F.size(a))).cast("int"))
        return bind(
            width,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.ceil(F.size(a) / w).cast("int") - 1),
                lambda b: F.slice(a, b * w + 1, w),
            ),
        )

    def bases_of(blocks: Column) -> Column:
        return bind(
            F.transform(blocks, total),
            lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, 1, b))),
        )

    def within(block: Column, base: Column) -> Column:
        return F.transform(block, lambda _, k: base + total(F.slice(block, 1, k)))

    return bind(
        c,
        lambda a: F.when(F.size(a) == 0, F.array().cast("array<bigint>")).otherwise(
            bind(blocks_of(a), lambda bl: F.flatten(F.zip_with(bl, bases_of(bl), within)))
        ),
    )


def list_item_kind(c: Column) -> Column:
    """Kind of list-item opening a word is, first match wins; null for none."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(LIST_ITEMS):
        kind = F.when(c.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def rtl_count(c: Column) -> Column:
    """Number of right-to-left letters."""
    return F.length(F.regexp_replace(c, r"[^\p{IsArabic}\p{IsHebrew}]", ""))


def ltr_count(c: Column) -> Column:
    """Number of other letters."""
    return F.length(F.regexp_replace(c, r"[^\p{L}]|[\p{IsArabic}\p{IsHebrew}]", ""))


def rtl_dominant(c: Column) -> Column:
    """True when right-to-left letters outnumber the others."""
    return rtl_count(c) > ltr_count(c)


def reverse_if_rtl(c: Column) -> Column:
    """Reverse a run made of two or more Arabic letters only."""
    return F.when(c.rlike(r"^\p{IsArabic}{2,}$"), F.reverse(c)).otherwise(c)


def fold_ligatures(c: Column) -> Column:
    """Spell out Latin ligatures."""
    for glyph, letters in LIGATURES.items():
        c = F.replace(c, F.lit(glyph), F.lit(letters))
    return c


def quote_regex(text: str) -> str:
    """``text`` with regular-expression characters escaped, for any engine."""
    return "".join(ch if ch.isalnum() or ord(ch) > 127 or ch in " _" else "\\" + ch for ch in text)


def highlight(c: Column, term: str, before: str = "<em>", after: str = "</em>") -> Column:
    """Mark every occurrence of ``term``, ignoring case."""
    return F.regexp_replace(c, f"(?i)({quote_regex(term)})", f"{before}$1{after}")
