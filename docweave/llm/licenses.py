"""License scans: wordings with optional and replaceable regions as automata over words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.license_texts import PHRASES, TEMPLATES
from docweave.llm.texts import LOWER, slices, word_hashes, word_spans

# Digits, letters and every character beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
FOUND = "array<struct<label string, template boolean, first long, last long, mandatory int>>"
_PIECE = re.compile(r"<<(.*?)>>|([^\W_]+)", re.S)


@dataclass
class Automaton:
    """A wording as a bit-parallel automaton: bit i is set where item i may come next.

    ``takes[word]``: items that accept this word; ``anything``: items that accept
    all. ``leaps``: where a bit of the first mask is set the second is set too,
    in the order of their places, so one pass reaches everything. A replaceable
    region of a to b words is a items, then b - a items that may be left at any
    time; an optional one is a leap over its items.
    """

    label: str
    head: list[frozenset[str]] = field(default_factory=list)
    takes: dict[str, int] = field(default_factory=dict)
    anything: int = 0
    leaps: list[tuple[int, int]] = field(default_factory=list)
    end: int = 0
    mandatory: int = 0

    def closed(self, state: int) -> int:
        for held, reached in self.leaps:
            if state & held:
                state |= reached
        return state

    def longest(self, words) -> int:
        """Number of ``words`` from the first that the longest accepted text takes, 0 if none."""
        state, accepted = self.closed(1), 0
        final = 1 << self.end
        for n, word in enumerate(words, 1):
            state = self.closed((state & (self.takes.get(word, 0) | self.anything)) << 1)
            if state & final:
                accepted = n
            if not state & (final - 1):
                break
        return accepted


def compile_template(label: str, text: str) -> Automaton:
    """The automaton of a wording in the markup of ``license_texts``. It must begin with a mandatory word."""
    made, opened, fixed = Automaton(label), [], True
    for markup, word in _PIECE.findall(text):
        kind, _, rest = markup.partition(";")
        if kind == "beginOptional":
            opened.append(made.end)
            fixed = False
        elif kind == "endOptional":
            start = opened.pop()
            made.leaps.append((1 << start, 1 << made.end))
        elif kind == "var":
            low, high = map(int, re.search(r"words=(\d+)-(\d+)", rest).groups())
            start, made.end = made.end, made.end + high
            made.anything |= (1 << made.end) - (1 << start)
            made.leaps.append(((1 << made.end) - (1 << start + low), 1 << made.end))
            fixed = False
        else:
            choices = frozenset(rest.lower().split("|") if kind else [word.lower()])
            for choice in choices:
                made.takes[choice] = made.takes.get(choice, 0) | 1 << made.end
            made.end += 1
            made.mandatory += not opened
            if fixed:
                made.head.append(choices)
    if opened or not made.head:
        raise ValueError(f"{label}: a region is left open, or no mandatory word at the beginning")
    # A leap's first mask begins at its lowest bit; outer blocks begin no later than inner ones.
    made.leaps.sort(key=lambda leap: (leap[0] & -leap[0], leap[1]))
    return made


def compile_phrase(phrase: str, label: str) -> Automaton:
    return compile_template(label, phrase)


class Lexicon:
    """Numbers of the words that some automaton names; 0 for all others."""

    def __init__(self, automata: list[Automaton]):
        words = sorted({w for a in automata for w in a.takes})
        data = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in words])
        starts = ends - [len(w.encode()) for w in words]
        hashes = word_hashes(data, starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.lengths = hashes[order], (ends - starts)[order]
        self.names = [None, *(words[i] for i in order)]
        self.number = {w: i for i, w in enumerate(self.names)}

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = (self.hashes[at] == hashes) & (self.lengths[at] == ends - starts)
        return np.where(known, at + 1, 0)


def find_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, id_column: str = "doc_id"
) -> DataFrame:
    """(id, n_words, found) of every row: the places of the phrases and of the accepted wordings.

    ``found``: label, whether a template or a phrase, first and last word (from
    0) and the number of mandatory words; of a template the longest text from a
    place counts. Null and empty texts have no words and nothing found; repeated
    rows give repeated results; columns but ``id_column`` and ``text`` are
    ignored; an empty table gives no rows. One pass, no shuffle: a task holds a
    slice of texts, or one text.
    """
    phrase_machines = [compile_phrase(p, label) for p, label in phrases.items()]
    template_machines = [compile_template(label, t) for label, t in templates.items()]
    machines = [(a, False) for a in phrase_machines] + [(a, True) for a in template_machines]

    def scan(batches: Iterator[pa.RecordBatch]):
        lexicon = Lexicon([a for a, _ in machines])
        for batch, data, offs in slices(batches):
            data = LOWER[data]
            starts, ends, first = word_spans(data, offs, WORD_BYTES)
            ids = lexicon.of(data, starts, ends)
            named = np.flatnonzero(ids)
            places: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for machine, template in machines:
                at = named
                for k, choices in enumerate(machine.head):
                    at = at[at + k < len(ids)]
                    at = at[np.isin(ids[at + k], [lexicon.number[c] for c in choices])]
                rows = np.searchsorted(first, at, side="right") - 1
                for place, row in zip(at.tolist(), rows.tolist()):
                    until = min(int(first[row + 1]), place + machine.end)
                    n = machine.longest(lexicon.names[i] for i in ids[place:until].tolist())
                    if n:
                        begin = place - int(first[row])
                        places[row].append({"label": machine.label, "template": template, "first": begin, "last": begin + n - 1, "mandatory": machine.mandatory})
            kind = pa.struct([("label", pa.string()), ("template", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("mandatory", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first).astype(np.int64)), pa.array(places, pa.list_(kind))],
                ["id", "n_words", "found"],
            )

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col("text"))
    return rows.mapInArrow(scan, f"id long, n_words long, found {FOUND}")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """The digest of ``find_licenses`` for each row of (doc_id, text).

    n_base, first_word and last_word: number, least and greatest start of the
    phrases' places; base_labels and labels: distinct, sorted, comma-joined, the
    latter with those of the templates. score: 0 where nothing is found, 0.5
    where only phrases are, else 1 - 0.5 ** (m / 4) with m the greatest number
    of mandatory words of an accepted wording, 0.5 at least. Awkward rows: see
    ``find_licenses``.
    """
    base = F.filter("found", lambda f: ~f["template"])
    starts = F.transform(base, lambda f: f["first"])
    joined = lambda found: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))))
    most = F.array_max(F.transform(F.filter("found", lambda f: f["template"]), lambda f: f["mandatory"]))
    sure = F.greatest(F.lit(0.5), 1 - F.pow(F.lit(0.5), most / 4))
    return find_licenses(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.when(F.size("found") == 0, 0.0).when(most.isNull(), 0.5).otherwise(sure).alias("score"),
    )


def as_regex(text: str) -> str:
    """A wording as a regular expression over words, each followed by a space.

    The same markup read another way: for the SQL beside the query and for tests.
    """
    out = []
    for markup, word in _PIECE.findall(text):
        kind, _, rest = markup.partition(";")
        if kind == "beginOptional":
            out.append("(?:")
        elif kind == "endOptional":
            out.append(")?")
        elif kind == "var":
            low, high = re.search(r"words=(\d+)-(\d+)", rest).groups()
            out.append(f"(?:[^ ]+ ){{{low},{high}}}")
        else:
            out.append(f"(?:{rest.lower() if kind else word.lower()}) ")
    return " " + "".join(out)


def oracle_sql() -> str:
    """DuckDB SQL of ``scan_licenses`` over ``documents``: lists for phrases, regular expressions for templates."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    places = []
    for phrase, label in PHRASES.items():
        same = " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
        places.append(f"list_transform(list_filter(range(len(w)), lambda i: {same}), lambda i: {{'label': '{label}', 'first': i}})")
    labels, weights = [], []
    for label, text in TEMPLATES.items():
        test, m = f"regexp_matches(j, '{as_regex(text)}')", compile_template(label, text).mandatory
        labels.append(f"CASE WHEN {test} THEN ['{label}'] ELSE [] END")
        weights.append(f"CASE WHEN {test} THEN {m} ELSE 0 END")
    concat = lambda lists: lists[0] if len(lists) == 1 else f"list_concat({lists[0]}, {concat(lists[1:])})"
    return f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), found AS (
            SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j, {concat(places)} AS base FROM words
        ), named AS (
            SELECT doc_id, len(w) AS n_words, len(base) AS n_base,
                list_min(list_transform(base, lambda b: b.first)) AS first_word,
                list_max(list_transform(base, lambda b: b.first)) AS last_word,
                list_sort(list_distinct(list_transform(base, lambda b: b.label))) AS b,
                {concat(labels)} AS t, greatest({", ".join(weights)}) AS m FROM found
        )
        SELECT doc_id, n_words, n_base, first_word, last_word, array_to_string(b, ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(b, t))), ',') AS labels,
            CASE WHEN m > 0 THEN greatest(0.5, 1 - pow(0.5, m / 4.0)) WHEN n_base > 0 THEN 0.5 ELSE 0.0 END AS score
        FROM named"""
