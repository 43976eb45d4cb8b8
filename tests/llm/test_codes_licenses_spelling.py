"""Vector codes, license scans and spelling variants against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docweave.llm import licenses, pivots, spelling
from docweave.llm.license_texts import PHRASES, TEMPLATES

SF = "/root/testdata/sf0.001"


# --- vector codes ---------------------------------------------------------------


def codes_brute(rows, parts=8, entries=16, rounds=6):
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(4096 * x) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(assign(v, p)[1], []).append(cut(v, p))
            new.append([
                [sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])
            ])
        books = new
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], Counter()
    for i, v, label in kept:
        found = [assign(v, p) for p in range(parts)]
        error = sum(f for f, _ in found)
        sums[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return sorted(((i, c, e, sums[label], sha) for i, c, e, label in out), key=repr)


def test_vector_codes(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    got = [tuple(r) for r in pivots.vector_codes(vectors).collect()]
    assert sorted(got, key=repr) == codes_brute(rows)


def test_vector_codes_awkward(spark):
    """Nulls, non-finite and other lengths go; ties, repeated rows, clashing columns and nine components stay."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 9) / 4096], i % 3 or None, "a", b"b", 7) for i in range(40)]
    rows += rows[3:6] + [(None, rows[0][1], 1, "a", None, 1), (3, rows[9][1], 2, None, None, 1)]
    bad = [None, [], [1.0] * 8 + [None], [1.0] * 8 + [float("nan")], [float("inf")] * 9, [1.0] * 8]
    rows += [(100 + k, v, 1, "a", b"b", 7) for k, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, id string, far binary, codes int")
    got = [tuple(r) for r in pivots.vector_codes(table).collect()]
    assert sorted(got, key=repr) == codes_brute([r[:3] for r in rows])
    few = table.filter("vec_id between 10 and 14")
    assert sorted((tuple(r) for r in pivots.vector_codes(few).collect()), key=repr) == codes_brute([r[:3] for r in rows if r[0] in range(10, 15)])
    assert pivots.vector_codes(table.filter("false")).count() == 0
    assert pivots.vector_codes(table.filter("vec_id = 100")).count() == 0


def test_vector_codes_beyond_the_range(spark):
    """Components are held where squared distances fit a long."""
    table = spark.createDataFrame([(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (3, [0.5] * 8, None)], "vec_id long, embedding array<double>, label int")
    rows = {r.vec_id: r for r in pivots.vector_codes(table).collect()}
    assert [rows[i].error for i in (1, 2, 3)] == [0, 0, 0] and rows[1].code == "00" * 8 and rows[2].code == "01" * 8


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([2, 40, 10_000, 1 << 26]), st.integers(1, 20))
def test_nearest_entries(seed, spread, many):
    """Bounds leave out no nearest entry and no tie."""
    rng = np.random.default_rng(seed)
    part, entries = rng.integers(-spread, spread, (50, 4)), rng.integers(-spread, spread, (many, 4))
    chosen = pivots.choose_pivots(entries, 5)
    code, best, _ = pivots.nearest_entries(part, pivots.pivot_distances(part, chosen), entries, chosen)
    far = ((part[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == far.min(axis=1)).all() and (code == far.argmin(axis=1)).all()


def test_pivots_save_distances():
    """Moved entries with the pivots of the first round still leave out most evaluations."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, (16, 8))
    part = centres[rng.integers(0, 16, 2000)] + rng.integers(-100, 100, (2000, 8))
    chosen = pivots.choose_pivots(centres, pivots.PIVOTS)
    _, _, evaluated = pivots.nearest_entries(part, pivots.pivot_distances(part, chosen), centres + 30, chosen)
    assert evaluated < 2000 * 16 / 4


# --- licenses -------------------------------------------------------------------


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def licenses_brute(i, text):
    w = license_words(text)
    joined = " " + " ".join(w) + " "
    base = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    more = {label: licenses.compile_template(label, t).mandatory for label, t in TEMPLATES.items() if re.search(licenses.as_regex(t), joined)}
    score = max(0.5, 1 - 0.5 ** (max(more.values()) / 4)) if more else 0.5 if base else 0.0
    at = [k for k, _ in base]
    labels = {label for _, label in base}
    return (i, len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | set(more))), score)


def filled(template: str, rng) -> str:
    """A text that the template accepts: regions left out or filled at random."""
    out, depth_off = [], [False]
    for markup, word in licenses._PIECE.findall(template):
        kind, _, rest = markup.partition(";")
        if kind == "beginOptional":
            depth_off.append(depth_off[-1] or bool(rng.integers(2)))
        elif kind == "endOptional":
            depth_off.pop()
        elif depth_off[-1]:
            continue
        elif kind == "var":
            low, high = map(int, re.search(r"words=(\d+)-(\d+)", rest).groups())
            out += [f"Någon{k}" for k in range(int(rng.integers(low, high + 1)))]
        else:
            out.append(str(rng.choice(rest.split("|"))) if kind else word)
    return " ".join(out)


def license_cases():
    rng = np.random.default_rng(3)
    texts = [None, "", " \n", "MIT License", "mit, (LICENSE) mit license", "cc by cc by", "GNU General Public", "x" * 5000, "日本 CC-BY 4.0"]
    for template in TEMPLATES.values():
        for _ in range(6):
            text = filled(template, rng)
            w = text.split()
            k = int(rng.integers(len(w)))
            texts += ["Before. " + text + " — after", " ".join(w[:k] + w[k + 1 :]), " ".join(w[:k] + ["other"] + w[k:]), "\n".join(w).upper()]
    texts.append(" ".join(texts[9:40]) + " lorem" * 20_000 + " Released under the MIT License.")
    return texts


def test_templates_accept_and_refuse(spark):
    """Automata agree with the same wordings as regular expressions, over whole and damaged texts."""
    rows = [(i, t, "found", 3, 4, b"x", 0.1) for i, t in enumerate(license_cases())]
    rows += [rows[3], (None, "the MIT License", None, None, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, found string, n_words int, id int, labels binary, score double")
    got = [tuple(r) for r in licenses.scan_licenses(table).collect()]
    assert sorted(got, key=repr) == sorted((licenses_brute(i, t) for i, t, *_ in rows), key=repr)
    assert {label for r in got for label in r[6].split(",")} >= set(TEMPLATES)
    assert licenses.scan_licenses(table.filter("false")).count() == 0


def test_found_places(spark):
    table = spark.createDataFrame([(1, "A. Released under the terms of the MIT Licence, v1")], "doc_id long, text string")
    (row,) = licenses.find_licenses(table).collect()
    assert row.n_words == 10 and [tuple(f) for f in row.found] == [("mit-notice", True, 1, 8, 4)]


@pytest.mark.parametrize("text", ["<<beginOptional>>a<<endOptional>> b", "<<var;name=x;words=0-2>> a", "a <<beginOptional>> b"])
def test_templates_that_cannot_be(text):
    with pytest.raises(ValueError):
        licenses.compile_template("x", text)


# --- spelling -------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def spelling_brute(rows, drop=199):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [spelling.TILE, 3])
def test_spelling_variants(spark, monkeypatch, tile):
    """Whole documents; with tiny tiles every group is cut into blocks that meet two by two."""
    monkeypatch.setattr(spelling, "TILE", tile)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in spelling.spelling_variants(table).collect()), key=repr) == spelling_brute(rows)


def test_spelling_awkward(spark):
    """Chains of forms, ties, letters beyond ASCII, nulls, repeated rows, clashing columns, very long words."""
    words = {"station": 700, "statiom": 130, "stattiom": 25, "stattioms": 5, "statios": 20, "Éclairs": 30, "éclairs": 6, "ÀÿÀÿÀÿ": 9, "ÀÿÀÿÀ÷": 9,
             "banana": 50, "bananä": 50, "bananas": 10, "abcde": 90, "q" * 4000: 6, "q" * 3999: 40, "ŁabcdefŁ": 8, "abcdef": 5}
    text = " ".join(" ".join([w] * n) for w, n in words.items())
    rows = [(1, text, "a"), (2, text, "b"), (2, text, "b"), (None, text, None), (5, None, "c"), (6, "", "d"), (7, "12 34", "e")]
    rows += [(100 + k, "variants " + "Variantes, " * 3 + "variant", "x") for k in range(300)]
    table = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, word string, n int, form string")
    got = sorted((tuple(r) for r in spelling.spelling_variants(table).collect()), key=repr)
    assert got == spelling_brute([r[:2] for r in rows])
    assert any(r[1] and r[1] != r[2] for r in got)
    assert spelling.spelling_variants(table.filter("false")).count() == 0
    assert spelling.spelling_variants(table.filter("doc_id in (5, 6, 7)")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abÿ", min_size=1, max_size=7), min_size=2, max_size=12, unique=True))
def test_single_edits(words):
    front, rear = spelling._matrix(words, 8), spelling._matrix(words, 8, back=True)
    a, b = np.triu_indices(len(words), 1)
    near, _ = spelling.single_edits(front, rear, np.array([len(w) for w in words]), a, b)
    assert near.tolist() == [one_edit(words[i], words[j]) for i, j in zip(a, b)]


@given(st.lists(st.tuples(st.binary(max_size=12), st.binary(max_size=30)), min_size=1, max_size=20))
def test_crc32_after(pairs):
    data = np.frombuffer(b"".join(p[1] for p in pairs) + b"x", np.uint8)
    ends = np.cumsum([len(p[1]) for p in pairs])
    starts = ends - [len(p[1]) for p in pairs]
    state = np.array([zlib.crc32(p[0]) for p in pairs], np.uint32)
    assert spelling.crc32_after(state, data, starts, ends).tolist() == [zlib.crc32(a + b) for a, b in pairs]
