"""The training-data operators against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import anchors, huffman, language, leaks, lengths, packing, parity, quality, suffixes, tokens, toxicity
from docweave.llm.census import census, multikey_order
from docweave.llm.components import components

SF = "/root/testdata/sf0.001"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    passage = " ".join(f"word{i}" for i in range(70))
    rows = [
        (1, passage, 10), (2, "before it " + passage + " after", 20), (2, "before it " + passage + " after", 20),
        (2, "the same id, another text", 21), (None, passage, 30), (None, None, None), (5, None, 50), (6, "", 60),
        (7, " \t\n\x0b\x0c\r", 70), (8, "é", 80), (9, "one two", 90), (10, "ONE two", 100), (11, "a b c d " * 9000, 110),
        (12, "x" * 3000, 120), (13, passage.replace("word60", "other"), 130), (14, "日本語 текст 😀 ́", 140),
    ]
    rows = [(i, t, "en" if i else None, "s", n, 7, 8, "cut", 0.5, b"sid", n) for i, t, n in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, _id long, _key long, _cut string, "
        "score double, sid binary, component int",
    )


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.filter("false")


def plain(awkward):
    return [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]


def words(text):
    return (text or "").encode().split()


# --- substring dedup by words ---------------------------------------------------


def repeats_brute(rows, window=50):
    first = {}
    for i, t in rows:
        w, i = words(t), float("inf") if i is None else i
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (float("inf") if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 12, 3])
def test_substring_digest(docs, texts, window):
    got = [tuple(r) for r in anchors.substring_digest(docs, window).collect()]
    assert sorted(got, key=repr) == repeats_brute(list(texts.items()), window)


def test_substring_digest_awkward(awkward, empty):
    got = [tuple(r) for r in anchors.substring_digest(awkward).collect()]
    assert sorted(got, key=repr) == repeats_brute(plain(awkward))
    assert anchors.substring_digest(empty).count() == 0


def test_cut_repeats(awkward, empty):
    out = anchors.cut_repeats(awkward)
    assert out.columns == awkward.columns
    rows = {(r.doc_id, r.n_chars): r for r in out.collect()}
    assert rows[(1, 10)].text.startswith("word0 ")
    cut = [r for r in out.collect() if r.doc_id == 2 and r.text.startswith("before it")]
    assert [r.text for r in cut] == ["before it after"] * 2 and cut[0].n_chars == len("before it after") and cut[0]._id == 7
    assert out.count() == awkward.count()
    assert anchors.cut_repeats(empty).count() == 0


@pytest.mark.parametrize("period", sorted(anchors.COVERS))
def test_covers(period):
    cover = anchors.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# --- suffixes -------------------------------------------------------------------


def strings_brute(rows, length):
    count = Counter()
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for _, b in bodies:
        count.update(b[k : k + length] for k in range(len(b) - length + 1))
    out = []
    for i, b in bodies:
        marks = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                marks[k] += 1
                marks[k + length] -= 1
        gone = np.cumsum(marks)[:-1] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [400, 128])
def test_repeated_strings(docs, texts, length):
    rows = [(i, t) for i, t in texts.items() if len(t) < 9000]
    small = docs.filter("length(text) < 9000")
    got = [tuple(r) for r in suffixes.repeated_strings(small, length).collect()]
    assert sorted(got, key=repr) == strings_brute(rows, length)


def test_repeated_strings_awkward(spark, awkward, empty):
    short = awkward.filter("length(text) < 4000 or text is null")
    got = [tuple(r) for r in suffixes.repeated_strings(short, 128).collect()]
    assert sorted(got, key=repr) == strings_brute(plain(short), 128)
    assert suffixes.repeated_strings(empty).count() == 0
    # Chimeras: interiors known from one text, edges from another; matches of just the length.
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdefgh ijkl"), 1500)) for _ in range(4)]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(rng.integers(1, 4)):
            b = base[rng.integers(4)]
            a = rng.integers(0, 1200)
            parts.append(b[a : a + int(rng.choice([127, 128, 129, 140, 200, 300, 600]))])
            parts.append("".join(rng.choice(list("mnopq"), int(rng.integers(0, 30)))))
        rows.append((k, "".join(parts)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in suffixes.repeated_strings(table, 128).collect()]
    assert sorted(got, key=repr) == strings_brute(rows, 128)


def test_multikey_order():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 500).astype(np.uint64) << np.uint64(40), rng.integers(0, 1 << 62, 500).astype(np.uint64)
    assert (np.stack([a, b], 1)[multikey_order(a, b)] == np.stack([a, b], 1)[np.lexsort((b, a))]).all()


@pytest.mark.parametrize("splitters", ["hash", "sampled"])
def test_census(spark, splitters):
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    rows = [(i, i, b"", pool[rng.integers(0, 40, 7)].tobytes()) for i in range(30)]
    table = spark.createDataFrame(rows, "_id long, _key long, meta binary, keys binary").repartition(5)
    keys = {i: np.frombuffer(k, np.uint64) for i, _, _, k in rows}
    count = Counter(k for v in keys.values() for k in v.tolist())
    first = {}
    for i, v in sorted(keys.items()):
        for k in v.tolist():
            first.setdefault(k, i)
    got = {r._id: np.unpackbits(np.frombuffer(r.bits, np.uint8), count=7).tolist() for r in census(table, "twice", splitters=splitters).collect()}
    assert got == {i: b for i, v in keys.items() if any(b := [int(count[k] > 1) for k in v.tolist()])}
    got = {r._id: np.unpackbits(np.frombuffer(r.bits, np.uint8), count=7).tolist() for r in census(table, "earlier", splitters=splitters).collect()}
    assert got == {i: b for i, v in keys.items() if any(b := [int(first[k] < i) for k in v.tolist()])}


# --- near copies ----------------------------------------------------------------


def classes_brute(rows, size, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least = defaultdict(lambda: float("inf"))
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least[root(k)], float("inf") if i is None else i)
    out = []
    for k, (i, _) in enumerate(rows):
        low = least[root(k)] if sets[k] else i
        out.append((i, len(sets[k]), None if low in (None, float("inf")) else low))
    return sorted(out, key=repr), [root(k) if sets[k] else -1 for k in range(len(rows))]


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 60)])
def test_near_duplicates(docs, texts, size, percent):
    got = [tuple(r) for r in parity.near_duplicates(docs, size, percent).collect()]
    assert sorted(got, key=repr) == classes_brute(list(texts.items()), size, percent)[0]


def test_near_duplicates_awkward(spark, awkward, empty):
    got = [tuple(r) for r in parity.near_duplicates(awkward).collect()]
    assert sorted(got, key=repr) == classes_brute(plain(awkward), 4, 85)[0]
    assert parity.near_duplicates(empty).count() == 0
    kept = parity.keep_one(awkward)
    assert kept.columns == awkward.columns and parity.keep_one(empty).count() == 0
    _, roots = classes_brute(plain(awkward), 5, 80)
    assert kept.count() == len(set(roots) - {-1}) + len({r for r, x in zip(plain(awkward), roots) if x == -1})


def test_near_duplicates_chains_and_tiles(spark, monkeypatch):
    """A large group of copies with edits: chains of links, and groups over the tile size."""
    monkeypatch.setattr(parity, "TILE", 16)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 7))):
            w[k] = f"e{rng.integers(1000)}"
        rows.append((i, " ".join(w[: int(rng.integers(100, 121))])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in parity.near_duplicates(table).collect()]
    assert sorted(got, key=repr) == classes_brute(rows, 4, 85)[0]


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 6), (6, 5), (3, 3), (1, 2), (20, 10), (20, 30), (30, 40), (40, 50), (50, 9)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 5 for i in (5, 6, 7, 8, 9, 10, 20, 30, 40, 50)}, 1: 1, 2: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- tokens ---------------------------------------------------------------------


def ids_of(texts):
    library = tokens.encoder(tokens.vocabulary_path()).tokenizer
    return [np.array(library.encode(t or "", add_special_tokens=False).ids + [1], np.uint32) for t in texts]


def test_encoding_is_the_library_s():
    parts = ["a", "B", "é", "É", "ß", "İ", "Σ", "'s", "'the", "don't", "12", "x9", "<|endoftext|>", "<|end", "oftext|>", " ", "\n", "\x1c",
             "\x85", " ", "́", "😀", ",", ".", "(", "×", "ﬁ", "中", "कि", "’s", "_", "-"]
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(5000)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    got = []
    for _, ids, upto in tokens.encoded(iter([batch])):
        got += np.split(ids, upto[:-1])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(got, ids_of(texts), strict=True))


def test_token_files(awkward, empty, docs, texts):
    for table, rows in ((awkward, plain(awkward)), (docs, list(texts.items()))):
        got = sorted((tuple(r) for r in huffman.token_files(table.select("doc_id", "text")).collect()), key=lambda r: r[1])
        ids = ids_of([t for _, t in rows])
        want = Counter((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, ids))
        assert Counter((r[0], r[2], r[3]) for r in got) == want
        order = [float("inf") if r[0] is None else r[0] for r in got]
        assert order == sorted(order)
        assert [r[1] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])))[:-1].tolist()
    assert huffman.token_files(empty.select("doc_id", "text")).count() == 0


def test_huffman_codes():
    rng = np.random.default_rng(6)
    for n, limit in ((1, 16), (2, 16), (300, 9), (5000, 13)):
        counts = (1e9 / np.arange(1, n + 1) ** 3).astype(np.int64) + 1
        size = huffman.code_lengths(counts, limit)
        assert size.max() <= limit and (2.0 ** -size.astype(float)).sum() <= 1
        ids = rng.choice(n, 10_000, p=counts / counts.sum()).astype(np.uint16)
        bits, at = huffman.pack(ids, size, huffman.canonical_codes(size))
        assert (huffman.unpack(bits, at, len(ids), huffman.decode_table(size)) == ids).all()
    # Without a limit that binds the code is Huffman's: its cost is the sum of all merges.
    import heapq

    counts = rng.integers(1, 1000, 200)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((huffman.code_lengths(counts, 30).astype(int) * counts).sum()) == cost


@pytest.mark.parametrize("size", [4096, 64])
def test_packing(awkward, empty, size):
    rows, want = packing.pack_documents(awkward.select("doc_id", "text"), size).collect(), Counter()
    for (i, _), x in zip(plain(awkward), ids_of([t for _, t in plain(awkward)])):
        for k in range(0, len(x), size):
            part = x[k : k + size]
            want[(i, k // size, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert packing.pack_documents(empty.select("doc_id", "text")).count() == 0


def test_packing_plan():
    rng = np.random.default_rng(7)
    counts = np.bincount(rng.integers(1, 4097, 3000), minlength=4097)
    patterns = packing.plan(counts)
    left = counts.copy()
    for uses, times in patterns:
        assert sum(n * k for n, k in times.items()) <= 4096
        for n, k in times.items():
            left[n] -= uses * k
    assert not left.any() and len(patterns) <= 4096
    # Little beyond what the tokens or the long pieces need (best-fit decreasing: 1542 of 1523).
    need = max(-(-int((counts * np.arange(4097)).sum()) // 4096), int(counts[2049:].sum()))
    assert sum(uses for uses, _ in patterns) <= 1542
    exact = np.zeros(4097, np.int64)
    exact[[3000, 600, 496, 2000, 2096, 1]] = [5, 5, 5, 2, 2, 0]
    assert sum(uses for uses, _ in packing.plan(exact)) == 7


def test_token_counts(docs, texts, awkward, empty):
    for table, rows in ((docs, texts.values()), (awkward, [t for _, t in plain(awkward)])):
        size = np.array([len(x) for x in ids_of(list(rows))])
        sums = lengths.with_sums(lengths.length_histogram(table))
        got = {r.context_limit: r for r in lengths.answers(sums).collect()}
        assert set(got) == set(size.tolist())
        for limit, r in got.items():
            assert (r.n_docs, r.docs_upto, r.docs_over) == ((size == limit).sum(), (size <= limit).sum(), (size > limit).sum())
            assert (r.tokens_upto, r.tokens_over) == (size[size <= limit].sum(), size[size > limit].sum())
            assert (r.kept_tokens, r.tokens_all) == (np.minimum(size, limit).sum(), size.sum())
            assert r.kept_tokens + r.cut_tokens == r.tokens_all
            assert abs(r.quantile_to - (size <= limit).mean()) < 1e-12
        for limit in (1, 100, 5000):
            r = lengths.kept_at(sums, limit).first()
            assert (r.docs_over, r.kept_tokens) == ((size > limit).sum(), np.minimum(size, limit).sum())
    assert lengths.token_counts(empty).count() == 0


# --- learned --------------------------------------------------------------------


def held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


def test_language(spark, awkward, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    got = {r.doc_id: r for r in language.identify(big).collect()}
    truth = {r.doc_id: r.lang for r in big.collect()}
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in got.items())
    aside = [i for i in got if held_out(i)]
    assert np.mean([got[i].lang_pred == truth[i] for i in aside]) > 0.97
    odd = {(r.doc_id, r.held_out, r.lang_pred) for r in language.identify(awkward).collect()}
    assert {(5, held_out(5), "und"), (6, held_out(6), "und"), (7, held_out(7), "und"), (None, True, "und"), (None, True, "en")} <= odd
    assert len(language.identify(awkward).collect()) == awkward.count() and language.identify(empty).count() == 0


def test_language_grams():
    texts = ["Ab  c!", "", "é", "-"]
    body = "".join(texts).encode()
    offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    text, gram = language.grams(np.frombuffer(body, np.uint8), offs)
    a, b, c, other = ord("a"), ord("b"), ord("c"), ord("é")
    want = [(0, 0, a, b), (0, a, b, 0), (0, b, 0, c), (0, 0, c, 0), (2, 0, other, 0)]
    assert list(zip(text.tolist(), gram.tolist())) == [(t, x << 42 | y << 21 | z) for t, x, y, z in want]
    vectors = language.gram_vectors(np.unique(gram))
    products = vectors @ vectors.T
    assert (np.diag(products) == language.SIZE).all() and np.abs(np.triu(products, 1)).max() < language.SIZE / 4


def test_toxicity(spark, awkward, empty):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    aside = [i for i in known if held_out(i)]
    assert np.mean([got[i].predicted for i in aside if known[i]]) > 0.8  # a tenth of the labels is noise
    assert np.mean([got[i].predicted for i in aside if not known[i]]) < 0.02
    some = toxicity.toxicity(awkward, labels)
    assert some.count() == awkward.count() and toxicity.toxicity(empty, labels.filter("false")).count() == 0
    kept = toxicity.drop_toxic(awkward, labels)
    assert kept.columns == awkward.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, awkward.collect()))


def test_machine_learns_pairs():
    """Two terms that are harmless alone: no linear score tells them from the pair."""
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(600):
        a, b = rng.random(2) < 0.5
        noise = rng.integers(10, 40, 3).tolist()
        rows.append((np.array(sorted({*([1] if a else [2]), *([3] if b else [4]), *noise}), np.uint64), int(a == b)))
    machine = toxicity.train(rows, epochs=60, rate=0.1, factor_share=1.0)
    right = 0
    for features, label in rows:
        place = np.searchsorted(machine.features, features)
        right += (machine.logits(np.zeros(len(place), int), place, 1)[0] > 0) == bool(label)
    assert right / len(rows) > 0.9


def base_brute(text):
    w = words(text)
    count, marks = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            marks.update(range(i, i + 5))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    n = len(w)
    chars = sum(len(x.decode()) for x in w)
    return n, chars, len(re.findall(r"[#*$%&|<>]", text or "")), again, len(marks), n < 10 or 100 * len(marks) > 20 * n


def test_quality(spark, docs, texts, awkward, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for table, rows in ((docs, list(texts.items())), (awkward, plain(awkward))):
        got = quality.quality(table, labels).collect()
        counts = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
        assert counts == Counter((i, *base_brute(t)) for i, t in rows)
        assert not any(r.kept and r.base_failed for r in got)
    assert quality.quality(empty, labels.filter("false")).count() == 0


def test_quality_keeps_good(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    got = {r.doc_id: r for r in quality.quality(spark.read.parquet(f"{d}/documents.parquet"), labels).collect()}
    assert np.mean([got[i].kept for i, q in known.items() if q and not got[i].base_failed]) > 0.97
    assert np.mean([got[i].kept for i, q in known.items() if not q]) < 0.2


def test_viterbi_and_marginals():
    """Against all labellings of short chains."""
    rng = np.random.default_rng(9)
    counts = np.array([1, 4, 0, 3, 6])
    first = np.concatenate(([0], np.cumsum(counts)))
    lines = quality.Lines(first, np.ones(first[-1]), rng.integers(0, quality.FEATURES, (first[-1], 3)))
    chain = quality.Chain(rng.normal(size=(quality.FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    score, labels = chain.scores(lines), quality.viterbi(chain, lines)
    p, moves = quality._marginals(chain, lines)
    expected = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        ways = {}
        for code in range(1 << (b - a)) if b > a else ():
            y = [code >> k & 1 for k in range(b - a)]
            ways[tuple(y)] = chain.start[y[0]] + sum(score[a + k, v] for k, v in enumerate(y)) + sum(chain.moves[u, v] for u, v in zip(y, y[1:]))
        if ways:
            assert tuple(labels[a:b]) == max(ways, key=ways.get)
            total = sum(np.exp(v) for v in ways.values())
            for k in range(b - a):
                assert abs(p[a + k, 1] - sum(np.exp(v) for y, v in ways.items() if y[k]) / total) < 1e-9
            for y, v in ways.items():
                for u, w in zip(y, y[1:]):
                    expected[u, w] += np.exp(v) / total
    assert np.abs(moves - expected).max() < 1e-9


# --- leaks ----------------------------------------------------------------------


def align_brute(a, b):
    best, h = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = leaks.MATCH if a[i - 1] == b[j - 1] else leaks.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] + leaks.GAP, h[i, j - 1] + leaks.GAP)
            best = max(best, h[i, j])
    return best


def test_align():
    rng = np.random.default_rng(10)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(1, 15)).astype(np.uint64) for _ in range(2))
        score, start, end = leaks.align(a, b)
        assert score == align_brute(a, b) and (score == 0 or 0 <= start < end <= len(b))
    assert leaks.align(np.array([5, 6, 7], np.uint64), np.array([1, 5, 6, 9, 7, 2], np.uint64)) == (5, 1, 5)


def test_contaminated(spark, docs, texts, awkward, empty):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    split = lambda t: re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", t.lower())
    known = {r.item_id: split(r.text) for r in items.collect()}
    want = set()
    for i, t in texts.items():
        w = split(t)
        for k, item in known.items():
            if sum(x in w for x in item) >= 0.6 * len(item) and align_brute(item, w) >= 0.6 * 2 * len(item):
                want.add((i, k))
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(docs, items).collect()}
    assert got == want and got
    rest = leaks.drop_contaminated(docs, items)
    assert rest.columns == docs.columns and {r.doc_id for r in rest.collect()} == set(texts) - {i for i, _ in want}
    odd = spark.createDataFrame(
        [(1, "word3 word4 word5 word6 WORD7 and word9", 1), (2, None, 2), (None, "x", 3), (3, "", 4), (4, "two", 5), (1, "one", 5)],
        "item_id long, text string, doc_id int",
    )
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(awkward, odd).collect()}
    assert {(1, 1), (2, 1), (None, 1), (13, 1), (9, 4), (10, 1)} <= got
    assert leaks.contaminated(empty, items).count() == 0 and leaks.contaminated(awkward, odd.filter("false")).count() == 0


def test_edited_copies_beside_exact(spark):
    """What only an exact copy has does not keep its edited copies from being aligned."""
    item = [f"w{k}" for k in range(40)]
    edited = [f"x{k}" if k % 5 == 2 else w for k, w in enumerate(item)]
    rows = [(1, " ".join(item)), *((i, f"before {' '.join(edited)} after no{i}") for i in range(2, 8)), (8, "w1 w2 w3 of another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in leaks.contaminated(docs, items).collect()}
    assert set(got) == set(range(1, 8)) and got[1] == 1 and abs(got[2] - 56 / 80) < 1e-9
    # The only seed stands at one end, the rest of the copy reaches over more words than the item has.
    item = [f"v{k}" for k in range(20)]
    spread = item[:4] + [x for w in item[4:] for x in (f"no{w}", w)]
    docs = spark.createDataFrame([(1, " ".join(spread))], "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    assert [r.doc_id for r in leaks.contaminated(docs, items).collect()] == [1]


def test_copies_without_three_words_in_a_row(spark):
    """Copies at the threshold are found whatever the edits, as brute force does."""
    rng = np.random.default_rng(11)
    known = {k: [f"w{x}" for x in rng.integers(0, 60, n)] for k, n in enumerate((1, 2, 4, 5, 6, 8, 12, 20, 33))}
    rows = {}
    for item in known.values():
        rows[len(rows)] = [x for k, w in enumerate(item) for x in ([w, f"y{k}"] if k % 2 else [w])]
        rows[len(rows)] = [x for k, w in enumerate(item) for x in ([w, f"y{k}"] if 5 * k < 4 * len(item) else [w])]
        for _ in range(12):
            copy = []
            for w in item:
                edit = rng.random()
                copy += [w] if edit < 0.6 else [w, f"w{rng.integers(60)}"] if edit < 0.85 else [f"w{rng.integers(60)}"] if edit < 0.93 else []
            around = [[f"w{x}" for x in rng.integers(0, 60, n)] for n in rng.integers(0, 90, 2)]
            rows[len(rows)] = around[0] + copy + around[1]
    want = {(i, k) for i, w in rows.items() for k, item in known.items() if align_brute(item, w) >= 0.6 * 2 * len(item)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id long, text string")
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in known.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.contaminated(docs, items).collect()}
    assert got == want and {(98, 7), (99, 7), (112, 8)} <= got


# --- the pipeline ---------------------------------------------------------------


def test_pipeline(spark, docs, texts):
    """Each stage against brute force on what the one before kept."""
    import corpus_pipeline

    stage, current = dict(corpus_pipeline.STAGES), docs
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 1").collect()}
    current = stage["toxicity"](spark, current, SF)
    assert current.columns == docs.columns and {r.doc_id for r in current.collect()} == set(texts) - bad
    rows = sorted((r.doc_id, r.text) for r in current.collect())
    _, roots = classes_brute(rows, 5, 80)
    lead = {}
    for (i, _), root in zip(rows, roots):
        lead.setdefault(root, i)
    current = stage["near_copies"](spark, current, SF)
    assert {r.doc_id for r in current.collect()} == set(lead.values())
    rows = sorted((r.doc_id, r.text) for r in current.collect())
    want = {i: sha for i, _, _, sha in repeats_brute(rows)}
    current = stage["repeated_passages"](spark, current, SF)
    assert {r.doc_id: hashlib.sha256(b" ".join(words(r.text))).hexdigest() for r in current.collect()} == want
    current = stage["test_items"](spark, current, SF)
    assert current.columns == docs.columns
    kept = {r.doc_id for r in current.collect()}
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.collect()} == kept


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
