"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.tables import drop_table, fill
from docweave.llm.texts import LOWER, mask_spans, ranges, slices, word_hashes
from docweave.session import cut_lineage

LEAST_LETTERS, LEAST_COUNT, DROP_ONE_IN, TIMES = 6, 5, 199, 5
# Words of a tile; larger groups are cut into tiles and every two meet.
TILE = 1024
# Code points compared at once.
CELLS = 1 << 22

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _crc_table() -> np.ndarray:
    """The remainders of all bytes for the polynomial of crc32, lowest bit first."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def crc32_after(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of the spans, each carried on from the crc32 in ``state``; all spans advance together."""
    order = np.argsort(starts - ends, kind="stable")  # the longest first
    at, left = starts[order], (ends - starts)[order]
    c = state[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    live = len(order)
    for step in range(int(left[0]) if live else 0):
        live = int(np.searchsorted(-left, -step, side="left"))  # those longer than step
        c[:live] = _CRC[(c[:live] ^ data[at[:live] + step]) & np.uint32(255)] ^ (c[:live] >> np.uint32(8))
    out = np.empty_like(c)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    return out


def letter_mask(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF (0xC3 and the byte after it)."""
    inside = _LETTER[data]
    lead = data == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def word_counts(docs: DataFrame, drop_one_in: int = DROP_ONE_IN, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word, n) of all texts of (doc_id, text): letter runs, A-Z lower-cased, one letter dropped from some.

    A run whose crc32 (of ``<doc_id>:<run>``) is divisible by ``drop_one_in``
    loses the code point at crc32 modulo its length. Words of fewer than
    ``least_letters`` code points are left out.
    """

    def runs(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(batches):
            data = LOWER[data]
            starts, ends, first = mask_spans(letter_mask(data), offs)
            inner = np.zeros(len(data) + 1, np.int64)  # bytes before a place that begin no code point
            np.cumsum((data & 0xC0) == 0x80, out=inner[1:])
            letters = ends - starts - (inner[ends] - inner[starts])
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            long = letters >= least_letters
            starts, ends, letters, row = starts[long], ends[long], letters[long], row[long]
            if not len(starts):
                continue
            # One entry for each run of a document, with its number there.
            names = word_hashes(data, starts, ends)
            order = np.lexsort((names, row))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(names[order].view(np.int64)) != 0) | (np.diff(row[order]) != 0)
            n = np.diff(np.append(np.flatnonzero(new), len(order)))
            one = order[new]
            starts, ends, letters, row, names = starts[one], ends[one], letters[one], row[one], names[one]
            ids = batch.column("doc_id").to_pylist()
            before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            crc = crc32_after(before[row], data, starts, ends)
            cut = np.flatnonzero(crc % np.uint32(drop_one_in) == 0)
            shorter = []
            for i in cut.tolist():
                word = data[starts[i] : ends[i]].tobytes().decode()
                at = int(crc[i]) % int(letters[i])
                shorter.append(word[:at] + word[at + 1 :])
            whole = np.ones(len(one), bool)
            whole[cut] = False
            # The same word of several documents of the slice is sent once.
            order = np.argsort(names[whole], kind="stable")
            new = np.ones(len(order), bool)
            new[1:] = np.diff(names[whole][order].view(np.int64)) != 0
            begin = np.flatnonzero(new)
            sums = np.add.reduceat(n[whole][order], begin) if len(order) else n[:0]
            one = order[new]
            s, e = starts[whole][one], ends[whole][one]
            body = data[ranges(s, e - s)]
            bounds = np.zeros(len(one) + 1, np.int32)
            np.cumsum(e - s, out=bounds[1:])
            words = pa.StringArray.from_buffers(len(one), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body)))
            kept = [(w, c) for w, c in zip(shorter, n[cut].tolist()) if len(w) >= least_letters]
            words = pa.concat_arrays([words, pa.array([w for w, _ in kept], pa.string())])
            sums = np.concatenate((sums, np.array([c for _, c in kept], np.int64)))
            yield pa.RecordBatch.from_arrays([words, pa.array(sums.astype(np.int64))], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    return rows.mapInArrow(runs, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _matrix(words: list[str], width: int, back: bool = False) -> np.ndarray:
    """Code points of the words, one word a row, padded with 0; all lie below 256."""
    out = np.zeros((len(words), width), np.uint8)
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(w[::-1] if back else w for w in words).encode("latin-1"), np.uint8)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def single_edits(front: np.ndarray, rear: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Of the pairs (a, b) of different words, which are one edit apart, and their common prefix lengths.

    ``front`` and ``rear`` are the padded code points forwards and backwards:
    one edit is what common prefix and suffix leave of the longer word at most.
    """
    prefix = (front[a] != front[b]).argmax(axis=1)
    longer = np.maximum(sizes[a], sizes[b])
    suffix = (rear[a] != rear[b]).argmax(axis=1)
    return (prefix + suffix >= longer - 1) & (np.abs(sizes[a] - sizes[b]) <= 1), prefix


def _tile_pairs(block: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one cell: within one block, or of two blocks with each other."""
    if low == high:
        return np.triu_indices(len(block), 1)
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of each word of (word, n) that has a near word.

    Of two words one edit apart one half is equal: the first half of the shorter
    length, or what is left of it at the end. Words meet where such a half is
    equal and their lengths are that length or one more; a pair with an equal
    first half is left out where the ends meet. A group beyond ``TILE`` words is
    cut into blocks by hash and each two blocks meet in a cell. ``form`` is the
    near word of greatest n, the least of those.
    """
    halves = []
    for longer in (0, 1):  # the length of the shorter one
        size = F.char_length("word") - longer
        cut = F.floor(size / 2).cast("int")
        for side, half in (("p", F.expr("left(word, cut)")), ("s", F.expr("right(word, size - cut)"))):
            part = words.withColumn("size", size).withColumn("cut", cut).filter(F.col("size") > 0)
            halves.append(part.select("word", "n", F.concat_ws("-", F.lit(side), "size", half).alias("half")))
    met = halves[0]
    for other in halves[1:]:
        met = met.union(other)
    met = cut_lineage(met, "halves")
    many = met.groupBy("half").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    cells = met.join(many, "half").withColumn("tiles", tiles)
    cells = cells.withColumn("block", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    cells = cells.withColumn("_other", F.explode(F.expr("sequence(0, tiles - 1)")))
    cells = cells.select(
        "half", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "word", "n", "block"
    )
    cell = ["half", "low", "high"]
    dealt = cells.repartition(fill(words), *cell).sortWithinPartitions(*cell)

    def compared(batches: Iterator[pa.RecordBatch]):
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            begin = _cell_starts(table)
            if len(begin) > 1:
                yield from _answers(table.slice(0, begin[-1]), begin[:-1])
            held = table.slice(begin[-1]).combine_chunks()
        if held is not None:
            yield from _answers(held, np.zeros(1, np.int64))

    found = dealt.mapInArrow(compared, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("best")
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    out = cut_lineage(out.select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form"), "near")
    drop_table(met)
    return out


def _cell_starts(table: pa.Table) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for name in ("half", "low", "high"):
        column = table.column(name).combine_chunks()
        codes = column.dictionary_encode().indices.to_numpy() if name == "half" else column.to_numpy()
        change[1:] |= np.diff(codes) != 0
    return np.flatnonzero(change)


def _answers(table: pa.Table, begin: np.ndarray):
    """One row of each word of the whole cells of ``table`` that has near words there."""
    words = table.column("word").to_pylist()
    counts = table.column("n").to_numpy()
    block = table.column("block").to_numpy()
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    halves = table.column("half").to_pylist()
    ends = np.append(begin[1:], len(words))
    left, right, skip = [], [], []
    volume = 0
    sizes = np.array([len(w) for w in words])
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []

    def compare():
        a, b, cut = np.concatenate(left), np.concatenate(right), np.concatenate(skip)
        left.clear(), right.clear(), skip.clear()
        if not len(a):
            return
        used = np.unique(np.concatenate((a, b)))
        width = int(sizes[used].max()) + 1
        some = [words[i] for i in used.tolist()]
        front, rear, size = _matrix(some, width), _matrix(some, width, back=True), sizes[used]
        a, b = np.searchsorted(used, a), np.searchsorted(used, b)
        step = max(1, CELLS // width)
        for s in range(0, len(a), step):
            x, y, c = a[s : s + step], b[s : s + step], cut[s : s + step]
            near, prefix = single_edits(front, rear, size, x, y)
            near &= prefix < c
            out_a.append(used[x[near]])
            out_b.append(used[y[near]])

    for s, e in zip(begin.tolist(), ends.tolist()):
        side, size, _ = halves[s].split("-", 2)
        x, y = _tile_pairs(block[s:e], int(low[s]), int(high[s]))
        # Both one longer than the length of the group: they meet in the group of their own length.
        fit = np.minimum(sizes[s + x], sizes[s + y]) == int(size)
        x, y = s + x[fit], s + y[fit]
        left.append(x), right.append(y)
        skip.append(np.full(len(x), int(size) // 2 if side == "s" else int(size) + 2))
        volume += len(x) * (int(size) + 2)
        if volume > CELLS:
            compare()
            volume = 0
    if left:
        compare()
    a = np.concatenate(out_a + out_b) if out_a else np.empty(0, np.int64)
    b = np.concatenate(out_b + out_a) if out_a else np.empty(0, np.int64)
    if not len(a):
        return
    # Words are told apart by their text: the same word stands in several cells of the table.
    names, code = np.unique(np.array(words, dtype=object), return_inverse=True)
    total = np.bincount(code[a], minlength=len(names))
    order = np.lexsort((code[b], -counts[b], code[a]))
    who = code[a][order]
    first = np.flatnonzero(np.append(True, np.diff(who) != 0))
    best = b[order][first]
    who = who[first]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([names[i] for i in who.tolist()], pa.string()),
            pa.array(total[who].astype(np.int64)),
            pa.array(counts[best].astype(np.int64)),
            pa.array([words[i] for i in best.tolist()], pa.string()),
        ],
        ["word", "n_near", "form_n", "form"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of (word, form): the last form reached from it.

    Pointers are doubled until none moves; as each form has several times the
    count of its word, a chain is no longer than the logarithm of the counts.
    """
    up = cut_lineage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("top"))
        joined = cut_lineage(up.join(higher, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "forms")
        drop_table(up)
        up = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return up


def spelling_variants(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES, drop_one_in: int = DROP_ONE_IN
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (doc_id, text).

    Words are letter runs (A-Z, a-z, U+00C0 to U+00FF) of ``least_letters`` code
    points and ``least_count`` occurrences over all rows at least; see
    ``word_counts`` for the letters dropped. ``form``: the near word (one code
    point inserted, deleted or replaced) of greatest n, of those the least, if
    its n is ``times`` that of the word at least. ``root``: the last form along
    the chain, or the word. Null and empty texts have no words; a null id counts
    as empty text before the colon; repeated rows count each time; other columns
    are ignored; an empty table gives no rows.
    """
    words = word_counts(docs, drop_one_in, least_letters).filter(F.col("n") >= least_count)
    words = cut_lineage(words, "words")
    near = near_words(words)
    all_words = words.join(near, "word", "left")
    has_form = F.col("form_n") >= times * F.col("n")
    all_words = all_words.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("form")).alias("form"),
        F.when(has_form, F.col("form_n")).alias("form_n"),
    )
    all_words = cut_lineage(all_words, "variants")
    drop_table(words)
    drop_table(near)
    last = roots(all_words.filter("form is not null"))
    out = all_words.join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql() -> str:
    """DuckDB SQL of ``spelling_variants`` over ``documents``: words that share a text with one letter left out."""
    table = ", ".join(str(int(x)) for x in _CRC)
    return f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents
        ), each AS (
            SELECT doc_id, r, count(*) AS n FROM runs WHERE length(r) >= {LEAST_LETTERS} GROUP BY doc_id, r
        ), crc AS (
            SELECT r, n, xor(list_reduce(
                list_transform(range(0, CAST(strlen(b) AS BIGINT)), lambda i: CAST(('0x' || substr(hex(encode(b)), CAST(2 * i + 1 AS INT), 2)) AS BIGINT)),
                lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INT) + 1]), 4294967295), 4294967295) AS h
            FROM (SELECT r, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS b, [{table}] AS t FROM each)
        ), cut AS (
            SELECT CASE WHEN h % {DROP_ONE_IN} = 0
                THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS word, n FROM crc
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {LEAST_LETTERS}
            GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
        ), less AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
        ), ranked AS (
            SELECT word, other, m, count(*) OVER (PARTITION BY word) AS k,
                row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place FROM pairs
        ), formed AS (
            SELECT w.word, w.n, coalesce(r.k, 0) AS n_near, CASE WHEN r.m >= {TIMES} * w.n THEN r.other END AS form,
                CASE WHEN r.m >= {TIMES} * w.n THEN r.m END AS form_n
            FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON w.word = r.word
        ), chain AS (
            SELECT word, form AS at FROM formed WHERE form IS NOT NULL
            UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL
        ), last AS (
            SELECT c.word, c.at FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NULL
        )
        SELECT f.word, f.form, coalesce(l.at, f.word) AS root, f.n, f.n_near, f.form_n
        FROM formed f LEFT JOIN last l ON f.word = l.word"""
