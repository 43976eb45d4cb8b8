"""Suffix-array dedup of bytes: repeated strings of a fixed length anywhere in the corpus.

Sorting all suffixes would move every byte many times, so the suffixes to sort
are narrowed down first, and nothing is lost on the way:

1. Sampled places (a byte gram whose hash is 0 modulo ``EVERY``) depend on the
   gram alone, so two equal strings have them at the same offsets. A string that
   holds a gram found nowhere else cannot repeat.
2. Strings with the same sampled places are named by the stretch from the first
   to the last of them (core) and by the stretch out to the next ones on either
   side (envelope). A repeated envelope decides all strings inside it.
3. What is left, strings whose core stands in different envelopes, are suffixes
   to be sorted as such.

Suffixes are named by fingerprints of their leading tokens (core, then envelope;
or the string itself). Sampled splitters cut the order of fingerprints into
ranges, each range sorts its suffixes by multikey quicksort and compares
neighbours. Splitters are whole names, so equal suffixes are never parted by a
boundary. Texts that occur more than once are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.census import census, packed_rows, unpacked
from docweave.llm.tables import NO_ID, fill, real_id
from docweave.llm.texts import BYTE_CODE, SLICE_BYTES, covered, prefix_sums, ranges, runs, slices, span_hash
from docweave.session import new_path

GRAM = 64
EVERY = 32


def distinct_texts(texts: DataFrame) -> DataFrame:
    """(_id, _key, copies, body, size): each text of (_id, _key, text) once, compressed.

    A task sends a text once and its further copies as a number, so a text that a
    third of all rows have is no load for the task that gets it.

    The table is kept in buckets of its id in the shared folder: later joins with
    it move only what they bring.
    """

    def squeeze(batches: Iterator[pa.RecordBatch]):
        again: dict[tuple[int, int], int] = {}  # texts of this task, and how often each came again
        for batch in batches:
            new = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("_id", "_key", "text"))):
                if row[:2] in again:
                    again[row[:2]] += 1
                else:
                    again[row[:2]] = 0
                    body = (row[2] or "").encode()
                    new.append((*row[:2], 1, pa.compress(body, codec="zstd", asbytes=True) if body else b"", len(body)))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in new], schema)
        more = [(*name, n, None, None) for name, n in again.items() if n]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in more], schema)

    schema = pa.schema([("_id", pa.int64()), ("_key", pa.int64()), ("copies", pa.int64()), ("body", pa.binary()), ("size", pa.int64())])
    spark, n = texts.sparkSession, fill(texts)
    rows = texts.mapInArrow(squeeze, "_id long, _key long, copies long, body binary, size long").repartition(n, "_id")
    once = rows.groupBy("_id", "_key").agg(
        F.sum("copies").alias("copies"), F.first("body", True).alias("body"), F.first("size", True).alias("size")
    )
    path = new_path(spark, "texts")
    name = "texts_" + path.rpartition("-")[2]
    once.write.bucketBy(n, "_id").option("path", path).saveAsTable(name)
    return spark.table(name)


def _bodies(batches: Iterator[pa.RecordBatch]):
    """Batches of distinct texts with their text beside the other columns."""
    for batch in batches:
        sizes = batch.column("size").to_pylist()
        at = 0
        while at < batch.num_rows:
            to, total = at, 0
            while to < batch.num_rows and (to == at or total + sizes[to] <= SLICE_BYTES):
                total += sizes[to]
                to += 1
            part = batch.slice(at, to - at)
            texts = [
                pa.decompress(b, n, codec="zstd", asbytes=True) if n else b""
                for b, n in zip(part.column("body").to_pylist(), sizes[at:to])
            ]
            yield part.append_column("text", pa.array(texts, pa.binary()).view(pa.string()))
            at = to


@dataclass
class Sampled:
    """Sampled places of the texts of a slice."""

    offs: np.ndarray
    sums: np.ndarray
    at: np.ndarray
    first: np.ndarray
    grams: np.ndarray


def sampled(data: np.ndarray, offs: np.ndarray) -> Sampled:
    sums = prefix_sums(BYTE_CODE[data])
    place = np.arange(max(len(data) - GRAM + 1, 0))
    grams = span_hash(sums, place, place + GRAM)
    at = np.flatnonzero((grams >> np.uint64(40)) % np.uint64(EVERY) == 0)
    text = np.searchsorted(offs, at, side="right") - 1
    inside = at + GRAM <= offs[text + 1]
    at, text = at[inside], text[inside]
    return Sampled(offs, sums, at, np.searchsorted(text, np.arange(len(offs))), grams[at])


@dataclass
class Strings:
    """Places of strings all of whose sampled grams repeat, and their cores."""

    at: np.ndarray
    core: np.ndarray  # index of the core, -1 for strings without a sampled place
    core_first: np.ndarray  # by text
    cores: np.ndarray
    envelopes: np.ndarray


def strings(s: Sampled, bits: list[bytes | None], length: int) -> Strings:
    n = len(s.offs) - 1
    known = [
        np.zeros(b - a, bool) if bit is None else unpacked(bit, b - a) for a, b, bit in zip(s.first[:-1], s.first[1:], bits)
    ]
    repeats = np.concatenate(known) if known else np.empty(0, bool)
    single = np.zeros(len(s.sums), np.int64)
    single[s.at[~repeats] + 1] = 1
    single = np.cumsum(single)
    starts = ranges(s.offs[:-1], np.maximum(np.diff(s.offs) - length + 1, 0))
    at = starts[single[starts + length - GRAM + 1] == single[starts]]
    left = np.searchsorted(s.at, at, side="left")
    right = np.searchsorted(s.at, at + length - GRAM, side="right") - 1
    has = right >= left
    code = (left[has] << 32) | right[has]
    text = np.searchsorted(s.offs, at[has], side="right") - 1
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    core = np.full(len(at), -1)
    core[has] = np.cumsum(new) - 1
    left, right, text = left[has][new], right[has][new], text[new]
    cores = span_hash(s.sums, s.at[left], s.at[right] + GRAM)
    last = len(s.at) - 1
    low = np.where(left > s.first[text], s.at[np.maximum(left - 1, 0)], s.offs[text])
    high = np.where(right + 1 < s.first[text + 1], s.at[np.minimum(right + 1, max(last, 0))] + GRAM, s.offs[text + 1])
    envelopes = span_hash(s.sums, low, high)
    return Strings(at, core, np.searchsorted(text, np.arange(n + 1)), cores, envelopes)


def asked(s: Sampled, found: Strings, bits: list[bytes | None], length: int):
    """Strings known to repeat, places of those to be sorted, their hashes, and where each text's begin.

    A string that a text has twice is known to repeat; it is sorted once.
    """
    pair, beside = np.zeros(len(found.cores), bool), np.zeros(len(found.cores), bool)
    for a, b, bit in zip(found.core_first[:-1], found.core_first[1:], bits):
        if bit is not None:
            size = -(-(b - a) // 8)
            pair[a:b], beside[a:b] = unpacked(bit[:size], b - a), unpacked(bit[size:], b - a)
    has = found.core >= 0
    known, open_ = np.zeros(len(found.at), bool), ~has
    known[has], open_[has] = pair[found.core[has]], beside[found.core[has]]
    rows = np.flatnonzero(open_)
    at = found.at[rows]
    hashes = span_hash(s.sums, at, at + length)
    text = np.searchsorted(s.offs, at, side="right") - 1
    order = np.lexsort((at, hashes, text))
    new = np.ones(len(rows), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    group = np.cumsum(new) - 1
    many = np.bincount(group) > 1 if len(rows) else np.empty(0, bool)
    known[rows[order]] |= many[group]
    once = np.sort(order[new])
    return known, at[once], hashes[once], np.searchsorted(text[once], np.arange(len(s.offs)))


def repeated_strings(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of (doc_id, text).

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers
    it also starts anywhere else, in the same document or another; strings are
    judged on the input. Null and empty texts have no bytes. Repeated rows repeat
    each other; ids may be missing; other columns are ignored; an empty table
    gives no rows. ``length`` must be at least 128.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    name = F.sha2(F.coalesce("text", F.lit("")), 256)
    half = lambda k: F.expr(f"cast(conv(substring(_name, {k}, 15), 16, 10) as long)")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text", name.alias("_name"))
    rows = rows.select("doc", "text", half(1).alias("_id"), half(16).alias("_key"))
    texts = distinct_texts(rows.select("_id", "_key", "text"))

    def with_(table: DataFrame, answers: DataFrame, column: str, how: str) -> DataFrame:
        """``table`` with the bits of its texts; joined on the bucketed id, the rest of the name compared."""
        new = answers.select(F.col("_id").alias("_id2"), F.col("_key").alias("_key2"), F.col("bits").alias(column))
        same = (F.col("_id") == F.col("_id2")) & (F.col("_key").bitwiseXOR(F.col("_key2")) == 0)
        return table.join(new, same, how).drop("_id2", "_key2")

    def grams(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(_bodies(batches)):
            s = sampled(data, offs)
            used = np.flatnonzero(np.diff(s.first))
            if len(used):
                yield packed_rows(batch, [b""] * len(used), [s.grams[s.first[i] : s.first[i + 1]] for i in used], used)

    def named(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(_bodies(batches)):
            s = sampled(data, offs)
            f = strings(s, batch.column("gram_bits").to_pylist(), length)
            used = np.flatnonzero(np.diff(f.core_first))
            keys = [np.concatenate([k[f.core_first[i] : f.core_first[i + 1]] for k in (f.cores, f.envelopes)]) for i in used]
            if len(used):
                yield packed_rows(batch, [b""] * len(used), keys, used)

    def sort_keys(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(_bodies(batches)):
            s = sampled(data, offs)
            f = strings(s, batch.column("gram_bits").to_pylist(), length)
            _, _, hashes, first = asked(s, f, batch.column("core_bits").to_pylist(), length)
            used = np.flatnonzero(np.diff(first))
            if len(used):
                yield packed_rows(batch, [b""] * len(used), [hashes[first[i] : first[i + 1]] for i in used], used)

    def digest(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(_bodies(batches)):
            s = sampled(data, offs)
            f = strings(s, batch.column("gram_bits").to_pylist(), length)
            known, at, _, first = asked(s, f, batch.column("core_bits").to_pylist(), length)
            marks = np.zeros(len(data) + 1, bool)
            marks[f.at[known]] = True
            for a, b, bit in zip(first[:-1], first[1:], batch.column("sort_bits").to_pylist()):
                if bit is not None:
                    marks[at[a:b][unpacked(bit, b - a)]] = True
            gone = covered(marks, length)[:-1]
            body, out = data.tobytes(), []
            for a, b, copies in zip(offs[:-1], offs[1:], batch.column("copies").to_pylist()):
                own = np.full(b - a, True) if copies > 1 and b - a >= length else gone[a:b]
                begin, end = runs(own)
                keep = np.concatenate(([0], end)), np.concatenate((begin, [b - a]))
                sha = hashlib.sha256()
                for x, y in zip(*keep):
                    sha.update(body[a + x : a + y])
                out.append((b - a, int(own.sum()), len(begin), sha.hexdigest()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key")]
                + [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                ["_id", "_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    gram_bits = census(texts, "twice", exact=False, make=grams)
    by_grams = with_(texts, gram_bits, "gram_bits", "inner")
    core_bits = census(by_grams, "pairs", splitters="sampled", make=named)
    all_grams = with_(texts, gram_bits, "gram_bits", "left")
    by_cores = with_(all_grams, core_bits, "core_bits", "left")
    sort_bits = census(by_cores, "twice", splitters="sampled", make=sort_keys)
    full = with_(by_cores, sort_bits, "sort_bits", "left")
    found = full.mapInArrow(
        digest, "_id long, _key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    out = rows.select("doc", "_id", "_key").join(found, ["_id", "_key"])
    return out.select(real_id("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
