"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter's place in an n-gram is
bound in by permuting its vector, the letters of a trigram are bound by
multiplication, the trigrams of a text are bundled by addition. Languages are
bundles of the texts known to be in them; a text gets the language whose bundle
has the largest cosine with its own.

A letter's vector is made from a hash of its code point, so every letter of every
script has its own. As bundling is addition, a text's vector is its trigram counts
times the vectors of its distinct trigrams, and a language's bundle is the sum of
those of its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.tables import held_out
from docweave.llm.texts import BASE, mix, slices

SIZE = 512
# Bits of a code point; a trigram is three of them in one long.
BITS = 21
POINT = (1 << BITS) - 1
# Texts, and distinct trigrams, multiplied with each other at once.
TOGETHER = 128
CHUNK = 16384
# Letters up to which every possible trigram has a cell while distinct ones are sought.
ALPHABET = 128

_symbols: list[np.ndarray] = []


def _letter(point: int) -> int:
    """The lower-case letter of a code point, 0 for other characters."""
    c = chr(point)
    return ord(c.lower()[0]) if c.isalpha() else 0


def symbol_table() -> np.ndarray:
    """Letters of all code points of the basic plane."""
    if not _symbols:
        _symbols.append(np.array([_letter(point) for point in range(1 << 16)], np.int64))
    return _symbols[0]


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A vector of +1 and -1 for each code point, from a hash of it; 0 is the boundary."""
    places = np.arange(1, SIZE // 64 + 1, dtype=np.uint64)
    words = mix((points.astype(np.uint64)[:, None] * np.uint64(SIZE // 64) + places) * BASE)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(used: np.ndarray) -> np.ndarray:
    """Vectors of trigrams: permuted letters, bound."""
    points, at = np.unique(np.stack([used >> 2 * BITS, used >> BITS & POINT, used & POINT]), return_inverse=True)
    letters = letter_vectors(points)
    first, second, third = at.reshape(3, -1)
    return (np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]).astype(np.float32)


def distinct(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams, ascending, and the place of each among them."""
    seen = np.zeros(1 << 16, bool)
    letters = [gram >> 2 * BITS, gram >> BITS & POINT, gram & POINT]
    if not len(gram) or max(x.max() for x in letters) >= len(seen):
        return np.unique(gram, return_inverse=True)
    for x in letters:
        seen[x] = True
    points = np.flatnonzero(seen)
    n = len(points)
    if n > ALPHABET:
        return np.unique(gram, return_inverse=True)
    # few letters: a cell for every triple instead of a sort
    place = np.zeros(len(seen), np.int32)
    place[points] = np.arange(n)
    triple = (place[letters[0]] * n + place[letters[1]]) * n + place[letters[2]]
    cells = np.zeros(n**3, bool)
    cells[triple] = True
    used = np.flatnonzero(cells)
    column = np.zeros(n**3, np.int32)
    column[used] = np.arange(len(used))
    return points[used // n**2] << 2 * BITS | points[used // n % n] << BITS | points[used % n], column[triple]


def bundles_of(group: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """Sums of the trigram vectors of n groups."""
    out = np.zeros((n, SIZE), np.float64)
    used, column = distinct(gram)
    if len(used) > CHUNK:
        order = np.argsort(column)
        group, column = group[order], column[order]
    for k in range(0, len(used), CHUNK):
        some = used[k : k + CHUNK]
        a, b = np.searchsorted(column, (k, k + CHUNK)) if len(used) > CHUNK else (0, len(column))
        cell = group[a:b] * len(some) + (column[a:b] - k)
        counts = np.bincount(cell, minlength=n * len(some)).reshape(n, len(some))
        out += counts.astype(np.float32) @ gram_vectors(some)
    return out


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, trigram) of all places; runs of other characters count as one boundary."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    upto = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offs]
    symbol = symbol_table()[np.minimum(points, 0xFFFF)]
    beyond = points > 0xFFFF
    if beyond.any():
        rare, which = np.unique(points[beyond], return_inverse=True)
        symbol[beyond] = np.array([_letter(point) for point in rare.tolist()], np.int64)[which]
    # A boundary begins every text and ends the one before it.
    symbol = np.append(np.insert(symbol, upto[:-1], 0), 0)
    begin = np.zeros(len(symbol), bool)
    begin[upto + np.arange(len(upto))] = True
    keep = (symbol > 0) | begin
    keep[1:] |= (symbol[:-1] > 0) & ~np.append(begin[2:], False)
    symbol, begin = symbol[keep], np.flatnonzero(begin[keep])
    gram = (symbol[:-2] << 2 * BITS) | (symbol[1:-1] << BITS) | symbol[2:]
    at = np.arange(len(gram))
    text = np.searchsorted(begin, at, side="right") - 1
    inside = at + 2 <= begin[np.minimum(text + 1, len(begin) - 1)]
    return text[inside], gram[inside]


def profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    """Bundle of each language: over all rows (text, lang) that are not held out."""

    def bundled(batches: Iterator[pa.RecordBatch]):
        sums: dict[str, np.ndarray] = {}
        for batch, data, offs in slices(batches):
            names, which = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            text, gram = grams(data, offs)
            for name, row in zip(names.tolist(), bundles_of(which[text], gram, len(names))):
                sums[name] = sums.get(name, 0) + row
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * SIZE), pa.array(np.arange(SIZE), pa.int32()), pa.array(vector, pa.float64())],
                ["lang", "place", "value"],
            )

    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("text", "lang")
    parts = known.mapInArrow(bundled, "lang string, place int, value double")
    out: dict[str, np.ndarray] = {}
    for row in parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect():  # SIZE numbers a language
        out.setdefault(row.lang, np.zeros(SIZE))[row.place] = row.value
    return dict(sorted(out.items()))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of (doc_id, text, lang).

    ``lang`` teaches the profiles and is no input of a prediction. ``score``: the
    cosine, not below 0. Texts that are null or have no letter are ``und`` with
    score 0, as are all where no language was learned; equal cosines go to the
    first name in order. Rows without an id count as held out, repeated rows are
    judged each, an empty table gives no rows.
    """
    known = profiles(docs)
    names = list(known)
    bundles = np.array([v / max(np.linalg.norm(v), 1e-12) for v in known.values()]).reshape(-1, SIZE)

    def predict(batches):
        for batch, data, offs in slices(batches):
            text, gram = grams(data, offs)
            lettered = np.bincount(text, gram > 0, batch.num_rows) > 0
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            upto = np.searchsorted(text, np.arange(0, batch.num_rows + TOGETHER, TOGETHER))
            for k, (a, b) in enumerate(zip(upto[:-1], upto[1:])):
                n = min(TOGETHER, batch.num_rows - k * TOGETHER)
                if n <= 0 or a == b or not names:
                    continue
                vectors = bundles_of(text[a:b] - k * TOGETHER, gram[a:b], n)
                length = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
                cosine = np.round((vectors @ bundles.T) / length[:, None], 6)
                best[k * TOGETHER : k * TOGETHER + n] = cosine.argmax(axis=1)
                score[k * TOGETHER : k * TOGETHER + n] = cosine.max(axis=1)
            found = [names[i] if ok and names else "und" for i, ok in zip(best.tolist(), lettered.tolist())]
            score = np.where(lettered & bool(names), np.clip(score, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
