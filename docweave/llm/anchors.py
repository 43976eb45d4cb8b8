"""Substring dedup with difference-cover anchors.

A difference cover of period p holds, for every distance, two places that far
apart modulo p. So two equal windows of ``window`` words, wherever they stand in
their documents, have some offset below p at which both meet a cover place. Only
the anchors at cover places are hashed (6 of 31 words instead of all). Anchors
that occur once are set aside; around the rest a match is extended: all windows
that hold such an anchor are compared as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from docweave.llm.census import census, packed_rows, unpacked
from docweave.llm.tables import keyed, real_id, shielded
from docweave.llm.texts import batch_slices, covered, give_back, ranges, slices, window_hashes, word_hashes, word_spans

# Perfect difference sets (fixed values): period and cover places.
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period whose anchors keep at least two fifths of a window; (1, (0,)) for short ones."""
    fit = [p for p in COVERS if (window - p + 1) * 5 >= 2 * window]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def _anchor_places(counts: np.ndarray, window: int, period: int, cover: tuple[int, ...]):
    """Places of all anchors, by text: (index of text, word place)."""
    size = window - period + 1
    usable = np.where(counts >= window, counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), usable)
    place = ranges(np.zeros(len(counts), np.int64), usable)
    here = np.zeros(period, bool)
    here[list(cover)] = True
    at = here[place % period]
    return text[at], place[at]


def repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """(_id, _key, meta, bits) of keyed ``docs``: windows that a smaller id has too.

    ``meta`` holds the places of the windows that were compared, ``bits`` which
    of them repeat an earlier document.
    """
    period, cover = cover_for(window)
    size = window - period + 1

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in slices(batches):
            starts, ends, first = word_spans(data, offs)
            text, place = _anchor_places(np.diff(first), window, period, cover)
            if not len(text):
                continue
            hashes = window_hashes(word_hashes(data, starts, ends), first[text] + place, size)
            used, at = np.unique(text, return_index=True)
            upto = np.append(at[1:], len(text))
            yield packed_rows(batch, [b""] * len(used), [hashes[a:b] for a, b in zip(at, upto)], used)

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in slices(batches):
            starts, ends, first = word_spans(data, offs)
            words = word_hashes(data, starts, ends)
            bits = batch.column("bits").to_pylist()
            metas, keys = [], []
            for i in range(batch.num_rows):
                n = int(first[i + 1] - first[i])
                _, place = _anchor_places(np.array([n]), window, period, cover)
                shared = place[unpacked(bits[i], len(place))]
                holds = np.zeros(n - window + 1 + period, np.int32)  # windows with a shared anchor
                np.add.at(holds, np.maximum(shared - period + 1, 0), 1)
                np.add.at(holds, np.minimum(shared + 1, n - window + 1), -1)
                at = np.flatnonzero(np.cumsum(holds)[: n - window + 1])
                metas.append(at.astype(np.int32).tobytes())
                keys.append(first[i] + at)
            flat = window_hashes(words, np.concatenate(keys), window)
            upto = np.cumsum([len(k) for k in keys])[:-1]
            yield packed_rows(batch, metas, np.split(flat, upto))

    shared = census(docs, "twice", exact=False, make=anchors)
    shared = shared.select("_id", "_key", "bits").dropDuplicates(["_id", "_key"])
    # Joined first: only texts that share an anchor are told apart from their copies.
    near = docs.join(shared, ["_id", "_key"]).dropDuplicates(["_id", "_key"])
    return census(near, "earlier", make=extended)


def _removal(data, offs, metas, bits, window):
    """For each text its words' spans and which words go."""
    starts, ends, first = word_spans(data, offs)
    gone = np.zeros(len(starts), bool)
    for i, (meta, bit) in enumerate(zip(metas, bits)):
        if bit is None:
            continue
        at = np.frombuffer(meta, np.int32)
        at = at[unpacked(bit, len(at))]
        marks = np.zeros(first[i + 1] - first[i], bool)
        marks[at] = True
        gone[first[i] : first[i + 1]] = covered(marks, window)
    return starts, ends, first, gone


def _joined(docs: DataFrame, window: int) -> DataFrame:
    rows = keyed(docs)
    found = repeated_windows(rows, window).dropDuplicates(["_id", "_key"])
    return rows.join(found, ["_id", "_key"], "left")


def substring_digest(docs: DataFrame, window: int = 50) -> DataFrame:
    """Per document what is left without word windows that smaller ids have too.

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller id; windows are judged on the input. Returns doc_id,
    n_words, n_removed, kept_sha256 (kept words joined by one space). Null and
    empty texts have no words. Rows without an id come last in the order, repeated
    rows of one id leave each other alone, other columns are ignored, an empty
    table gives no rows.
    """

    def digest(batches):
        for batch, data, offs in slices(batches):
            metas, bits = batch.column("meta").to_pylist(), batch.column("bits").to_pylist()
            starts, ends, first, gone = _removal(data, offs, metas, bits, window)
            body = data.tobytes()
            shas, removed = [], np.add.reduceat(np.append(gone, False), first[:-1]) * (np.diff(first) > 0)
            for i in range(batch.num_rows):
                words = body[offs[i] : offs[i + 1]].split()
                if removed[i]:
                    words = [w for w, g in zip(words, gone[first[i] : first[i + 1]].tolist()) if not g]
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(shas, pa.string()),
                ],
                ["_id", "n_words", "n_removed", "kept_sha256"],
            )

    out = _joined(docs, window).mapInArrow(digest, "_id long, n_words long, n_removed long, kept_sha256 string")
    return out.select(real_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def cut_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` without the repeated words, all columns kept.

    A document that loses nothing keeps its text as it is, blanks included; in
    others each removed run goes with the blanks after it. A document of which
    nothing is left keeps its row with an empty text. ``n_chars``, where there is
    such a column, follows the new text. Null texts stay null.
    """

    def cut_texts(batch: pa.RecordBatch) -> list[bytes]:
        texts = []
        for part, data, offs in batch_slices(batch):
            metas, bits = part.column("meta").to_pylist(), part.column("bits").to_pylist()
            starts, ends, first, gone = _removal(data, offs, metas, bits, window)
            body = data.tobytes()
            for i in range(part.num_rows):
                a, b = first[i], first[i + 1]
                at, end = offs[i], offs[i + 1]
                edges = np.append(starts[a:b], end)
                keep = np.flatnonzero(np.diff(np.concatenate(([0], (~gone[a:b]).astype(np.int8), [0]))))
                head = body[at : edges[0]] if b > a and not gone[a] else b""
                texts.append(head + b"".join(body[edges[s] : edges[e]] for s, e in zip(keep[::2], keep[1::2])))
        return texts

    def cut(batches):
        for batch in batches:
            told = batch.column("bits").is_valid()
            texts = pa.array(cut_texts(batch.filter(told)), pa.binary()).cast(batch.column("text").type)
            new = pc.replace_with_mask(batch.column("text"), told, texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), new, told], [*names, "text", "_cut"])
        give_back()

    own, back = shielded(docs)
    names = [f"own{i}" for i, c in enumerate(docs.columns) if c != "text"]
    found = repeated_windows(keyed(docs), window).dropDuplicates(["_id", "_key"])
    # One join and one pass over whole rows: texts are shuffled once, copies of a row are cut alike.
    rows = own.select(*names, "_id", "_key", "text").join(found, ["_id", "_key"], "left")
    fields = [own.schema[c] for c in (*names, "text")]
    out = rows.select(*names, "text", "meta", "bits").mapInArrow(
        cut, T.StructType([*fields, T.StructField("_cut", T.BooleanType())])
    )
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_cut"), length).otherwise(F.col(f"own{docs.columns.index('n_chars')}"))
    return back(out, **changed)
