"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every word pair of the test items is a seed, however frequent it is in the
documents. A fixed-size bit table of all seeds tells each reading task which
places of a text matter, so only these leave it. Edits that still let a copy reach
the threshold leave a least number of an item's pairs whole; a copy has half of
that number at least among the rarer ones. Stretches that hold as many are aligned, allowing for changed, missing and added words, which scores
how much of the item they repeat. Where no pair need be whole, single words count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from docweave.llm.tables import fill, keyed, real_id, shielded
from docweave.llm.texts import BYTE_CODE, prefix_sums, slices, span_hash, window_hashes, word_spans
from docweave.session import cut_lineage

SEED_WORDS = 2
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of an item's best possible score from which a passage counts as a copy.
THRESHOLD = 0.6
TABLE_BITS = 1 << 22

WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _words(data: np.ndarray, offs: np.ndarray):
    """Hashes of words without punctuation, and where each text's begin."""
    starts, ends, first = word_spans(data, offs, WORD)
    return span_hash(prefix_sums(BYTE_CODE[data]), starts, ends), first


def _grams(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of all n-grams that lie within a text."""
    inside = np.ones(max(len(words) - size + 1, 0), bool)
    for k in range(1, size):
        cut = first[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    at = np.flatnonzero(inside)
    return at, window_hashes(words, at, size) if len(at) else np.empty(0, np.uint64)


def longest_copy(n: int, threshold: float) -> int:
    """Most words a copy of ``n`` words can span: all of them, and added words until the score is at ``threshold``."""
    return n + int(MATCH * n * (1 - threshold) / -GAP + 1e-9)


def least_seeds(n: int, threshold: float) -> tuple[int, int]:
    """(size, need): a copy of ``n`` words that reaches ``threshold`` has ``need`` of its seeds of ``size`` words.

    Of the n - 1 pairs an added word parts one and costs 1, a changed or missing
    word two and costs 3, a word left out at an end one and costs 2. So no more
    pairs are lost than the score may lose. Single words: each gives MATCH at most.
    """
    pairs = n - 1 - (longest_copy(n, threshold) - n)
    return (SEED_WORDS, pairs) if pairs > 0 else (1, max(int(np.ceil(threshold * n - 1e-9)), 1))


def item_words(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, words, seeds, times, size, need, span): word hashes of each test item and its seeds.

    ``times``: how often the item has each seed; ``size``: words of a seed;
    ``need``: seeds of a copy at least; ``span``: words of a copy at most.
    """

    def read(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(batches):
            words, first = _words(data, offs)
            bodies, seeds, times, bounds = [], [], [], []
            for a, b in zip(first[:-1], first[1:]):
                own = words[a:b]
                size, need = least_seeds(len(own), threshold)
                seed, n = np.unique(_grams(own, np.array([0, len(own)]), size)[1], return_counts=True)
                bodies.append(own.tobytes())
                seeds.append(seed.view(np.int64))
                times.append(n)
                bounds.append((size, need, longest_copy(len(own), threshold)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id"),
                    pa.array(bodies, pa.binary()),
                    pa.array(seeds, pa.list_(pa.int64())),
                    pa.array(times, pa.list_(pa.int64())),
                    *(pa.array(c, pa.int64()) for c in zip(*bounds)),
                ],
                ["item_id", "words", "seeds", "times", "size", "need", "span"],
            )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).filter("item_id is not null and text is not null")
    schema = "item_id long, words binary, seeds array<long>, times array<long>, size long, need long, span long"
    return rows.mapInArrow(read, schema).filter("length(words) > 0")


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    """The three places of a hash in the bit table."""
    return [(hashes >> np.uint64(shift)).astype(np.int64) & (TABLE_BITS - 1) for shift in (42, 20, 0)]


def bit_table(grams: DataFrame) -> np.ndarray:
    """Bits of all hashes in column seed in a table of fixed size; three bits each."""
    slots = F.array(*(F.shiftright("seed", k).bitwiseAND(F.lit(TABLE_BITS - 1)) for k in (42, 20, 0)))
    each = grams.select(F.explode(slots).alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
    rows = each.agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).collect()
    table = np.zeros(TABLE_BITS // 64, np.int64)
    for r in rows:  # at most TABLE_BITS / 64 rows
        table[r.word] = r.bits
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def _marked(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes may be in a bit table."""
    hit = np.ones(len(hashes), bool)
    for slot in _slots(hashes):
        hit &= bits[slot]
    return hit


def seed_places(docs: DataFrame, table: np.ndarray, sizes: list[int]) -> DataFrame:
    """(_id, _key, place, seed): words of keyed texts at which a seed of the items begins."""
    packed = np.packbits(table)

    def read(batches: Iterator[pa.RecordBatch]):
        bits = np.unpackbits(packed).astype(bool)
        for batch, data, offs in slices(batches):
            words, first = _words(data, offs)
            for size in sizes:
                at, grams = _grams(words, first, size)
                hit = _marked(grams, bits)
                at, grams = at[hit], grams[hit]
                owner = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(pa.array(owner)),
                        batch.column("_key").take(pa.array(owner)),
                        pa.array(at - first[owner], pa.int64()),
                        pa.array(grams.view(np.int64), pa.int64()),
                    ],
                    ["_id", "_key", "place", "seed"],
                )

    docs = docs.withColumn("text", F.lower("text"))
    return docs.mapInArrow(read, "_id long, _key long, place long, seed long")


def seed_counts(docs: DataFrame, table: np.ndarray, sizes: list[int]) -> DataFrame:
    """(seed, n): how often each seed of the items stands in keyed texts, in all of them.

    Counted in the task first, so a seed travels once for each slice of documents.
    """
    packed = np.packbits(table)

    def read(batches: Iterator[pa.RecordBatch]):
        bits = np.unpackbits(packed).astype(bool)
        for _, data, offs in slices(batches):
            words, first = _words(data, offs)
            for size in sizes:
                grams = _grams(words, first, size)[1]
                seed, n = np.unique(grams[_marked(grams, bits)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(n, pa.int64())], ["seed", "n"])

    counts = docs.select(F.lower("text").alias("text")).mapInArrow(read, "seed long, n long")
    return counts.groupBy("seed").agg(F.sum("n").alias("n"))


def marked_texts(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """(_id, _key, words): word hashes of the keyed texts whose key may be in the bit table."""
    packed = np.packbits(table)

    def read(batches: Iterator[pa.RecordBatch]):
        bits = np.unpackbits(packed).astype(bool)
        for batch in batches:
            hit = _marked(np.asarray(batch.column("_key")).view(np.uint64), bits)
            for part, data, offs in slices([batch.filter(pa.array(hit))]):
                words, first = _words(data, offs)
                bodies = [words[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_key"), pa.array(bodies, pa.binary())],
                    ["_id", "_key", "words"],
                )

    docs = docs.withColumn("text", F.lower("text"))
    return docs.mapInArrow(read, "_id long, _key long, words binary")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and the passage's words it spans.

    Smith-Waterman with linear gap costs, a row of the matrix at a time: within a
    row the gaps are a running maximum.
    """
    n = len(passage)
    slope = GAP * np.arange(n + 1)
    row, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        down = np.concatenate(([0], np.maximum(np.maximum(diagonal, above), 0)))
        start = np.concatenate(([0], np.where(diagonal >= above, origin[:-1], origin[1:])))
        start = np.where(down > 0, start, np.arange(n + 1))
        lifted = down - slope
        source = np.maximum.accumulate(np.where(lifted >= np.maximum.accumulate(lifted), np.arange(n + 1), 0))
        row, origin = down[source] - slope[source] + slope, start[source]
        end = int(row.argmax())
        if row[end] > best[0]:
            best = (int(row[end]), int(origin[end]), end)
    return best


def rare_seeds(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``grams`` without the commonest seeds of each item, ``need`` less by as many.

    A copy has ``need`` seeds of its item. Where seeds that stand in the item k times
    are left aside, it still has ``need`` - k of the others: at most half of ``need``
    is left aside, so nothing is lost whichever seeds these are.
    """
    grams = grams.join(counts, "seed", "left").withColumn("half", F.expr("need div 2"))
    own = W.partitionBy("item_id", "version", "need", "span")
    order = own.orderBy(F.col("times") > F.col("half"), F.coalesce("n", F.lit(0)).desc(), "seed")
    grams = grams.withColumn("upto", F.sum("times").over(order.rowsBetween(W.unboundedPreceding, 0)))
    aside = F.when(F.col("upto") <= F.col("half"), F.col("upto")).otherwise(0)
    grams = grams.withColumn("need", F.col("need") - F.max(aside).over(own)).filter("upto > half")
    return grams.select("item_id", "version", "need", "span", "seed", "times")


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(_id, _key, item_id, score, start_word, end_word) of keyed ``docs`` that repeat an item."""
    items = item_words(items.dropDuplicates(["item_id", "text"]), threshold).withColumn("version", F.xxhash64("words"))
    items = cut_lineage(items, "items")
    grams = items.select("item_id", "version", "need", "span", F.explode(F.arrays_zip("seeds", "times")).alias("each"))
    grams = grams.select("item_id", "version", "need", "span", F.col("each.seeds").alias("seed"), F.col("each.times").alias("times"))
    sizes = items.agg(F.min("size"), F.max("size")).first()
    sizes = list(range(sizes[0] or 1, (sizes[1] or 0) + 1))
    # Which seeds are common decides on the work only; all documents are counted.
    grams = cut_lineage(rare_seeds(grams, seed_counts(docs, bit_table(grams), sizes)), "seeds")
    places = seed_places(docs, bit_table(grams), sizes)
    # Windows of two spans that begin at each multiple of the span: a copy lies within one of them.
    slot = F.expr("place div span")
    met = places.join(grams, "seed").withColumn("at", F.explode(F.array(slot, slot - 1))).filter("at >= 0")
    window = ["_id", "_key", "item_id", "version", "need", "span", "at"]
    met = met.groupBy(*window, "seed", "times").agg(F.count(F.lit(1)).alias("n"))
    near = met.groupBy(*window).agg(F.sum(F.least("n", "times")).alias("n")).filter("n >= need")
    near = near.select("_id", "_key", "item_id", "version", "span", (F.col("at") * F.col("span")).alias("passage"))
    near = cut_lineage(near, "near")
    texts = marked_texts(docs, bit_table(near.select(F.col("_key").alias("seed")).distinct())).dropDuplicates(["_id", "_key"])
    part = F.expr("substring(words, cast(8 * passage + 1 as int), cast(16 * span as int))").alias("words")
    pairs = near.join(texts, ["_id", "_key"]).select("_id", "_key", "item_id", "version", "passage", part)
    pairs = pairs.join(items.select("item_id", "version", F.col("words").alias("item")), ["item_id", "version"])

    def scored(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for words, item, at in zip(*(batch.column(c).to_pylist() for c in ("words", "item", "passage"))):
                item, words = np.frombuffer(item, np.uint64), np.frombuffer(words, np.uint64)
                # What both have in common bounds the score.
                bound = np.isin(item, words).sum() / len(item)
                score, start, end = align(item, words) if bound >= threshold else (0, 0, 0)
                out.append((score / (MATCH * len(item)), at + start, at + end))
            score, start, end = (np.array(c) for c in zip(*out)) if out else (np.empty(0), np.empty(0, int), np.empty(0, int))
            keep = [batch.column(c) for c in ("_id", "_key", "item_id")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                ["_id", "_key", "item_id", "score", "start_word", "end_word"],
            )

    schema = "_id long, _key long, item_id long, score double, start_word long, end_word long"
    pairs = pairs.repartition(fill(docs), "_id", "_key", "item_id", "passage")
    scores = pairs.mapInArrow(scored, schema).filter(F.col("score") >= threshold)
    best = F.max(F.struct("score", (-F.col("start_word")).alias("neg"), "end_word")).alias("best")
    scores = scores.groupBy("_id", "_key", "item_id").agg(best)
    return scores.select("_id", "_key", "item_id", "best.score", (-F.col("best.neg")).alias("start_word"), "best.end_word")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): documents that repeat a test item.

    One row per document and item whose best alignment reaches ``threshold`` of
    the item's own score; words are counted without punctuation. Null and empty
    texts repeat nothing; items without id, text or words are left out; repeated
    rows give one row; other columns are ignored; empty tables give no rows.
    """
    found = leaks(keyed(docs), items, threshold)
    return found.select(real_id().alias("doc_id"), "item_id", "score", "start_word", "end_word")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that repeat a test item; columns as they are."""
    bad = leaks(keyed(docs), items, threshold).select("_id", "_key").distinct()
    own, back = shielded(docs)
    return back(own.join(bad, ["_id", "_key"], "left_anti"))
