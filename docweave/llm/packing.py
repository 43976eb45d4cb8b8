"""Best-fit packing with exact complements.

The lengths of all pieces are counted: at most ``size`` numbers, whatever the
corpus. The plan is made on these counts. The largest length left looks up its
gap among single lengths, then among pairs, then among triples that fill it
exactly; what is found is used as often as its counts allow. Where nothing fits
exactly the largest length that fits goes in and the rest of the gap is looked up
again. A plan is a list of patterns with a number of uses, each of which uses up
a length, so it has no more patterns than there are lengths. Pieces are numbered
within their length, and the number alone says which sequence and place a piece
gets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from docweave.llm.tables import keyed, real_id
from docweave.llm.tokens import encoded
from docweave.session import cut_lineage

PIECE_SCHEMA = "_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, size: int) -> DataFrame:
    """Pieces of at most ``size`` tokens of keyed documents."""

    def pieces(batches):
        for batch, ids, upto in encoded(batches):
            counts = np.diff(upto, prepend=0)
            each = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), each)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
            start = piece * size
            length = np.minimum(counts[doc] - start, size)
            body, at = ids.astype("<u4").tobytes(), (upto - counts)[doc] + start
            crc = [zlib.crc32(body[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.mapInArrow(pieces, PIECE_SCHEMA)


class _Stock:
    """Lengths left, and exact fillings of a gap from them."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.size = len(counts) - 1
        self.no_pair = np.zeros(len(counts), bool)  # stocks only shrink: what fails once fails for good
        self.no_triple = np.zeros(len(counts), bool)

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """The pair of lengths with that sum of which most can be had."""
        if gap < 2 or self.no_pair[gap]:
            return None
        a = np.arange(1, gap // 2 + 1)
        have = np.minimum(self.left[a], self.left[gap - a])
        have[a * 2 == gap] //= 2
        best = int(have.argmax())
        if have[best]:
            return gap - int(a[best]), int(a[best])
        self.no_pair[gap] = True
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        if self.left[gap]:
            return (gap,)
        if found := self.pair(gap):
            return found
        if not self.no_triple[gap]:
            for c in np.flatnonzero(self.left[1 : gap // 3 + 1]) + 1:
                self.left[c] -= 1
                found = self.pair_with(gap - int(c))
                self.left[c] += 1
                if found:
                    return (*found, int(c))
            self.no_triple[gap] = True
        return None

    def pair_with(self, gap: int) -> tuple[int, ...] | None:
        """As ``pair``, while one length is held back: a failure says nothing for later."""
        known = self.no_pair[gap]
        found = self.pair(gap)
        self.no_pair[gap] = known
        return found

    def largest(self, gap: int) -> int:
        """The largest length that fits, 0 if none does."""
        fit = np.flatnonzero(self.left[: gap + 1])
        return int(fit[-1]) if len(fit) else 0


def plan(counts: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """(uses, {length: times}) for all pieces; counts[n] pieces have length n."""
    stock, out = _Stock(counts), []
    for length in range(len(counts) - 1, 0, -1):
        while stock.left[length]:
            chosen, gap = [length], stock.size - length
            stock.left[length] -= 1
            while gap:
                more = stock.exact(gap) or ((n,) if (n := stock.largest(gap)) else ())
                if not more:
                    break
                for n in more:
                    stock.left[n] -= 1
                    gap -= n
                chosen += more
            times = {n: chosen.count(n) for n in dict.fromkeys(chosen)}
            for n, k in times.items():
                stock.left[n] += k
            uses = min(int(stock.left[n]) // k for n, k in times.items())
            for n, k in times.items():
                stock.left[n] -= k * uses
            out.append((uses, times))
    return out


def slots(patterns: list[tuple[int, dict[int, int]]], size: int):
    """Sorted arrays that turn (length, number) into a sequence and an offset."""
    used, rows, sequence = np.zeros(size + 1, np.int64), [], 0
    for uses, times in patterns:
        offset = 0
        for n, k in times.items():
            rows.append((n, used[n], sequence, offset, k))
            used[n] += k * uses
            offset += n * k
        sequence += uses
    table = np.array(rows, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def numbered(pieces: DataFrame, total: int) -> DataFrame:
    """Pieces with their number (from 0) within their length; a hot length is split by hash."""
    salts = max(16, total // 100_000)
    split = pieces.withColumn("_salt", F.pmod(F.xxhash64("_id", "piece", "ids_crc32"), F.lit(salts)))
    group = split.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    group = group.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("length", "_salt").orderBy("_id", "piece", "ids_crc32"))
    return (
        split.withColumn("_inside", inside)
        .join(group, ["length", "_salt"])
        .withColumn("number", F.col("_inside") + F.col("_before") - 1)
        .drop("_salt", "_inside", "_before")
    )


def pack_documents(docs: DataFrame, size: int = 4096) -> DataFrame:
    """Sequences of at most ``size`` tokens that hold every document of (doc_id, text).

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Only documents longer than ``size`` are cut. Null and empty texts are
    one end token. Repeated rows are packed as often as they occur, rows without
    an id too; other columns are ignored; an empty table gives no rows.
    """
    pieces = cut_lineage(cut_pieces(keyed(docs), size), "pieces")
    counts = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``size`` rows
        counts[row.length] = row.n
    table = slots(plan(counts), size)
    wide = int(counts.max()) + 1
    starts = table[:, 0] * wide + table[:, 1]

    def placed(batches):
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            _, low, sequence, offset, times = table[np.searchsorted(starts, length * wide + number, side="right") - 1].T
            nth = number - low
            keep = [batch.column(c) for c in ("_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence + nth // times), pa.array(offset + nth % times * length)],
                ["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    out = numbered(pieces, int(counts.sum())).mapInArrow(placed, f"{PIECE_SCHEMA}, sequence_id long, offset long")
    return out.select(real_id().alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
