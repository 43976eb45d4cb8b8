"""Which 64-bit keys occur more than once, over any number of documents.

Keys travel as packed arrays, not as rows: a chunk of documents sends each of
its distinct keys once to the bucket of that key, the bucket answers with one
bit per key and chunk, and the chunk gives the bits back to its documents. A key
that a third of all documents hold costs one entry per chunk, so no bucket and
no document is hot, and nothing is answered per pair of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docweave.llm.tables import drop_table, fill
from docweave.session import cut_lineage

CHUNK_KEYS = 1 << 18
BUCKET_KEYS = 1 << 18
# A filter looks at so many leading bits of a key.
FILTER_BITS = 48

CHUNK_SCHEMA = "chunk long, n long, ids binary, rows binary, counts binary, metas array<binary>, keys binary, more binary, place binary"
PACKED_SCHEMA = "_id long, _key long, meta binary, keys binary"
ANSWER_SCHEMA = "_id long, _key long, meta binary, bits binary"


def packed_rows(batch, metas: list[bytes], keys: list[np.ndarray], at=None) -> pa.RecordBatch:
    """A batch of PACKED_SCHEMA for the rows ``at`` of a batch of keyed documents."""
    take = (lambda c: batch.column(c)) if at is None else (lambda c: batch.column(c).take(pa.array(at)))
    return pa.RecordBatch.from_arrays(
        [take("_id"), take("_key"), pa.array(metas, pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary())],
        ["_id", "_key", "meta", "keys"],
    )


def _planes(values: np.ndarray) -> bytes:
    """Values byte by byte: equal leading bytes stand together and compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplanes(body: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _steps(ordered: np.ndarray) -> bytes:
    return _planes(np.diff(ordered, prepend=np.uint64(0)))


def _unsteps(body: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(body, np.uint64), dtype=np.uint64)


def unpacked(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order of 64-bit keys (then of further ones) by multikey quicksort with 16-bit digits.

    The keys are parted by their first digit; only parts that are still tied are
    ordered by the next one. All tied parts of one level are handled together.
    """
    order = np.arange(len(keys[0]))
    part = np.zeros(len(order), np.int64)
    tied = order.copy()  # places whose part has more than one key
    for key in keys:
        for shift in (48, 32, 16, 0):
            if not len(tied):
                return order
            digit = ((key[order[tied]] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)
            level = (part[tied] << 16) | digit
            by = np.argsort(level, kind="stable")
            order[tied], level = order[tied][by], level[by]
            new = np.ones(len(tied), bool)
            new[1:] = level[1:] != level[:-1]
            part[tied] = np.cumsum(new)
            tied = tied[~(new & np.append(new[1:], True))]
    return order


def census(
    rows: DataFrame,
    rule: str,
    exact: bool = True,
    splitters: str = "hash",
    values: bool = False,
    make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """Answers for the packed keys of ``rows`` (_id, _key, meta, keys).

    With ``make`` they are made of batches of ``rows`` in the pass that puts them into
    chunks: a task then holds one Python worker instead of two.

    ``keys`` is an array of unsigned 64-bit hashes. The result has a row (_id,
    _key, meta, bits) for each row with a set bit; ``bits`` is packed, a bit per
    key, or with ``values`` the keys themselves that have one. ``rule``:
    ``twice``, the key occurs at least twice over all rows; ``earlier``, a row
    with a smaller _id has it. With ``exact=False`` only the leading 48 bits
    count: a cheaper filter that may let a few single keys pass but never loses a
    repeated one. Buckets are ranges of keys: even ones for hashes, or between
    ``sampled`` splitters, where each range orders its keys by multikey quicksort
    and compares neighbours. Equal keys never stand in two ranges.
    The result is stored in the shared folder.
    """
    drop = np.uint64(0 if exact else 64 - FILTER_BITS)
    width = 64 if exact else FILTER_BITS

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def packed():
            ids, row_keys, metas, bodies = zip(*held)
            if rule == "pairs":
                counts = np.array([len(k) // 16 for k in bodies], np.int64)
                both = [np.frombuffer(k, np.uint64).reshape(2, -1) for k in bodies]
                keys, second = (np.concatenate([b[i] for b in both]) for i in (0, 1))
                order = np.lexsort((second, keys))
            else:
                counts = np.array([len(k) // 8 for k in bodies], np.int64)
                keys = second = np.frombuffer(b"".join(bodies), np.uint64) >> drop
                order = np.argsort(keys, kind="stable")
            new = np.ones(len(keys), bool)
            new[1:] = (keys[order][1:] != keys[order][:-1]) | (second[order][1:] != second[order][:-1])
            begin = np.flatnonzero(new)
            place = np.empty(len(keys), np.uint32)
            place[order] = np.cumsum(new) - 1
            if rule == "earlier":
                each = np.repeat(np.array(ids, np.int64), counts)
                more = _planes(np.minimum.reduceat(each[order], begin)) if len(begin) else b""
            else:
                more = np.packbits(np.diff(np.append(begin, len(keys))) > 1).tobytes()
                if rule == "pairs":
                    more = _planes(second[order][begin]) + more
            values = [
                first + n, len(begin), np.array(ids, np.int64).tobytes(), np.array(row_keys, np.int64).tobytes(),
                counts.tobytes(), list(metas), _steps(keys[order][begin]), more, _planes(place),
            ]
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.list_(pa.binary()), *[pa.binary()] * 3]
            names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in make(batches) if make else batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("_id", "_key", "meta", "keys"))):
                if held and size + len(row[3]) // 8 > CHUNK_KEYS:
                    yield packed()
                    n, held, size = n + 1, [], 0
                held.append(row)
                size += len(row[3]) // 8
        if held:
            yield packed()

    chunks = cut_lineage(rows.mapInArrow(chunked, CHUNK_SCHEMA), "chunks")
    total = chunks.agg(F.sum("n")).first()[0] or 0
    buckets = max(fill(rows), -(-total // BUCKET_KEYS))
    if splitters == "sampled":
        bounds = _splitters(chunks, buckets)
    else:
        bounds = np.array([(i << width) // buckets for i in range(1, buckets)], np.uint64)

    def route(batches):
        for batch in batches:
            for chunk, n, keys, more in zip(*(batch.column(c).to_pylist() for c in ("chunk", "n", "keys", "more"))):
                keys = _unsteps(keys)
                cuts = np.concatenate(([0], np.searchsorted(keys, bounds), [n]))
                used = np.flatnonzero(np.diff(cuts))
                if rule == "earlier":
                    low = _unplanes(more, np.int64)
                    extra = [_planes(low[cuts[u] : cuts[u + 1]]) for u in used]
                else:
                    head = 8 * n if rule == "pairs" else 0
                    seen = unpacked(more[head:], n)
                    extra = [np.packbits(seen[cuts[u] : cuts[u + 1]]).tobytes() for u in used]
                    if head:
                        second = _unplanes(more[:head], np.uint64)
                        extra = [_planes(second[cuts[u] : cuts[u + 1]]) + e for u, e in zip(used, extra)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int64()),
                        pa.array([chunk] * len(used), pa.int64()),
                        pa.array([_steps(keys[cuts[u] : cuts[u + 1]]) for u in used], pa.binary()),
                        pa.array(extra, pa.binary()),
                    ],
                    ["bucket", "chunk", "keys", "more"],
                )

    def answer(table: pa.Table) -> pa.Table:
        parts = [_unsteps(k) for k in table.column("keys").to_pylist()]
        keys, sizes = np.concatenate(parts), [len(p) for p in parts]
        more, upto = table.column("more").to_pylist(), np.cumsum(sizes)[:-1]
        order = multikey_order(keys) if splitters == "sampled" else np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        if rule == "pairs":
            second = np.concatenate([_unplanes(m[: 8 * n], np.uint64) for m, n in zip(more, sizes)])
            more = [m[8 * n :] for m, n in zip(more, sizes)]
            order = multikey_order(keys, second) if splitters == "sampled" else np.lexsort((second, keys))
            new_first = np.append(True, keys[order][1:] != keys[order][:-1])
            new[1:] = new_first[1:] | (second[order][1:] != second[order][:-1])
            # Keys that stand beside more than one second key.
            which = np.cumsum(new_first) - 1
            several = np.bincount(which, new) > 1
            other = np.empty(len(keys), bool)
            other[order] = several[which]
        else:
            new[1:] = keys[order][1:] != keys[order][:-1]
        begin, group = np.flatnonzero(new), np.cumsum(new) - 1
        if rule == "earlier":
            low = np.concatenate([_unplanes(m, np.int64) for m in more])
            least = np.empty(len(keys), np.int64)
            least[order] = np.minimum.reduceat(low[order], begin)[group]
            # A chunk knows its own least id: only a smaller one is told.
            bits = [
                np.packbits(o).tobytes() + v[o].tobytes()
                for o, v in zip(np.split(least < low, upto), np.split(least, upto))
            ]
        else:
            seen = np.concatenate([unpacked(m, n) for m, n in zip(more, sizes)])
            held = np.diff(np.append(begin, len(keys))) + np.maximum.reduceat(seen[order].astype(np.int64), begin) > 1
            out = np.empty(len(keys), bool)
            out[order] = held[group]
            bits = [np.packbits(x).tobytes() for x in np.split(out, upto)]
            if rule == "pairs":
                bits = [b + np.packbits(x).tobytes() for b, x in zip(bits, np.split(other, upto))]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "bucket": table.column("bucket"),
                "size": pa.array(sizes, pa.int64()),
                "bits": pa.array(bits, pa.binary()),
            }
        )

    def give_back(batches):
        for batch in batches:
            columns = ("n", "ids", "rows", "counts", "metas", "place", "answers")
            all_keys = batch.column("keys").to_pylist() if values else [None] * batch.num_rows
            for (n, ids, row_keys, counts, metas, place, answers), keys in zip(
                zip(*(batch.column(c).to_pylist() for c in columns)), all_keys
            ):
                counts, place = np.frombuffer(counts, np.int64), _unplanes(place, np.uint32)
                ids, row_keys = np.frombuffer(ids, np.int64), np.frombuffer(row_keys, np.int64)
                each = np.repeat(ids, counts)
                verdict, beside, at = np.zeros(n, bool), np.zeros(n, bool), 0
                lowest = np.full(n, np.iinfo(np.int64).max)
                if rule == "earlier":
                    np.minimum.at(lowest, place, each)
                for a in sorted(answers or (), key=lambda a: a["bucket"]):
                    got = unpacked(a["bits"], a["size"])
                    verdict[at : at + a["size"]] = got
                    if rule == "pairs":
                        beside[at : at + a["size"]] = unpacked(a["bits"][-(-a["size"] // 8) :], a["size"])
                    if rule == "earlier":
                        lowest[at : at + a["size"]][got] = np.frombuffer(a["bits"], np.int64, offset=-(-a["size"] // 8))
                    at += a["size"]
                flags = lowest[place] < each if rule == "earlier" else verdict[place]
                ends = np.cumsum(counts)
                more = beside[place]
                hits = np.concatenate(([0], np.cumsum(flags | more)))
                found = np.flatnonzero(hits[ends] > hits[ends - counts])
                spans = [slice(ends[i] - counts[i], ends[i]) for i in found]
                if values:
                    each_key = _unsteps(keys)[place]
                    bits = [each_key[s][flags[s]].tobytes() for s in spans]
                else:
                    bits = [np.packbits(flags[s]).tobytes() for s in spans]
                    if rule == "pairs":
                        bits = [b + np.packbits(more[s]).tobytes() for b, s in zip(bits, spans)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[found], pa.int64()),
                        pa.array(row_keys[found], pa.int64()),
                        pa.array([metas[i] for i in found], pa.binary()),
                        pa.array(bits, pa.binary()),
                    ],
                    ["_id", "_key", "meta", "bits"],
                )

    sent = chunks.select("chunk", "n", "keys", "more").mapInArrow(route, "bucket long, chunk long, keys binary, more binary")
    answers = (
        sent.groupBy("bucket")
        .applyInArrow(answer, "chunk long, bucket long, size long, bits binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("bucket", "size", "bits")).alias("answers"))
    )
    kept = chunks.select("chunk", "n", "ids", "rows", "counts", "metas", "place", *(["keys"] if values else []))
    found = cut_lineage(kept.join(answers, "chunk", "left").mapInArrow(give_back, ANSWER_SCHEMA), "answers")
    drop_table(chunks)  # the answers are stored: the keys are of no more use
    return found


def _splitters(chunks: DataFrame, buckets: int, sample: int = 100_000) -> np.ndarray:
    """Splitters at even ranks of a bounded sample of the distinct keys of chunks."""
    n = max(1, chunks.count())
    each = max(1, sample // n)

    def pick(batches):
        for batch in batches:
            for keys in batch.column("keys").to_pylist():
                keys = _unsteps(keys)
                step = max(1, len(keys) // each)
                yield pa.RecordBatch.from_arrays([pa.array([keys[step // 2 :: step].tobytes()], pa.binary())], ["sample"])

    some = chunks.filter(F.pmod(F.xxhash64("chunk"), F.lit(-(-n // sample))) == 0).select("keys")
    rows = some.mapInArrow(pick, "sample binary").collect()
    found = np.sort(np.concatenate([np.frombuffer(r[0], np.uint64) for r in rows] or [np.empty(0, np.uint64)]))
    return np.unique(found[(np.arange(1, buckets) * len(found)) // buckets]) if len(found) else found
