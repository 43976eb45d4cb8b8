"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

One code is made from the counts of all ids. A block holds whole documents in
order of their ids; its bits can be decoded without any other block, and from
any of its checkpoints (bit offsets, one per ``EVERY`` ids) without what stands
before. The decoder looks up the next 16 (or more, for larger vocabularies) bits
in one table and follows all checkpoints of a block at the same time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from docweave.llm.tables import drop_table, fill, keyed, real_id
from docweave.llm.texts import give_back
from docweave.llm.tokens import encoded
from docweave.session import cut_lineage, new_path

EVERY = 128
BLOCK_IDS = 1 << 19

FILE_SCHEMA = (
    "part long, block long, first_id long, first_key long, n_ids long, docs binary, counts binary, "
    "lengths binary, bits binary, checkpoints binary"
)


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Lengths of the best prefix code with no code longer than ``limit`` bits.

    Package-merge. Ids that never occur get length 0; a single id gets 1. The
    limit grows where the number of ids needs it.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    by = used[np.argsort(counts[used], kind="stable")]
    weights = counts[by].astype(np.float64)
    level, packaged = weights, []
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        packaged.append(order >= len(weights))
        level = both[order]
    take, depth = 2 * (len(by) - 1), np.zeros(len(by), np.int64)
    for is_pair in reversed(packaged):
        pairs = int(is_pair[:take].sum())
        depth[: take - pairs] += 1
        take = 2 * pairs
    depth[:take] += 1
    lengths[by] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    if len(order):
        longest = int(lengths.max())
        room = np.uint64(1) << (np.uint64(longest) - lengths[order].astype(np.uint64))
        codes[order] = (np.cumsum(room) - room) >> (np.uint64(longest) - lengths[order].astype(np.uint64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and length for every value of the next ``width`` bits."""
    width = int(lengths.max()) if len(lengths) else 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    ids = np.repeat(order, 1 << (width - lengths[order].astype(np.int64)))
    ids = np.append(ids, np.zeros((1 << width) - len(ids), ids.dtype))
    return ids.astype(np.uint32), lengths[ids].astype(np.int64), width


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of ``ids`` (first bit highest) and the bit offset of every ``EVERY``-th id."""
    size = lengths[ids].astype(np.int64)
    upto = np.cumsum(size)
    at = upto - size
    words = np.zeros((int(upto[-1]) if len(ids) else 0) // 64 + 2, np.uint64)
    if len(ids):
        code, word, shift = codes[ids], at >> 6, 64 - (at & 63) - size
        over = shift < 0  # the code ends in the next word
        head = np.where(over, code >> np.maximum(-shift, 0).astype(np.uint64), code << np.maximum(shift, 0).astype(np.uint64))
        used, first = np.unique(word, return_index=True)
        words[used] = np.add.reduceat(head, first)
        words[word[over] + 1] += code[over] << (64 + shift[over]).astype(np.uint64)
    return words.byteswap().tobytes(), at[::EVERY]


def unpack(bits: bytes, checkpoints: np.ndarray, n: int, table) -> np.ndarray:
    """The ids of a block, all its checkpoints decoded side by side."""
    ids, sizes, width = table
    words = np.frombuffer(bits, np.uint64).byteswap()
    out = np.empty((len(checkpoints), EVERY), np.uint32)
    at, last = checkpoints.copy(), len(words) * 64 - 64
    for step in range(EVERY):
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        next_bits = (words[word] << shift) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - shift))
        value = (next_bits >> np.uint64(64 - width)).astype(np.int64)
        out[:, step] = ids[value]
        at = np.minimum(at + sizes[value], last - 1)
    return out.reshape(-1)[:n]


def document_ids(docs: DataFrame) -> DataFrame:
    """(_id, _key, width, raw): the ids of each keyed document, encoded where its text is read."""

    def encode(batches: Iterator[pa.RecordBatch]):
        for batch, ids, upto in encoded(batches):
            raw, width = ids.tobytes(), ids.itemsize
            ends = (upto * width).tolist()
            body = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
            width = pa.array(np.full(batch.num_rows, width, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"), width, pa.array(body, pa.binary())], ["_id", "_key", "width", "raw"]
            )

    return docs.mapInArrow(encode, "_id long, _key long, width long, raw binary")


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.dtype(f"u{width}"))


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def id_counts(rows: DataFrame) -> np.ndarray:
    """How often each token id occurs in all documents."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            widths = batch.column("width").to_numpy()
            raw = batch.column("raw").to_pylist()
            for width in np.unique(widths).tolist():
                body = b"".join(r for r, w in zip(raw, widths.tolist()) if w == width)
                more = np.bincount(_ids(body, width), minlength=len(total))
                more[: len(total)] += total
                total = more
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    each = rows.select("width", "raw").mapInArrow(count, "id long, n long")
    found = each.groupBy("id").agg(F.sum("n").alias("n")).collect()  # no more than the vocabulary has
    out = np.zeros(max([r.id for r in found], default=0) + 1, np.int64)
    for r in found:
        out[r.id] = r.n
    return out


def write_ids(docs: DataFrame, path: str) -> None:
    """Write the ids of all documents (doc_id, text) to ``path``, by ascending id.

    Texts are encoded once, where they are read; what is counted, dealt out by
    ranges of ids and coded are the token ids.
    """
    rows = cut_lineage(document_ids(keyed(docs)), "token-ids")
    lengths = code_lengths(id_counts(rows))

    def blocks(batches: Iterator[pa.RecordBatch]):
        codes = canonical_codes(lengths)
        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def built():
            doc, key, ids = zip(*held)
            counts = np.array([len(i) for i in ids], np.int64)
            flat = np.concatenate(ids)
            bits, checkpoints = pack(flat, lengths, codes)
            values = [
                part, block, doc[0], key[0], len(flat), np.array(doc, np.int64).tobytes(), counts.tobytes(),
                lengths.tobytes(), bits, checkpoints.astype(np.int64).tobytes(),
            ]
            kinds = [pa.binary() if isinstance(v, bytes) else pa.int64() for v in values]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], _names(FILE_SCHEMA))

        for batch in batches:
            for doc, key, width, raw in zip(*(batch.column(c).to_pylist() for c in ("_id", "_key", "width", "raw"))):
                ids = _ids(raw, width)
                if held and size + len(ids) > BLOCK_IDS:
                    yield built()
                    block, held, size = block + 1, [], 0
                held.append((doc, key, ids))
                size += len(ids)
        if held:
            yield built()
        give_back()

    ordered = rows.repartitionByRange(fill(docs), "_id", "_key").sortWithinPartitions("_id", "_key")
    ordered.mapInArrow(blocks, FILE_SCHEMA).write.parquet(path)
    drop_table(rows)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    ``start``: ids of all documents before it.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select("part", "block", "first_id", "first_key", "n_ids")
    parts = sizes.groupBy("part").agg(F.min(F.struct("first_id", "first_key")).alias("head"), F.sum("n_ids").alias("n"))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("head")), F.lit(0)).alias("_part_start"))
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("block")), F.lit(0))
    starts = sizes.withColumn("_inside", inside).join(parts, "part")
    starts = starts.select("part", "block", (F.col("_inside") + F.col("_part_start")).alias("start"))

    def decoded(batches):
        table = None
        for batch in batches:
            columns = ("part", "block", "n_ids", "lengths", "docs", "counts", "bits", "checkpoints")
            for part, block, n, lengths, docs, counts, bits, checkpoints in zip(*(batch.column(c).to_pylist() for c in columns)):
                if table is None or table[0] != lengths:
                    table = (lengths, decode_table(np.frombuffer(lengths, np.uint8)))
                ids = unpack(bits, np.frombuffer(checkpoints, np.int64), n, table[1])
                counts = np.frombuffer(counts, np.int64)
                ends = np.cumsum(counts)
                body = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(body[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                same = np.ones(len(counts), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (part * same, block * same, np.frombuffer(docs, np.int64), ends - counts, counts)]
                    + [pa.array(crc, pa.int64())],
                    ["part", "block", "_id", "_at", "n_tokens", "ids_crc32"],
                )

    digest = files.mapInArrow(decoded, "part long, block long, _id long, _at long, n_tokens long, ids_crc32 long")
    return digest.join(starts, ["part", "block"]).select(
        real_id().alias("doc_id"), (F.col("start") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame) -> DataFrame:
    """Write the ids of ``docs`` to the shared folder and give the digest read back.

    Null and empty texts have the end id alone. Rows without an id are written
    last, repeated rows one after the other; other columns are ignored; an empty
    table gives no rows.
    """
    path = new_path(docs.sparkSession, "token-ids")
    write_ids(docs, path)
    return read_ids(docs.sparkSession, path)
