"""N-gram Jaccard join by parity sketches.

Every distinct shingle flips one bit of its document's sketch, so two sketches
differ in no more bits than the sets differ in shingles. Sets of a size band are
cut into the same blocks of hash space, one more than their allowed difference:
two linked sets agree in at least one whole block, and equal block sketches are
the join. What meets there is compared by whole sketches, and what passes by the
sets themselves.

Equal sets are one class from the start. Links between classes are never listed
pair by pair: each task returns a spanning forest of those it found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.census import census, packed_rows
from docweave.llm.components import components
from docweave.llm.tables import drop_table, fill, keyed, real_id, shielded
from docweave.llm.texts import BYTE_CODE, LOWER, give_back, mix, prefix_sums, ranges, slices, span_hash, word_spans
from docweave.session import cut_lineage

# Sets of one task when a group of candidates is too large for one.
TILE = 4096
# Pairs of sketches that are compared at once.
PAIRS = 1 << 13
# Bytes of sketches in a task, and sets in a task that compares sets.
CELL_BYTES = 8 << 20
SETS_PER_TASK = 1000
SET_SCHEMA = "_id long, _key long, n_shingles long, sid binary"


class Bands:
    """Size bands for a link threshold of ``percent``, and their block counts."""

    def __init__(self, percent: int = 85, ratio: float = 1.65):
        self.percent, self.ratio = percent, ratio
        # The least size at which sets may differ and still link.
        least = next(n for n in range(1, 10_000) if self.apart(n)) if percent < 100 else 1 << 40
        self.lows = [least]
        while self.lows[-1] < 1 << 40:
            self.lows.append(int(max(self.lows[-1] + 1, self.lows[-1] * ratio, self.lows[-1] * 100 / percent + 1)))
        self.at = np.array(self.lows, np.int64)

    def apart(self, n):
        """Most shingles by which two linked sets differ, the smaller of size n."""
        return (100 - self.percent) * n // self.percent

    def own(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, n, side="right") - 1

    def allowed(self, band: int) -> int:
        return self.apart(self.lows[band + 1] - 1)

    def blocks(self, band: int) -> int:
        """One more than may differ, and some for blocks that happen to be empty."""
        return self.allowed(band) + 3 + self.allowed(band) // 16

    def of(self, n: int) -> list[int]:
        """Bands in which a set of size n meets its partners."""
        own = int(self.own(np.array([n]))[0])
        if own < 0:
            return []
        smaller = -(-self.percent * n // 100)
        return [own - 1, own] if own and smaller < self.lows[own] else [own]


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ordered by text and hash, and where each text's begin.

    A text with fewer words than ``size`` has its words as one shingle.
    """
    low = LOWER[data]
    starts, ends, first = word_spans(data, offs)
    words = span_hash(prefix_sums(BYTE_CODE[low]), starts, ends)
    counts = np.diff(first)
    usable = np.where(counts >= size, counts - size + 1, counts > 0)
    text = np.repeat(np.arange(len(counts)), usable)
    begin = ranges(first[:-1], usable)
    end = np.minimum(begin + size, first[1:][text])
    hashes = span_hash(prefix_sums(words), begin, end)
    ends = np.cumsum(usable).tolist()
    for a, b in zip([0, *ends], ends):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(len(counts) + 1))


def set_ids(hashes: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """128-bit name of each set."""
    halves = []
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(salt)))))
        halves.append(mix((sums[begin[1:]] - sums[begin[:-1]]) + np.diff(begin).astype(np.uint64)))
    return [a.tobytes() + b.tobytes() for a, b in zip(*halves)]


def _used_blocks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of hash space that sorted hashes fall in, and where those of each begin."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    new = np.ones(len(block), bool)
    np.not_equal(block[1:], block[:-1], out=new[1:])
    first = new.nonzero()[0]
    return block[first].astype(np.int64), first


def sketch(hashes: np.ndarray, blocks: int, at: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Parity sketch of a set: a 64-bit word per block of hash space. ``at``: its used blocks, if known."""
    out = np.zeros(blocks, np.uint64)
    used, first = at or _used_blocks(hashes, blocks)
    out[used] = np.bitwise_xor.reduceat(np.uint64(1) << (hashes & np.uint64(63)), first)
    return out


def _folded(words: np.ndarray) -> np.ndarray:
    """Sketch words folded to 16 bits by parity; still at most one bit per shingle."""
    words = words ^ (words >> np.uint64(32))
    words = words ^ (words >> np.uint64(16))
    return words.astype(np.uint16)


def _block_keys(mixed: np.ndarray, at: tuple[np.ndarray, np.ndarray], blocks: int, band: int, allowed: int) -> np.ndarray:
    """Join keys of the blocks, the xor of all mixed hashes in each; empty ones only where too few others are left.

    A block that no difference falls in has the same shingles, so the same xor;
    the whole hashes keep blocks of few shingles apart, whose sketch words are
    often alike by chance.
    """
    used, first = at
    out = np.zeros(blocks, np.uint64)
    out[used] = np.bitwise_xor.reduceat(mixed, first)
    keys = mix(mix(out ^ np.uint64(band + 1 << 40)) + np.arange(blocks, dtype=np.uint64))
    return keys[used] if len(used) > allowed else keys


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which rows of sketches differ."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _close(sketches: np.ndarray, sizes: np.ndarray, one: int, others: np.ndarray, bands: Bands) -> np.ndarray:
    """Which of ``others`` may link with ``one`` by size and sketch.

    Most sets that only share a block differ too much in the first part of their
    sketches already; the rest is looked at for the others.
    """
    small, large = np.minimum(sizes[one], sizes[others]), np.maximum(sizes[one], sizes[others])
    sized = 100 * small >= bands.percent * large
    fit, most = others[sized], bands.apart(small[sized])
    part = -(-sketches.shape[1] // 3)
    far = _differing(sketches[fit, :part], sketches[one, :part])
    near = far <= most
    fit, most, far = fit[near], most[near], far[near]
    if not len(fit):
        return fit
    return fit[far + _differing(sketches[fit, part:], sketches[one, part:]) <= most]


def _spread(members: np.ndarray, forest: _Forest, near) -> None:
    """Join what ``near(one, others)`` links, each member visited once.

    From each visited member only those not yet reached are looked at, so a
    group that hangs together is done in far fewer looks than it has pairs.
    """
    rest = members
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            one = front.pop()
            found = near(one, rest)
            for other in found.tolist():
                forest.join(one, other)
            front += found.tolist()
            rest = rest[~np.isin(rest, found)] if len(found) else rest


def _near_pairs(words: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, bands: Bands):
    """The pairs of places ``x`` and ``y`` that may link by size and sketch."""
    part = -(-words.shape[1] // 3)
    for a in range(0, len(x), PAIRS):
        i, j = x[a : a + PAIRS], y[a : a + PAIRS]
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        fit = 100 * small >= bands.percent * large
        i, j, most = i[fit], j[fit], bands.apart(small[fit])
        far = _differing(words[i, :part], words[j, :part])
        near = far <= most
        i, j, most, far = i[near], j[near], most[near], far[near]
        near = far + _differing(words[i, part:], words[j, part:]) <= most
        yield i[near], j[near]


def _spread_many(members: np.ndarray, forest: _Forest, words: np.ndarray, sizes: np.ndarray, bands: Bands) -> None:
    """As ``_spread`` by size and sketch, many members at a time.

    The members that were reached look at those not yet reached; where none is
    left to look, the next ones start. They are more each time that nothing is
    found, so sets that have nothing but a block in common are done in few steps,
    and in a large group of copies few look at all others.
    """
    rest, front, n = members, members[:0], 16
    while len(rest):
        n = max(1, min(n, PAIRS // len(rest)))
        if len(front):
            some, front = front[:n], front[n:]
            x, y = np.repeat(some, len(rest)), np.tile(rest, len(some))
        else:
            some, rest = rest[:n], rest[n:]
            x, y = np.repeat(some, len(rest)), np.tile(rest, len(some))
            if n > 1:  # with each other too
                i, j = np.triu_indices(len(some), 1)
                x, y = np.concatenate([some[i], x]), np.concatenate([some[j], y])
        found = members[:0]
        for i, j in _near_pairs(words, sizes, x, y, bands):
            for a, b in zip(i.tolist(), j.tolist()):
                forest.join(a, b)
            found = np.concatenate([found, j])
        n = 16 if len(found) else 2 * n
        if len(found):
            reached = np.isin(rest, found)
            front, rest = np.concatenate([front, rest[reached]]), rest[~reached]


def _star(names: list[bytes], forest: _Forest) -> pa.Table:
    pairs = [(names[i], names[forest.root(i)]) for i in range(len(names)) if forest.root(i) != i]
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})


def candidate_links(rows: DataFrame, size: int, bands: Bands) -> DataFrame:
    """(a, b): sets that may link, as forests; every true link lies within a component."""

    def keys(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(batches):
            hashes, begin = shingle_sets(data, offs, size)
            names, at, metas, out = set_ids(hashes, begin), [], [], []
            mixed, upto = mix(hashes), begin.tolist()
            for i, (a, b) in enumerate(zip(upto[:-1], upto[1:])):
                for band in bands.of(b - a):
                    blocks = bands.blocks(band)
                    used = _used_blocks(hashes[a:b], blocks)
                    words = sketch(hashes[a:b], blocks, used)
                    at.append(i)
                    metas.append(names[i] + np.array([band, b - a], np.int64).tobytes() + _folded(words).tobytes())
                    out.append(_block_keys(mixed[a:b], used, blocks, band, bands.allowed(band)))
            if at:
                yield packed_rows(batch, metas, out, at)

    answers = census(rows, "twice", exact=False, values=True, make=keys)
    # One row per set and band: equal sets have equal keys.
    name = F.expr("substring(meta, 1, 24)").alias("name")
    found = answers.groupBy(name).agg(F.first("meta").alias("meta"), F.first("bits").alias("bits"))
    found = found.select(
        F.expr("substring(name, 1, 16)").alias("sid"),
        F.expr("substring(name, 17, 8)").alias("band"),
        F.expr("substring(meta, 25)").alias("meta"),
        "bits",
    )
    found = cut_lineage(found, "sketches")
    drop_table(answers)
    met = cut_lineage(_shared_keys(found), "shared-keys")
    sketches = found.select("sid", "band", "meta")
    # Copies share nearly all their keys: three keys a set find most of them.
    low = [F.min(F.struct(F.xxhash64("key", F.lit(k)), "key", "n"))["key"] for k in (1, 2)]
    few = met.groupBy("sid", "band", "size").agg(F.array_distinct(F.array(*low, F.max(F.struct("n", "key"))["key"])).alias("keys"))
    near = cut_lineage(_close_links(few.select("sid", "band", "size", F.explode("keys").alias("key")), sketches, bands), "near")
    # A key that only sets of one component hold can link nothing more.
    roots = components(near).withColumnRenamed("node", "sid")
    placed = met.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    split = placed.groupBy("key").agg(F.min("root").alias("_least"), F.max("root").alias("_most")).filter("_least <> _most")
    rest = met.join(split.select("key"), "key", "left_semi").select("sid", "band", "size", "key")
    return near.union(_close_links(rest, sketches, bands))


def _shared_keys(found: DataFrame) -> DataFrame:
    """(sid, band, size, key, n): the block keys that several sets hold, without their sketches.

    A row per set and key, so rows grow as the keys do. Of keys that the very
    same sets hold (told by number and two xors of hashes, which are summed where
    the keys are) the least one stands for all.
    """

    def entries(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            bits = batch.column("bits").to_pylist()
            counts = np.array([len(b) // 8 for b in bits], np.int64)
            at = pa.array(np.repeat(np.arange(len(bits)), counts))
            keys = np.frombuffer(b"".join(bits), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid").take(at), batch.column("band").take(at), batch.column("size").take(at), pa.array(keys)],
                ["sid", "band", "size", "key"],
            )

    sized = found.select("sid", "band", F.octet_length("meta").alias("size"), "bits")
    each = sized.mapInArrow(entries, "sid binary, band binary, size int, key long")
    marks = [F.bit_xor(F.xxhash64("sid")).alias("one"), F.bit_xor(F.xxhash64(F.lit(7), "sid")).alias("two")]
    groups = each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *marks).filter("n > 1")
    groups = cut_lineage(groups.groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key", "n"), "groups")
    return each.join(groups, "key").select("sid", "band", "size", "key", "n")


def _close_links(entries: DataFrame, sketches: DataFrame, bands: Bands) -> DataFrame:
    """(a, b): forests of the sets that are close by sketch, of those that share a key of (sid, band, size, key).

    A sketch is sent once for each key of its set. A group beyond ``TILE`` sets
    is cut into tiles and every two tiles meet in a cell.
    """
    n = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).filter("n > 1")
    n = cut_lineage(n, "sizes")
    volume = n.agg(F.sum("bytes").alias("b")).first().b or 0
    tasks = max(fill(entries), -(-volume // CELL_BYTES))
    met = entries.join(n.select("key", "n"), "key").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    met = met.withColumn("tile", F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int"))
    # (i, j) for all j: each tile meets each other once.
    met = met.withColumn("_other", F.explode(F.expr("sequence(0, tiles - 1)")))
    cell = F.xxhash64("key", F.least("tile", "_other"), F.greatest("tile", "_other"))
    met = met.select("sid", "band", cell.alias("cell"))
    dealt = met.join(sketches, ["sid", "band"]).withColumn("task", F.pmod("cell", F.lit(tasks)))

    def linked(table: pa.Table) -> pa.Table:
        here = table.column("band").combine_chunks().dictionary_encode()
        names, which = here.dictionary.to_pylist(), here.indices.to_numpy()
        out = [
            _linked(table.take(pa.array(np.flatnonzero(which == k))), bands)
            for k in sorted(range(len(names)), key=names.__getitem__)
        ]
        give_back()
        return pa.concat_tables(out)

    return dealt.groupBy("task").applyInArrow(linked, "a binary, b binary")


def _linked(table: pa.Table, bands: Bands) -> pa.Table:
    """Forests of the sets of one band that are close by sketch within their cells."""
    names = table.column("sid").to_pylist()
    # Sizes, then sketches: in one band all are of one length, here filled up to whole 64-bit words.
    metas = np.frombuffer(b"".join(table.column("meta").to_pylist()), np.uint8).reshape(len(names), -1)
    whole = np.zeros((len(names), -(-metas.shape[1] // 8) * 8), np.uint8)
    whole[:, : metas.shape[1]] = metas
    whole = whole.view(np.uint64)
    sizes, words = whole[:, 0].astype(np.int64), np.ascontiguousarray(whole[:, 1:])
    flat = table.column("cell").combine_chunks().dictionary_encode().indices.to_numpy()
    who = np.argsort(flat, kind="stable")
    flat = flat[who]
    begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    count = np.diff(np.append(begin, len(flat)))
    forest = _Forest(len(names))
    # Pairs and small groups: all at once.
    pairs = []
    for n in np.unique(count[(count > 1) & (count <= 16)]):
        group = who[begin[count == n][:, None] + np.arange(n)]
        i, j = np.triu_indices(n, 1)
        pairs.append(np.stack([group[:, i].ravel(), group[:, j].ravel()], 1))
    if pairs:
        pairs = np.concatenate(pairs)
        for x, y in _near_pairs(words, sizes, pairs[:, 0], pairs[:, 1], bands):
            for i, j in zip(x.tolist(), y.tolist()):
                forest.join(i, j)
    for s, n in zip(begin[count > 16].tolist(), count[count > 16].tolist()):
        _spread_many(who[s : s + n], forest, words, sizes, bands)
    return _star(names, forest)


def exact_links(rows: DataFrame, groups: DataFrame, size: int, bands: Bands) -> DataFrame:
    """(a, b): forests of the sets of each group (sid, root) that do link.

    ``rows``: keyed documents with their ``sid``, one for each. A group beyond
    ``TILE`` sets is cut into tiles and every two tiles meet in a task.
    """
    n = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    tiles = groups.join(n, "root").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    tiles = tiles.withColumn("tile", F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int"))

    def sets(batches):
        for batch, data, offs in slices(batches):
            hashes, begin = shingle_sets(data, offs, size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sid"), batch.column("root"), batch.column("tiles"), batch.column("tile"),
                    pa.array([hashes[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])], pa.binary()),
                ],
                ["sid", "root", "tiles", "tile", "hashes"],
            )

    def linked(table: pa.Table) -> pa.Table:
        found: list[pa.Table] = []
        roots = table.column("root").to_pylist()
        by: dict[bytes, list[int]] = {}
        for i, root in enumerate(roots):
            by.setdefault(root, []).append(i)
        names, bodies = table.column("sid").to_pylist(), table.column("hashes").to_pylist()
        for at in by.values():
            sets = [np.frombuffer(bodies[i], np.uint64) for i in at]
            sizes = np.array([len(s) for s in sets])
            sketches = np.array([sketch(s, 32) for s in sets])
            forest = _Forest(len(at))

            def near(one, others):
                some = _close(sketches, sizes, one, others, bands)
                if not len(some):
                    return some
                flat = np.concatenate([sets[i] for i in some])
                ends = np.cumsum(sizes[some])
                place = np.minimum(np.searchsorted(sets[one], flat), sizes[one] - 1)
                same = np.concatenate(([0], np.cumsum(sets[one][place] == flat)))
                both = same[ends] - same[ends - sizes[some]]
                return some[100 * both >= bands.percent * (sizes[some] + sizes[one] - both)]

            _spread(np.arange(len(at)), forest, near)
            found.append(_star([names[i] for i in at], forest))
        give_back()
        return pa.concat_tables(found)

    # As many tasks as the sets need, by number: a set is some kilobytes.
    tasks = max(4 * fill(rows), -(-groups.count() // SETS_PER_TASK))
    held = rows.join(tiles, "sid").mapInArrow(sets, "sid binary, root binary, tiles int, tile int, hashes binary")
    one = held.filter("tiles = 1").withColumn("task", F.pmod(F.xxhash64("root"), F.lit(tasks)).cast("string"))
    # (i, j) for all j: each tile meets each other once.
    many = held.filter("tiles > 1").withColumn("_other", F.explode(F.expr("sequence(0, tiles - 1)")))
    many = many.withColumn("task", F.concat_ws("-", F.hex("root"), F.least("tile", "_other"), F.greatest("tile", "_other")))
    tasks = one.unionByName(many.drop("_other"))
    return tasks.groupBy("task").applyInArrow(linked, "a binary, b binary")


def classes(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets (_id, _key, n_shingles, sid) of keyed ``docs``, and (sid, component): the least _id reached."""
    bands = Bands(percent)

    def named(batches):
        for batch, data, offs in slices(batches):
            hashes, begin = shingle_sets(data, offs, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"), pa.array(np.diff(begin)), pa.array(set_ids(hashes, begin), pa.binary())],
                ["_id", "_key", "n_shingles", "sid"],
            )

    sets = cut_lineage(docs.mapInArrow(named, SET_SCHEMA), "sets")
    groups = components(candidate_links(docs, size, bands)).withColumnRenamed("node", "sid")
    one = sets.groupBy("sid").agg(F.min(F.struct("_id", "_key")).alias("one")).select("sid", "one._id", "one._key")
    one = cut_lineage(one, "set-documents")
    rows = docs.dropDuplicates(["_id", "_key"]).join(one.join(groups.select("sid"), "sid"), ["_id", "_key"])
    roots = components(exact_links(rows.select("sid", "text"), groups, size, bands)).withColumnRenamed("node", "sid")
    owned = one.join(roots, "sid", "left").select("sid", "_id", F.coalesce("root", "sid").alias("root"))
    owned = cut_lineage(owned, "owned")
    least = cut_lineage(owned.groupBy("root").agg(F.min("_id").alias("component")), "least")
    return sets, cut_lineage(owned.join(least, "root").select("sid", "component"), "labels")


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text).

    A document's set are its distinct shingles of ``size`` words, A-Z lower-cased;
    two link when 100 * shared >= ``percent`` * all. Texts without words (null,
    empty) have no shingle and stay alone. Rows without an id count as last and
    name no component that has an id; repeated rows share a component; other
    columns are ignored; an empty table gives no rows.
    """
    sets, label = classes(keyed(docs), size, percent)
    component = F.when(F.col("n_shingles") > 0, real_id("component")).otherwise(real_id())
    return sets.join(label, "sid", "left").select(real_id().alias("doc_id"), "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies of ``docs``: the least id, columns as they are.

    Of rows with the same id in one group the one with the least text hash stays,
    once. Rows without words are kept, repeated rows once.
    """
    rows = keyed(docs)
    sets, label = classes(rows, size, percent)
    full = sets.filter("n_shingles > 0").join(label, "sid")
    lead = full.groupBy("component").agg(F.min(F.struct("_id", "_key")).alias("lead"))
    lead = lead.select("lead._id", "lead._key").union(sets.filter("n_shingles = 0").select("_id", "_key")).distinct()
    own, back = shielded(docs)
    kept = own.join(lead, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return back(kept)
