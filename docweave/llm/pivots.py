"""Vector codes: a small codebook for each part of the vectors, learned with LAESA pivots."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.tables import drop_table
from docweave.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Entries of the first codebook that serve as pivots of their part position.
PIVOTS = 5


@dataclass
class Codebooks:
    """``entries[p]``: the integer entries of part position p, (entries, width); ``pivots[p]``: (pivots, width)."""

    entries: list[np.ndarray]
    pivots: list[np.ndarray]
    limit: int

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, comma-joined."""
        numbers = (str(int(x)) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def usable(vector: str):
    """Whether a vector column holds a vector of finite numbers."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & finite, F.lit(False))


def integers(vectors: np.ndarray, parts: int, scale: int, limit: int) -> np.ndarray:
    """(rows, parts, width) floors of ``scale`` times the components, padded with 0 to equal parts."""
    whole = np.clip(np.floor(vectors.astype(np.float64) * scale), -limit, limit).astype(np.int64)
    width = -(-whole.shape[1] // parts)
    out = np.zeros((len(whole), parts * width), np.int64)
    out[:, : whole.shape[1]] = whole
    return out.reshape(len(whole), parts, width)


def choose_pivots(entries: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` different entries, each the one of greatest summed distance from those before it."""
    chosen, far = [0], np.zeros(len(entries))
    while len(chosen) < most:
        far += np.sqrt(((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
        far[chosen] = -1
        if (nearest := int(far.argmax())) in chosen:
            break
        chosen.append(nearest)
    return entries[chosen]


def pivot_distances(part: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) Euclidean distances, the squares exact."""
    return np.sqrt(np.stack([((part - q) ** 2).sum(axis=1) for q in pivots], axis=1).astype(np.float64))


def nearest_entries(part: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray):
    """For each row of ``part`` its nearest entry (ties: lower index), the squared distance, and the number evaluated.

    |d(x, q) - d(e, q)| <= d(x, e) for every pivot q: entries are visited by
    their greatest such bound, and only rows whose bound does not exceed the best
    distance so far are evaluated, in integers. Bounds are lowered by more than
    rounding can raise them, so no entry that is nearest or ties is left out.
    """
    of_entries = pivot_distances(entries, pivots)
    bound = np.zeros((len(part), len(entries)))
    for q in range(len(pivots)):
        x, e = to_pivots[:, q, None], of_entries[None, :, q]
        np.maximum(bound, np.abs(x - e) - 1e-14 * (x + e), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(part), np.iinfo(np.int64).max)
    code = np.full(len(part), len(entries))
    evaluated = 0
    rows = np.arange(len(part))
    for k in range(len(entries)):
        entry = order[rows, k]
        rows_in = bound[rows, entry] <= np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-12)
        rows, entry = rows[rows_in], entry[rows_in]  # the bounds of a row only rise
        if not len(rows):
            break
        evaluated += len(rows)
        far = ((part[rows] - entries[entry]) ** 2).sum(axis=1)
        better = (far < best[rows]) | ((far == best[rows]) & (entry < code[rows]))
        best[rows[better]], code[rows[better]] = far[better], entry[better]
    return code, best, evaluated


def _unpack(batch: pa.RecordBatch, parts: int, width: int, pivots: list[int]):
    n = batch.num_rows
    body = lambda name, kind: np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(n, -1)
    whole = body("whole", np.int32).astype(np.int64).reshape(n, parts, width)
    far = np.split(body("far", np.float64), np.cumsum(pivots)[:-1], axis=1)
    return whole, far


@dataclass
class Prepared:
    """Stored vectors as integers with their pivot distances, and the first codebooks."""

    table: DataFrame | None
    books: Codebooks
    width: int


def prepare(
    vectors: DataFrame, id_column: str, vector: str, label: str, parts: int, entries: int, scale: int, pivots: int
) -> Prepared:
    """One pass that writes each usable vector as integers beside its distances to the pivots."""
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
    ).filter(usable("v"))
    order = [F.col("id").isNull(), "id", "v"]
    # Two scans of a few columns that keep 1 and `entries` rows.
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return Prepared(None, Codebooks([], [], 0), 0)
    size = len(first[0].v)
    rows = rows.filter(F.size("v") == size)
    seeds = rows.orderBy(*order).limit(entries).collect()
    limit = math.isqrt((1 << 62) // (4 * size))
    limit = min(limit, (1 << 31) - 1)
    start = integers(np.array([r.v for r in seeds]), parts, scale, limit)
    books = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    chosen = [choose_pivots(b, pivots) for b in books]

    def measure(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            whole = integers(flat.reshape(batch.num_rows, size), parts, scale, limit)
            far = np.concatenate([pivot_distances(whole[:, p], chosen[p]) for p in range(parts)], axis=1)
            packed = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (whole.astype(np.int32), far)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *packed], ["id", "label", "whole", "far"])

    kind = rows.schema["label"].dataType.simpleString()
    table = rows.mapInArrow(measure, f"id long, label {kind}, whole binary, far binary")
    return Prepared(cut_lineage(table, "parts"), Codebooks(books, chosen, limit), start.shape[2])


def refined(prepared: Prepared) -> list[np.ndarray]:
    """The entries after one round: each the floor of the mean of its parts; unused entries stay."""
    books, width = prepared.books, prepared.width
    parts, counts = len(books.entries), [len(q) for q in books.pivots]
    many = len(books.entries[0])

    def sums(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((parts, many, width), np.int64)
        used = np.zeros((parts, many), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, far = _unpack(batch, parts, width, counts)
            for p in range(parts):
                code, _, _ = nearest_entries(whole[:, p], far[p], books.entries[p], books.pivots[p])
                for e in range(many):
                    mine = code == e
                    total[p, e] += whole[mine, p].sum(axis=0)
                    used[p, e] += int(mine.sum())
        at, of = np.nonzero(used)
        cells = (at * many + of)[:, None] * width + np.arange(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells.ravel()), pa.array(total[at, of].ravel()), pa.array(np.repeat(used[at, of], width))],
            ["cell", "total", "used"],
        )

    # A row for each component of each entry: bounded by the codebooks, whatever the table holds.
    each = prepared.table.select("whole", "far").mapInArrow(sums, "cell long, total long, used long")
    each = each.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("used").alias("used"))
    new = [entries.copy() for entries in books.entries]
    for row in each.collect():
        entry, position = divmod(row.cell, width)
        new[entry // many][entry % many, position] = int(row.total) // row.used
    return new


def learn_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
) -> tuple[DataFrame, Codebooks]:
    """Codes (id, label, codes, error) of all usable vectors, and the codebooks they refer to.

    Components become floor(scale * x); each vector is cut into ``parts`` equal
    parts, padded with 0 if they don't fill the last. The first codebook of a
    part position are the parts of the ``entries`` least ids; each round moves
    the entries to the floored means of their parts. Distances to the pivots are
    computed once and stored with the integers; a round reads that table, sends
    one row for each component of an entry a task, and shuffles nothing else.

    Left out: null or empty vectors, null or non-finite components, and vectors
    of another length than that of the least id. Components are held within the
    range whose squared distances fit a long (2**27 for 64 components). Null ids come last, equal ids in the order of their
    vectors; repeated rows count each time; with fewer rows than ``entries`` the
    codebooks are smaller; an empty table gives no rows and empty codebooks.
    """
    prepared = prepare(vectors, id_column, vector, label, parts, entries, scale, pivots)
    kind = vectors.schema[label].dataType.simpleString()
    schema = f"id long, label {kind}, codes array<int>, error long"
    if prepared.table is None:
        return vectors.sparkSession.createDataFrame([], schema), prepared.books
    for _ in range(rounds):
        prepared.books.entries = refined(prepared)
    books, width = prepared.books, prepared.width

    def coded(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, far = _unpack(batch, parts, width, [len(q) for q in books.pivots])
            found = [nearest_entries(whole[:, p], far[p], books.entries[p], books.pivots[p]) for p in range(parts)]
            codes = np.stack([f[0] for f in found], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("label"),
                    pa.array(codes.tolist(), pa.list_(pa.int32())),
                    pa.array(np.sum([f[1] for f in found], axis=0)),
                ],
                ["id", "label", "codes", "error"],
            )

    codes = cut_lineage(prepared.table.mapInArrow(coded, schema), "codes")
    drop_table(prepared.table)
    return codes, books


def vector_codes(vectors: DataFrame, **settings) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector; see ``learn_codes``.

    ``code``: the indexes in part order, two hex digits each. ``label_error``: the
    error summed over equal labels, nulls together; the sums are made apart and
    joined back, so a label that many rows hold is gathered nowhere.
    """
    codes, books = learn_codes(vectors, **settings)
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    joined = codes.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        F.col("id").alias("vec_id"),
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


def oracle_sql() -> str:
    """DuckDB SQL of ``vector_codes`` over ``embeddings``: every distance, no bounds; rounds written out."""
    least = f"""least_id AS (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {ENTRIES})"""
    steps = [
        f"""whole AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        )""",
        least,
        f"""x AS (
            SELECT vec_id, label, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS v
            FROM (SELECT *, unnest(range({PARTS})) AS p FROM whole)
        )""",
        """c0 AS (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v
            FROM x WHERE vec_id IN (SELECT vec_id FROM least_id)
        )""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS (
            SELECT x.vec_id, x.label, x.p, any_value(x.v) AS v, min({ENTRIES} * CAST(list_sum(list_transform(
                range(1, len(x.v) + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS BIGINT) + c.e) AS best
            FROM x JOIN c{r} c ON x.p = c.p GROUP BY x.vec_id, x.label, x.p
        )""")
        if r < ROUNDS:
            steps.append(f"""s{r} AS (
                SELECT p, best % {ENTRIES} AS e, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m
                FROM (SELECT p, best, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY ALL
            ), c{r + 1} AS (
                SELECT c.p, c.e, coalesce(s.v, c.v) AS v FROM c{r} c
                LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS v FROM s{r} GROUP BY p, e) s ON c.p = s.p AND c.e = s.e
            )""")
    return f"""
        WITH {", ".join(steps)}, coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', CAST(best % {ENTRIES} AS INT)), '' ORDER BY p) AS code,
                CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id, label
        ), books AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded, books"""
