"""Toxicity by a factorization machine over hashed terms.

A document's features are its distinct words, lower-cased, and their beginnings,
each hashed to 64 bits. Beside a weight every known feature has a short vector;
the score adds the products of all pairs of vectors, so that two harmless terms
may be harmful together. The machine is trained on a bounded sample of labelled
documents; scoring reads every text once and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from docweave.llm.tables import drop_table, held_out, labelled_sample, prior_shift, shielded
from docweave.llm.texts import BYTE_CODE, LOWER, give_back, mix, prefix_sums, slices, span_hash, word_spans
from docweave.session import cut_lineage

# Documents of each label to learn from, at most.
SAMPLE = 3000
# Documents of the sample that a feature needs to be learned.
LEAST = 5
# Parts in which the sample is put in order and fetched.
PARTS = 8
FACTORS = 4
BEGINNINGS = (3, 4, 5, 6, 7, 8)

TERM = np.zeros(256, bool)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Machine:
    """Bias, and by feature hash (sorted) weights and factor vectors."""

    features: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Scores of n documents; ``doc`` and ``feature`` list their known features, each once."""
        out = self.bias + np.bincount(doc, self.weights[feature], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[feature, f]
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def terms(data: np.ndarray, offs: np.ndarray, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) of all distinct features, or (document, place in ``known``)."""
    starts, ends, first = word_spans(data, offs, TERM)
    sums = prefix_sums(BYTE_CODE[LOWER[data]])
    words, at, which = np.unique(span_hash(sums, starts, ends), return_index=True, return_inverse=True)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    pairs = np.unique(doc * len(words) + which)
    doc, which = pairs // max(len(words), 1), pairs % max(len(words), 1)
    docs, out = [], []
    for k in (0, *BEGINNINGS):
        long = np.flatnonzero(ends[at] - starts[at] > k)
        a = starts[at[long]]
        h = mix(span_hash(sums, a, a + k) + np.uint64(k)) if k else words[long]
        if known is not None:
            place = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            found = known[place] == h if len(known) else np.zeros(len(h), bool)
            long, h = long[found], place[found]
        held, value = np.zeros(len(words), bool), np.zeros(len(words), h.dtype)
        held[long], value[long] = True, h
        has = held[which]
        docs.append(doc[has])
        out.append(value[which[has]])
    doc, out = np.concatenate(docs), np.concatenate(out)
    if known is not None:  # places are small: one number holds document and place
        pairs = np.sort(doc * max(len(known), 1) + out)
        return np.divmod(pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]], max(len(known), 1))
    order = np.lexsort((out, doc))
    doc, out = doc[order], out[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (out[1:] != out[:-1])
    return doc[new], out[new]


def places(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where in ``known`` (sorted) the hashes stand; those not in it are left out."""
    at = np.searchsorted(known, hashes)
    has = at < len(known)
    has[has] = known[at[has]] == hashes[has]
    return at[has]


def train(rows: list[tuple[np.ndarray, int]], least: int = LEAST, **how) -> Machine:
    """``fit`` to (feature hashes, label); features of fewer than ``least`` rows are left out."""
    flat = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.uint64)
    features, n = np.unique(flat, return_counts=True)
    features = features[n >= least]
    return fit(features, [places(features, r[0]) for r in rows], np.array([r[1] for r in rows], np.float64), **how)


def fit(
    features: np.ndarray,
    sets: list[np.ndarray],
    labels: np.ndarray,
    epochs: int = 6,
    rate: float = 0.05,
    shrink: float = 0.05,
    factor_share: float = 0.02,
) -> Machine:
    """Fit by stochastic gradient on the logistic loss; ``sets``: places in ``features`` for each label.

    After each epoch weights are shrunk towards 0 (``shrink``), which clears those
    that only fit single documents. Factors learn at ``factor_share`` of the rate:
    a text has many more pairs than terms. The order is fixed.
    """
    rng = np.random.default_rng(17)
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.25
    machine = Machine(
        features, float(np.log(share / (1 - share))), np.zeros(len(features)), rng.normal(0, 0.01, (len(features), FACTORS))
    )
    if len(features) == 0 or len(set(labels)) < 2:
        machine.bias = min(machine.bias, -0.01) if not labels.all() or not len(labels) else machine.bias
        return machine
    for epoch in range(epochs):
        step = rate / (1 + epoch / 2)
        order = rng.permutation(len(sets))
        for a in range(0, len(order), 16):
            some = order[a : a + 16]
            doc = np.repeat(np.arange(len(some)), [len(sets[i]) for i in some])
            feature = np.concatenate([sets[i] for i in some])
            used, local = np.unique(feature, return_inverse=True)
            v = machine.factors[feature]
            sums = np.stack([np.bincount(doc, v[:, f], len(some)) for f in range(FACTORS)], 1)
            g = sigmoid(machine.logits(doc, feature, len(some))) - labels[some]
            machine.bias -= step * g.sum()
            machine.weights[used] -= step * np.bincount(local, g[doc], len(used))
            dv = np.stack([np.bincount(local, g[doc] * (sums[doc, f] - v[:, f]), len(used)) for f in range(FACTORS)], 1)
            machine.factors[used] -= step * factor_share * np.clip(dv, -5, 5)
        least_kept = shrink * step * 20
        machine.weights = np.sign(machine.weights) * np.maximum(np.abs(machine.weights) - least_kept, 0)
    return machine


def learned(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Machine:
    """A machine learned from lower-cased documents labelled toxic or not, held-out ones left aside.

    Its bias is set to the share of toxic labels among all that are not held out.
    Features are counted, and documents put in order, by Spark: the driver gets
    the features of at least ``LEAST`` documents, and four bytes for each that a
    document has, part by part.
    """

    def features(batches: Iterator[pa.RecordBatch]):
        for batch, data, offs in slices(batches):
            doc, hashes = terms(data, offs, None)
            upto = np.searchsorted(doc, np.arange(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h.tobytes() for h in np.split(hashes, upto)], pa.binary()), batch.column("label")],
                ["hashes", "label"],
            )

    def counts(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.int64)
            feature, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(n)], ["feature", "n"])

    def packed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("feature").to_numpy().tobytes()], pa.binary())], ["packed"])

    def placed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at = [places(known, np.frombuffer(h, np.uint64)) for h in batch.column("hashes").to_pylist()]
            at = pa.array([x.astype(np.uint32).tobytes() for x in at], pa.binary())
            yield pa.RecordBatch.from_arrays([at, batch.column("label")], ["places", "label"])

    sample = labelled_sample(docs, labels, "toxic", most).mapInArrow(features, "hashes binary, label int")
    sample = cut_lineage(sample, "sample")  # at most 2 * most rows
    common = sample.mapInArrow(counts, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    common = common.filter(F.col("n") >= LEAST).select("feature").mapInArrow(packed, "packed binary")
    known = np.sort(np.frombuffer(b"".join(bytes(r.packed) for r in common.toLocalIterator()), np.uint64))
    # Ranges are dealt by a prefix: the bounds of an order by all hashes would be a sample of whole rows in the driver.
    ordered = sample.repartitionByRange(PARTS, F.substring("hashes", 1, 16)).sortWithinPartitions("hashes", "label")
    sets, toxic = [], []
    for row in ordered.mapInArrow(placed, "places binary, label int").toLocalIterator():
        sets.append(np.frombuffer(row.places, np.uint32))
        toxic.append(row.label)
    drop_table(sample)
    machine = fit(known, sets, np.array(toxic, np.float64))
    machine.bias += prior_shift(docs, labels, "toxic", most)
    del sets
    give_back()
    return machine


def scored(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, by which they are scored, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    names = [c for c in docs.columns if c != text]

    def score(batches):
        for batch, data, offs in slices(batches, text):
            doc, feature = terms(data, offs, machine.features)
            p = sigmoid(machine.logits(doc, feature, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*names, "score", "predicted"]
            )

    more = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.mapInArrow(score, T.StructType([*(docs.schema[c] for c in names), *more]))


def toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of (doc_id, text).

    Learns from ``labels`` (doc_id, toxic) of documents that are not held out;
    ``most``: labelled documents of each kind, at most. Null and empty texts get
    the score of no features. Without labels of both kinds all scores are the
    share of toxic labels. Rows without an id count as held out; repeated rows
    are scored each; an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.lower("text").alias("text"))
    out = scored(docs, learned(docs, labels, most))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``docs`` without the documents predicted toxic; columns as they are."""
    machine = learned(docs.select("doc_id", F.lower("text").alias("text")), labels, most)
    own, back = shielded(docs)
    rows = own.select(*(f"own{i}" for i in range(len(docs.columns))), F.lower("text").alias("text"))
    return back(scored(rows, machine).filter("predicted = 0"))
