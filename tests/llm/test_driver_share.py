"""What a learned operator brings to the driver does not grow with words that it cannot learn from."""

from __future__ import annotations

import tracemalloc

import numpy as np

from docweave.llm import tables, toxicity


def test_rare_features_stay_on_executors(spark):
    """300 documents of 4,000 words, each word found once: its hashes alone are 8 bytes each."""
    n, words = 300, 4000
    docs = spark.range(n).selectExpr(
        "id AS doc_id", f"concat(if(id % 3 = 0, 'vile ', 'mild '), array_join(transform(sequence(1, {words}), i -> concat('commonword', hex(xxhash64(id, i)))), ' ')) AS text"
    )
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS INT) AS toxic")
    tracemalloc.start()
    try:
        machine = toxicity.learned(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert 0 < len(machine.features) < 100
    assert peak < n * words * 8 / 4, peak


def test_same_machine_as_from_whole_rows(spark):
    """Counting and ordering by Spark against all hashes in one place, equal rows and a common first feature among them."""
    n = 700
    docs = spark.range(n).selectExpr(
        "id AS doc_id",
        "if(id % 50 = 7, null, if(id % 4 = 0, 'equal vile text', array_join(transform(sequence(1, 12), i -> concat(if(id % 3 = 0, 'v', 'm'), (id * 31 + i * i * 7) % 90)), ' '))) AS text",
    )
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS INT) AS toxic")
    got = toxicity.learned(docs, labels)
    rows = []
    for row in tables.labelled_sample(docs, labels, "toxic", toxicity.SAMPLE).collect():
        body = (row.text or "").encode()
        _, hashes = toxicity.terms(np.frombuffer(body, np.uint8), np.array([0, len(body)]), None)
        rows.append((hashes.tobytes(), row.label))
    want = toxicity.train([(np.frombuffer(h, np.uint64), y) for h, y in sorted(rows)])
    assert len(want.features) > 50 and got.features.tolist() == want.features.tolist()
    assert got.weights.tolist() == want.weights.tolist() and got.factors.tolist() == want.factors.tolist()
    assert got.bias == want.bias


def test_places():
    known = np.array([3, 5, 9], np.uint64)
    assert toxicity.places(known, np.array([1, 5, 9, 10], np.uint64)).tolist() == [1, 2]
    assert toxicity.places(known[:0], np.array([1], np.uint64)).tolist() == []
