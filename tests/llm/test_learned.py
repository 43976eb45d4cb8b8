"""Learned operators: plain computations beside the vectorised ones, and shares of labels."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from docweave.llm import language, quality, tables, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_language_against_plain_bundles(spark):
    """Cosines of dictionaries of trigrams, one trigram vector after the other."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([
        ("Der Hund läuft über die Straße, größer als je", "de"), ("the dog runs over the street, larger than ever", "en"),
        ("собака бежит по улице", "ru"), ("кучето тича по улицата", "bg"), ("犬が 走る 😀 𐐷𐐨", "ja"), ("über größe straße", "de"),
        ("the larger street", None), ("улица собака", None), ("", "en"), ("größe", None), ("12 34", "en"),
    ])]

    def trigrams(text):
        letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
        words = letters.split()
        line = "\0" + "\0".join(words) + "\0" if words else "\0"
        return Counter(line[i : i + 3] for i in range(len(line) - 2))

    def vector(counts):
        out = np.zeros(language.SIZE)
        for gram, n in counts.items():
            x, y, z = (language.letter_vectors(np.array([ord(c)]))[0].astype(int) for c in gram)
            out += n * np.roll(x, 2) * np.roll(y, 1) * z
        return out

    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    bundles = {}
    for i, text, lang in rows:
        if lang and not got[i].held_out:
            bundles[lang] = bundles.get(lang, 0) + vector(trigrams(text))
    for i, text, _ in rows:
        counts = trigrams(text)
        if not any(c != "\0" for gram in counts for c in gram):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        v = vector(counts)
        cosines = {k: float(v @ b / np.linalg.norm(v) / np.linalg.norm(b)) for k, b in sorted(bundles.items()) if np.any(b)}
        assert got[i].lang_pred == max(cosines, key=cosines.get)
        assert abs(got[i].score - max(0, max(cosines.values()))) < 1e-5


def test_letters_are_told_apart():
    """Marks and scripts: no two letters share a vector."""
    points = np.array([ord(c) for c in "éäßñöèüабвгд日本語"])
    products = language.letter_vectors(points).astype(int) @ language.letter_vectors(points).astype(int).T
    assert np.abs(np.triu(products, 1)).max() < language.SIZE / 3


def test_machine_against_plain_pairs():
    """The double sum over all pairs of features."""
    rng = np.random.default_rng(5)
    machine = toxicity.Machine(np.arange(30, dtype=np.uint64), -0.4, rng.normal(size=30), rng.normal(size=(30, toxicity.FACTORS)))
    sets = [sorted(rng.choice(30, n, replace=False).tolist()) for n in (0, 1, 2, 9, 30)]
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    got = machine.logits(doc, np.array([f for s in sets for f in s]), len(sets))
    for features, value in zip(sets, got):
        want = machine.bias + sum(machine.weights[f] for f in features)
        want += sum(float(machine.factors[f] @ machine.factors[g]) for f in features for g in features if f < g)
        assert math.isclose(value, want, abs_tol=1e-9)


def test_prior_shift(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS toxic")
    n = {r.toxic: r["count"] for r in docs.join(labels, "doc_id").filter(~tables.held_out()).groupBy("toxic").count().collect()}
    assert math.isclose(tables.prior_shift(docs, labels, "toxic", 100), math.log(n[1] / n[0]))
    assert math.isclose(tables.prior_shift(docs, labels, "toxic", 1000), math.log(n[1] / n[0]) - math.log(n[1] / 1000))
    assert tables.prior_shift(docs, labels, "toxic", 5000) == 0
    assert tables.prior_shift(docs, labels.filter("toxic = 1"), "toxic", 100) == 0
    assert tables.prior_shift(docs.filter("false"), labels, "toxic", 100) == 0


def test_toxic_share_does_not_follow_the_bound(docs, labels):
    """The sample of 200 has half toxic documents, the corpus about a tenth."""
    share, score = {}, {}
    for most in (200, toxicity.SAMPLE):
        rows = toxicity.toxicity(docs, labels, most).select("score", "predicted").collect()
        share[most] = np.mean([r.predicted for r in rows])
        score[most] = np.mean([r.score for r in rows])
    assert abs(share[200] - share[toxicity.SAMPLE]) < 0.02 and abs(score[200] - score[toxicity.SAMPLE]) < 0.03, (share, score)


def test_kept_share_does_not_follow_the_bound(docs, labels):
    share = {}
    for most in (200, quality.SAMPLE):
        rows = quality.quality(docs, labels, most).filter("not base_failed").select("kept").collect()
        share[most] = np.mean([r.kept for r in rows])
    assert abs(share[200] - share[quality.SAMPLE]) < 0.03, share
