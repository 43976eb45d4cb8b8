"""Term vectors gather the tokens of many texts at once."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from docweave.operators import search


def expected(text):
    """{token: (positions, offsets)} of letters and digits, by a plain loop."""
    out = {}
    for pos, m in enumerate(re.finditer(r"[^\W_]+", text.lower())):
        places = out.setdefault(m[0], ([], []))
        places[0].append(pos)
        places[1].append(m.start())
    return out


def test_term_vectors(spark, monkeypatch):
    monkeypatch.setattr(search, "VECTOR_TOKENS", 7)  # slices within a batch
    texts = ["a b a", "", None, "ÄÖ_ä 𝒳𝒳 \U0001f600x 日本,日本", "  lead", "end.end", "...", "x", "y" * 500 + " z" * 300, "a b a"]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("body", T.StringType())])
    rows = [*enumerate(texts), (None, "null id id"), (0, "a b a")]
    docs = spark.createDataFrame(rows, schema).coalesce(1)
    got = sorted((r.id if r.id is not None else -1, r.token, r.freq, r.first_pos, r.positions, r.offsets) for r in search.term_vectors(docs, "id", "body").collect())
    want = sorted(
        (i if i is not None else -1, token, len(places), places[0], places, starts)
        for i, text in rows if text
        for token, (places, starts) in expected(text).items()
    )
    assert got == want
    plain = search.term_vectors(docs, "id", "body", offsets=False)
    assert sorted((r.id if r.id is not None else -1, r.token, r.freq, r.first_pos, r.positions) for r in plain.collect()) == [w[:5] for w in want]
    assert search.term_vectors(docs.where("false"), "id", "body").count() == 0


def test_term_vectors_sort_nothing_by_expression(spark):
    """Sorting and cutting structs by interpreted expressions was most of the time."""
    docs = spark.createDataFrame([(1, "a b a")], "id long, body string")
    plan = search.term_vectors(docs, "id", "body")._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan and "MapInArrow" in plan
