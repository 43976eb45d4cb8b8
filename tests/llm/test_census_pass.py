"""A census makes its keys in the pass that puts them into chunks."""

from __future__ import annotations

import numpy as np

from docweave.llm import census as census_module
from docweave.llm.parity import keep_one


def test_census_takes_one_python_pass(spark, monkeypatch):
    """Keys were made by one Python worker and put into chunks by a second, in the same task."""
    passes = []
    kept = census_module.cut_lineage

    def seen(df, label="step"):
        if label == "chunks":
            passes.append(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        return kept(df, label)

    monkeypatch.setattr(census_module, "cut_lineage", seen)
    words = " ".join(map(str, np.arange(100)))
    docs = spark.createDataFrame([(1, words), (2, words + " more"), (3, "other"), (4, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == [1, 3, 4]
    assert passes == [1]
