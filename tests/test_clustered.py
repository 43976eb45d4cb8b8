"""Stored documents in an order by which range filters leave rows unread."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docweave.operators import search
from docweave.schema import conform
from docweave.sinks import store


def documents(spark, n):
    """Dates of ten years and amounts to 10,000 that have nothing to do with each other."""
    date = F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit("d")), F.lit(315_000_000)))
    money = F.pmod(F.xxhash64("id", F.lit("m")), F.lit(1_000_000)) / 100
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("unique_id"), F.lit("db").alias("database_nm"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("table_nm"),
        F.when(F.col("id") % 50 != 7, F.array(date, date - F.expr("INTERVAL 3 DAYS"))).alias("date_text"),
        F.when(F.col("id") % 50 != 9, F.array(money)).alias("money_text"),
    )
    return conform(rows)


def rows_read(found):
    """Rows that the scan gave to the plan above it."""
    found.collect()
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


@pytest.mark.parametrize("kind", ["date", "money"])
def test_rows_are_left_unread(spark, tmp_path, kind):
    n = 40_000
    path = str(tmp_path / "stored")
    docs = documents(spark, n)
    store.write_documents(store.clustered(docs), path, row_group=1 << 15)
    held = store.read_documents(spark, path)
    assert held.count() == n
    if kind == "date":
        look = lambda df: search.filter_any_date(df, "1976-02-01", "1976-05-01").select("unique_id")
    else:
        look = lambda df: search.filter_any_money(df, 5000, 5300).select("unique_id")
    found = look(held)
    assert sorted(r.unique_id for r in found.collect()) == sorted(r.unique_id for r in look(docs).collect())
    plain = str(tmp_path / "plain")
    store.write_documents(docs, plain, row_group=1 << 15)
    clustered, scattered = rows_read(found), rows_read(look(store.read_documents(spark, plain)))
    assert clustered < 0.4 * n and clustered < 0.5 * scattered, (clustered, scattered)


def test_clustered_awkward(spark):
    docs = documents(spark, 300)
    assert store.clustered(docs.where("false")).count() == 0
    same = documents(spark, 1).select("*").crossJoin(spark.range(50).select(F.col("id").alias("_n"))).drop("_n")
    assert store.clustered(same).count() == 50 and store.clustered(docs).columns == docs.columns
    bare = conform(docs.drop("date_text", "money_text"))
    assert store.clustered(bare).count() == 300
    got, want = store.clustered(docs).collect(), docs.collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
