"""Stored tables travel as rows; documents are made behind the shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.operators import search
from docweave.operators.tables import table_to_documents
from docweave.sinks import store


def exchanges(df):
    """Columns that each exchange of a plan carries."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("RepartitionByExpression"):
            found.append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_tables_travel_as_rows(spark, tmp_path):
    n = 6000
    money = (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 100).alias("amount")
    date = F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit("d")), F.lit(315_000_000))).alias("day")
    one = spark.range(n).select("id", F.when(F.col("id") % 50 != 7, money).alias("amount"))
    two = spark.range(n).select(F.col("id").cast("string").alias("name"), F.when(F.col("id") % 9 != 1, date).alias("day"))
    two = two.union(two.limit(5)).union(two.select(F.lit(None).cast("string"), F.lit(None).cast("timestamp")).limit(3))
    kinds = {"amount": "money"}
    make = {"one": lambda df: table_to_documents(df, "one", "db", kinds=kinds, key_columns=["id"]), "two": lambda df: table_to_documents(df, "two", "db")}
    parts = [(one, kinds, make["one"]), (two, None, make["two"])]
    found = store.clustered_tables(parts)
    assert sorted(exchanges(found)) == [3, 3], "a row and its place travel"
    path = str(tmp_path / "stored")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    store.write_documents(found, path, row_group=1 << 14, folders=2)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    held, whole = store.read_documents(spark, path), make["one"](one).unionByName(make["two"](two))
    names = whole.columns
    assert sorted(map(repr, held.select(names).collect())) == sorted(map(repr, whole.collect()))
    look = lambda df: search.filter_any_money(df, 5000, 5300).select("unique_id")
    assert sorted(look(held).collect()) == sorted(look(whole).collect()) and look(held).count()
    left = look(held)
    left.collect()
    leaves = left._jdf.queryExecution().executedPlan().collectLeaves()
    read = sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))
    assert read < 0.5 * n, read
    empty = store.clustered_tables([(one.where("false"), kinds, make["one"])])
    assert empty.count() == 0
