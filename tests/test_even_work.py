"""Steps whose work once fell to one task, travelled twice or looked at a part of the rows."""

from pyspark.sql import functions as F

from docweave.functions import number_formats as nf
from docweave.llm import leaks
from docweave.schema import conform
from docweave.sinks import store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_common_seeds_are_counted_in_all_documents_f4_f5(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"alpha beta gamma{i} alpha beta") for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta delta epsilon zeta eta theta")], "item_id long, text string")
    counted = []
    whole = leaks.rare_seeds
    monkeypatch.setattr(leaks, "rare_seeds", lambda grams, counts: counted.extend(grams.join(counts, "seed").collect()) or whole(grams, counts))
    assert leaks.contaminated(docs, items).collect() == []
    assert [r.n for r in counted] == [80]


def test_cells_without_a_code_are_dealt_f6(spark):
    cells = spark.range(4000).select("id", F.col("id").cast("string").alias("value"), F.when(F.col("id") < 2000, "0.0").alias("code"))
    cells = cells.withColumns({"number": F.lit(True), "from_1904": F.lit(False)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many cells
    try:
        shown = nf.format_cells(cells, nf.compiled_codes(cells.where("code IS NOT NULL").select("code")))
        rows = shown.select("id", "shown", F.spark_partition_id().alias("task"), "code").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.id: r.shown for r in rows} == {i: f"{i}.0" if i < 2000 else str(i) for i in range(4000)} and len(rows) == 4000
    for code in ("0.0", None):
        assert len({r.task for r in rows if r.code == code}) > 2


def test_folders_are_read_not_joined_f8(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "docs"), []
    names = [("d", "t"), ("d", None), (None, "t"), ("d", "other"), ("", "t")]
    rows = [(f"{n}-{k}", *name) for n, name in enumerate(names) for k in range(3)]
    schema = "unique_id string, database_nm string, table_nm string"
    store.write_documents(conform(spark.createDataFrame(rows, schema)), path)
    other = set((tmp_path / "docs" / "database_nm=d" / "table_nm=other").iterdir())
    write = store.write_documents
    monkeypatch.setattr(store, "write_documents", lambda df, *a, **k: plans.append(plan_of(df)) or write(df, *a, **k))
    again = spark.createDataFrame([("0-0", "d", "t"), ("1-1", None, "t"), ("new", "d", None)], schema)
    store.upsert_documents(conform(again), path)
    held = [(r.unique_id, r.database_nm, r.table_nm) for r in store.read_documents(spark, path).collect()]
    want = {u: (u, d or None, t) for u, d, t in rows} | {u: (u, d, t) for u, d, t in (tuple(r) for r in again.collect())}
    assert sorted(held, key=repr) == sorted(want.values(), key=repr)
    assert set((tmp_path / "docs" / "database_nm=d" / "table_nm=other").iterdir()) == other
    # no join by folder, in which the rows of a table would meet in one task
    assert "coalesce(database_nm" not in plans[-1]
