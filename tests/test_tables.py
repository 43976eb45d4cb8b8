"""Routing, naming and ids of table rows; catalog rules; upsert."""

from datetime import datetime
from decimal import Decimal

import pytest

from docweave.operators import catalog as cat
from docweave.operators.tables import field_name, kind_of_native, plan_columns, table_to_documents
from docweave.operators.upsert import latest_by_id, upsert
from docweave.plans.imports import TableImport, import_tables, plan_tables


@pytest.mark.parametrize(
    "native, precision, dialect, kind",
    [
        ("varchar", 50, "sqlserver", "string"),
        ("nvarchar", 200, "sqlserver", "large_string"),
        ("uniqueidentifier", 0, "sqlserver", "string"),
        ("bigint", 0, "sqlserver", "long"),
        ("smallint", 0, "sqlserver", "int"),
        ("bit", 0, "sqlserver", "boolean"),
        ("datetime", 0, "sqlserver", "timestamp"),
        ("datetime2", 0, "sqlserver", "timestamp"),
        ("smalldatetime", 0, "sqlserver", "timestamp"),
        ("date", 0, "sqlserver", "timestamp"),
        ("numeric", 0, "sqlserver", "numeric"),
        ("smallmoney", 0, "sqlserver", "money"),
        ("xml", 0, "sqlserver", "xml"),
        ("decimal", 0, "sqlserver", "other"),
        ("float", 0, "sqlserver", "other"),
        ("NUMBER", 22, "oracle", "number"),
        ("VARCHAR2", 40, "oracle", "string"),
        ("VARCHAR2", 4000, "oracle", "large_string"),
        ("TIMESTAMP(6)", 0, "oracle", "timestamp"),
        ("DATE", 0, "oracle", "timestamp"),
        ("XMLTYPE", 0, "oracle", "xml"),
        ("FLOAT", 0, "oracle", "float"),
        ("RAW", 0, "oracle", "other"),
    ],
)
def test_kinds(native, precision, dialect, kind):
    assert kind_of_native(native, precision, dialect) == kind


def test_names():
    assert field_name("Table_NM", "string") == "Table_NM_s"
    assert field_name("vendor", "string", "oracle") == "vendor"
    assert field_name("x_dt", "string") == "x_date"
    assert field_name("a_dt_dts", "string") == "a_date_dates"
    assert field_name("x_dt", "timestamp") == "x_dt"


def test_blank_and_null_values_are_left_out(spark):
    df = spark.createDataFrame([("a", " \t", None, True, Decimal("1.50"))], "k string, b string, n int, f boolean, m decimal(9,2)")
    row = table_to_documents(df, "t", "db", id_column="k", kinds={"m": "money"}).first()
    assert row.unique_id == "a"
    assert row.fields == {"k": "a", "f_b": "true", "m": "1.5000"}
    assert row.text == ["a"] and row.money_text == [1.5] and row.date_text == []


def test_large_text_is_reversed_and_dates_are_collected(spark):
    df = spark.createDataFrame([("x", datetime(2024, 1, 2))], "body string, at timestamp")
    row = table_to_documents(df, "t", "db", native={"body": ("varchar", 800), "at": ("datetime", 0)}, dialect="sqlserver").first()
    assert row.text_rev == ["x"] and row.date_text == [datetime(2024, 1, 2)]
    assert row.text == ["x", row.unique_id] and len(row.unique_id) == 64


def test_ids_repeat_and_tell_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    first, again = (table_to_documents(df, "t", "db").select("unique_id").collect() for _ in range(2))
    assert first == again and first[0] != first[1]
    fresh = [table_to_documents(df, "t", "db", random_id=True).first().unique_id for _ in range(2)]
    assert fresh[0] != fresh[1]


def test_null_id_falls_back_to_a_hash(spark):
    df = spark.createDataFrame([(None, "v"), ("k", "w")], "id string, v string")
    rows = {r.text[0]: r for r in table_to_documents(df, "t", "db", id_column="id").collect()}
    assert rows["k"].unique_id == "k"
    assert len(rows["v"].unique_id) == 64 and rows["v"].unique_id in rows["v"].text


def test_number_is_told_apart_by_its_point(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("-3.",)], "n string")
    docs = table_to_documents(df, "t", "db", native={"n": ("NUMBER", 22)}, dialect="oracle").collect()
    assert sorted(list(d.fields)[0] for d in docs) == ["n", "n", "n_i"]


CATALOG = ["a", "c", "c1", "g", "h", "j", "k", "r", "s", "t", "u", "Z"]


def test_buckets(spark):
    df = spark.createDataFrame([(n,) for n in CATALOG], "table_nm string")
    got = {r.table_nm: r.b for r in df.select("table_nm", cat.range_bucket(df.table_nm).alias("b")).collect()}
    assert got == {"a": 0, "c": 0, "Z": 0, "c1": 1, "g": 1, "h": 2, "j": 2, "k": 3, "r": 3, "s": 4, "t": 4, "u": 5}


def test_resume_without_start_gives_nothing(spark):
    df = spark.createDataFrame([(n,) for n in CATALOG], "table_nm string")
    assert cat.resume_from_table(df, "nowhere").count() == 0
    assert [r.table_nm for r in cat.resume_from_table(df, "T").orderBy("table_nm").collect()] == ["t", "u"]


def test_split_keeps_names_that_hold_the_word(spark):
    df = spark.createDataFrame([("my android and x > 1 and y < 2",), ("plain",)], "s string")
    got = [tuple(r.v) for r in df.select(cat.split_selection(df.s).alias("v")).collect()]
    assert got == [("my android", "x > 1 and y < 2"), ("plain", None)]


def test_exclude_by_list_or_table(spark):
    df = spark.createDataFrame([("A",), ("b",)], "table_nm string")
    banned = spark.createDataFrame([("a",), ("a",)], "table_nm string")
    assert cat.exclude_tables(df, ["a"]).count() == 1
    assert cat.exclude_tables(df, banned).count() == 1


def test_delta_plan_is_empty_after_a_full_import(spark):
    source = spark.createDataFrame([("t", "BASE TABLE", 3), ("u", "VIEW", 2)], "table_nm string, table_type string, source_n long")
    full = spark.createDataFrame([("t", 3), ("u", 5)], "table_nm string, n long")
    assert plan_tables(source, stored=full).count() == 0
    part = spark.createDataFrame([("t", 2)], "table_nm string, n long")
    assert [r.table_nm for r in plan_tables(source, stored=part).collect()] == ["t", "u"]
    assert plan_tables(source, stored=part, exclude=["U"], bucket=4).count() == 1


def test_a_failing_table_does_not_stop_the_others(spark):
    job = TableImport("db", {"good": lambda: spark.range(3), "bad": lambda: spark.read.parquet("/nowhere/at/all")})
    docs, failed = import_tables(job, ["bad", "good", "unknown"], {"good": "good and id > 0"})
    assert docs.count() == 2 and set(failed) == {"bad", "unknown"}


def test_upsert_is_idempotent_and_last_write_wins(spark):
    stored = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "unique_id string, v int, seq int")
    batch = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 9, 1)], "unique_id string, v int, seq int")
    once = upsert(stored, batch, order=["seq"])
    assert {(r.unique_id, r.v) for r in once.collect()} == {("a", 1), ("b", 3), ("c", 9)}
    assert sorted(upsert(once, batch, order=["seq"]).collect()) == sorted(once.collect())


def test_a_hot_id_is_combined_before_the_shuffle(spark):
    hot = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS unique_id", "id AS seq")
    out = latest_by_id(hot, "unique_id", ["seq"])
    assert out.where("unique_id = 'hot'").first().seq == 29_997
    assert out.count() == 20_001
    assert out._jdf.queryExecution().toString().count("partial_max_by") >= 1


def test_plans_follow_the_schema(spark):
    plans = plan_columns(spark.createDataFrame([(1, 2.0)], "vendor int, y_dts double"))
    assert [(p.field, p.kind) for p in plans] == [("vendor_s_i", "int"), ("y_dates", "other")]
