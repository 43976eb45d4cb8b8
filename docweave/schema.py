"""The one document schema every source is mapped to."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

_S = T.StringType()
_SA = T.ArrayType(_S)

DOCUMENT = T.StructType(
    [
        T.StructField("unique_id", _S),
        T.StructField("source_nm", _S),
        T.StructField("database_nm", _S),
        T.StructField("table_nm", _S),
        T.StructField("vendor", _S),
        T.StructField("media_format", _S),
        T.StructField("categories_nm", _SA),
        T.StructField("path", _S),
        T.StructField("web_link", _S),
        T.StructField("html_link", _S),
        T.StructField("original_link", _S),
        T.StructField("translated_link", _S),
        T.StructField("author", _S),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("metadata", T.MapType(_S, _SA)),
        T.StructField("sheet", _S),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("row_number", T.IntegerType()),
        T.StructField("header", _S),
        T.StructField("footer", _S),
        T.StructField("comments", _SA),
        T.StructField("notes", _SA),
        T.StructField("image_links", _SA),
        T.StructField("links", _SA),
        T.StructField("content", _S),
        T.StructField("fields", T.MapType(_S, _S)),
        T.StructField("text", _SA),
        T.StructField("text_rev", _SA),
        T.StructField("date_text", T.ArrayType(T.TimestampType())),
        T.StructField("money_text", T.ArrayType(T.DoubleType())),
    ]
)


# What a stored document has besides: the least and greatest of its dates and amounts. Dates are
# microseconds, as Spark by default stores timestamps in a form that has no statistics. ``bounded``
# tells rows that have no date or amount from rows stored without bounds.
BOUNDS = {
    "bounded": "true",
    "micros_min": "unix_micros(array_min(date_text))",
    "micros_max": "unix_micros(array_max(date_text))",
    "money_min": "array_min(money_text)",
    "money_max": "array_max(money_text)",
}


def with_bounds(documents: DataFrame) -> DataFrame:
    """Documents with their bounds, by which a scan can leave out files and row groups."""
    return documents.selectExpr("*", *[f"{how} AS {name}" for name, how in BOUNDS.items()])


STORED = T.StructType(
    [
        *DOCUMENT.fields,
        T.StructField("bounded", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in ("micros_min", "micros_max")],
        *[T.StructField(n, T.DoubleType()) for n in ("money_min", "money_max")],
    ]
)


def conform(df: DataFrame) -> DataFrame:
    """``df`` with exactly the document columns; missing ones are null."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in DOCUMENT.fields
        ]
    )


def union_documents(*parts: DataFrame) -> DataFrame:
    """All sources in one collection under one schema."""
    whole = conform(parts[0])
    for part in parts[1:]:
        whole = whole.unionByName(conform(part))
    return whole
