"""Any relational table to documents: naming, typing and routing of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from docweave.functions.text import CONTROL_AND_SPACE
from docweave.schema import conform


@dataclass(frozen=True)
class Route:
    """Name suffix of a kind and the catch-all fields its values also go to."""

    suffix: str = ""
    text: bool = False
    text_rev: bool = False
    date: bool = False
    money: bool = False


# Where a column of each kind goes.
ROUTES = {
    "string": Route("", text=True),
    "large_string": Route("", text=True, text_rev=True),
    "long": Route("_l", text=True),
    "int": Route("_i", text=True),
    "boolean": Route("_b"),
    "timestamp": Route("_tdt", date=True),
    "numeric": Route("", text=True),
    "money": Route("", money=True),
    "xml": Route("_t", text=True),
    "float": Route(""),
    "number": Route("_i", text=True),  # whole numbers; see _number_route
    "number_fraction": Route(""),
    "other": Route("", text=True),
}

# Fixed value: declared character length from which a column is also indexed reversed.
LARGE_TEXT = 200

# Renamed because they clash with document fields, per dialect.
RESERVED = {"sqlserver": ("table_nm", "vendor"), "oracle": ("table_nm",), "spark": ("table_nm", "vendor")}


def kind_of_native(native: str, precision: int = 0, dialect: str = "sqlserver") -> str:
    """Kind of a column from its native type name and declared length."""
    low = native.lower()
    if "char" in low or low == "uniqueidentifier":
        return "large_string" if "char" in low and precision >= LARGE_TEXT else "string"
    if low == "bigint":
        return "long"
    if low == "bit":
        return "boolean"
    if dialect == "oracle":
        words = [("number", "number"), ("time", "timestamp"), ("date", "timestamp"), ("money", "money"),
                 ("xml", "xml"), ("float", "float")]
    else:
        words = [("int", "int"), ("datetime", "timestamp"), ("numeric", "numeric"), ("money", "money"),
                 ("xml", "xml")]
        if low == "date":
            return "timestamp"
    return next((kind for word, kind in words if word in low), "other")


def kind_of_spark(dtype: T.DataType) -> str:
    """Kind of a column from its Spark type alone."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(dtype, T.LongType):
        return "long"
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return "int"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dtype, T.DecimalType):
        return "numeric"
    return "other"


def field_name(column: str, kind: str, dialect: str = "spark") -> str:
    """Field name before its type suffix.

    Names of document fields get ``_s``. A name ending like a date field whose
    values are not dates has every ``_dt`` spelled ``_date``.
    """
    name = column + "_s" if column.lower() in RESERVED[dialect] else column
    if name.endswith(("_dt", "_dts")) and kind != "timestamp":
        name = name.replace("_dt", "_date")
    return name


@dataclass(frozen=True)
class ColumnPlan:
    """How one source column becomes a field."""

    column: str
    kind: str
    field: str
    route: Route


def plan_columns(
    df: DataFrame,
    kinds: Mapping[str, str] | None = None,
    native: Mapping[str, tuple[str, int]] | None = None,
    dialect: str = "spark",
) -> list[ColumnPlan]:
    """Plan for every column of a table, from its schema only.

    ``kinds`` names kinds outright (Spark has no money type); ``native`` gives
    native type names and lengths read from the source's own catalog.
    """
    kinds, native = kinds or {}, native or {}
    plans = []
    for f in df.schema.fields:
        if f.name in kinds:
            kind = kinds[f.name]
        elif f.name in native:
            kind = kind_of_native(*native[f.name], dialect=dialect)
        else:
            kind = kind_of_spark(f.dataType)
        route = ROUTES[kind]
        plans.append(ColumnPlan(f.name, kind, field_name(f.name, kind, dialect) + route.suffix, route))
    return plans


def rename_columns(df: DataFrame, kinds: Mapping[str, str] | None = None, dialect: str = "spark") -> DataFrame:
    """The table under its field names, values untouched."""
    return df.withColumnsRenamed({p.column: p.field for p in plan_columns(df, kinds, dialect=dialect)})


# Expressions are written as SQL text: a catalog has many tables with many
# columns, and text reaches the JVM in one call per table, not one per function.

_BLANKS = f"decode(unhex('{CONTROL_AND_SPACE.encode().hex()}'), 'UTF-8')"


# Name of the id while a row is mapped; no source column is called this.
ROW_ID = "__docweave_row_id"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str | None) -> str:
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_sql(column: str, dtype: T.DataType, kind: str) -> str:
    """A column value as text, null where it is null or blank."""
    c = quoted(column)
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN btrim({c}, {_BLANKS}) <> '' THEN {c} END"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
    if kind == "money":
        # an amount beyond the money type stays as it is written
        return f"coalesce(CAST(try_cast({c} AS DECIMAL(19,4)) AS STRING), CAST({c} AS STRING))"
    return f"CAST({c} AS STRING)"


def is_fraction_sql(text: str) -> str:
    """A number written with a decimal point."""
    return f"({text}) RLIKE '^([-0-9]*)[.]([0-9]*)$'"


def hashed_id_sql(table_nm: str, values: Iterable[str]) -> str:
    """Deterministic id of a row, so a repeated import replaces it."""
    parts = ", ".join(f"coalesce({v}, chr(30))" for v in values)
    return f"sha2(concat_ws(chr(31), {literal(table_nm)}, {parts}), 256)"


def table_to_documents(
    df: DataFrame,
    table_nm: str,
    database_nm: str,
    *,
    id_column: str | None = None,
    key_columns: Iterable[str] | None = None,
    kinds: Mapping[str, str] | None = None,
    native: Mapping[str, tuple[str, int]] | None = None,
    dialect: str = "spark",
    vendor: str | None = None,
    categories: Iterable[str] = (),
    random_id: bool = False,
) -> DataFrame:
    """Every row of a table as one document.

    The id is the id column, or a hash of ``key_columns`` (all columns when not
    given; naming the keys keeps column pruning), which then is searchable too.
    ``random_id`` gives each row an id of its own on every import instead. The
    result is one projection: no shuffle, and unused pieces are pruned.
    """
    plans = plan_columns(df, kinds, native, dialect)
    types = {f.name: f.dataType for f in df.schema.fields}
    text = {p.column: value_sql(p.column, types[p.column], p.kind) for p in plans}

    if random_id:
        made = "uuid()"
    else:
        keys = list(key_columns) if key_columns else list(types)
        made = hashed_id_sql(table_nm, [value_sql(k, types[k], "other") for k in keys])
    if id_column is not None:
        made = f"coalesce({text[id_column]}, {made})"

    pairs, catch_all, rev, dates, money = [], [], [], [], []
    for p in plans:
        value, route = text[p.column], p.route
        name = literal(p.field)
        if p.kind == "number":
            fraction = is_fraction_sql(value)
            name = f"CASE WHEN {fraction} THEN {literal(p.field.removesuffix('_i'))} ELSE {name} END"
            catch_all.append(f"CASE WHEN NOT {fraction} THEN {value} END")
        elif route.text:
            catch_all.append(value)
        if route.text_rev:
            rev.append(value)
        if route.date:
            dates.append(f"CAST({quoted(p.column)} AS TIMESTAMP)")
        if route.money:
            money.append(f"CAST({quoted(p.column)} AS DOUBLE)")
        pairs.append(f"CASE WHEN ({value}) IS NOT NULL THEN struct({name} AS key, {value} AS value) END")
    # an id made here is searchable like a value
    catch_all.append(ROW_ID if id_column is None else f"CASE WHEN ({text[id_column]}) IS NULL THEN {ROW_ID} END")

    def kept(values: list[str], item: str) -> str:
        return f"array_compact(array({', '.join(values)}))" if values else f"CAST(array() AS ARRAY<{item}>)"

    labels = ", ".join(literal(c) for c in categories)
    return conform(
        df.selectExpr("*", f"{made} AS {ROW_ID}").selectExpr(
            f"{ROW_ID} AS unique_id",
            f"{literal(database_nm)} AS source_nm",
            f"{literal(database_nm)} AS database_nm",
            f"{literal(table_nm)} AS table_nm",
            f"{literal(vendor)} AS vendor",
            "'Database' AS media_format",
            f"CAST(array({labels}) AS ARRAY<STRING>) AS categories_nm",
            f"map_from_entries(array_compact(array({', '.join(pairs)}))) AS fields",
            f"{kept(catch_all, 'STRING')} AS text",
            f"{kept(rev, 'STRING')} AS text_rev",
            f"{kept(dates, 'TIMESTAMP')} AS date_text",
            f"{kept(money, 'DOUBLE')} AS money_text",
        )
    )


def greatest_sql(df: DataFrame, kinds: Mapping[str, str] | None = None, dialect: str = "spark") -> tuple[str, str]:
    """Greatest date (microseconds) and greatest amount of the document of a row, before it is one."""
    plans = plan_columns(df, kinds, dialect=dialect)

    def greatest(columns: list[str], kind: str) -> str:
        values = [f"CAST({quoted(c)} AS {kind})" for c in columns]
        return f"array_max(array({', '.join(values)}))" if values else f"CAST(NULL AS {kind})"

    date = greatest([p.column for p in plans if p.route.date], "TIMESTAMP")
    return f"unix_micros({date})", greatest([p.column for p in plans if p.route.money], "DOUBLE")


def typed_fields(df: DataFrame, key: str, kinds: Mapping[str, str] | None = None, dialect: str = "spark") -> DataFrame:
    """Long form of the routing: one row per row and column with a value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for p in plan_columns(df, kinds, dialect=dialect):
        value = value_sql(p.column, types[p.column], p.kind)
        cells.append(
            f"CASE WHEN ({value}) IS NOT NULL THEN struct({literal(p.field)} AS field_nm, {literal(p.kind)} AS value_kind, "
            f"{value} AS value, {p.route.text} AS in_text, {p.route.date} AS in_date, {p.route.money} AS in_money) END"
        )
    return df.selectExpr(quoted(key), f"inline(array_compact(array({', '.join(cells)})))")
