"""Database and folder imports put together from the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from docweave.operators import catalog as cat
from docweave.operators.files import file_documents, inherit_fields
from docweave.operators.tables import table_to_documents
from docweave.schema import conform, union_documents


@dataclass
class TableImport:
    """What to import from a database and how."""

    database_nm: str
    tables: Mapping[str, Callable[[], DataFrame]]
    kinds: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    native: Mapping[str, Mapping[str, tuple[str, int]]] = field(default_factory=dict)
    keys: Mapping[str, Iterable[str]] = field(default_factory=dict)
    id_columns: Mapping[str, str] = field(default_factory=dict)
    dialect: str = "spark"
    vendor: str | None = None


def plan_tables(
    catalog: DataFrame,
    *,
    exclude: Iterable[str] = (),
    start: str | None = None,
    stored: DataFrame | None = None,
    bucket: int | None = None,
) -> DataFrame:
    """Tables to import, in name order.

    ``catalog`` holds (table_nm, table_type, source_n). Denied and finished
    tables are left out, then those before the start table and outside the
    name bucket.
    """
    out = cat.exclude_tables(catalog, exclude) if exclude else catalog
    if start is not None:
        out = cat.resume_from_table(out, start)
    if bucket is not None:
        out = out.where(cat.range_bucket(out["table_nm"]) == bucket)
    if stored is not None:
        todo = cat.delta_import_plan(out, stored).where("action = 'import'").select("table_nm")
        out = out.join(todo, "table_nm", "left_semi")
    return out.orderBy("table_nm")


def import_tables(
    job: TableImport, names: Iterable[str], selections: Mapping[str, str] | None = None
) -> tuple[DataFrame | None, dict[str, str]]:
    """Documents of the named tables as one lazy plan, and the tables that failed.

    The loop only builds plans. A table that cannot be opened is reported and
    the others go on.
    """
    parts, failed = [], {}
    for name in names:
        try:
            df = job.tables[name]()
            if selections and name in selections:
                df = cat.select_rows(df, selections[name])
            parts.append(
                table_to_documents(
                    df,
                    name,
                    job.database_nm,
                    id_column=job.id_columns.get(name),
                    key_columns=job.keys.get(name),
                    kinds=job.kinds.get(name),
                    native=job.native.get(name),
                    dialect=job.dialect,
                    vendor=job.vendor,
                )
            )
        except (PySparkException, KeyError) as problem:
            failed[name] = str(problem).splitlines()[0]
    return (union_documents(*parts) if parts else None), failed


def import_files(files: DataFrame, records: Iterable[DataFrame], **options) -> DataFrame:
    """Documents of files and of the records found in them.

    A file with records is represented by them, others by one document.
    ``records`` hold ``path``, ``unique_id`` and the fields of their own.
    """
    whole = file_documents(files, **options)
    split = [conform(inherit_fields(r, whole, "path")) for r in records]
    if not split:
        return whole
    found = union_documents(*split)
    return union_documents(whole.join(found.select("path").distinct(), "path", "left_anti"), found)
