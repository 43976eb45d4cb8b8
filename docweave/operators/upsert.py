"""Replace-by-id: the last write of a document wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def latest_by_id(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one last in ``order``.

    ``max_by`` combines before the shuffle, so an id written many times sends
    one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def latest_of(incoming: DataFrame, order: Sequence[str] = (), key: str = "unique_id") -> DataFrame:
    """One row per id of a batch; without an order, one picked the same way each time."""
    if order:
        return latest_by_id(incoming, key, order)
    # A map has no hash of its own; its sorted entries have.
    parts = [
        F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in incoming.schema.fields
    ]
    tied = incoming.withColumn("_tie", F.xxhash64(*parts))
    return latest_by_id(tied, key, ["_tie"]).drop("_tie")


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "unique_id", order: Sequence[str] = ()) -> DataFrame:
    """``stored`` with the documents of ``incoming`` added or replacing theirs.

    Only incoming rows are de-duplicated; stored rows are kept unless their id
    comes in again. Catalyst broadcasts the ids of a small batch by its size.
    """
    newest = latest_of(incoming, order, key)
    kept = stored.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest)
