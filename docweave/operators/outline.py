"""Bookmark trees flattened to a list, parents before children."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docweave.session import cut_lineage


def orphans(nodes: DataFrame) -> DataFrame:
    """Nodes that name a parent which their document does not have."""
    known = nodes.select("doc", F.col("id").alias("parent"))
    return nodes.where(F.col("parent").isNotNull()).join(known, ["doc", "parent"], "left_anti").select(*nodes.columns)


def flatten_outline(nodes: DataFrame, width: int = 19) -> DataFrame:
    """Depth and pre-order path of every node of ``nodes(doc, id, parent, ord, title)``.

    Every node knows a stretch of its path and where that begins; a round joins
    the stretch above, so stretches double and a tree of depth n needs log2(n)
    rounds. Rounds are written to the shared folder: plans stay small and a lost
    executor replays none. A node whose parent is missing stands at the top (see
    :func:`orphans`), as do those of a cycle. Sort by ``(doc, path)`` for reading
    order; ``width`` holds every long.
    """
    known = nodes.select("doc", F.col("id").alias("parent"), F.lit(True).alias("_known")).distinct()
    up = F.when(F.col("_known"), F.col("parent"))
    step = F.lpad(F.col("ord").cast("string"), width, "0")
    state = nodes.join(known, ["doc", "parent"], "left").select(
        "doc", "id", "title", up.alias("up"), F.when(up.isNull(), 0).otherwise(1).alias("depth"), step.alias("path"), step.alias("own")
    )
    state = cut_lineage(state)
    rounds = state.count().bit_length()
    while rounds and not state.where("up IS NOT NULL").isEmpty():
        above = state.select(
            "doc", F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("path").alias("_path")
        )
        state = state.join(above, ["doc", "up"], "left").select(
            "doc",
            "id",
            "title",
            F.col("_up").alias("up"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.concat_ws("/", "_path", "path").alias("path"),
            "own",
        )
        state, rounds = cut_lineage(state), rounds - 1
    ends = F.col("up").isNull()
    return state.select(
        "doc", "id", "title", F.when(ends, F.col("depth")).otherwise(0).alias("depth"), F.when(ends, F.col("path")).otherwise(F.col("own")).alias("path")
    )
