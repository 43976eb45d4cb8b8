"""Connected components of links between keys, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docweave.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of the links (a, b) the least node it is linked with.

    Each round gives every node its least neighbour, follows that map twice and
    contracts the links to what they join now, without repeats. Links only get
    fewer; stars and chains of stars need two or three rounds. Every round is
    written to the shared folder, nothing goes to the driver but whether links
    are left. No links give no rows.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    edges = cut_lineage(edges.distinct(), "links")
    maps = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m"))
        up = cut_lineage(up.select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "roots")
        for _ in range(2):
            higher = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            up = up.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        up = cut_lineage(up, "roots")
        maps.append(up)
        for end in ("a", "b"):
            new = up.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
            edges = edges.join(new, end)
        edges = edges.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        edges = cut_lineage(edges.distinct(), "links")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).filter("false")
    out = maps[0]
    for up in maps[1:]:
        higher = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
        out = out.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return out
