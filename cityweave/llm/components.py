"""Connected components of a graph of links, by the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.common import stored

#: Link ends to a file of the tables that a round leaves.
ENDS_PER_FILE = 200_000


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for every id that has a link.

    Each round takes the smallest label among the neighbours and then the label of that label, so labels
    travel by ever longer steps. Each round is written to the shared folder, which cuts the lineage; the number
    of files goes with that of the links.
    """
    ends = F.array(F.struct(F.col(a).alias("id"), F.col(b).alias("other")), F.struct(F.col(b).alias("id"), F.col(a).alias("other")))
    edges = stored(links.select(F.explode(ends).alias("e")).select("e.id", "e.other").distinct(), "links")
    files = -(-edges.count() // ENDS_PER_FILE) or 1
    first = edges.groupBy("id").agg(F.min("other").alias("m")).select("id", F.least("id", "m").alias("component"))
    labels = stored(first.coalesce(files), "labels")
    while True:
        told = edges.hint("merge").join(labels.select(F.col("id").alias("other"), "component"), "other")
        near = told.groupBy("id").agg(F.min("component").alias("near"))
        moved = labels.hint("merge").join(near, "id").select("id", F.least("component", "near").alias("next"), F.col("component").alias("before"))
        moved = stored(moved.coalesce(files), "labels")
        roots = moved.select(F.col("id").alias("next"), F.col("next").alias("root"))
        jumped = moved.hint("merge").join(roots, "next").select("id", F.least("next", "root").alias("component"), "before")
        jumped = stored(jumped.coalesce(files), "labels")
        labels = jumped.select("id", "component")
        if jumped.where("component <> before").isEmpty():
            return labels
