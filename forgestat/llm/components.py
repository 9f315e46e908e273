"""Connected components by repeated contraction, as DataFrame jobs.

Each round hooks every node to its smallest neighbour, shortens the chains of
hooks by pointer jumping and contracts the edges; at least every node that is
no local minimum disappears, so the number of rounds is logarithmic. Nothing is
gathered on the driver but row counts. Both sides of every join are written
tables, so a hub with many neighbours can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgestat.llm.common import saved


def _jump(hooks: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """One pointer jump; second result: how many hooks changed."""
    nxt = hooks.select(F.col("node").alias("up"), F.col("label").alias("top"))
    moved = saved(hooks.join(nxt, hooks["label"] == nxt["up"], "left")
                  .select("node", F.coalesce("top", "label").alias("label"),
                          (F.coalesce("top", "label") != F.col("label")).alias("moved")), "jump", rows)
    return moved.select("node", "label"), moved.filter("moved").count()


def _relabel(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    to = hooks.select(F.col("node").alias("_from"), F.col("label").alias("_to"))
    return (df.join(to, df[column] == to["_from"], "left")
            .withColumn(column, F.coalesce("_to", column)).drop("_from", "_to"))


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``edges(a, b)`` (bigint) -> ``(node, component)`` for every node that
    has an edge to another node; ``component`` is the smallest node reachable.

    Null ends, loops and repeated edges are ignored. No edges: no rows. ``rows``: a
    bound on the number of edges, if known.
    """
    edges = saved(edges.filter("a <> b").select(F.least("a", "b").alias("a"),
                                                F.greatest("a", "b").alias("b")).distinct(), "edges", rows)
    labels, left = None, edges.count()
    nodes = 2 * left                                     # at most
    while left:
        hooks = saved(edges.select(F.col("a").alias("node"), F.col("a").alias("near"))
                      .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
                      .groupBy("node").agg(F.min("near").alias("near"))
                      .select("node", F.least("node", "near").alias("label")), "hooks", 2 * left)
        changed = 1
        while changed:
            hooks, changed = _jump(hooks, 2 * left)
        # a node that kept its own label is a local minimum; it may still hook later
        labels = hooks if labels is None else saved(_relabel(labels, "label", hooks), "labels", nodes)
        contracted = _relabel(_relabel(edges, "a", hooks), "b", hooks).filter("a <> b")
        edges = saved(contracted.select(F.least("a", "b").alias("a"),
                                        F.greatest("a", "b").alias("b")).distinct(), "edges", left)
        left = edges.count()
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("label").alias("component"))
