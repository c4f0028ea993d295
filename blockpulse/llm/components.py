"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockpulse.llm.scratch import Scratch


def roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of `links` (a, b: different longs, each pair once).

    In each round every node picks the first node in its neighbourhood, itself included, in the order
    of a hash, and links are moved to the picked nodes. Links inside a neighbourhood vanish, so groups
    of copies are done in a round or two and long chains shrink by a constant factor. Picks are written
    before they are joined to the links: a node with very many links is then a skewed side of a plain
    join, which Spark splits.
    """
    picks: list[DataFrame] = []
    edges, written = links, False
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select("b", "a")).toDF("node", "other")
        mine, first = F.struct(F.xxhash64("node"), "node"), F.min(F.struct(F.xxhash64("other"), "other"))
        best = ends.groupBy("node").agg(first.alias("first"))
        pick = scratch.write(best.select("node", F.when(mine < F.col("first"), F.col("node")).otherwise(F.col("first.other")).alias("pick")), "picks")
        moved = edges.join(pick.toDF("a", "to_a"), "a").join(pick.toDF("b", "to_b"), "b").where("to_a <> to_b")
        step = scratch.write(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        if written:
            scratch.drop(edges)
        edges, written = step, True
        picks.append(pick)
    if not picks:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = picks[0].toDF("node", "root")
    for pick in picks[1:]:
        later = pick.toDF("root", "later")
        found = found.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return found


def smallest_ids(nodes: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root, component_id): one node, and the smallest id, of each node's component.

    `nodes` holds one row per node: node long, id (its own smallest id; may be NULL).
    """
    members = scratch.write(roots(links, scratch).join(nodes, "node"), "members")
    smallest = scratch.write(members.groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    relabelled = members.join(smallest, "root").select("node", "root", "component_id")
    out = nodes.join(relabelled, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )
    table = scratch.write(out, "classes")
    scratch.drop(members, smallest)
    return table
