"""Connected components of documents that share content.

In every round each node that still has edges hooks onto its smallest neighbour, whether smaller or not. By that
rule two nodes can point at each other but no longer cycle can arise; of such a pair the smaller one is the root.
Trees collapse by pointer jumping, edges are renamed to their roots, loops dropped and repeats removed. Every
node joins another, so at least half of those with edges are gone after each round, whatever the order of their
names along a chain. Tables between steps are written to the shared folder, and dropped when they are done with.
The component of a node is the smallest node of it.

Joins on a node's name are split at hot keys (``join_unique``), so a hub costs no single task its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.runtime import HOT_ROWS, Stage, is_empty, join_unique


def _roots(stage: Stage, parents: DataFrame) -> DataFrame:
    """``node, root`` of a forest given as ``node, parent``, whose roots are their own parents."""
    current, held = parents, parents
    while True:
        up = current.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        step = stage.put(join_unique(current, up, "parent").select("node", "parent", "root"))
        stage.drop(held)
        if is_empty(step.where("root <> parent")):
            return step.select("node", "root")
        current, held = step.select("node", F.col("root").alias("parent")), step


def components(nodes: DataFrame, edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``node, component`` of every row of ``nodes`` (column ``node``); ``edges`` has ``u, v``.

    Null ends and loops are no edges; nodes without edges are components of their own.
    """
    stage = Stage(nodes.sparkSession, "components")
    clean = edges.where("u is not null and v is not null and u <> v")
    left = stage.put(clean.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    labels = stage.put(left.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("label", F.col("node")))
    while not is_empty(left):
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = stage.put(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent")))
        back = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("back"))
        mutual = (F.col("back") == F.col("node")) & (F.col("node") < F.col("parent"))
        rooted = join_unique(hooks, back, "parent", hot_rows=hot_rows).select("node", F.when(mutual, F.col("node")).otherwise(F.col("parent")).alias("parent"))
        roots = _roots(stage, stage.put(rooted))
        stage.drop(hooks)
        renamed = join_unique(labels, roots.select(F.col("node").alias("label"), "root"), "label", "left", hot_rows)
        new_labels = stage.put(renamed.select("node", F.coalesce("root", "label").alias("label")))
        half = stage.put(join_unique(left, roots.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", hot_rows=hot_rows).select("ru", "v"))
        moved = join_unique(half, roots.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", hot_rows=hot_rows).where("ru <> rv")
        contracted = stage.put(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
        for old in (left, labels, half):
            stage.drop(old)
        left, labels = contracted, new_labels
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    found = stage.put(join_unique(labels, smallest, "label", hot_rows=hot_rows).select("node", "component"))
    stage.drop(labels)
    unique = nodes.select("node").distinct()
    return unique.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def content_edges(rows: DataFrame, doc: str, digest: str) -> DataFrame:
    """``u, v`` from the smallest document of each digest to the others that hold it."""
    pairs = rows.where(F.col(digest).isNotNull()).select(F.col(doc).alias("v"), F.col(digest).alias("h")).distinct()
    pairs = Stage(rows.sparkSession, "digests").put(pairs)
    heads = pairs.groupBy("h").agg(F.min("v").alias("u"))
    return join_unique(pairs, heads, "h").where("u <> v").select("u", "v").distinct()
