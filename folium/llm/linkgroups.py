"""Consolidating pairwise matches into groups.

Method: deterministic Borůvka hooking. In every round each component selects its smallest incident edge
under one total order of edges, which makes the selections a forest but for mutual pairs; of a mutual
pair the smaller label becomes the root. Trees collapse by pointer doubling, edges are relabelled with
their roots, loops dropped and the rest deduplicated, until no edge remains. The number of components
that still have edges at least halves per round.

Selection is a plain minimum with map-side combining, so a path with a third of all pairs costs one row
per task; the joins on a path take hot paths out of the shuffle (``join_unique``). All tables between steps are written to the shared folder. Nothing is collected but row counts.

Pairs with a null or empty end are no link; a pair within one path, repeated pairs and either direction
are harmless: a path linked only with itself forms a group of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.runtime import Stage, is_empty, join_unique


def _collapse(stage: Stage, parents: DataFrame) -> DataFrame:
    """Roots of a forest of (node, parent): each parent is replaced by its parent until nothing changes."""
    held = current = stage.put(parents)
    while True:
        up = current.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = join_unique(current, up, "parent", "left").select("node", "parent", F.coalesce("above", "parent").alias("root"))
        step = stage.put(step)
        stage.drop(held)
        if is_empty(step.where("root <> parent")):
            out = step.select("node", "root")
            out._folium_path = step._folium_path  # so that it can be dropped
            return out
        held, current = step, step.select("node", F.col("root").alias("parent"))


def link_groups(links: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``node, group`` per linked node; ``group`` is the smallest node of its group."""
    spark = links.sparkSession
    stage = Stage(spark, "linkgroups")
    ends = links.select(links[a].cast("string").alias("x"), links[b].cast("string").alias("y"))
    ends = ends.where("x is not null and y is not null and x <> '' and y <> ''")
    pairs = stage.put(ends.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())
    labels = stage.put(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("label", F.col("node")))
    edges = stage.put(pairs.where("u <> v"))
    stage.drop(pairs)
    while not is_empty(edges):
        incident = edges.select("u", "v", F.explode(F.array("u", "v")).alias("node"))
        chosen = incident.groupBy("node").agg(F.min(F.struct("u", "v")).alias("e"))
        hooks = stage.put(
            chosen.select("node", F.when(F.col("e.u") == F.col("node"), F.col("e.v")).otherwise(F.col("e.u")).alias("parent"))
        )
        back = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("back"))
        rooted = join_unique(hooks, back, "parent").select(
            "node", F.when((F.col("back") == F.col("node")) & (F.col("node") < F.col("parent")), F.col("node")).otherwise(F.col("parent")).alias("parent")
        )
        roots = _collapse(stage, rooted)
        stage.drop(hooks)
        ru = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        rv = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        half = stage.put(join_unique(edges, ru, "u").select("ru", "v"))
        moved = join_unique(half, rv, "v").where("ru <> rv")
        nxt = stage.put(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
        renamed = join_unique(labels, roots.select(F.col("node").alias("label"), "root"), "label", "left")
        new_labels = stage.put(renamed.select("node", F.coalesce("root", "label").alias("label")))
        for old in (edges, labels, half, roots):
            stage.drop(old)
        edges, labels = nxt, new_labels
    smallest = labels.groupBy("label").agg(F.min("node").alias("group"))
    return join_unique(labels, smallest, "label").select("node", "group")
