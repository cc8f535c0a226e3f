"""Splits that keep related records together.

Method: connected components over records that share any entity, by alternating large-star and
small-star steps, then a hash of the component falls into ranges proportional to the wanted shares.

Records are reduced to their distinct entity sets first: the graph has entities as nodes, and each
distinct set contributes a path of edges. A hot entity costs nothing more than its distinct sets. Both
star steps are a minimum per node (combined map-side) joined back to the edges, with hot nodes taken out of
the shuffle (``join_unique``), never a collected neighbourhood. Edge tables are written to the shared folder after every step.

Records whose entities are all null form a component of their own by record key. Repeated rows of one
record share its entities. Blank and unevenly spelled existing splits are normalised or null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.runtime import Stage, join_unique

# Spellings of the three splits after trimming and lower-casing.
SPLIT_NAMES = {"train": "train", "training": "train", "val": "val", "valid": "val", "validation": "val", "dev": "val", "test": "test", "testing": "test"}


def split_name(col: Column) -> Column:
    """Normalised split (train, val, test), null where there is none."""
    bare = F.lower(F.regexp_replace(col, r"[\s\p{Z}]+", ""))
    return F.create_map(*[F.lit(x) for kv in SPLIT_NAMES.items() for x in kv])[bare]


def page_entity(doc_id: Column) -> Column:
    """``project/page path`` of a ``docs_raw/<project>/<version>/<page path>``; null where it has another form."""
    parts = F.split(doc_id, "/")
    page = F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(1))), "/")
    return F.when(F.size(parts) >= 4, F.concat_ws("/", parts[1], page))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return join_unique(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = join_unique(down, least, "u")
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def star_components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node, component`` (smallest node) of every node of the edges ``u, v``, loops included."""
    nodes = stage.put(edges.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    current = stage.put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(current)
    while state[0]:
        large = stage.put(_large_star(current))
        small = stage.put(_small_star(large))
        stage.drop(large)
        stage.drop(current)
        current, before = small, state
        state = _state(current)
        if state == before:
            break
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return join_unique(nodes, stars, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def entity_components(df: DataFrame, record: str, entities: dict[str, Column]) -> DataFrame:
    """``record, component`` for every distinct non-null record; records sharing any entity share it."""
    stage = Stage(df.sparkSession, "entities")
    named = [F.when(e.isNotNull(), F.concat(F.lit(f"{name}:"), e.cast("string"))) for name, e in entities.items()]
    own = F.concat(F.lit("~record:"), df[record].cast("string"))
    sets = df.where(df[record].isNotNull()).select(df[record].alias("record"), F.array_compact(F.array(*named)).alias("es"), own.alias("own"))
    sets = sets.select("record", F.when(F.size("es") > 0, F.array_sort("es")).otherwise(F.array("own")).alias("es"))
    distinct = sets.select("es").distinct()
    n = F.size("es")
    links = distinct.select(F.explode(F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.struct(F.get("es", i).alias("u"), F.coalesce(F.get("es", i + 1), F.get("es", i)).alias("v")))).alias("e")).select("e.u", "e.v")
    # a record repeated with other entities links them all
    repeated = sets.select("record", F.get("es", F.lit(0)).alias("first")).groupBy("record").agg(F.min("first").alias("u"), F.max("first").alias("v")).where("u <> v").select("u", "v")
    components = star_components(links.unionByName(repeated), stage)
    keyed = stage.put(sets.select("record", F.get("es", F.lit(0)).alias("node")))
    return join_unique(keyed, components, "node").groupBy("record").agg(F.min("component").alias("component"))


def reached_shares(assigned: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Per split: its target share, records, components and reached share of the records."""
    total = sum(shares.values())
    per = assigned.groupBy("split").agg(F.count("*").alias("records"), F.count_distinct("component").alias("components"))
    goal = assigned.sparkSession.createDataFrame([(s, v / total) for s, v in shares.items()], "split string, target_share double")
    out = goal.join(F.broadcast(per), "split", "left")  # one row per split on both sides
    return out.select("split", "target_share", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("components", F.lit(0)).alias("components"),
                      F.coalesce(F.col("records") / F.sum("records").over(Window.partitionBy()), F.lit(0.0)).alias("reached_share"))


def assign(components: DataFrame, shares: dict[str, float], seed: int = 29) -> DataFrame:
    """``components`` with ``split``: the component's hash in proportional ranges, in the given order."""
    total = sum(shares.values())
    point = F.xxhash64("component", F.lit(seed)).cast("double") / 2.0**64 + 0.5
    bounds, acc = [], 0.0
    for name, share in shares.items():
        acc += share / total
        bounds.append((acc, name))
    pick = reduce(lambda rest, b: F.when(point < b[0], F.lit(b[1])).otherwise(rest), reversed(bounds[:-1]), F.lit(bounds[-1][1]))
    return components.withColumn("split", pick)
