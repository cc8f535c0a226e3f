"""Mixing sources to target weights.

Method: low-discrepancy source schedule. Shares that the repeat caps allow are found by filling up:
sources that cannot reach their share give all they may, the rest is divided among the others in
proportion. Each source's documents are shuffled by a hash (afresh in every repetition) and laid end to
end, repetition after repetition, and cut into blocks of equal token size. Slots of the mixture carry golden-ratio points; a point is mapped
through the cumulative weights to a source, the slot's rank among the slots of that source names the
source's block, and so every stretch of the mixture holds the sources in proportion.

Documents without a source, of a source without a target, or without tokens are not selected. Sources
are compared after trimming and lower-casing. A source with a target and no documents gets share 0.
The list of targets is read to the driver (one row per source), whatever its length; a slot finds its source
by binary search.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folium.operators.prefix import running_sum
from folium.runtime import join_bounded

#: Tokens of a block, the unit that the schedule places.
BLOCK_TOKENS = 2048
#: Documents (or slots) of one bucket of the running sums, on average.
BUCKET_ROWS = 20_000

GOLDEN = 0.6180339887498949


def source_name(col):
    """The spelling by which sources are compared; null for blank ones."""
    name = F.lower(F.regexp_replace(F.btrim(col), r"[\s_-]+", "_"))
    return F.when(F.length(name) > 0, name)


def allocate(sizes: dict[str, int], shares: dict[str, float], caps: dict[str, int], total: float) -> dict[str, float]:
    """Tokens of each source: its share of ``total``, at most cap x size, the rest shared by the others."""
    given = {s: 0.0 for s in shares}
    free = {s for s in shares if sizes.get(s, 0) > 0 and shares[s] > 0 and caps[s] > 0}
    left = total
    while free and left > 0:
        weight = sum(shares[s] for s in free)
        full = {s for s in sorted(free) if caps[s] * sizes[s] <= left * shares[s] / weight}
        if not full:
            for s in free:
                given[s] = left * shares[s] / weight
            break
        for s in full:
            given[s] = float(caps[s] * sizes[s])
        left -= sum(given[s] for s in full)
        free -= full
    return given


def mix(
    docs: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    n_tokens: str = "n_tokens",
    total_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 17,
) -> DataFrame:
    """The mixture as rows ``slot, position, source, repetition, key, n_tokens``.

    ``targets`` has ``source, target_share, max_repeats``. ``total_tokens`` is the wanted size, by
    default the tokens of all documents whose source has a target. ``repetition`` counts from 0 and
    stays below the source's ``max_repeats``. A document starts in the block that holds its first token.
    """
    spark = docs.sparkSession
    goal = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null")
    wanted = goal.groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("cap"))
    rows = wanted.orderBy("source").collect()
    shares = {r["source"]: float(r["share"] or 0) for r in rows}
    caps = {r["source"]: int(r["cap"] or 0) for r in rows}
    items = (
        docs.select(docs[key].alias("key"), source_name(docs[source]).alias("source"), docs[n_tokens].cast("long").alias("n_tokens"))
        .where((F.col("n_tokens") > 0) & F.col("key").isNotNull())
    )
    items = join_bounded(items, wanted.select("source"), ["source"], "inner", salt=8)
    per = {r["source"]: (int(r["tokens"]), int(r["n"])) for r in items.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).collect()}
    sizes = {s: v[0] for s, v in per.items()}
    total = float(total_tokens if total_tokens is not None else sum(sizes.values()))
    given = allocate(sizes, shares, caps, total)
    mass = sum(given.values())
    out_type = dict(items.dtypes)["key"]
    if mass <= 0:
        return spark.createDataFrame([], f"slot long, position int, source string, repetition int, key {out_type}, n_tokens long")

    plan = [(s, given[s], sizes[s], caps[s]) for s in sorted(given) if given[s] > 0]
    blocks = spark.createDataFrame(
        [(s, size, min(cap, math.ceil(g / size) + 1)) for s, g, size, cap in plan], "source string, supply long, repeats int"
    )
    # every repetition lays the documents end to end in an order of its own
    buckets = max(1, math.ceil(max(v[1] for v in per.values()) / BUCKET_ROWS))
    laid = join_bounded(items, blocks, ["source"], "inner", salt=8).withColumn("repetition", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))
    laid = laid.withColumn("_h", F.xxhash64("key", "repetition", F.lit(seed)))
    laid = laid.withColumn("_bucket", F.floor((F.col("_h").cast("double") / 2.0**64 + 0.5) * buckets).cast("int"))
    laid = running_sum(laid, ["source", "repetition"], "_bucket", ["_h", "key"], "n_tokens", "_before")
    laid = laid.withColumn("block", F.floor((F.col("repetition") * F.col("supply") + F.col("_before")) / block_tokens))

    # slots: a golden-ratio point per slot, mapped through the cumulative weights
    n_slots = max(1, math.ceil(mass / block_tokens))
    known = spark.sparkContext.broadcast(([s for s, *_ in plan], np.cumsum([g / mass for _, g, *_ in plan])[:-1]))

    def pick(batches):
        names, bounds = known.value
        names = pa.array(names, pa.string())
        for b in batches:
            point = ((b.column(0).to_numpy() + 1) * GOLDEN) % 1.0
            yield pa.RecordBatch.from_arrays([b.column(0), names.take(pa.array(np.searchsorted(bounds, point, "right")))], names=["slot", "source"])

    slots = spark.range(n_slots).withColumnRenamed("id", "slot").mapInArrow(pick, "slot long, source string")
    slots = slots.withColumn("_bucket", F.floor(F.col("slot") / BUCKET_ROWS).cast("int")).withColumn("_one", F.lit(1))
    slots = running_sum(slots, ["source"], "_bucket", ["slot"], "_one", "block").select("slot", "source", "block")

    joined = slots.join(laid, ["source", "block"])
    within = Window.partitionBy("slot").orderBy("repetition", "_before", "key")
    return joined.select(
        "slot", (F.row_number().over(within) - 1).alias("position"), "source", "repetition", "key", "n_tokens"
    )


def reached_shares(mixture: DataFrame, docs: DataFrame, targets: DataFrame, source: str = "source", n_tokens: str = "n_tokens") -> DataFrame:
    """Per target source: its target and reached share, tokens, documents, largest repetition, and supply."""
    goal = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null")
    supply = (
        docs.select(source_name(docs[source]).alias("source"), docs[n_tokens].alias("_n"))
        .groupBy("source")
        .agg(F.sum("_n").alias("supply_tokens"))
    )
    got = mixture.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"), (F.max("repetition") + 1).alias("repeats_used")
    )
    got = got.withColumn("_all", F.sum("tokens").over(Window.partitionBy()))  # one row per target source
    got = got.withColumn("reached_share", F.col("tokens") / F.col("_all"))
    out = goal.join(got, "source", "left").join(supply, "source", "left")
    return out.select(
        "source", "target_share", "max_repeats",
        F.coalesce("supply_tokens", F.lit(0)).alias("supply_tokens"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("repeats_used", F.lit(0)).alias("repeats_used"),
        F.coalesce("reached_share", F.lit(0.0)).alias("reached_share"),
    )
