"""Assigning weighted components to train, val and test, largest first.

Components are taken by falling weight, ties by a seeded order; each goes to the split that is furthest
below its target (ties: train, test, val). The choice among components of one weight depends only on
how many came before, so the plan is made on the driver over the distinct weights, and each component finds its split from its rank among
those of its weight. This gives the same result as going through the components one by one. There are at most
sqrt(2 x total weight) distinct weights, as d of them add up to d * d / 2 or more: 1.4 million for 10**12 chunks.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.operators.prefix import running_sum

ORDER = ("train", "test", "val")


def targets(total: float, test_fraction: float, val_fraction: float) -> dict[str, float]:
    return {"train": total * (1 - test_fraction - val_fraction), "test": total * test_fraction, "val": total * val_fraction}


def _taken(goal: np.ndarray, held: np.ndarray, w: float, n: int) -> np.ndarray:
    """How many of ``n`` equal items of weight ``w`` each split takes."""
    return np.bincount(_choices(goal, held, w, np.arange(n)), minlength=3) if n <= 64 else _taken_many(goal, held, w, n)


def _before(goal: np.ndarray, held: np.ndarray, w: float, s: int, k: np.ndarray) -> np.ndarray:
    """Number of picks made before split ``s`` makes its pick ``k`` (0-based)."""
    out = k.astype(np.int64).copy()
    mine = goal[s] - (held[s] + k * w)
    for o in range(3):
        if o == s:
            continue
        # picks j of the other split with a larger remaining need, or an equal one and an earlier place
        j = np.floor((goal[o] - held[o] - mine) / w).astype(np.int64)
        for _ in range(2):  # settle rounding on the exact comparison
            need = goal[o] - (held[o] + j * w)
            j = np.where((need > mine) | ((need == mine) & (o < s)), j + 1, j)
        need = goal[o] - (held[o] + (j - 1) * w)
        j = np.where((need > mine) | ((need == mine) & (o < s)), j, j - 1)
        out += np.maximum(j, 0)
    return out


def _choices(goal: np.ndarray, held: np.ndarray, w: float, ranks: np.ndarray) -> np.ndarray:
    """Split (index in ORDER) of the items of these ranks."""
    out = np.zeros(len(ranks), np.int64)
    for s in range(3):
        lo, hi = np.full(len(ranks), -1, np.int64), ranks.astype(np.int64) + 1
        while (hi - lo > 1).any():  # the largest k whose pick comes at this rank or before
            mid = (lo + hi) // 2
            ok = _before(goal, held, w, s, np.maximum(mid, 0)) <= ranks
            lo, hi = np.where(ok & (hi - lo > 1), mid, lo), np.where(ok | (hi - lo <= 1), hi, mid)
        hit = (lo >= 0) & (_before(goal, held, w, s, np.maximum(lo, 0)) == ranks)
        out[hit] = s
    return out


def _taken_many(goal: np.ndarray, held: np.ndarray, w: float, n: int) -> np.ndarray:
    out = []
    for s in range(3):
        lo, hi = -1, n
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if int(_before(goal, held, w, s, np.array([mid]))[0]) < n else (lo, mid)
        out.append(lo + 1)
    return np.array(out)


def shuffled_ties(components: DataFrame, seed: int) -> DataFrame:
    """``components`` with ``tie``: the place of each in a seeded shuffle of the sorted names, as a plain run over a list orders
    equal weights. The shuffle needs all names in one list, so this is for reproducing small runs; ``seeded_tie`` is the way at scale.
    """
    names = sorted(r["component"] for r in components.select("component").distinct().collect())
    random.Random(seed).shuffle(names)
    places = components.sparkSession.createDataFrame([(c, i) for i, c in enumerate(names)], f"component {dict(components.dtypes)['component']}, tie long")
    return components.join(places, "component")


def seeded_tie(component: Column, seed: int) -> Column:
    """A seeded order of components as 60 bits of a hash."""
    return F.conv(F.substring(F.md5(F.concat(component.cast("string"), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long")


def assign_by_weight(components: DataFrame, tie: Column, test_fraction: float = 0.2, val_fraction: float = 0.2) -> DataFrame:
    """``component, weight, split`` from ``component, weight``; ``tie`` (a long from 0 to 2**60) orders equal weights."""
    rows = components.select("component", F.col("weight").cast("long").alias("weight"), tie.alias("_tie"))
    hist = rows.groupBy("weight").agg(F.count("*").alias("n")).orderBy(F.desc("weight")).collect()
    total = sum(r["weight"] * r["n"] for r in hist)
    goal = np.array([targets(total, test_fraction, val_fraction)[s] for s in ORDER])
    held, state = np.zeros(3), {}
    for r in hist:
        state[r["weight"]] = tuple(held)
        if r["weight"] > 0:
            held = held + _taken(goal, held, float(r["weight"]), r["n"]) * float(r["weight"])
    known = components.sparkSession.sparkContext.broadcast((goal, state))
    bucketed = rows.withColumn("_bucket", F.shiftright("_tie", 54).cast("int")).withColumn("_one", F.lit(1))
    ranked = running_sum(bucketed, ["weight"], "_bucket", ["_tie", "component"], "_one", "_rank")

    def run(batches):
        goal, state = known.value
        for b in batches:
            w = b.column("weight").to_numpy(zero_copy_only=False)
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            out = np.zeros(len(w), np.int64)
            for x in np.unique(w):
                at = np.flatnonzero(w == x)
                held = np.array(state[int(x)])
                out[at] = _choices(goal, held, float(x), rank[at]) if x > 0 else int(np.argmax(goal - held))
            yield pa.RecordBatch.from_arrays([b.column("component"), b.column("weight"), pa.array([ORDER[i] for i in out], pa.string())], names=["component", "weight", "split"])

    kind = dict(rows.dtypes)["component"]
    return ranked.select("component", "weight", "_rank").mapInArrow(run, f"component {kind}, weight long, split string")
