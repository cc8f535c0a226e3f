"""Filling fixed-capacity containers with items, leaving little room unused.

Method: conflict-constrained best fit. Items are spread by a hash over blocks of bounded size; inside a
block they are placed in falling size. Open containers are kept by their residual room, and a bitmap of
the residuals in use answers "which is the smallest residual that still takes this item" (successor
search). Each container carries two bitmaps, of the sources and of the duplicate clusters it holds:
a container never holds two items of one duplicate cluster, nor items of more than ``max_sources``
sources. If the tightest container conflicts, the search goes on to the next tightest, and a new one is
opened only when none is compatible. Items larger than the capacity are cut: full pieces take a
container each, the remainder is placed like any other item.

An item of null or zero size takes no room and is placed like one of size 0. Null sources and clusters
conflict with nothing. Ties in size are ordered by key, so the result is deterministic. Keys must be
unique; of repeated keys one is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of one block: a task places this many at most on average, and each block leaves one container open.
BLOCK_ITEMS = 20_000

SCHEMA = "key long, piece int, n_pieces int, size long, container string, position int, used long"


def place(sizes: list[int], clusters: list, sources: list, capacity: int, max_sources: int) -> tuple[list[int], list[int]]:
    """Container index of each item (none above ``capacity``) and the room used in each container.

    Containers of one residual are kept by source bitmap, so a bitmap is tested once for all its
    containers. Items of one cluster and size stand next to each other and are placed in one sweep over
    the residuals, as each container takes at most one of them.
    """
    seen: dict = {}
    for c in clusters:
        if c is not None:
            seen[c] = seen.get(c, 0) + 1
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(c for c, n in seen.items() if n > 1))}
    source_bit = {s: 1 << i for i, s in enumerate(sorted({s for s in sources if s is not None}))}
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], cluster_bit.get(clusters[i], 0), i))
    by_room: dict[int, dict[int, list[int]]] = {}
    in_use = 0  # bit r is set where a container with residual room r is open
    used: list[int] = []
    held: list[int] = []  # cluster bitmaps
    where = [0] * len(sizes)

    def tightest(size: int):
        """Residuals in use from ``size`` on, in rising order."""
        rest, room = in_use >> size, size
        while rest:
            step = (rest & -rest).bit_length() - 1
            room, rest = room + step, rest >> step
            yield room
            room, rest = room + 1, rest >> 1

    def put(i: int, b: int, mask: int) -> None:
        nonlocal in_use
        used[b] += sizes[i]
        where[i] = b
        left = capacity - used[b]
        by_room.setdefault(left, {}).setdefault(mask, []).append(b)
        in_use |= 1 << left

    at = 0
    while at < len(order):
        i = order[at]
        size, cb = sizes[i], cluster_bit.get(clusters[i], 0)
        run = at + 1
        while cb and run < len(order) and sizes[order[run]] == size and clusters[order[run]] == clusters[i]:
            run += 1
        todo = order[at:run]
        at = run
        moved: list[tuple[int, int, int]] = []
        for room in tightest(size):
            masks = by_room[room]
            for mask in list(masks):
                k = 0
                bins = masks[mask]
                while k < len(bins) and todo:
                    bit = source_bit.get(sources[todo[0]], 0)
                    if (mask | bit).bit_count() > max_sources:
                        break
                    if held[bins[k]] & cb:
                        k += 1
                        continue
                    moved.append((todo.pop(0), bins[k], mask | bit))
                    bins[k] = bins[-1]
                    bins.pop()
                if not bins:
                    del masks[mask]
                if not todo:
                    break
            if not masks:
                del by_room[room]
                in_use &= ~(1 << room)
            if not todo:
                break
        for i in todo:
            used.append(0)
            held.append(0)
            moved.append((i, len(used) - 1, source_bit.get(sources[i], 0)))
        for i, b, mask in moved:
            held[b] |= cb
            put(i, b, mask)
    return where, used


def pack(
    df: DataFrame,
    key: str,
    size: str,
    capacity: int,
    source: str | None = None,
    cluster: str | None = None,
    max_sources: int = 4,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Assign every item, or every piece of one above ``capacity``, to a container and a position in it.

    Returns ``key, piece, n_pieces, size, container, position, used``; ``used`` is the room taken in the
    container. The number of blocks follows the counted rows, so blocks keep their size at any scale.
    """
    none = F.lit(None).cast("string")
    items = df.where(df[key].isNotNull()).select(
        df[key].cast("long").alias("key"),
        F.greatest(F.coalesce(df[size].cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        (df[source].cast("string") if source else none).alias("source"),
        (df[cluster].cast("string") if cluster else none).alias("cluster"),
    )
    # of repeated keys one row is kept whole, the smallest
    items = items.groupBy("key").agg(F.min(F.struct("size", "source", "cluster")).alias("_row")).select("key", "_row.*")
    n_blocks = max(1, math.ceil(df.count() / block_items))
    blocked = items.withColumn("block", F.pmod(F.xxhash64("key", F.lit(11)), F.lit(n_blocks)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py() if table.num_rows else 0
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        t = table.take(pa.array(order))
        keys, total = t.column("key").to_pylist(), t.column("size").to_pylist()
        sources, clusters = t.column("source").to_pylist(), t.column("cluster").to_pylist()
        rows: list[tuple] = []
        small = [(i, s % capacity if s > capacity else s) for i, s in enumerate(total) if s <= capacity or s % capacity]
        where, used = place([s for _, s in small], [clusters[i] for i, _ in small], [sources[i] for i, _ in small], capacity, max_sources)
        fill: dict[int, int] = {}
        for (i, s), w in zip(small, where):
            n = max(1, math.ceil(total[i] / capacity))
            fill[w] = fill.get(w, -1) + 1
            rows.append((keys[i], n - 1, n, s, f"{block}-{w}", fill[w], used[w]))
        at = len(used)
        for i, s in enumerate(total):
            if s > capacity:
                n = math.ceil(s / capacity)
                for piece in range(s // capacity):
                    rows.append((keys[i], piece, n, capacity, f"{block}-{at}", 0, capacity))
                    at += 1
        cols = list(zip(*rows)) if rows else [[]] * 7
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        names = ["key", "piece", "n_pieces", "size", "container", "position", "used"]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return blocked.groupBy("block").applyInArrow(run, SCHEMA)
