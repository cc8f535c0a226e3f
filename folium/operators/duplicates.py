"""Exact duplicates by fingerprint and near duplicates by vectors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.functions.text import fingerprint
from folium.runtime import Stage, is_empty, join_bounded, join_unique


def order_key(path: str | Column, index: str | Column) -> Column:
    """Corpus order: path by its components, then position in the document."""
    p = F.col(path) if isinstance(path, str) else path
    i = F.col(index) if isinstance(index, str) else index
    return F.struct(F.split(p, "/").alias("path"), i.alias("index"))


def latest_rows(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """One row per key: the one with the latest stamp, so a later run replaces an earlier one; of equal stamps one by its hash.

    Texts stay where they are: the keys that occur more than once are found on key and stamp alone, with map-side
    combining, and joined back (broadcast where they are measured to be few). Rows with a null key are all kept.
    """
    others = [c for c in df.columns if c != key]
    stage = Stage(df.sparkSession, "latest")
    per = df.select(key, stamp).where(F.col(key).isNotNull()).groupBy(key, stamp).agg(F.count("*").alias("_c"))
    latest = per.groupBy(key).agg(F.max(F.struct(stamp, "_c")).alias("_w"), F.sum("_c").alias("_n")).where("_n > 1")
    again = stage.put(latest.select(key, F.col(f"_w.{stamp}").alias("_at"), F.col("_w._c").alias("_same"), F.lit(True).alias("_again")))
    joined = join_bounded(df, again, [key], "left", salt=16).where(F.col("_again").isNull() | F.col(stamp).eqNullSafe(F.col("_at")))
    if is_empty(again.where("_same > 1")):
        return joined.select(*df.columns)
    one = joined.where("_same > 1").groupBy(key).agg(F.max_by(F.struct(*others), F.xxhash64(*others)).alias("_row"))
    single = joined.where("_same is null or _same = 1").select(*df.columns)
    return single.unionByName(one.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))


def mark_duplicates(df: DataFrame, key: str, text: str | None, order: Column) -> DataFrame:
    """``df`` with ``content_hash`` and ``duplicate_of``: the first row of its hash in ``order``, null for that row.

    Without ``text`` the column ``content_hash`` must be there already, so that no text is shuffled.

    The first row of each hash comes from an aggregate with map-side combining and is joined back, so a
    text that makes up a third of the table is no single task's window.
    """
    hashed = (df.withColumn("content_hash", fingerprint(text)) if text else df).withColumn("_order", order)
    first = hashed.groupBy("content_hash").agg(F.min(F.struct("_order", key)).alias("_f"), F.count("*").alias("_n"))
    heads = first.where("_n > 1").select("content_hash", F.col(f"_f.{key}").alias("_first"))
    out = join_unique(hashed, heads, "content_hash", "left") if text is None else hashed.join(heads, "content_hash", "left")
    return out.withColumn("duplicate_of", F.when(F.col("_first") != F.col(key), F.col("_first"))).drop("_order", "_first")


def duplicate_clusters(marked: DataFrame, key: str) -> DataFrame:
    """One row per exact-duplicate cluster: its first row and its number of copies."""
    return marked.where("duplicate_of is not null").groupBy("duplicate_of").agg(F.count("*").alias("n_copies"), F.min(key).alias("smallest_copy"))


def repeated_hashes(df: DataFrame, text: str) -> DataFrame:
    """Fingerprints that occur more than once, with their number of occurrences."""
    return df.groupBy(fingerprint(text).alias("content_hash")).agg(F.count("*").alias("n")).where("n > 1")


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with the vector scaled to length 1; rows without a usable vector are dropped."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    scaled = df.withColumn("_norm", norm).where("_norm > 0")
    return scaled.withColumn(vector, F.transform(vector, lambda x: x.cast("double") / F.col("_norm"))).drop("_norm")


#: Vectors of a block of the exact comparison, and of a block of a bucket of the hashed one.
BLOCK = 2_000
BUCKET = 500
#: Chance that the hashed comparison misses a pair at the threshold, share of all pairs that may meet by chance, and tables at most.
MISS, CHANCE, MOST_TABLES = 0.001, 0.005, 2_000


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _prepared(df: DataFrame, key: str, vector: str, kind: str, digest: str | None) -> DataFrame:
    """Written ``id, kind, v, digest`` with unit vectors; rows with a null id or kind are left out."""
    cols = [F.col(key).alias("id"), F.col(kind).alias("kind"), F.col(vector).alias("v"), (F.col(digest) if digest else F.col(key).cast("string")).alias("digest")]
    return Stage(df.sparkSession, "vectors").put(unit_vectors(df.select(*cols).where("id is not null and kind is not null"), "v"))


def _cells(rows: DataFrame, group: list[str], size: int, seed: int) -> DataFrame:
    """Rows of every group in blocks of about ``size``, repeated for each pair ``i <= j`` of blocks that theirs is in; ``side`` is 0 in the first."""
    counts = rows.groupBy(*group).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    wide = join_bounded(rows, counts.where("blocks > 1"), group, "left", salt=16).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = wide.withColumn("mine", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")).cast("int"))
    other = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).withColumn("side", (F.col("mine") > F.col("other")).cast("int"))


def vector_pairs(df: DataFrame, key: str, vector: str, kind: str, threshold: float, digest: str | None = None, block: int = BLOCK) -> DataFrame:
    """``id_a < id_b, cosine``: all pairs of one kind at or above the threshold, not of one digest.

    Exact comparison in cells: the rows of each kind are cut into blocks of about ``block`` rows, and every pair of
    blocks is one matrix product in one task, so no kind is compared in a single task and none twice. The work is
    quadratic in a kind; ``hashed_vector_pairs`` is the way for large tables.
    """
    rows = _prepared(df, key, vector, kind, digest)
    id_type = dict(rows.dtypes)["id"]

    def compare(t: pa.Table) -> pa.Table:
        ids, digests = t.column("id").to_pylist(), t.column("digest").to_pylist()
        m = _matrix(t.column("v"))
        side, same = t.column("side").to_numpy(), bool(t.column("i")[0].as_py() == t.column("j")[0].as_py())
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        x, y = np.nonzero(m[left] @ m[right].T >= threshold - 1e-9)
        found = []
        for a, b in zip(left[x], right[y]):
            if (not same or a < b) and digests[a] != digests[b] and ids[a] != ids[b]:
                c = float(np.dot(m[a], m[b]))
                if c >= threshold:
                    found.append((min(ids[a], ids[b]), max(ids[a], ids[b]), c))
        cols = list(zip(*found)) or [[]] * 3
        return pa.table([pa.array(cols[0], t.schema.field("id").type), pa.array(cols[1], t.schema.field("id").type), pa.array(cols[2], pa.float64())], names=["id_a", "id_b", "cosine"])

    return _cells(rows, ["kind"], block, 5).groupBy("kind", "i", "j").applyInArrow(compare, f"id_a {id_type}, id_b {id_type}, cosine double")


def hash_plan(n: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits and tables for ``n`` vectors of a kind, so that a pair at the threshold is missed with chance ``miss``.

    The fewest bits with which unrelated vectors meet at a rate of ``CHANCE`` and ``BUCKET`` others each at most, or, at
    a low threshold, those that take ``MOST_TABLES`` tables; that makes candidates more, and loses none.
    """
    meet = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    bits, tables = 4, 1
    for b in range(4, 40):
        t = 1 if meet >= 1 else math.ceil(math.log(miss) / math.log1p(-(meet**b)))
        if t > MOST_TABLES and b > 4:
            break
        bits, tables = b, t
        if tables <= CHANCE * 2**bits and n * tables <= BUCKET * 2**bits:
            break
    return bits, tables


def hashed_candidates(rows: DataFrame, dims: int, bits: int, tables: int, seed: int) -> DataFrame:
    """Distinct ``kind, x, y`` (x < y) that share a bucket of random hyperplanes; large buckets are compared in blocks spread over tasks."""
    planes = np.random.default_rng(seed).standard_normal((tables * bits, dims))
    id_type = dict(rows.dtypes)["id"]

    def spread(batches):
        weights = (1 << np.arange(bits)).astype(np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            m = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            signs = (m @ planes.T > 0).reshape(len(m), tables, bits)
            code = (signs * weights).sum(axis=2) + (np.arange(tables, dtype=np.int64) << 40)[None, :]
            take = pa.array(np.repeat(np.arange(len(m)), tables))
            yield pa.RecordBatch.from_arrays([b.column(n).take(take) for n in ("id", "kind")] + [pa.array(code.ravel())], names=["id", "kind", "code"])

    codes = Stage(rows.sparkSession, "codes").put(rows.select("id", "kind", "v").mapInArrow(spread, f"id {id_type}, kind {dict(rows.dtypes)['kind']}, code long"))
    cells = _cells(codes, ["kind", "code"], BUCKET, 5).select("kind", "code", "i", "j", "side", "id")
    x = cells.where("side = 0").withColumnRenamed("id", "p")
    y = cells.where("side = 1 or i = j").select("kind", "code", "i", "j", F.col("id").alias("q"))
    met = x.join(y, ["kind", "code", "i", "j"]).where("p <> q and (i < j or p < q)")
    return met.select("kind", F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct()


def hashed_vector_pairs(
    df: DataFrame, key: str, vector: str, kind: str, threshold: float, dims: int, bits: int | None = None, tables: int | None = None, seed: int = 3, digest: str | None = None
) -> DataFrame:
    """Like ``vector_pairs``, with candidates from random hyperplanes; exact on what it compares.

    Two vectors with angle a meet in one of ``tables`` tables of ``bits`` planes with chance
    1 - (1 - (1 - a/pi)**bits)**tables. Without ``bits`` and ``tables`` both follow from the number of vectors and the threshold (``hash_plan``).
    """
    rows = _prepared(df, key, vector, kind, digest)
    if bits is None or tables is None:
        largest = rows.groupBy("kind").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        bits, tables = hash_plan(largest, threshold)
    met = hashed_candidates(rows, dims, bits, tables, seed)
    vx = rows.select(F.col("id").alias("x"), F.col("v").alias("vx"), F.col("digest").alias("dx"))
    vy = rows.select(F.col("id").alias("y"), F.col("v").alias("vy"), F.col("digest").alias("dy"))
    both = met.join(vx, "x").join(vy, "y").where("dx <> dy")
    id_type = dict(rows.dtypes)["id"]

    def check(batches):
        for b in batches:
            if b.num_rows:
                u, v = (b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for c in ("vx", "vy"))
                c = np.einsum("ij,ij->i", u, v)
                ok = pa.array(c >= threshold)
                yield pa.RecordBatch.from_arrays([b.column("x").filter(ok), b.column("y").filter(ok), pa.array(c).filter(ok)], names=["id_a", "id_b", "cosine"])

    return both.select("x", "y", "vx", "vy").mapInArrow(check, f"id_a {id_type}, id_b {id_type}, cosine double")


def first_seen(df: DataFrame, keys: list[str], order: list[Column | str], flag: str) -> DataFrame:
    """``df`` with ``flag``: whether the row is the first of its keys in ``order``."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    matched = [df[k].eqNullSafe(first[k]) for k in keys]
    cond = matched[0]
    for m in matched[1:]:
        cond = cond & m
    out = df.join(first, cond, "left").drop(*[first[k] for k in keys])
    return out.withColumn(flag, F.struct(*order) == F.col("_first")).drop("_first")
