"""Near-duplicate records with small edits, insertions or reordering.

Method: anchor-point covering. The fingerprint of a text is a row of words of w min-hash symbols over
its shingles. The anchors of a word space are the code words of the [w, w - 1] parity code over GF(p): every
word lies within covering radius 1 of the code, and for each of its w positions there is one anchor
that keeps the other symbols. A fingerprint is replicated to all anchors within the radius. Two
words at distance at most 1 (the threshold) keep w - 1 common symbols and so meet at one anchor; for this
code the ball of the radius alone suffices, the wider ball of radius plus threshold of the general
scheme is not needed. With t words a pair of similarity J is met unless all its words differ in
two symbols or more: the chance is (1 - J**w - w J**(w - 1) (1 - J))**t. ``plan`` takes w from the number of
texts, so that texts with little in common meet seldom at any size, and t so that a pair at the threshold is
missed with chance ``MISS`` at most whatever w (w = 4 and t = 12 for J = 0.6 and up to ten million texts).

At each anchor fingerprints are compared by 64 further symbols of two bits and by set size; candidates
are compared by 40 symbols of one byte; what remains is checked exactly on the shingle sets of the texts.
Both filters keep a pair at the threshold but for a chance below 0.0005.

Texts equal after lower-casing and collapsing blanks are copies and no pair. Copies with the same tokens form one
class (they differ in tokens where a blank is none to the token rule, such as a no-break space); one
representative stands for it in all comparisons, and the class is expanded only in the result. Anchors with more than ``HOT``
fingerprints are compared in a second pass, in blocks spread over tasks, so none is dropped or capped.

Null texts, content types or ids take no part, nor do texts of fewer than ``min_tokens`` tokens.
Repeated rows count once.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.functions.codepoints import Points, from_arrow, mix64, shingle_hashes, slices, tokens
from folium.runtime import Stage

#: Chance to miss a pair at the threshold, at most.
MISS = 0.0005
#: Similarity of texts with little in common, and how many such texts each may meet on average.
BACKGROUND = 0.01
CHANCE_MEETINGS = 500
FIELD = 2**31 - 1
COMPONENTS = 64
SKETCH = 40
#: Fingerprints of an anchor that one task compares on its own.
HOT = 2048
#: Rows of one partition of the anchor shuffle, on average.
ANCHOR_ROWS = 1_000_000

def plan(n: int, threshold: float) -> tuple[int, int]:
    """Symbols of a word, and words, for ``n`` texts."""
    word = 4
    while True:
        meets = threshold**word + word * threshold ** (word - 1) * (1 - threshold)
        tables = 1 if meets >= 1 else math.ceil(math.log(MISS) / math.log1p(-meets))
        if n * tables * word * BACKGROUND ** (word - 1) <= CHANCE_MEETINGS:
            return word, tables
        word += 1


def multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20240517).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normal_text(text: str) -> str:
    return " ".join(text.lower().split())


def min_hashes(h: np.ndarray, starts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Min-hash symbols (rows x factors, uint32) of the hash runs beginning at ``starts``."""
    out = np.empty((len(starts), len(factors)), np.uint32)
    for j, factor in enumerate(factors):
        out[:, j] = np.minimum.reduceat(((h * factor) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def distinct_counts(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each row (by 40 bits of the hash)."""
    key = np.sort((row.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    new = np.concatenate([[True], key[1:] != key[:-1]])
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)


def _signature(batch: pa.RecordBatch, shingle: int, min_tokens: int, symbols: int, factors: np.ndarray) -> pa.RecordBatch | None:
    ids, kinds, texts = (batch.column(i).to_pylist() for i in range(3))
    classes, first, of, copies = {}, [], [], []
    for i, (kind, text) in enumerate(zip(kinds, texts)):
        key, copy = class_ids(kind, text)
        copies.append(copy)
        if key not in classes:
            classes[key] = len(first)
            first.append(i)
        of.append(classes[key])
    if not first:
        return None
    cid = np.array(list(classes), np.int64)
    points = from_arrow(pa.array([texts[i].lower() for i in first], pa.large_string()))
    long_enough = tokens(points).count >= min_tokens
    h, row = shingle_hashes(points, shingle)
    counts = np.bincount(row, minlength=len(first))
    ok = long_enough & (counts > 0)
    if not ok.any():
        return None
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    mh = np.zeros((len(first), len(factors)), np.uint32)
    has = counts > 0
    mh[has] = min_hashes(h, starts[has], factors)
    size = np.floor(np.log(np.maximum(distinct_counts(h, row, len(first)), 1)) / math.log(1.05)).astype(np.int32)
    two = ((mh[:, :COMPONENTS] >> 7) & 3).astype(np.uint64)
    shift = (np.arange(32, dtype=np.uint64) * np.uint64(2))[None, :]
    f0 = np.bitwise_or.reduce(two[:, :32] << shift, axis=1).view(np.int64)
    f1 = np.bitwise_or.reduce(two[:, 32:] << shift, axis=1).view(np.int64)
    words = np.ascontiguousarray(mh[:, :symbols])
    sketch = np.ascontiguousarray((mh[:, :SKETCH] >> 12).astype(np.uint8))
    of = np.array(of)
    keep = np.flatnonzero(ok[of])
    if not len(keep):
        return None
    pick = of[keep]
    kind_hash = {k: int.from_bytes(hashlib.md5(k.encode()).digest()[:8], "little", signed=True) for k in set(kinds)}
    kh = np.array([kind_hash[k] for k in kinds], np.int64)[keep]
    binary = lambda m: pa.array([x.tobytes() for x in m], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(cid[pick]), pa.array(np.array(copies, np.int64)[keep]), batch.column(0).take(pa.array(keep)), pa.array(kh), pa.array(size[pick]), pa.array(f0[pick]), pa.array(f1[pick]), binary(words[pick]), binary(sketch[pick])],
        names=["cid", "copy", "id", "kh", "size", "f0", "f1", "words", "sketch"],
    )


def anchors_of(words: np.ndarray, word: int) -> np.ndarray:
    """Identifiers (rows x symbols, uint64) of all anchors within radius 1 of each word of ``word`` symbols."""
    n = len(words)
    w = words.reshape(n, -1, word).astype(np.int64) % FIELD
    total = w.sum(axis=2, keepdims=True)
    out = np.empty((n, w.shape[1], word), np.uint64)
    table = (np.arange(w.shape[1], dtype=np.uint64) + np.uint64(1))[None, :]
    for i in range(word):
        c = w.copy()
        c[:, :, i] = (w[:, :, i] - total[:, :, 0]) % FIELD  # the parity symbol of the others
        key = np.broadcast_to(mix64(table), (n, w.shape[1]))
        for q in range(word):
            key = mix64(key + c[:, :, q].astype(np.uint64))
        out[:, :, i] = key
    return out.reshape(n, -1)


def _spread(word: int):
    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            words = np.frombuffer(b"".join(b.column("words").to_pylist()), np.uint32).reshape(n, -1)
            kinds = b.column("kh").to_numpy(zero_copy_only=False).view(np.uint64)
            a = mix64(anchors_of(words, word) + kinds[:, None])  # texts of different kinds never meet
            rep = a.shape[1]
            col = lambda name: np.repeat(b.column(name).to_numpy(zero_copy_only=False), rep)  # noqa: E731, B023
            arrays = [a.ravel().view(np.int64), col("cid"), col("size"), col("f0"), col("f1")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["anchor", "cid", "size", "f0", "f1"])

    return run


_LOW = np.uint64(0x5555555555555555)


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal two-bit symbols."""
    x = a ^ b
    return 32 - np.bitwise_count((x | (x >> np.uint64(1))) & _LOW).astype(np.int64)


def _close(s, f0, f1, i, j, least: int, ratio: int) -> np.ndarray:
    near = np.abs(s[i] - s[j]) <= ratio
    i, j = i[near], j[near]
    ok = _agree(f0[i], f0[j]) + _agree(f1[i], f1[j]) >= least
    return i[ok], j[ok]


PAIR_SCHEMA = "a long, b long, anchor long, size int, f0 long, f1 long"
_NAMES = ["a", "b", "anchor", "size", "f0", "f1"]


def _pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    both = np.unique(np.stack([lo, hi], 1), axis=0) if len(lo) else np.zeros((0, 2), np.int64)
    both = both[both[:, 0] != both[:, 1]]
    none = pa.nulls(len(both), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, pa.nulls(len(both), pa.int32()), none, none], names=_NAMES)


def _hot_rows(cols) -> pa.RecordBatch:
    anchor, cid, size, f0, f1 = cols
    none = pa.nulls(len(anchor), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(cid), none, pa.array(anchor), pa.array(size), pa.array(f0), pa.array(f1)], names=_NAMES)


def _compare_sorted(least: int, ratio: int, hold: int = 200_000):
    """Compare within runs of one anchor in a stream sorted by anchor; rows of hot runs are passed on.

    At most ``hold`` rows and one run of ``HOT`` are held: once a run is known to be hot, its rows leave.
    """

    def compare(cols):
        anchor, cid, size, f0, f1 = cols
        n = len(anchor)
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        run = np.cumsum(new) - 1
        count = np.bincount(run)
        hot = count[run] > HOT
        if hot.any():
            yield _hot_rows([x[hot] for x in cols])
        u0, u1 = f0.view(np.uint64), f1.view(np.uint64)
        idx = np.flatnonzero((count[run] > 1) & ~hot)
        left, right = [], []
        lag = 1
        while len(idx):
            idx = idx[idx + lag < n]
            idx = idx[run[idx] == run[idx + lag]]
            i, j = _close(size, u0, u1, idx, idx + lag, least, ratio)
            left.append(cid[i])
            right.append(cid[j])
            lag += 1
        if left:
            yield _pairs_batch(np.concatenate(left), np.concatenate(right))

    def run(batches):
        parts: list[list[np.ndarray]] = []
        rows, hot_key = 0, None
        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            if hot_key is not None:
                k = int(np.searchsorted(cols[0], hot_key, "right"))
                if k:
                    yield _hot_rows([x[:k] for x in cols])
                cols = [x[k:] for x in cols]
                if len(cols[0]):
                    hot_key = None
            if not len(cols[0]):
                continue
            parts.append(cols)
            rows += len(cols[0])
            if rows < hold:
                continue
            cols = [np.concatenate(x) for x in zip(*parts)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last run may go on
            if cut:
                yield from compare([x[:cut] for x in cols])
            rest = [x[cut:] for x in cols]
            parts, rows = [rest], len(rest[0])
            if rows > HOT:
                yield _hot_rows(rest)
                hot_key, parts, rows = rest[0][-1], [], 0
        if parts:
            yield from compare([np.concatenate(x) for x in zip(*parts)])

    return run


def _compare_blocks(least: int, ratio: int):
    def run(table: pa.Table) -> pa.Table:
        cid = table.column("cid").to_numpy()
        size = table.column("size").to_numpy()
        f0, f1 = (table.column(c).to_numpy().view(np.uint64) for c in ("f0", "f1"))
        side = table.column("side").to_numpy()
        same = table.column("same").to_numpy()
        left = np.flatnonzero(side == 0)
        right = left if len(same) and same[0] else np.flatnonzero(side == 1)
        a, b = [], []
        for i in left:
            x, y = _close(size, f0, f1, np.full(len(right), i), right, least, ratio)
            a.append(cid[x])
            b.append(cid[y])
        got = _pairs_batch(np.concatenate(a), np.concatenate(b)) if a else _pairs_batch(np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.Table.from_batches([got]).select(["a", "b"])

    return run


def _hot_pairs(hot: DataFrame, least: int, ratio: int) -> DataFrame:
    """Pairs of hot anchors: members are cut into blocks, and each pair of blocks is one group."""
    counts = hot.groupBy("anchor").agg(F.ceil(F.count("*") / HOT).cast("int").alias("blocks"))
    rows = hot.join(counts, "anchor").withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = other.select(
        "anchor", "cid", "size", "f0", "f1", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"), (F.col("mine") == F.col("other")).alias("same"),
    )
    return cells.groupBy("anchor", "i", "j").applyInArrow(_compare_blocks(least, ratio), "a long, b long")


def _similar_sketches(least: float):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sa", "sb"))
            ok = pa.array((x == y).mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], names=["a", "b"])

    return run


def class_ids(kind: str, text: str) -> tuple[int, int]:
    """64 bits of the class of texts with equal tokens, and of the copies it belongs to; the same where no unusual blank occurs."""
    low = text.lower()
    copy = " ".join(low.split())
    spaced = " ".join(x for x in low.replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if x)
    of = lambda t: int.from_bytes(hashlib.md5(f"{kind}\0{t}".encode()).digest()[:8], "little", signed=True)
    c = of(copy)
    return (c if spaced == copy else of(f"{spaced}\0")), c


def _shingle_sets(shingle: int):
    def run(batches):
        for b in (x for whole in batches for x in slices(whole, 2)):
            cids, kinds, texts = (b.column(c).to_pylist() for c in ("cid", "kind", "text"))
            own = [i for i, c in enumerate(cids) if class_ids(kinds[i], texts[i])[0] == c]  # an id may hold several texts
            if not own:
                continue
            p: Points = from_arrow(pa.array([texts[i].lower() for i in own], pa.large_string()))
            h, row = shingle_hashes(p, shingle)
            bounds = np.searchsorted(row, np.arange(len(own) + 1))
            sets = [np.unique(h[bounds[i] : bounds[i + 1]]).tobytes() for i in range(len(own))]
            yield pa.RecordBatch.from_arrays([pa.array([cids[i] for i in own], pa.int64()), pa.array(sets, pa.binary())], names=["cid", "shingles"])

    return run


def _exact(threshold: float):
    def run(batches):
        for b in batches:
            sims = []
            for x, y in zip(b.column("xa").to_pylist(), b.column("xb").to_pylist()):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(u, v, assume_unique=True))
                sims.append(common / max(1, len(u) + len(v) - common))
            ok = pa.array([s >= threshold for s in sims], pa.bool_())
            cols = [b.column("a").filter(ok), b.column("b").filter(ok), pa.array(sims, pa.float64()).filter(ok)]
            yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "similarity"])

    return run


class NearDuplicates:
    """Near-duplicate classes of one table; ``pairs`` and ``members`` are read as often as wanted."""

    def __init__(
        self, df: DataFrame, key: str, text: str, kind: str, shingle: int = 5, threshold: float = 0.8, min_tokens: int = 0
    ):
        self.spark = df.sparkSession
        self.stage = Stage(self.spark, "neardup")
        self.shingle, self.threshold, self.min_tokens = shingle, threshold, min_tokens
        self.rows = df.select(df[key].cast("string").alias("id"), df[kind].cast("string").alias("kind"), df[text].alias("text")).where(
            "id is not null and kind is not null and text is not null"
        )
        # symbols agree with chance J; the filters leave 3.5 standard deviations at the threshold
        j = threshold
        q = j + (1 - j) / 4
        self.least = math.floor(COMPONENTS * q - 3.5 * math.sqrt(COMPONENTS * q * (1 - q)))
        self.sketch_least = max(0.0, j - 3.9 * math.sqrt(j * (1 - j) / SKETCH))
        self.ratio = math.ceil(-math.log(j) / math.log(1.05)) + 1

        self.word, tables = plan(df.count(), threshold)
        factors = multipliers(max(COMPONENTS, self.word * tables))
        schema = "cid long, copy long, id string, kh long, size int, f0 long, f1 long, words binary, sketch binary"

        def signatures(batches, shingle=shingle, min_tokens=min_tokens, symbols=self.word * tables):
            for b in (x for whole in batches for x in slices(whole, 2)):
                out = _signature(b, shingle, min_tokens, symbols, factors)
                if out is not None:
                    yield out

        self.anchors = self.word * tables
        self.signed = self.stage.put(self.rows.mapInArrow(signatures, schema))

    def members(self) -> DataFrame:
        """``cid, id``: every record and its class of equal texts."""
        return self.signed.select("cid", "id").distinct()

    def copies(self) -> DataFrame:
        """``a, b``: classes that are copies of one another although their tokens differ."""
        classes = self.signed.select("cid", "copy").distinct()
        least = classes.groupBy("copy").agg(F.min("cid").alias("a"), F.count("*").alias("n")).where("n > 1")
        return classes.join(least, "copy").where("cid <> a").select("a", F.col("cid").alias("b"))

    def pairs(self) -> DataFrame:
        """``a, b, similarity`` (a < b): all pairs of classes at or above the threshold."""
        names = ("kh", "size", "f0", "f1", "words")
        reps = self.signed.groupBy("cid").agg(*[F.first(c).alias(c) for c in names])
        n = self.signed.count()
        spread = reps.mapInArrow(_spread(self.word), "anchor long, cid long, size int, f0 long, f1 long")
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        width = max(width, math.ceil(n * self.anchors / ANCHOR_ROWS))
        met = spread.repartition(width, "anchor").sortWithinPartitions("anchor").mapInArrow(_compare_sorted(self.least, self.ratio), PAIR_SCHEMA)
        met = self.stage.put(met)
        cool = met.where("anchor is null").select("a", "b")
        hot = met.where("anchor is not null").select("anchor", F.col("a").alias("cid"), "size", "f0", "f1")
        candidates = cool if not hot.take(1) else cool.unionByName(_hot_pairs(hot, self.least, self.ratio))
        sketches = self.signed.groupBy("cid").agg(F.first("sketch").alias("s"), F.min("id").alias("id"), F.first("copy").alias("copy"))
        sa = sketches.select(F.col("cid").alias("a"), F.col("s").alias("sa"), F.col("copy").alias("ca"))
        sb = sketches.select(F.col("cid").alias("b"), F.col("s").alias("sb"), F.col("copy").alias("cb"))
        likely = candidates.distinct().join(sa, "a").join(sb, "b").where("ca <> cb").select("a", "b", "sa", "sb").mapInArrow(_similar_sketches(self.sketch_least), "a long, b long")
        likely = self.stage.put(likely)
        # the texts of the representatives that are still in question
        asked = likely.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        wanted = asked.join(sketches.select("cid", "id"), "cid")
        texts = self.rows.join(wanted, "id").select("cid", "kind", "text")
        sets = texts.mapInArrow(_shingle_sets(self.shingle), "cid long, shingles binary")
        sets = self.stage.put(sets.groupBy("cid").agg(F.first("shingles").alias("shingles")))
        xa = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("xa"))
        xb = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("xb"))
        return likely.join(xa, "a").join(xb, "b").mapInArrow(_exact(self.threshold), "a long, b long, similarity double")

    def id_pairs(self) -> DataFrame:
        """``id_a < id_b``: all pairs of different records of two different classes that are similar."""
        members = self.stage.put(self.members())
        pairs = self.stage.put(self.pairs())
        left = members.select(F.col("cid").alias("a"), F.col("id").alias("x"))
        right = members.select(F.col("cid").alias("b"), F.col("id").alias("y"))
        out = pairs.join(left, "a").join(right, "b").where("x <> y")
        return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
