"""Splitting oversized items at natural boundaries.

Method: recursive bisection. A text above the limit is cut at the strongest boundary near its midpoint
(paragraph, line, sentence, clause, word, in this order; of equal ones the nearest to the midpoint, all
within the middle half), and each half is cut again while it exceeds the limit minus the overlap. Then
every piece but the first is extended to the left by the overlap, so consecutive pieces share exactly
that many tokens and none exceeds the limit.

The core spans of the pieces (``core_start`` to ``char_end``) follow one another without gap, so joining
them gives back the text. Tokens are counted over the whole text, whatever a stored count says.

A null text has no piece; an empty text, or one within the limit, is its own single piece. A text
without any boundary is cut between tokens. Repeated rows come out repeated; other columns are dropped
but for the carried ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folium.functions.codepoints import from_arrow, slices, tokens

SENTENCE_ENDS = np.array([ord(c) for c in ".?!…。"], np.uint32)
CLAUSE_ENDS = np.array([ord(c) for c in ",;:"], np.uint32)


def boundary_strengths(cps: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Strength of cutting before each token: 5 paragraph, 4 line, 3 sentence, 2 clause, 1 word, 0 none."""
    n = len(start)
    out = np.zeros(n, np.int8)
    if n < 2:
        return out
    newlines = np.concatenate([[0], np.cumsum(cps == 10)])
    breaks = newlines[start[1:]] - newlines[end[:-1]]
    gap = start[1:] > end[:-1]
    last = cps[end[:-1] - 1]
    s = gap.astype(np.int8)
    s[gap & np.isin(last, CLAUSE_ENDS)] = 2
    s[gap & np.isin(last, SENTENCE_ENDS)] = 3
    s[breaks == 1] = 4
    s[breaks > 1] = 5
    out[1:] = s
    return out


def bisect(strength: np.ndarray, limit: int, overlap: int) -> list[int]:
    """Token positions at which cores begin; the first is 0."""
    most = limit - overlap
    n = len(strength)
    if n <= limit:
        return [0]
    cuts, todo = [], [(0, n)]
    while todo:
        lo, hi = todo.pop()
        size = hi - lo
        if size <= most:
            continue
        a, b = lo + max(1, size // 4), hi - max(1, size // 4)
        mid = (lo + hi) / 2
        at = np.arange(a, b + 1)
        best = int(at[np.argmax(strength[a : b + 1] * float(2 * size) - np.abs(at - mid))])
        cuts.append(best)
        todo += [(lo, best), (best, hi)]
    return [0, *sorted(cuts)]


def pieces(cps: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int, int, int, int]]:
    """``(char_start, core_start, char_end, n_tokens, overlap_tokens)`` of each piece of one text."""
    n = len(start)
    cores = bisect(boundary_strengths(cps, start, end), limit, overlap)
    out = []
    for k, lo in enumerate(cores):
        hi = cores[k + 1] if k + 1 < len(cores) else n
        first = max(0, lo - overlap) if k else 0
        char_end = int(start[hi]) if hi < n else len(cps)
        core = int(start[lo]) if k else 0
        out.append((int(start[first]) if k else 0, core, char_end, hi - first, lo - first))
    return out


def split_items(
    df: DataFrame, key: str, text: str, limit: int = 512, overlap: int = 60, carry: tuple[str, ...] = (), with_text: bool = True
) -> DataFrame:
    """Pieces of every text: the key, carried columns, and ``piece, n_pieces, n_tokens, overlap_tokens,
    char_start, core_start, char_end`` and the piece's ``text``. ``overlap`` must be below a fifth of ``limit``.
    """
    if not 0 <= overlap * 5 < limit:
        raise ValueError("overlap must be below a fifth of limit")
    keep = [key, *carry]
    source = df.select(*[df[c] for c in keep], df[text].alias("_text")).where("_text is not null")
    ints = ("piece", "n_pieces", "n_tokens", "overlap_tokens", "char_start", "core_start", "char_end")
    fields = [df.schema[c] for c in keep] + [T.StructField(c, T.IntegerType()) for c in ints]
    if with_text:
        fields.append(T.StructField("text", T.StringType()))

    def run(batches):
        for b in (x for whole in batches for x in slices(whole, len(keep))):
            col = b.column(len(keep))
            p = from_arrow(col)
            t = tokens(p)
            bounds = np.concatenate([[0], np.cumsum(t.count)])
            big = np.flatnonzero(t.count > limit)
            small = t.count <= limit
            take, values, texts = [], [], []
            for i in big:
                lo, hi = p.off[i], p.off[i + 1]
                a, z = bounds[i], bounds[i + 1]
                cps = p.cps[lo:hi]
                cut = pieces(cps, t.start[a:z] - lo, t.end[a:z] - lo, limit, overlap)
                if with_text:
                    whole = cps.tobytes().decode("utf-32-le")
                    texts += [whole[x[0] : x[2]] for x in cut]
                take += [i] * len(cut)
                values += [(k, len(cut), x[3], x[4], x[0], x[1], x[2]) for k, x in enumerate(cut)]
            rest = np.flatnonzero(small)
            z = np.zeros(len(rest), np.int32)
            plain = np.stack([z, z + 1, t.count[rest], z, z, z, p.lengths[rest]], 1).astype(np.int32)
            cut_rows = np.array(values, np.int32).reshape(-1, len(ints))
            numbers = np.concatenate([plain, cut_rows])
            order = pa.array(np.concatenate([rest, np.array(take, np.int64)]))
            arrays = [b.column(k).take(order) for k in range(len(keep))]
            arrays += [pa.array(numbers[:, k]) for k in range(len(ints))]
            if with_text:
                same = col.take(pa.array(rest)).cast(pa.string())
                arrays.append(pa.concat_arrays([same, pa.array(texts, pa.string())]))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))
