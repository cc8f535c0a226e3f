"""Text vectors: an injected model, or hashed character n-grams where none is there."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folium.functions.codepoints import from_arrow, mix64, slices

DIMS = 384


def hashed_ngrams(texts: list[str], dims: int = DIMS, n: int = 4) -> np.ndarray:
    """Unit vectors of signed counts of character ``n``-grams, whatever the model."""
    p = from_arrow(pa.array([" ".join(t.lower().split()) for t in texts], pa.large_string()))
    out = np.zeros((len(texts), dims), np.float32)
    if len(p.cps) >= n:
        h = np.zeros(len(p.cps) - n + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = mix64(h + p.cps[k : k + len(h)].astype(np.uint64) + np.uint64(1))
        row = p.rows
        ok = row[: len(h)] == row[n - 1 :]
        h, row = h[ok], row[: len(ok)][ok]
        sign = np.where(h >> np.uint64(63), -1.0, 1.0).astype(np.float32)
        np.add.at(out, (row, (h % np.uint64(dims)).astype(np.int64)), sign)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


_MODELS: dict[str, Callable[[list[str]], np.ndarray]] = {}


class WorkerModel:
    """An encoder that each worker process loads once, under ``name``, when it first needs it; only ``load`` travels with the task."""

    def __init__(self, name: str, load: Callable[[], Callable[[list[str]], np.ndarray]]):
        self.name, self.load = name, load

    def __call__(self, texts: list[str]) -> np.ndarray:
        if self.name not in _MODELS:
            _MODELS[self.name] = self.load()
        return _MODELS[self.name](texts)


def with_vectors(df: DataFrame, key: str, text: str, encode: Callable[[list[str]], np.ndarray] = hashed_ngrams) -> DataFrame:
    """``key, vector`` of every non-null text; ``encode`` is called once per batch in the worker."""
    rows = df.select(df[key].alias("key"), df[text].alias("text")).where("text is not null")
    kind = dict(rows.dtypes)["key"]

    def run(batches):
        for b in (x for whole in batches for x in slices(whole, 1)):
            if b.num_rows:
                v = np.asarray(encode(b.column(1).to_pylist()), np.float32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(v), pa.list_(pa.float32()))], names=["key", "vector"])

    return rows.mapInArrow(run, f"key {kind}, vector array<float>")
