"""Seams for models: texts to embed, a deterministic stand-in embedder, and batched calls with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame, functions as F


def entity_text(type_: Column, name: Column, spec: Column, unit: Column) -> Column:
    """``type: name [spec] [unit]`` without the parts that are blank."""
    part = lambda c: F.when(F.trim(c) != "", F.concat(F.lit(" ["), F.trim(c), F.lit("]")))
    return F.concat(type_, F.lit(": "), name, F.coalesce(part(spec), F.lit("")), F.coalesce(part(unit), F.lit("")))


def chunk_text(breadcrumb: Column, text: Column) -> Column:
    return F.concat_ws("\n", F.nullif(breadcrumb, F.lit("")), F.nullif(F.trim(text), F.lit("")))


def hash_embed(texts: list[str | None], dim: int) -> np.ndarray:
    """Signed hashing of words into unit vectors; blank texts embed as ``[EMPTY]``. A stand-in for a model."""
    out = np.zeros((len(texts), dim), "f4")
    for i, t in enumerate(texts):
        for w in (t or "").lower().split() or ["[EMPTY]"]:
            h = zlib.crc32(w.encode())
            out[i, h % dim] += 1.0 if h & (1 << 31) else -1.0
    n = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(n > 0, n, 1.0)


def with_retry(call: Callable, tries: int = 5, first: float = 1.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """Exponential backoff around a call."""

    def run(*args):
        for i in range(tries):
            try:
                return call(*args)
            except Exception:
                if i == tries - 1:
                    raise
                sleep(min(most, first * 2**i))

    return run


def embed(df: DataFrame, key: str, text: str, dim: int = 64, batch: int = 100, embedder: Callable[[list[str | None], int], np.ndarray] = hash_embed) -> DataFrame:
    """(key, embedding): texts go to the embedder in batches; its answers must have the dimension."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = with_retry(embedder)
        for whole in batches:
            for b in (whole.slice(i, batch) for i in range(0, whole.num_rows, batch)):
                v = np.asarray(call(b.column(1).to_pylist(), dim), "f4")
                if v.shape != (b.num_rows, dim):
                    raise ValueError(f"the embedder gave {v.shape}, not {(b.num_rows, dim)}")
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * dim, pa.int32()), pa.array(v.reshape(-1)))], [key, "embedding"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, embedding array<float>")
