"""Vectors as packed blocks: which rows take part, packing, unpacking."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096  # most vectors in a packed row


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that take part.

    Rows without id, null or empty vectors and vectors that hold a null or
    non-finite component take none. Of rows that repeat an id the smallest
    vector (component by component) counts, once.
    """
    e = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    e = e.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite))
    return e.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of a batch of vec_id, embedding for each vector length in it."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
    lists = batch.column("embedding")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield ids[at], flat[starts[at][:, None] + np.arange(dim)[None, :]]


def packed(vectors: DataFrame, convert: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Rows of up to ``CHUNK`` vectors of one length: dim, n, norm (largest), ids, vecs (binary)."""

    def pack(batches):
        for batch in batches:
            for ids, m in matrices(batch):
                order = np.argsort(ids, kind="stable")
                for i in range(0, len(order), CHUNK):
                    at = order[i:i + CHUNK]
                    block = np.ascontiguousarray(convert(m[at]))
                    norm = float(np.sqrt((block.astype(np.float64) ** 2).sum(axis=1)).max())
                    yield pa.RecordBatch.from_pylist([{"dim": block.shape[1], "n": len(at), "norm": norm,
                                                       "ids": ids[at].tobytes(), "vecs": block.tobytes()}], schema=SCHEMA)

    return vectors.mapInArrow(pack, "dim int, n int, norm double, ids binary, vecs binary")


SCHEMA = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("norm", pa.float64()), ("ids", pa.binary()), ("vecs", pa.binary())])


def narrowest(v: np.ndarray) -> np.ndarray:
    """Whole numbers in the fewest of 16, 32 or 64 bits that hold them all."""
    most = np.abs(v).max(initial=0)
    return v.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def widened(vecs: bytes, count: int, dim: int) -> np.ndarray:
    """Whole numbers of any width, ``count`` vectors, in 64 bits."""
    return np.frombuffer(vecs, f"i{len(vecs) // max(count * dim, 1) or 8}").reshape(-1, dim).astype(np.int64)


def joined_whole_blocks(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """All vectors of the rows of ``table``, each stored in its own width: ids ascending, matrix of 64 bits."""
    ids = [np.frombuffer(b, np.int64) for b in table["ids"].to_pylist()]
    vecs = [widened(b, len(i), dim) for b, i in zip(table["vecs"].to_pylist(), ids, strict=True)]
    ids, vecs = np.concatenate(ids or [np.empty(0, np.int64)]), np.concatenate(vecs or [np.empty((0, dim), np.int64)])
    order = np.argsort(ids, kind="stable")
    return ids[order], vecs[order]


def joined_blocks(table: pa.Table, dim: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """All vectors of the rows of ``table``: ids ascending, matrix of ``kind``."""
    ids = np.concatenate([np.frombuffer(b, np.int64) for b in table["ids"].to_pylist()] or [np.empty(0, np.int64)])
    vecs = np.concatenate([np.frombuffer(b, kind).reshape(-1, dim) for b in table["vecs"].to_pylist()] or [np.empty((0, dim), kind)])
    order = np.argsort(ids, kind="stable")
    return ids[order], vecs[order]
