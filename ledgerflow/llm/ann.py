"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes smallest distance: with M the largest norm of all
rows, a vector x is hashed as (x / M, sqrt(1 - |x/M|^2)) and a query q as
(q / |q|, 0). Each of ``tables`` tables cuts ``projections`` Gaussian projections
of width ``width`` into cells; a vector's cells are its bucket. A query visits
``probes`` buckets of each table in estimated success order: the perturbations of
its own bucket by ascending sum of squared distances to the cell walls crossed.

Index and probes meet by a join on (table, bucket), as packed rows. Buckets with
many vectors or queries are dealt into stripes by their counted size, so a hot
bucket is many cells and none of its rows is left out. Every candidate is scored
against the original vectors; each cell keeps a query's best ``k``, the tables'
lists are merged and ranked again.

A query that finds fewer than ``k`` candidates although there are more visits
every bucket of the first table instead.

Parameters: the projections come from ``seed`` alone, M is taken over all rows;
nothing is fitted on a sample. Recall against brute force is in the README.

Defined cases: as ``vectors.usable``; zero vectors take no part either; vectors of
different length never meet; ties go to the smaller vec_id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import joined_blocks, matrices, usable

VECTORS_A_CELL = 65_536
QUERIES_A_CELL = 8_192
PACKED = "dim int, t int, bucket long, n int, ids binary, vecs binary"
SCHEMA = pa.schema([("dim", pa.int32()), ("t", pa.int32()), ("bucket", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary())])
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def hash_table(dim: int, t: int, projections: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim, t])
    return rng.normal(size=(dim + 1, projections)), rng.uniform(0, width, projections)


def bucket_ids(cells: np.ndarray) -> np.ndarray:
    """One whole number for each row of cells (cells beyond 2^15 wrap together, which only adds candidates)."""
    out = np.zeros(len(cells), np.int64)
    for j in range(cells.shape[1]):
        out = out * np.int64(1_000_003) + cells[:, j]
    return out


def probe_order(offsets: np.ndarray, width: float, probes: int) -> list[list[tuple[int, int]]]:
    """The first ``probes`` perturbation sets, (projection, -1 or +1) each, by ascending estimated cost."""
    m = len(offsets)
    walls = np.concatenate([offsets, width - offsets])  # distance to the lower, then the upper wall
    order = np.argsort(walls, kind="stable")
    cost = (walls[order] ** 2).tolist()
    steps = [(int(i % m), -1 if i < m else 1) for i in order]
    out, heap = [[]], [(cost[0], (0,))]
    while heap and len(out) < probes:
        c, chosen = heapq.heappop(heap)
        if len({steps[i][0] for i in chosen}) == len(chosen):
            out.append([steps[i] for i in chosen])
        last = chosen[-1]
        if last + 1 < len(cost):
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (c + cost[last + 1], (*chosen, last + 1)))
    return out


def _rows(dim: int, t: int, buckets: np.ndarray, ids: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(buckets, kind="stable")
    keys, starts = np.unique(buckets[order], return_index=True)
    out = []
    for key, at in zip(keys.tolist(), np.split(order, starts[1:]), strict=True):
        out.append({"dim": dim, "t": t, "bucket": key, "n": len(at), "ids": ids[at].tobytes(), "vecs": m[at].tobytes()})
    return pa.RecordBatch.from_pylist(out, schema=SCHEMA)


def _index(largest: float, tables: int, projections: int, width: float, seed: int):
    def index(batches):
        for batch in batches:
            for ids, m in matrices(batch):
                x = m / largest
                x = np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))])
                for t in range(tables):
                    a, b = hash_table(m.shape[1], t, projections, width, seed)
                    yield _rows(m.shape[1], t, bucket_ids(np.floor((x @ a + b) / width).astype(np.int64)), ids, m)
    return index


def _probe(tables: int, projections: int, width: float, probes: int, seed: int):
    def probe(batches):
        for batch in batches:
            for ids, m in matrices(batch):
                q = np.hstack([m / np.linalg.norm(m, axis=1, keepdims=True), np.zeros((len(m), 1))])
                for t in range(tables):
                    a, b = hash_table(m.shape[1], t, projections, width, seed)
                    y = (q @ a + b) / width
                    home = np.floor(y).astype(np.int64)
                    visited, who = [], []
                    for i, (cell, offset) in enumerate(zip(home, (y - home) * width, strict=True)):
                        for changes in probe_order(offset, width, probes):
                            near = cell.copy()
                            for j, step in changes:
                                near[j] += step
                            visited.append(near)
                            who.append(i)
                    yield _rows(m.shape[1], t, bucket_ids(np.array(visited)), ids[who], m[who])
    return probe


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, adding the components in order: the same double wherever a pair meets."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def _nearest(k: int):
    def nearest(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if queries.num_rows and vectors.num_rows:
            dim = queries["dim"][0].as_py()
            q_ids, q = joined_blocks(queries, dim, np.float64)
            ids, x = joined_blocks(vectors, dim, np.float64)
            step = max(1, 4_000_000 // len(ids))
            for i in range(0, len(q_ids), step):
                s = q[i:i + step] @ x.T
                s[q_ids[i:i + step, None] == ids[None, :]] = -np.inf
                # the product's own rounding may swap near ties: keep a margin, then score the kept ones in fixed order
                margin = 1e-12 * (np.abs(q[i:i + step]).sum(axis=1) * np.abs(x).max() + 1e-300)
                least = np.partition(s, -k, axis=1)[:, -k] - margin if len(ids) > k else np.full(len(s), -np.inf)
                qs, xs = np.nonzero((s >= least[:, None]) & (s > -np.inf))
                exact = inner_products(q[i + qs], x[xs])
                order = np.lexsort((ids[xs], -exact, qs))
                qs, xs, exact = qs[order], xs[order], exact[order]
                keep = np.arange(len(qs)) - np.searchsorted(qs, qs) < k
                parts.append((q_ids[i + qs[keep]], ids[xs[keep]], exact[keep]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], schema=HITS)
    return nearest


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = hits.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meet(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Hits of probes and index rows of equal (dim, t, bucket), in stripes by the buckets' sizes."""
    key = ["dim", "t", "bucket"]
    stripes = (index.groupBy(*key).agg(F.ceil(F.sum("n") / VECTORS_A_CELL).cast("int").alias("xs"))
               .join(probes.groupBy(*key).agg(F.ceil(F.sum("n") / QUERIES_A_CELL).cast("int").alias("qs")), key))
    own = lambda n: F.pmod(F.xxhash64("ids"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = index.join(stripes, key).withColumn("x", own("xs")).withColumn("q", every("qs"))
    q = probes.join(stripes, key).withColumn("q", own("qs")).withColumn("x", every("xs"))
    cell = [*key, "x", "q"]
    pick = lambda d: d.select(*cell, "ids", "vecs").groupBy(*cell)
    return pick(q).cogroup(pick(x)).applyInArrow(_nearest(k), "query_id long, vec_id long, score double")


def search(embeddings: DataFrame, k: int = 20, every: int = 20, tables: int = 8, projections: int = 4, width: float = 2.0,
           probes: int = 10, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row whose vec_id is divisible by ``every``."""
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    vectors = stored(usable(embeddings).withColumn("norm", length).where("norm > 0"), "vectors")
    largest, n = vectors.agg(F.max("norm"), F.count("*")).first()
    asking = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    index = stored(vectors.select("vec_id", "embedding").mapInArrow(_index(largest or 1.0, tables, projections, width, seed), PACKED), "index")
    visits = stored(asking.mapInArrow(_probe(tables, projections, width, probes, seed), PACKED), "visits")
    found = stored(_ranked(_meet(index, visits, k), k), "found")

    # as many candidates as a query could find at all: the other vectors of its length
    of_length = vectors.groupBy(F.size("embedding").alias("dim")).agg((F.count("*") - 1).alias("others"))
    counted = found.groupBy("query_id").agg(F.count("*").alias("n_found"))
    short = (asking.withColumn("dim", F.size("embedding")).join(of_length, "dim")
             .join(counted, F.col("vec_id") == F.col("query_id"), "left")
             .where(F.coalesce("n_found", F.lit(0)) < F.least(F.lit(k), "others")).select("vec_id", "embedding", "dim"))
    if short.isEmpty():
        return found
    buckets = index.where("t = 0").select("dim", "t", "bucket").distinct()
    exhaustive = (short.join(buckets, "dim")
                  .select("dim", "t", "bucket", F.lit(1).alias("n"), F.col("vec_id").alias("id"), "embedding"))

    def pack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([{**{c: row[c] for c in ("dim", "t", "bucket", "n")}, "ids": np.int64(row["id"]).tobytes(),
                                                   "vecs": np.array(row["embedding"]).tobytes()}], schema=SCHEMA)

    rest = _ranked(_meet(index.where("t = 0"), exhaustive.mapInArrow(pack, PACKED), k), k)
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*rest.columns).unionByName(rest)
