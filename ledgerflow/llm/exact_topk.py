"""Exact top-k search by distributed histogram selection.

Queries are a stated set of rows, dealt into blocks; vectors are packed rows
dealt into stripes. Each round every (query block, stripe) cell scores its
vectors and counts them in BINS equal bins of the query's present score range;
the counts are summed per block, and the bin that holds the query's k-th score
becomes its next range. A range shrinks by BINS each round, so whole-number
scores need few rounds until every query knows its exact k-th score and how many
ties of it belong to the result. A last pass emits the scores above it and the
first ties by id; no cell emits more than k rows above or k ties for a query.

State is stored between rounds; a cell holds at most STRIPE vectors and a block
about BLOCK queries, however large the table. The driver sees counts and the
widest remaining range, nothing else.

Defined cases: see ``vectors.usable`` for the rows that take part; vectors of
different length never meet; fewer than k candidates give them all; ties go to
the smaller vec_id; an empty table gives an empty result; other columns are
ignored. Scores must fit 62 bits, else an error is raised. Vectors travel in the fewest of 16, 32 or 64 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored
from .vectors import joined_whole_blocks, narrowest, packed, usable, widened

BLOCK = 1024
STRIPE = 65_536
BINS = 256
LEAST = np.iinfo(np.int64).min


def whole_numbers(scale: int):
    def convert(m: np.ndarray) -> np.ndarray:
        v = np.floor(m * scale)
        if np.abs(v).max(initial=0) >= 2.0**62:
            raise ValueError("components are too large for whole-number scores")
        return narrowest(v)
    return convert


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products. Doubles hold them where they stay below 2^53."""
    bound = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    if bound >= 2.0**62:
        raise ValueError("scores are too large for 64 bits")
    if bound < 2.0**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


STATE = "dim int, g int, ids binary, vecs binary, lo binary, span binary, need binary, widest long"
STATE_SCHEMA = pa.schema([("dim", pa.int32()), ("g", pa.int32()), *[(c, pa.binary()) for c in ("ids", "vecs", "lo", "span", "need")],
                          ("widest", pa.int64())])


def _state(dim, g, ids, vecs, lo, span, need) -> pa.Table:
    return pa.Table.from_pylist([{"dim": dim, "g": g, "ids": ids.tobytes(), "vecs": bytes(vecs), "lo": lo.tobytes(),
                                  "span": span.tobytes(), "need": need.tobytes(), "widest": int(span.max(initial=0))}],
                                schema=STATE_SCHEMA)


def _read(row) -> list[np.ndarray]:
    return [np.frombuffer(row[c], np.int64).copy() for c in ("ids", "lo", "span", "need")]


def _cell_scores(state: pa.Table, chunks: pa.Table):
    """(query ids, lo, span, need, ids, scores with a query's own row at LEAST) in sub-blocks of queries."""
    row = state.to_pylist()[0]
    dim = row["dim"]
    q_ids, lo, span, need = _read(row)
    q = widened(row["vecs"], len(q_ids), dim)
    ids, x = joined_whole_blocks(chunks, dim)
    step = max(1, 8_000_000 // max(1, len(ids)))
    for i in range(0, len(q_ids), step):
        cut = slice(i, i + step)
        s = scores(q[cut], x)
        at = np.searchsorted(ids, q_ids[cut])
        own = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == q_ids[cut])
        s[np.flatnonzero(own), at[own]] = LEAST
        yield q_ids[cut], lo[cut], span[cut], need[cut], ids, s


def _width(span: np.ndarray, bins: int) -> np.ndarray:
    return np.maximum(-(-span // bins), 1)


def _count(bins: int):
    schema = pa.schema([("dim", pa.int32()), ("g", pa.int32()), ("counts", pa.binary())])

    def count(state: pa.Table, chunks: pa.Table) -> pa.Table:
        if not state.num_rows or not chunks.num_rows:
            return schema.empty_table()
        row = state.slice(0, 1).select(["dim", "g"]).to_pylist()[0]
        out = []
        for _, lo, span, _, _, s in _cell_scores(state, chunks):
            # a settled query has span 0 and counts no more
            inside = (span > 0)[:, None] & (s >= lo[:, None]) & (s - lo[:, None] < span[:, None]) & (s != LEAST)
            bin_ = (s - lo[:, None]) // _width(span, bins)[:, None]
            flat = (np.arange(len(lo))[:, None] * bins + bin_)[inside]
            out.append(np.bincount(flat, minlength=len(lo) * bins))
        return pa.Table.from_pylist([row | {"counts": np.concatenate(out).tobytes()}], schema=schema)

    return count


def _refine(bins: int):
    def refine(state: pa.Table, counts: pa.Table) -> pa.Table:
        if not state.num_rows:
            return STATE_SCHEMA.empty_table()
        row = state.to_pylist()[0]
        ids, lo, span, need = _read(row)
        total = np.zeros(len(ids) * bins, np.int64)
        for b in counts["counts"].to_pylist():
            total += np.frombuffer(b, np.int64)
        down = total.reshape(-1, bins)[:, ::-1].cumsum(axis=1)  # from the highest bin
        live, width = span > 0, _width(span, bins)
        few = live & (down[:, -1] < need)  # only in the first round: every candidate belongs to the result
        back = np.argmax(down >= need[:, None], axis=1)
        above = np.where(back > 0, down[np.arange(len(ids)), np.maximum(back - 1, 0)], 0)
        start = lo + (bins - 1 - back) * width
        # span 0, settled: lo is the k-th score, need the ties of it that belong to the result
        left = np.where(width == 1, 0, np.minimum(width, lo + span - start))
        step = live & ~few
        lo, span, need = np.where(step, start, lo), np.where(step, left, span), np.where(step, need - above, need)
        lo, span, need = np.where(few, LEAST, lo), np.where(few, 0, span), np.where(few, 0, need)
        return _state(row["dim"], row["g"], ids, row["vecs"], lo, span, need)

    return refine


def _select(state: pa.Table, chunks: pa.Table) -> pa.Table:
    parts = []
    if state.num_rows and chunks.num_rows:
        for q_ids, lo, _, need, ids, s in _cell_scores(state, chunks):
            qs, xs = np.nonzero(s > lo[:, None])
            parts.append((q_ids[qs], ids[xs], s[qs, xs]))
            qs, xs = np.nonzero((s == lo[:, None]) & (need > 0)[:, None])
            first = np.searchsorted(qs, qs)  # ids ascend, so the place within a query's ties is their rank
            keep = np.arange(len(qs)) - first < need[qs]
            qs, xs = qs[keep], xs[keep]
            parts.append((q_ids[qs], ids[xs], s[qs, xs]))
    cols = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(3)]
    return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})


def search(embeddings: DataFrame, k: int = 20, scale: int = 64, every: int = 20, bins: int = BINS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest whole-number inner products
    of every row whose vec_id is divisible by ``every``, among all other rows."""
    spark = embeddings.sparkSession
    chunks = stored(packed(usable(embeddings), whole_numbers(scale)), "chunks")
    n, norm = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("norm"), F.lit(0.0))).first()
    blocks = max(1, math.ceil(n / every / BLOCK))
    stripes = max(math.ceil(shuffle_partitions(spark) / blocks), math.ceil(2 * n / STRIPE), 1)

    def queries(batches):
        schema = pa.schema([("dim", pa.int32()), ("g", pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                vecs = widened(row["vecs"], len(ids), row["dim"])
                g = (ids // every) % blocks
                for b in np.unique(g[ids % every == 0]):
                    at = (ids % every == 0) & (g == b)
                    yield pa.RecordBatch.from_pylist([{"dim": row["dim"], "g": int(b), "ids": ids[at].tobytes(),
                                                       "vecs": narrowest(vecs[at]).tobytes()}], schema=schema)

    def begin(parts: pa.Table) -> pa.Table:
        dim, g = parts["dim"][0].as_py(), parts["g"][0].as_py()
        ids, vecs = joined_whole_blocks(parts, dim)
        bound = np.ceil(np.sqrt((vecs.astype(np.float64) ** 2).sum(axis=1)) * norm) + 1
        if bound.max(initial=0) >= 2.0**61:
            raise ValueError("scores are too large for 64 bits")
        reach = bound.astype(np.int64)
        return _state(dim, g, ids, narrowest(vecs), -reach, 2 * reach + 1, np.full(len(ids), k, np.int64))

    state = stored(chunks.select("dim", "ids", "vecs").mapInArrow(queries, "dim int, g int, ids binary, vecs binary")
                   .groupBy("dim", "g").applyInArrow(begin, STATE), "state")
    dealt = (chunks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .withColumn("s", F.pmod(F.xxhash64("ids"), F.lit(stripes)).cast("int"))
             .select("dim", "g", "s", "ids", "vecs").groupBy("dim", "g", "s"))

    def cells(state: DataFrame):
        return (state.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
                .groupBy("dim", "g", "s").cogroup(dealt))

    while (state.agg(F.max("widest")).first()[0] or 0) > 0:
        counts = cells(state).applyInArrow(_count(bins), "dim int, g int, counts binary")
        state = stored(state.groupBy("dim", "g").cogroup(counts.groupBy("dim", "g")).applyInArrow(_refine(bins), STATE), "state")
    hits = cells(state).applyInArrow(_select, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
