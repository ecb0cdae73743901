"""Hard negatives by anchor-clustered shared lists.

An anchor's positives are the rows of its label with the highest inner products; its
hard negatives for a positive are the highest rows of other labels whose score lies in a window below
the positive's. Scores are inner products of whole numbers and exact.

1. Anchors of one label are clustered by direction (k-means, fitted on at most SAMPLE anchors, assigned
   for all) and cut into blocks of about BLOCK; a block has a centre and the widest angle w of
   its members to it.
2. Blocks meet the vectors in cells: vectors are dealt into stripes of about STRIPE, blocks into
   batches of about BATCH anchors, every batch meets every stripe. In a cell each block makes one list
   of its candidates, sorted by the angular upper bound |x| cos(max(0, angle(x, centre) - w)),
   which times |u| bounds the score with each member u. All members walk that list step by step; a
   member leaves once its bound is below what it still needs, so what it has is certified.
   The bound is widened by more than its rounding; ties of the last score are walked too.
3. Two walks: the first finds the positives, the second, with every positive's window known, for each
   the highest scores within it. A cell returns at most the wanted number for each anchor and positive, the global ranks are taken over the cells.

The blocks are a stated query set that meets all rows, so work grows with anchors x rows unless bounds end the walks;
a task holds one batch and one stripe. The driver holds the centres alone.

Defined cases: rows with a null id or label, a null or empty vector or a null or
non-finite component take no part; of rows that repeat an id the smallest vector (then label)
counts, once; vectors of different length never meet; an anchor without a row of its label or without
a row in a window gives nothing for it; windows of negative positive scores are empty; ties go to the
smaller id; an empty table gives an empty result; other columns are ignored.
Labels are whole numbers. Scores must stay below 2^55, else an error is raised.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored

SAMPLE = 4096  # anchors that the cluster centres are fitted on, at most
CLUSTERS = 32
BLOCK = 512
BATCH = 16_384
STRIPE = 65_536
STEP = 1024  # candidates scored at once
CHUNK = 4096
KEY = ["dim", "label", "cluster", "part"]
KEY_TYPES = "dim int, label long, cluster int, part int"
_KEY_FIELDS = [("dim", pa.int32()), ("label", pa.int64()), ("cluster", pa.int32()), ("part", pa.int32())]


def _usable(embeddings: DataFrame) -> DataFrame:
    e = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    e = e.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite))
    return e.groupBy("vec_id").agg(F.min(F.struct("embedding", "label")).alias("r")).select("vec_id", "r.label", "r.embedding")


CHUNKS = pa.schema([("dim", pa.int32()), ("label", pa.int64()), ("n", pa.int32()), ("widest", pa.float64()), ("ids", pa.binary()), ("vecs", pa.binary())])


def _chunks(scale: int):
    def chunks(batches):
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
            lengths = batch.column("embedding").value_lengths().to_numpy()
            flat = np.floor(batch.column("embedding").flatten().to_numpy(zero_copy_only=False) * scale)
            if np.abs(flat).max(initial=0) >= 2.0**31:
                raise ValueError("components are too large for whole numbers of 31 bits")
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
            order = np.lexsort((ids, labels, lengths))
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(lengths[order]) != 0) | (np.diff(labels[order]) != 0)])) if len(order) else []
            for at in np.split(order, cuts[1:]) if len(order) else []:
                for i in range(0, len(at), CHUNK):
                    j = at[i:i + CHUNK]
                    m = flat[starts[j][:, None] + np.arange(lengths[j[0]])].astype(np.int32)
                    yield pa.RecordBatch.from_pylist(
                        [{"dim": m.shape[1], "label": int(labels[j[0]]), "n": len(j), "widest": float(np.sqrt((m.astype(float) ** 2).sum(axis=1).max())),
                          "ids": ids[j].tobytes(), "vecs": m.tobytes()}], schema=CHUNKS)
    return chunks


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, norms); a zero vector has no direction and stays zero."""
    norms = np.sqrt((m * m).sum(axis=1))
    return m / np.where(norms > 0, norms, 1.0)[:, None], norms


def centres(sample: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Unit centres of directions by Lloyd's steps, begun with the first ``count`` of them."""
    units, _ = _unit(sample)
    c = units[:count].copy()
    for _ in range(rounds):
        of = (units @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, of, units)
        new, norms = _unit(sums)
        c = np.where((norms > 0)[:, None], new, c)
    return c


def _anchors(chunks: DataFrame, every: int) -> DataFrame:
    """dim, label, vec_id, vec (binary) of the anchors."""
    schema = pa.schema([("dim", pa.int32()), ("label", pa.int64()), ("vec_id", pa.int64()), ("vec", pa.binary())])

    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, vecs = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vecs"], np.int32).reshape(-1, row["dim"])
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["dim"], np.int32)), pa.array(np.full(len(at), row["label"], np.int64)),
                                                      pa.array(ids[at]), pa.array([v.tobytes() for v in vecs[at]], pa.binary())], schema=schema)

    return stored(chunks.select("dim", "label", "ids", "vecs").mapInArrow(pick, "dim int, label long, vec_id long, vec binary"), "anchors")


BLOCKS = pa.schema([*_KEY_FIELDS, ("ids", pa.binary()), ("vecs", pa.binary())])


def blocks(chunks: DataFrame, every: int, block: int = BLOCK, sample: int = SAMPLE, clusters: int = CLUSTERS) -> DataFrame:
    """dim, label, cluster, part, ids, vecs: the anchors of one label and cluster, about ``block`` a row."""
    anchors = _anchors(chunks, every)
    rows = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    fitted = {}
    for dim in sorted({r["dim"] for r in rows}):
        m = np.array([np.frombuffer(r["vec"], np.int32) for r in rows if r["dim"] == dim], float)
        fitted[dim] = centres(m, min(clusters, max(1, math.isqrt(len(m)))))
    schema = pa.schema([("dim", pa.int32()), ("label", pa.int64()), ("vec_id", pa.int64()), ("vec", pa.binary()), ("cluster", pa.int32())])

    def assign(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int32)
            dims, vecs = batch.column("dim").to_numpy(), batch.column("vec")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if int(dim) in fitted:
                    m = np.frombuffer(b"".join(vecs.take(pa.array(at)).to_pylist()), np.int32).reshape(-1, dim)
                    out[at] = (m @ fitted[int(dim)].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], schema=schema)

    placed = anchors.mapInArrow(assign, "dim int, label long, vec_id long, vec binary, cluster int")
    counts = placed.groupBy("dim", "label", "cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    parted = (placed.join(counts, ["dim", "label", "cluster"])
              .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts"))

    def gather(t: pa.Table) -> pa.Table:
        ids = t["vec_id"].to_numpy()
        order = np.argsort(ids)
        vecs = t["vec"].to_pylist()
        return pa.Table.from_pylist([{c: t[c][0].as_py() for c in KEY} | {"ids": ids[order].tobytes(), "vecs": b"".join(vecs[i] for i in order)}], schema=BLOCKS)

    return stored(parted.groupBy(*KEY).applyInArrow(gather, f"{KEY_TYPES}, ids binary, vecs binary"), "blocks")


class Stripe:
    """The vectors of one cell, by label: ids, labels, whole numbers, directions and norms."""

    def __init__(self, chunks: pa.Table, dim: int):
        order = np.argsort(chunks["label"].to_numpy(), kind="stable")
        rows = [chunks.slice(int(i), 1).to_pylist()[0] for i in order]
        self.ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
        self.labels = np.repeat([r["label"] for r in rows], [r["n"] for r in rows])
        self.x = np.concatenate([np.frombuffer(r["vecs"], np.int32).reshape(-1, dim) for r in rows])
        self.norms = np.concatenate([np.sqrt((np.frombuffer(r["vecs"], np.int32).reshape(-1, dim).astype(float) ** 2).sum(axis=1)) for r in rows])

    def shared_list(self, members: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(candidates by falling bound, bounds for a member of norm 1)."""
        units, norms = _unit(members)
        centre = _unit(units.sum(axis=0)[None, :])[0][0]
        angles = np.arccos(np.clip(units @ centre, -1, 1))
        wide = angles[norms > 0].max(initial=0) + 1e-6
        x, n = self.x[candidates], self.norms[candidates]
        cosine = np.clip((x @ centre) / np.where(n > 0, n, 1.0), -1, 1) if centre.any() else np.ones(len(x))
        bound = n * (np.cos(np.maximum(0, np.arccos(cosine) - wide)) + 1e-9)
        order = np.argsort(-bound, kind="stable")
        return candidates[order], bound[order]

    def scores(self, members: np.ndarray, at: np.ndarray) -> np.ndarray:
        x = self.x[at]
        most = members.shape[1] * float(np.abs(members).max(initial=0)) * float(np.abs(x).max(initial=0))
        if most >= 2.0**55:
            raise ValueError("scores are too large")
        if most < 2.0**53:
            return (members.astype(float) @ x.T.astype(float)).astype(np.int64)
        return members.astype(np.int64) @ x.T.astype(np.int64)


LOWEST = np.iinfo(np.int64).min


def walk(stripe: Stripe, listed: np.ndarray, bounds: np.ndarray, members: np.ndarray, owner: np.ndarray, own_ids: np.ndarray,
         low: np.ndarray, high: np.ndarray, k: int, step: int = STEP):
    """(wish, id, score): for each wish the k highest scores from low to high of its member ``owner``, ties by id.

    Wishes walk the list together; one ends when its bound is below low or its present k-th score.
    """
    norms = np.sqrt((members.astype(float) ** 2).sum(axis=1))
    kth = np.full(len(owner), LOWEST)
    wish, ids, scores = (np.empty(0, np.int64) for _ in range(3))
    live = np.flatnonzero(low <= high)
    i, width = 0, min(64, step)  # short steps first: a good list ends early
    while len(live) and i < len(listed):
        needed = np.maximum(low[live], kth[live])
        live = live[norms[owner[live]] * bounds[i] >= needed]
        if not len(live):
            break
        at = listed[i:i + width]
        who, row = np.unique(owner[live], return_inverse=True)
        s = stripe.scores(members[who], at)
        s[stripe.ids[at][None, :] == own_ids[who][:, None]] = LOWEST  # never its own partner
        floor_ = np.maximum(np.maximum(low[live], kth[live]), LOWEST + 1)
        for j in range(0, len(live), 256):
            part = s[row[j:j + 256]]
            a, c = np.nonzero((part >= floor_[j:j + 256, None]) & (part <= high[live[j:j + 256], None]))
            wish = np.concatenate([wish, live[j:j + 256][a]])
            ids = np.concatenate([ids, stripe.ids[at][c]])
            scores = np.concatenate([scores, part[a, c]])
        order = np.lexsort((ids, -scores, wish))
        wish, ids, scores = wish[order], ids[order], scores[order]
        rank = np.arange(len(wish)) - np.searchsorted(wish, wish)
        kth[wish[rank == k - 1]] = scores[rank == k - 1]
        keep = rank < k
        wish, ids, scores = wish[keep], ids[keep], scores[keep]
        i, width = i + width, min(2 * width, step)
    return wish, ids, scores


def window(positive: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with least * positive <= 100 * s <= most * positive."""
    return -((-least * positive) // 100), (most * positive) // 100


HITS = pa.schema([*_KEY_FIELDS, ("anchor_id", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _cell(k: int, negatives: tuple[int, int] | None):
    """Walks of all blocks of a cell: for positives, or for negatives in their windows."""

    def cell(batch: pa.Table, chunks: pa.Table) -> pa.Table:
        if not batch.num_rows or not chunks.num_rows:
            return HITS.empty_table()
        dim = batch["dim"][0].as_py()
        stripe = Stripe(chunks, dim)
        out = []
        for i in range(batch.num_rows):
            block = batch.slice(i, 1).to_pylist()[0]
            own = np.frombuffer(block["ids"], np.int64)
            members = np.frombuffer(block["vecs"], np.int32).reshape(-1, dim)
            if negatives is None:
                first, last = np.searchsorted(stripe.labels, [block["label"], block["label"] + 1])
                candidates, owner = np.arange(first, last), np.arange(len(own))
                low, high = np.full(len(own), LOWEST), np.full(len(own), np.iinfo(np.int64).max)
                place = np.zeros(len(own), np.int32)
            else:
                candidates = np.flatnonzero(stripe.labels != block["label"])
                anchor, place, positive = (np.frombuffer(block[c], kind) for c, kind in (("anchor", np.int64), ("place", np.int32), ("positive", np.int64)))
                owner = np.searchsorted(own, anchor)
                low, high = window(positive, *negatives)
            if not len(candidates) or not len(owner):
                continue
            listed, bounds = stripe.shared_list(members.astype(float), candidates)
            wish, ids, scores = walk(stripe, listed, bounds, members, owner, own, low, high, k)
            out.append(pa.table([*[pa.array(np.full(len(wish), block[c]), t) for c, t in _KEY_FIELDS],
                                 pa.array(own[owner[wish]]), pa.array(place[wish].astype(np.int32)), pa.array(ids), pa.array(scores)], schema=HITS))
        return pa.concat_tables(out) if out else HITS.empty_table()

    return cell


def _with_positives(block: pa.Table, found: pa.Table) -> pa.Table:
    schema = pa.schema([*BLOCKS, ("anchor", pa.binary()), ("place", pa.binary()), ("positive", pa.binary())])
    if not block.num_rows or not found.num_rows:
        return schema.empty_table()
    more = {"anchor": found["anchor_id"].to_numpy().tobytes(), "place": found["rank"].to_numpy().astype(np.int32).tobytes(),
            "positive": found["score"].to_numpy().tobytes()}
    return pa.Table.from_pylist([block.to_pylist()[0] | more], schema=schema)


def mine(embeddings: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, scale: int = 256,
         least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank:
    for each anchor (vec_id divisible by ``every``) and each of its ``positives`` highest rows of its
    label the ``negatives`` highest rows of other labels from ``least`` to ``most`` percent of the positive's score."""
    spark = embeddings.sparkSession
    chunks = stored(_usable(embeddings).mapInArrow(_chunks(scale), "dim int, label long, n int, widest double, ids binary, vecs binary"), "chunks")
    cut = blocks(chunks, every)
    n = chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    anchors = cut.agg(F.coalesce(F.sum(F.octet_length("ids") / 8), F.lit(0.0))).first()[0]
    batches = max(1, math.ceil(anchors / BATCH))
    # a cell returns some rows for each of its anchors, so stripes are not made smaller than CHUNK for the sake of more tasks
    stripes = max(1, min(math.ceil(shuffle_partitions(spark) / batches), math.ceil(n / CHUNK)), math.ceil(n / STRIPE))
    dealt = (chunks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
             .withColumn("s", F.pmod(F.xxhash64("ids"), F.lit(stripes)).cast("int")).groupBy("dim", "g", "s"))

    def cells(rows: DataFrame, k: int, limits: tuple[int, int] | None) -> DataFrame:
        return (rows.withColumn("g", F.pmod(F.xxhash64(*KEY), F.lit(batches)).cast("int"))
                .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).groupBy("dim", "g", "s").cogroup(dealt)
                .applyInArrow(_cell(k, limits), f"{KEY_TYPES}, anchor_id long, place int, vec_id long, score long"))

    def ranked(hits: DataFrame, k: int) -> DataFrame:
        best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    near = stored(ranked(cells(cut, positives, None), positives), "positives")
    wanted = (cut.groupBy(*KEY).cogroup(near.groupBy(*KEY))
              .applyInArrow(_with_positives, f"{KEY_TYPES}, ids binary, vecs binary, anchor binary, place binary, positive binary"))
    hard = ranked(cells(stored(wanted, "wishes"), negatives, (least, most)), negatives)
    return (hard.select("anchor_id", F.col("place").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near.select("anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                  ["anchor_id", "positive_rank"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"))
