"""Document quality: random-indexing word vectors, pooled per document, and a
two-layer network with calibrated probabilities.

1. Random indexing. Every word, and every word's shape (runs of letters, capitals
   and digits cut to one sign, other characters as they are, marked where the word
   repeats the one before), has a sparse random index vector of +1 and -1. A word's
   vector is the sum of the index vectors of its neighbours at distance 1 and 2,
   over all documents; words are hashed into a table of fixed size. Tasks send one
   partial table each, which are added part by part.
2. Pooling. A document's features are mean and deviation of its words' and shapes'
   vectors over the whole text. They are stored once.
3. Network. Trained on the driver on the features of at most ``sample`` labelled
   documents (those with the smallest hash), never of the held-out fold. A part
   of them is kept aside to stop training and to fit the temperature.
4. Scores of all documents from the stored features.

Labels enter by the training rows only; id, source and language enter nowhere.

Defined cases: null and empty texts have zero features and still get a score;
every row gives one row, repeated or not; a null id is not held out; labels that
are null are ignored, of several labels of an id the largest counts; without labels
all scores are 0.5, with labels of one kind the (smoothed) share of that kind;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty, texts_by_arrow
from .shingles import BUFFER, encoded, _mixed, _power_tables, _SPACE, _u

DIM = 32
WORD_ROWS, SHAPE_ROWS = 1 << 15, 1 << 12
PARTS = 16
FAN = 128  # tables that one group adds up
REACH = (1, 2)
AT_ONCE = 100_000  # words whose vectors are held at once
SAMPLE = 20_000  # most labelled documents that the network is fitted to
FOLD, FOLDS = 2, 4

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")


# --- words and shapes ---------------------------------------------------------------------------------------------------

def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, word hash, shape hash) of the words of a buffer."""
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power_tables(len(b) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + _u(1)) * up[:len(b)])])
    words = _mixed((sums[ends] - sums[starts]) * down[starts])
    kind = _CLASS[b]
    new = np.concatenate([[True], kind[1:] != kind[:-1]]) if len(kind) else np.empty(0, bool)
    new[starts] = True
    place = np.concatenate([np.zeros(1, np.int64), np.cumsum(new)])
    held = np.where(new, (kind.astype(np.uint64) + _u(1)) * up[place[:-1]], _u(0))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(held)])
    return starts, words, _mixed((sums[ends] - sums[starts]) * down[place[starts]])


def _rows(words: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of one text's words and shapes."""
    again = np.zeros(len(words), np.uint64)
    again[1:] = words[1:] == words[:-1]
    return (words % _u(WORD_ROWS)).astype(np.int64), (_mixed(shapes + again) % _u(SHAPE_ROWS)).astype(np.int64)


def token_rows(texts: Iterable[bytes]):
    """(word rows, shape rows) of each text, in order."""
    held, size = [], 0

    def flush():
        if held:
            starts, words, shapes = _hashes(b" ".join(held))
            cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in held])[:-1])
            for w, s in zip(np.split(words, cuts), np.split(shapes, cuts), strict=True):
                yield _rows(w, s)
            held.clear()

    for t in texts:
        if len(t) > BUFFER // 2:
            yield from flush()
            size, parts, at = 0, [], 0
            while at < len(t):
                end = min(len(t), at + BUFFER)
                while end < len(t) and not _SPACE[t[end]]:
                    end += 1
                parts.append(_hashes(t[at:end])[1:])
                at = end
            yield _rows(*(np.concatenate(p) for p in zip(*parts, strict=True)))
            continue
        held.append(t)
        size += len(t) + 1
        if size >= BUFFER // 2:
            yield from flush()
            size = 0
    yield from flush()


# --- 1: random indexing ---------------------------------------------------------------------------------------------------

def index_vectors(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the two non-zero components of each row's index vector."""
    rng = np.random.default_rng(seed)
    places = np.stack([rng.integers(0, DIM, rows), rng.integers(0, DIM, rows)], axis=1)
    return places, rng.choice([-1.0, 1.0], (rows, 2))


def _add_contexts(table: np.ndarray, stream: list[np.ndarray], places: np.ndarray, signs: np.ndarray) -> None:
    """Add to each row of ``table`` the index vectors of its neighbours in the texts of ``stream``."""
    targets, contexts = [], []
    for rows in stream:
        for d in REACH:
            if len(rows) > d:
                targets += [rows[:-d], rows[d:]]
                contexts += [rows[d:], rows[:-d]]
    if targets:
        t, c = np.concatenate(targets), np.concatenate(contexts)
        flat = (t[:, None] * DIM + places[c]).ravel()
        table += np.bincount(flat, weights=signs[c].ravel(), minlength=len(table))


def added(sums: DataFrame, fan: int) -> DataFrame:
    """One level of a tree of sums: part, node, sums of each ``fan`` neighbouring nodes as one node."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table["sums"][0].as_py()) // 4)
        for b in table["sums"].to_pylist():
            total += np.frombuffer(b, np.float32)
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "node": pa.array([table["node"][0].as_py() // fan], pa.int32()),
                         "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    return sums.groupBy("part", (F.col("node") / fan).cast("int").alias("parent")).applyInArrow(add, "part int, node int, sums binary")


def word_vectors(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of all word rows and shape rows, from every document."""

    def gather(batches):
        w_index, s_index = index_vectors(WORD_ROWS, 1), index_vectors(SHAPE_ROWS, 2)
        words, shapes = np.zeros(WORD_ROWS * DIM), np.zeros(SHAPE_ROWS * DIM)
        for batch in batches:
            ws, ss, held = [], [], 0
            for w, s in token_rows(encoded(batch.column("text"))):
                for i in range(0, len(w), AT_ONCE):  # a long text in runs that share their neighbours
                    cut = slice(i, i + AT_ONCE + max(REACH))
                    ws.append(w[cut])
                    ss.append(s[cut])
                    held += len(ws[-1])
                    if held >= AT_ONCE:
                        _add_contexts(words, ws, *w_index)
                        _add_contexts(shapes, ss, *s_index)
                        ws, ss, held = [], [], 0
            _add_contexts(words, ws, *w_index)
            _add_contexts(shapes, ss, *s_index)
        whole = np.concatenate([words, shapes]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS), pa.int32()), pa.array(np.full(PARTS, TaskContext.get().partitionId(), np.int32)),
             pa.array([p.tobytes() for p in np.array_split(whole, PARTS)], pa.binary())], names=["part", "node", "sums"])

    summed = documents.select(text_or_empty().alias("text")).mapInArrow(gather, "part int, node int, sums binary")
    for fan in (FAN, FAN, 1 << 31):  # the last takes what is left, FAN for each FAN^3 tasks
        summed = added(summed, fan)
    summed = summed.select("part", "sums")
    parts = sorted(summed.collect())  # PARTS rows of a table of fixed size
    whole = np.concatenate([np.frombuffer(r["sums"], np.float32) for r in parts]) if parts else np.zeros((WORD_ROWS + SHAPE_ROWS) * DIM, np.float32)
    vectors = whole.reshape(-1, DIM)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vectors[:WORD_ROWS], vectors[WORD_ROWS:]


# --- 2: pooling -------------------------------------------------------------------------------------------------------------

def _pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    total, squares = np.zeros(DIM), np.zeros(DIM)
    for i in range(0, len(rows), AT_ONCE):
        v = vectors[rows[i:i + AT_ONCE]]
        total += v.sum(axis=0)
        squares += (v * v).sum(axis=0)
    n = max(len(rows), 1)
    mean = total / n
    return np.concatenate([mean, np.sqrt(np.maximum(squares / n - mean * mean, 0))])


def features(documents: DataFrame, tables) -> DataFrame:
    """doc_id and features (binary float32) of each row; ``tables``: the broadcast word vectors."""
    d = documents.select("doc_id", text_or_empty().alias("text"))

    def pool(batches):
        words, shapes = tables.value
        for batch in batches:
            out = [np.concatenate([_pooled(w, words), _pooled(s, shapes)]).astype(np.float32).tobytes() for w, s in token_rows(encoded(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "features"])

    return d.mapInArrow(pool, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, features binary")


def shared_vectors(documents: DataFrame):
    """The word vectors, a table of fixed size, at every executor."""
    return documents.sparkSession.sparkContext.broadcast(word_vectors(documents))


# --- 3: network ---------------------------------------------------------------------------------------------------------------

@dataclass
class Network:
    """tanh layer and logistic output on standardised features, divided by a temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(x) / self.temperature, -50, 50)))


def _loss(odds: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, odds) - y * odds))


def calibrated(odds: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the smallest loss, by golden-section search over its logarithm.

    Targets are drawn in by the number of rows of their kind (1 / (n + 2)), so that
    rows which are told apart without error still give finite odds."""
    y = np.where(y == 1, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    low, high, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        if _loss(odds / np.exp(a), y) < _loss(odds / np.exp(b), y):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 120, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4,
          seed: int = 3) -> Network:
    """Adam on the logistic loss; the epoch of the smallest loss on a fifth kept aside is taken."""
    rng = np.random.default_rng(seed)
    flat = Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        flat.b2 = float(np.log(share / (1 - share)))
        return flat
    order = rng.permutation(len(y))
    aside, own = order[:max(1, len(y) // 5)], order[max(1, len(y) // 5):]
    net = Network(x[own].mean(axis=0), x[own].std(axis=0) + 1e-4, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, hidden**-0.5, hidden), 0.0)
    z = (x - net.shift) / net.scale
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    best, kept, worse = np.inf, None, 0
    for _ in range(epochs):
        rng.shuffle(own)
        for i in range(0, len(own), batch):
            at = own[i:i + batch]
            h = np.tanh(z[at] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-(h @ params[2] + params[3][0]))) - y[at]) / len(at)
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[at].T @ back + decay * params[0], back.sum(axis=0), h.T @ error + decay * params[2], np.array([error.sum()])]
            t += 1
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                params[j] -= rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
        loss = _loss(np.tanh(z[aside] @ params[0] + params[1]) @ params[2] + params[3][0], y[aside])
        if loss < best - 1e-5:
            best, kept, worse = loss, [p.copy() for p in params], 0
        else:
            worse += 1
            if worse >= 15:
                break
    net.w1, net.b1, net.w2, net.b2 = kept[0], kept[1], kept[2], float(kept[3][0])
    net.temperature = calibrated(net.odds(x[aside]), y[aside])
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == FOLD, F.lit(False))


def training_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, label of at most ``sample`` labelled ids outside the held-out fold."""
    usable = F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
    return (labels.where(usable).groupBy("doc_id").agg(F.max("quality").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def fitted(pooled: DataFrame, chosen: DataFrame) -> Network:
    """The network fitted to the rows of ``pooled`` that ``chosen`` labels (its size is bounded)."""
    rows = (pooled.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("features").alias("features"))
            .toArrow().sort_by("doc_id"))
    x = np.array([np.frombuffer(b, np.float32) for b in rows["features"].to_pylist()], np.float64).reshape(-1, 4 * DIM)
    return train(x, rows["label"].to_numpy().astype(np.float64))


# --- 4: scores --------------------------------------------------------------------------------------------------------------------

def score(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    documents = texts_by_arrow(documents)
    pooled = stored(features(documents, shared_vectors(documents)), "features")
    net = fitted(pooled, training_labels(labels, sample))
    kind = pooled.schema["doc_id"].dataType.simpleString()

    def scored(batches):
        for batch in batches:
            x = np.array([np.frombuffer(b, np.float32) for b in batch.column("features").to_pylist()], np.float64).reshape(-1, 4 * DIM)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.probability(x))], names=["doc_id", "score"])

    return (pooled.mapInArrow(scored, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """``documents`` without the rows that score below the threshold.

    Scored in one pass beside the text, so the text is neither stored nor shuffled."""
    documents = texts_by_arrow(documents)
    tables = shared_vectors(documents)
    chosen = training_labels(labels, sample)
    labelled = documents.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    net = fitted(features(labelled, tables), chosen)

    def keep(batches):
        words, shapes = tables.value
        for batch in batches:
            x = [np.concatenate([_pooled(w, words), _pooled(s, shapes)]).astype(np.float32)
                 for w, s in token_rows(encoded(batch.column("text")))]
            good = net.probability(np.array(x, np.float64).reshape(-1, 4 * DIM)) >= threshold
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(keep, documents.schema)
