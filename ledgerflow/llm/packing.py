"""Packing documents into windows by non-negative least squares.

1. Every document's token ids, with a closing id, are cut at each full window;
   what is left is its rest. Rests are not cut further.
2. The lengths of all pieces make one histogram (at most ``window`` counts).
   Combinations of up to three lengths that fill a window exactly are
   enumerated; non-negative least squares finds how often to repeat each so that
   the histogram is used up; repeats are rounded and held within the histogram.
3. Residual counts are packed greedily, longest first, each gap taking the
   longest length that fits, as often as the counts allow at once.
4. Each piece gets its rank among the pieces of its length, and the plan says
   which window and offset that rank has. ``sequences`` puts the pieces of each
   window together.

Pieces are numbered where they are cut: each written block of at most about
HELD_BYTES counts its pieces of every length, and a piece's rank is its number plus
the counts of the blocks before. Only the counts, narrow rows, are summed over
tasks and blocks; ids are never sorted, and what joins them with their block's first
rank is dealt by (length, block), so a length that most pieces share (a full
window, a group of copies) is spread over as many groups as there are blocks,
each within HELD_BYTES at every size. The histogram and the plan have sizes
bounded by the window, whatever the corpus.

Defined cases: null and empty texts are one closing id; repeated rows are packed
each; null ids stay null; an empty table gives an empty result; other columns
are ignored. A last window may stay short; it is padded to the window except at a
power of two.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import Recent, as_text, by_text, segments
from .common import stored, text_or_empty, texts_by_arrow
from .token_counts import byte_symbols

WINDOW = 1024
HELD_BYTES = 8 << 20  # of ids in one written block
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


# --- token ids ------------------------------------------------------------------------------------------------------

LATIN_END = "\u0250"  # characters below are of one kind in every version of Unicode
BEYOND_LATIN = re.compile(f"[{LATIN_END}-\U0010ffff]")


@functools.cache
def library(path: str):
    """The library's encoder, loaded where a text needs it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def merges_in_id_order(path: str):
    """(special strings, function from text to ids) for a vocabulary file whose merges
    stand in the order of their ids, None for another.

    Such a file gives the same ids by ranks, which is several times faster;
    the library's own encoder takes the texts with a special string or with
    characters whose kind depends on the version of Unicode.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocabulary, special = file["model"]["vocab"], [t["content"] for t in file["added_tokens"]]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in file["model"]["merges"]]
    if [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))):
        return None
    back = {c: b for b, c in byte_symbols().items()}
    ranks = {bytes(back[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    return special, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@functools.cache
def encoder(path: str):
    """(pattern found in the texts that ranks cannot take, function from a text to ids by
    ranks, ids of other texts' pieces); one for each worker process and vocabulary file."""
    plain = merges_in_id_order(path)

    def encode(pieces: list[str]) -> list[bytes]:
        found = library(path).encode_batch_fast([as_text(p) for p in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    if plain is None:
        return re.compile(""), None, Recent(encode)
    special, quick = plain
    return re.compile("|".join([BEYOND_LATIN.pattern, *map(re.escape, special)])), quick, Recent(encode)


def token_ids(path: str, texts: Iterable[str]) -> Iterator[bytes]:
    """The ids of each text, little-endian 32 bit."""
    other, quick, recent = encoder(path)
    for by_library, group in itertools.groupby(texts, lambda t: other.search(t) is not None):
        if by_library:
            yield from map(b"".join, by_text(group, recent, b"".join))
        else:
            for t in group:
                yield b"".join(array("I", quick(" " + part if spaced else part)).tobytes() for spaced, part in segments(t))


def _numbers(lengths: np.ndarray) -> np.ndarray:
    """For each entry how many equal ones stand before it."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    out = np.empty(len(lengths), np.int64)
    out[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered)
    return out


def _cut(path: str, window: int, end: bytes, most: int):
    width = 4 * window

    def cut(batches):
        task, blocks = TaskContext.get().partitionId(), itertools.count()
        for batch in batches:
            doc_ids = batch.column("doc_id")
            at, start, ids, total, held = [], [], [], [], 0

            def rows():
                length = np.array([len(x) // 4 for x in ids], np.int64)
                return pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(total, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(np.full(len(ids), task, np.int32)), pa.array(np.full(len(ids), next(blocks), np.int32)), pa.array(_numbers(length))],
                    names=[*COLUMNS, "ids", "task", "block", "number"])

            for i, data in enumerate(token_ids(path, batch.column("text").to_pylist())):
                data += end
                for s in range(0, len(data), width):
                    at.append(i)
                    start.append(s // 4)
                    ids.append(data[s:s + width])
                    total.append(len(data) // 4)
                    held += len(ids[-1])
                    if held >= most:
                        yield rows()
                        at, start, ids, total, held = [], [], [], [], 0
            yield rows()

    return cut


# --- plan -----------------------------------------------------------------------------------------------------------

def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All non-increasing combinations of one to three of ``lengths`` (sorted) that
    fill ``window`` exactly, as rows padded with 0."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    rows = [np.array([[window, 0, 0]])] if there[window] else []
    small = lengths[lengths < window]
    other = window - small
    two = there[other] & (small >= other)
    rows.append(np.stack([small[two], other[two], np.zeros(two.sum(), int)], axis=1))
    a, b = np.meshgrid(small, small, indexing="ij")
    c = window - a - b
    three = (a >= b) & (b >= c) & (c > 0) & there[np.clip(c, 0, window)]
    rows.append(np.stack([a[three], b[three], c[three]], axis=1))
    return np.concatenate(rows).astype(np.int64)


def least_squares(rows: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeats x of the combinations with the smallest |A x - histogram|,
    by accelerated projected gradient; A counts each length in each combination."""
    if not len(rows):
        return np.zeros(0)

    def forward(x):
        out = np.bincount(rows.ravel(), weights=np.repeat(x, rows.shape[1]), minlength=len(histogram))
        out[0] = 0
        return out

    def back(r):
        return r[rows].sum(axis=1)

    v = np.ones(len(rows))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        v = back(forward(v))
        largest = np.linalg.norm(v)
        v /= largest
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        r = forward(y) - histogram
        r[0] = 0
        step = np.maximum(0.0, y - back(r) / (1.05 * largest))
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = step + (last - 1) / t * (step - x)
        x = step
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """[(lengths of one window, repeats)] that use every count of ``histogram`` (index: length) exactly once."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    rows = combinations(np.flatnonzero(left), window)
    repeats = least_squares(rows, left.astype(float))
    out = []
    for i in np.argsort(-repeats, kind="stable"):
        wanted = int(round(repeats[i]))
        if wanted == 0:
            break
        lengths, need = np.unique(rows[i][rows[i] > 0], return_counts=True)
        times = min(wanted, int((left[lengths] // need).min()))
        if times:
            left[lengths] -= times * need
            out.append((rows[i][rows[i] > 0].tolist(), times))
    while left.any():
        room, lengths, used = window, [], np.zeros_like(left)
        while room:
            fits = np.flatnonzero((left - used)[:room + 1])
            if not len(fits):
                break
            longest = int(fits[-1])
            lengths.append(longest)
            used[longest] += 1
            room -= longest
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        out.append((lengths, times))
    return out


def slots(windows: list[tuple[list[int], int]], window: int) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first window, offset) by ascending rank."""
    table: dict[int, list[tuple[int, int, int]]] = {}
    given = np.zeros(window + 1, np.int64)
    first = 0
    for lengths, times in windows:
        offset = 0
        for n in lengths:
            table.setdefault(n, []).append((int(given[n]), first, offset))
            given[n] += times
            offset += n
        first += times
    return {n: np.array(rows) for n, rows in table.items()}


# --- the operator ---------------------------------------------------------------------------------------------------

def pack(documents: DataFrame, path: str, window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids (binary, little-endian 32 bit)."""
    d = texts_by_arrow(documents).select("doc_id", text_or_empty().alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    cut = d.mapInArrow(_cut(path, window, end_id.to_bytes(4, "little"), HELD_BYTES),
                       f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary, task int, block int, number long")
    pieces = stored(cut, "pieces", compression="zstd")
    counts = stored(pieces.groupBy("length", "task", "block").agg(F.count("*").alias("n")), "counts")
    tasks = stored(counts.groupBy("length", "task").agg(F.sum("n").alias("n")), "counts")
    histogram = np.zeros(window + 1, np.int64)
    for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``window`` rows
        histogram[r["length"]] = r["n"]
    table = slots(plan(histogram, window), window)

    earlier = lambda by, order: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begun = (counts.withColumn("within", earlier(["length", "task"], "block")).drop("n")
             .join(tasks.withColumn("before", earlier(["length"], "task")).drop("n"), ["length", "task"])
             .select("length", "task", "block", (F.col("before") + F.col("within")).alias("begun")))
    ranked = (pieces.join(begun.hint("shuffle_hash"), ["length", "task", "block"])
              .select(*COLUMNS, "ids", (F.col("begun") + F.col("number")).alias("rank")))

    def placed(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at, rows = np.flatnonzero(length == n), table[int(n)]
                slot = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                sequence[at] = slot[:, 1] + rank[at] - slot[:, 0]
                offset[at] = slot[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in COLUMNS], pa.array(sequence), pa.array(offset), batch.column("ids")],
                names=[*COLUMNS, "sequence_id", "offset", "ids"])

    return ranked.mapInArrow(placed, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                                     "ids binary")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per window: sequence_id, ids of its pieces in order of their offsets (binary)."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(pieces.alias("pieces"))
            .select("sequence_id", F.aggregate("pieces", F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids")))
