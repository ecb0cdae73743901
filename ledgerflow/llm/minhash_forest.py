"""MinHash near-duplicates by an LSH forest: documents whose sets of three-word
shingles have a similarity of at least 85 in 100, and the groups they form.

1. Sets and signatures. Equal sets form one class, named by a 64-bit hash; a class
   has TREES signatures of DEPTH minhash values each, packed into one long a tree
   (tree, then value by value), so that its order is the signatures' order.
2. Sorted orders. The signatures of all trees are range-sorted, one order a tree;
   (signature, class) is the sort key, so a signature that many classes share is
   spread over several tasks. Rows that have no common prefix of LEAST values with the row
   before or after leave. A region is a set of rows with a common prefix.
3. Longest-common-prefix neighbours. A class's weight is the number of rows that share its whole
   signature, over all trees: of copies with edits the original, which they resemble more
   than each other, weighs most. In the first trees each class meets the heaviest class of its
   region; pairs whose sizes cannot fit or whose sketches (a bit of each signature value) differ in
   far too many bits drop out, the others are confirmed on their full sets. Each class is labelled with the smallest such neighbour.
4. Adaptive depth. Regions whose rows all have one label are done. Of the others, those with at
   most CROWD rows give pairs of rows with different labels; fuller ones are split by their next
   value. A region still full at the greatest depth gives its classes to an exact join on their sets:
   rarest shingles first, two sets that link share one in their first n - ceil(85 n / 100) + 1; only
   pairs with different labels, fitting sizes and enough shingles left meet. No candidate is capped;
   pairs are confirmed as before. The components of all confirmed links are the groups.

Links are exact; a link of similarity s is found unless none of the trees has it
at the depth of its region, a probability of at most (1 - s^DEPTH)^TREES: below 1e-6 at 0.85
and less above. The sketch test fails with a probability below 1e-7.

Defined cases: null and empty texts and texts without words have the empty set, link
with nothing and are kept; a group's id is its smallest doc_id, null only if it has no other;
repeated rows are copies; an empty table gives an empty result; other columns are
ignored, whatever their names; texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, text_or_empty, texts_by_arrow
from .components import components
from .shingles import encoded, set_key, shingle_sets

WORDS = 3
SHARE = 85  # of 100
TREES = 24
DEPTH = 5  # values of a signature
LEAST = 3  # values that neighbours have in common
BITS = 11  # of a value kept in a signature
HOPS = 4  # links followed to a label
FIRST = 6  # trees whose neighbours are linked before regions are looked at
CROWD = 16  # rows of a region that are compared with each other
DIFFER = 27  # most bits in which the sketches (one bit of each value) of a pair differ that is confirmed; 9 are expected at 0.85
ROWS = 1_000_000  # signatures in a task's part of the sorted orders
BUFFER = 1 << 16  # shingles hashed at once
_u = np.uint64


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.arange(1, 2 * n + 1, dtype=np.uint64) * _u(0x9E3779B97F4A7C15)
    x = _finished(x)
    return x[:n], x[n:] | _u(1)


def _finished(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u(33))) * _u(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _u(33))) * _u(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _u(33))


def signatures(found: list[np.ndarray]) -> np.ndarray:
    """One row for each (non-empty) set: TREES longs, the tree in the highest bits."""
    flips, factors = _constants(TREES * DEPTH)
    least = np.empty((TREES * DEPTH, len(found)), np.uint64)
    at = 0
    while at < len(found):
        size, end = 0, at
        while end < len(found) and (end == at or size + len(found[end]) <= BUFFER):
            size += len(found[end])
            end += 1
        flat = np.concatenate(found[at:end])
        starts = np.cumsum([0, *[len(s) for s in found[at:end - 1]]])
        mixed = np.empty_like(flat)
        for i in range(TREES * DEPTH):
            np.bitwise_xor(flat, flips[i], out=mixed)
            np.multiply(mixed, factors[i], out=mixed)
            least[i, at:end] = np.minimum.reduceat(mixed, starts)
        at = end
    values = (_finished(least) >> _u(64 - BITS)).reshape(TREES, DEPTH, len(found))
    path = np.repeat(np.arange(TREES, dtype=np.uint64)[:, None], len(found), axis=1)
    for d in range(DEPTH):
        path = (path << _u(BITS)) | values[:, d]
    return np.ascontiguousarray(path.T).view(np.int64)


def sketch(paths: np.ndarray) -> np.ndarray:
    """One bit of every signature value, in two longs: rows of ``signatures`` to rows (s0, s1)."""
    out = np.zeros((len(paths), 2), np.int64)
    for t in range(TREES):
        for d in range(DEPTH):
            out[:, 2 * t // TREES] = (out[:, 2 * t // TREES] << 1) | ((paths[:, t] >> (BITS * d)) & 1)
    return out


def members(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class (null for the empty set), paths, s0, s1 (at a class's first row in each batch; else null)."""
    d = texts_by_arrow(documents.select("doc_id", text_or_empty().alias("text")))

    def named(batches):
        for batch in batches:
            sets = list(shingle_sets(encoded(batch.column("text")), WORDS))
            names = [set_key(s) if len(s) else None for s in sets]
            first = {name: i for i, name in reversed(list(enumerate(names))) if name is not None}
            at = sorted(first.values())
            paths, s0, s1 = ([None] * len(sets) for _ in range(3))
            if at:
                signed = signatures([sets[i] for i in at])
                for i, row, (first_half, second_half) in zip(at, signed, sketch(signed).tolist(), strict=True):
                    paths[i], s0[i], s1[i] = row.tobytes(), first_half, second_half
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                                              pa.array(paths, pa.binary()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())],
                                             names=["doc_id", "n_shingles", "class", "paths", "s0", "s1"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return stored(d.mapInArrow(named, f"doc_id {kind}, n_shingles long, class long, paths binary, s0 long, s1 long"), "members")


NEIGHBOURS = pa.schema([("path", pa.int64()), ("class", pa.int64()), ("same", pa.int64())])


def _level(depth: int) -> int:
    """Bits of a path below a prefix of ``depth`` values."""
    return BITS * (DEPTH - depth)


def _unpack(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            paths = np.frombuffer(b"".join(part.column("paths").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(np.repeat(part.column("class").to_numpy(), TREES))], names=["path", "class"])


def _neighbours(batches):
    """Of one sorted part, the rows that share a prefix with the row before or after.

    The first and the last row may share one with another part and always stay.
    """
    parts = [(b.column("path").to_numpy(), b.column("class").to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    path, name = (np.concatenate(p) for p in zip(*parts, strict=True))
    parts.clear()
    prefix = path >> _level(LEAST)
    near = prefix[1:] == prefix[:-1]
    keep = np.concatenate([[True], near]) | np.concatenate([near, [True]])
    starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
    runs = np.diff(np.concatenate([starts, [len(path)]]))
    same = np.repeat(runs, runs)
    at = np.flatnonzero(keep)
    for i in range(0, len(at), 100_000):
        j = at[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(path[j]), pa.array(name[j]), pa.array(same[j])], schema=NEIGHBOURS)


def neighbours(classes: DataFrame) -> DataFrame:
    """path, class, same (rows with the same path in its part), n, s0, s1 of the rows of the
    sorted orders that share a prefix of LEAST values with a neighbour."""
    rows = classes.select("class", "paths").mapInArrow(_unpack, "path long, class long")
    parts = max(shuffle_partitions(classes.sparkSession), math.ceil(classes.count() * TREES / ROWS))
    near = (rows.repartitionByRange(parts, "path", "class").sortWithinPartitions("path", "class")
            .mapInArrow(_neighbours, "path long, class long, same long"))
    return stored(near.join(classes.drop("paths"), "class"), "neighbours")


def _may_link(a: str, b: str) -> str:
    """Whether sizes fit and sketches differ in few enough bits."""
    return (f"100 * {a}.n >= {SHARE} * {b}.n and 100 * {b}.n >= {SHARE} * {a}.n "
            f"and bit_count({a}.s0 ^ {b}.s0) + bit_count({a}.s1 ^ {b}.s1) <= {DIFFER}")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, counted on their full sets."""
    side = lambda s: sets.select(F.col("class").alias(s), F.col("keys").alias(f"keys_{s}"))

    def confirm(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                x, y = ([np.frombuffer(k, np.uint64) for k in part.column(c).to_pylist()] for c in ("keys_a", "keys_b"))
                both = np.array([len(np.intersect1d(s, t, assume_unique=True)) for s, t in zip(x, y, strict=True)], np.int64)
                either = np.array([len(s) + len(t) for s, t in zip(x, y, strict=True)], np.int64) - both
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(100 * both >= SHARE * either))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(confirm, "a long, b long")


def full_sets(documents: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, keys (sorted shingle hashes) of the classes in ``wanted``: one text of each is read again."""
    shown = (rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("__id"))
             .join(wanted, "class", "left_semi").select("__id").distinct())
    texts = (documents.select("doc_id", text_or_empty().alias("text")).join(shown, F.expr("doc_id <=> __id"), "left_semi").select("text"))

    def hashed(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                sets = [s for s in shingle_sets(encoded(batch.column("text").slice(i, 256)), WORDS) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["class", "keys"])

    # a repeated id may bring texts of other classes: they do no harm
    return stored(texts_by_arrow(texts).mapInArrow(hashed, "class long, keys binary").dropDuplicates(["class"]), "sets")


def _mixed(rows: DataFrame, by: str) -> DataFrame:
    """by, m (rows) of the groups of rows that hold more than one label."""
    return (rows.groupBy(by).agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("m"))
            .where("l0 <> l1").select(by, "m"))


def _across(rows: DataFrame, by: str, also: str = "true") -> DataFrame:
    x, y = rows.alias("x"), rows.alias("y")
    return (x.join(y, F.expr(f"x.{by} = y.{by} and x.label < y.label and {_may_link('x', 'y')} and ({also})"))
            .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")))


def crowded_pairs(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: pairs of crowded classes (class, label, n, s0, s1) with different labels that can link.

    Exact for all pairs among them: prefix, length and position filter on their shingles, rarest first.
    """
    def listed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.int64)
                for i in range(0, len(keys), 50_000):
                    k = keys[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.full(len(k), row["class"], np.int64))], names=["shingle", "class"])

    entries = stored(crowded.join(sets, "class").select("class", "keys").mapInArrow(listed, "shingle long, class long"), "entries")
    shared = entries.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    # shingles of one class alone come first in the order: only their number matters
    lists = (entries.join(shared, "shingle").groupBy("class")
             .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("s")).join(crowded, "class")
             .withColumn("alone", F.col("n") - F.size("s"))
             .withColumn("q", F.expr(f"n - cast(ceil({SHARE} * n / 100D - 1e-9) as long) + 1 - alone")).where("q > 0"))
    prefix = stored(lists.select(*crowded.columns, "alone", F.posexplode(F.expr("slice(s, 1, cast(least(q, size(s)) as int))")).alias("i", "e"))
                    .select(*crowded.columns, (F.col("n") - F.col("alone") - F.col("i")).alias("left"), F.col("e.shingle").alias("shingle")), "prefix")
    rows = prefix.join(_mixed(prefix, "shingle").drop("m"), "shingle")
    return _across(rows, "shingle", f"{100 + SHARE} * least(x.left, y.left) >= {SHARE} * (x.n + y.n)").distinct()


def _to_heaviest(near: DataFrame) -> DataFrame:
    """a, b: each class and the heaviest class of its region, in the first trees."""
    weight = near.groupBy("class").agg(F.sum("same").alias("weight"))
    rows = (near.where(F.shiftright("path", BITS * DEPTH) < FIRST)
            .select(F.shiftright("path", _level(LEAST)).alias("region"), "class", "n", "s0", "s1").join(weight, "class"))
    heaviest = rows.groupBy("region").agg(F.max(F.struct("weight", "class", "n", "s0", "s1")).alias("y"))
    return (rows.alias("x").join(heaviest, "region").where(F.expr(f"x.class <> y.class and {_may_link('x', 'y')}"))
            .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct())


def _smallest(pairs: DataFrame, hops: int = HOPS) -> DataFrame:
    """class, label: the smallest class at most ``hops`` confirmed links away."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    for _ in range(hops - 1):
        label = both.join(label.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("label"))
    return label.select(F.col("a").alias("class"), "label")


def _changes(batches):
    """Pairs of rows next to each other in one sorted part that share a prefix and differ in their label."""
    columns = ["path", "class", "label", "n", "s0", "s1"]
    parts = [[b.column(c).to_numpy() for c in columns] for b in batches if b.num_rows]
    if not parts:
        return
    path, name, label, n, s0, s1 = (np.concatenate(p) for p in zip(*parts, strict=True))
    prefix = path >> _level(LEAST)
    at = np.flatnonzero((prefix[1:] == prefix[:-1]) & (label[1:] != label[:-1])) + 1
    differ = np.bitwise_count(s0[at] ^ s0[at - 1]).astype(int) + np.bitwise_count(s1[at] ^ s1[at - 1])
    at = at[(differ <= DIFFER) & (100 * np.minimum(n[at], n[at - 1]) >= SHARE * np.maximum(n[at], n[at - 1]))]
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(name[at], name[at - 1])), pa.array(np.maximum(name[at], name[at - 1]))], names=["a", "b"])


def _between_labels(rows: DataFrame) -> DataFrame:
    """a, b: classes with different labels that are longest-common-prefix neighbours in any tree."""
    parts = max(shuffle_partitions(rows.sparkSession), math.ceil(rows.count() / ROWS))
    return (rows.select("path", "class", "label", "n", "s0", "s1").repartitionByRange(parts, "path", "class").sortWithinPartitions("path", "class")
            .mapInArrow(_changes, "a long, b long").distinct())


def links(documents: DataFrame, rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """a, b: confirmed links between classes, enough of them for all components."""
    classes = stored(rows.where(F.col("paths").isNotNull()).groupBy("class")
                     .agg(F.first("n_shingles").alias("n"), *[F.first(c).alias(c) for c in ("s0", "s1", "paths")]), "classes")
    near = neighbours(classes)
    sets = full_sets(documents, rows, near.select("class").distinct())
    kept = ["path", "class", "label", "n", "s0", "s1"]

    def mixed(rows: DataFrame, depth: int) -> DataFrame:
        """The rows of regions of that depth that hold several labels, m: rows of the region."""
        placed = rows.select(*kept, F.shiftright("path", _level(depth)).alias("region"))
        return stored(placed.join(_mixed(placed, "region"), "region"), "regions")

    def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
        return rows.select(*[c for c in kept if c != "label"]).join(_smallest(links), "class", "left").withColumn("label", F.coalesce("label", "class"))

    known = stored(confirmed(_to_heaviest(near), sets), "links")
    left = mixed(labelled(near, known), LEAST)
    known = known.unionByName(stored(confirmed(_between_labels(left), sets), "links"))
    left = labelled(left, known)
    pairs = None
    for depth in range(LEAST, DEPTH + 1):
        left = mixed(left, depth)
        small = _across(left.where(F.col("m") <= crowd), "region")
        pairs = small if pairs is None else pairs.unionByName(small)
        left = left.where(F.col("m") > crowd)
    crowded = left.select("class", "label", "n", "s0", "s1").distinct()
    if not crowded.isEmpty():
        pairs = pairs.unionByName(crowded_pairs(crowded, sets))
    return known.unionByName(stored(confirmed(pairs.distinct(), sets), "links"))


def near_duplicates(documents: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (it is its group's smallest id), class."""
    rows = members(documents)
    named = components(links(documents, rows, crowd)).select(F.col("node").alias("class"), "label")
    placed = rows.select("doc_id", "n_shingles", "class").join(named, "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = placed.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return (placed.join(least, "label", "left")
            .withColumn("component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "class"))
