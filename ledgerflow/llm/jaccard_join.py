"""N-gram Jaccard join: documents whose sets of word shingles have a similarity of
at least 3/4, by a size-aware heavy-light join.

Two sets link when 100 * |A and B| >= 75 * |A or B|, i.e. 7 |A and B| >= 3 (|A| + |B|).

1. Sets. Equal sets form one class, named by a 64-bit hash of the set; from here
   on classes are joined, so copies cost one set each. (Names of different sets
   collide with probability n^2 / 2^65 for n classes.)
2. Inverted lists. Shingles are dealt into buckets by hash, as packed arrays of
   about 7 bytes each; each bucket counts the classes that hold a shingle and
   returns only shared shingles to the classes. One global order: rarest first.
   A class whose prefix (the first n - ceil(3n/4) + 1 shingles in that order) has
   no shared shingle links with nothing and drops out.
3. Light and heavy sets. Light sets enumerate fixed-size subsets: the pairs of
   shared shingles in a prefix one longer, since two different light sets that
   link share at least two there. Heavy sets scan the inverted lists of their prefix
   shingles, which hold every set from 3/4 of the boundary on. The boundary
   between them is the size of least cost: subsets emitted by the light sets plus,
   for the heavy ones, 1 + log2(length) for each list they stand in (a list is
   sorted and compared with its hubs, not pair by pair), from a histogram of both by size.
4. Candidates from a list must have compatible sizes and enough shingles left
   from the shared one on (position filter); their overlap is counted exactly on
   the shared shingles.
5. Components. First each list links its sets of similar size to one of them (that
   with the fewest shingles of its own);
   the components of these links are labelled, and only sets of one list that
   are in different components meet in the second step, each with those of the sizes that
   its own shingles leave in reach (length and position filter before pairing). A group of near copies
   thus costs one verification per member, not one per pair, and no link between
   different components is lost. ``linked_pairs`` gives all links instead.

Defined cases: null and empty texts and texts without words have the empty set and
link with nothing; null ids stay null and are no component's smallest id unless
there is no other; repeated rows are copies; an empty table gives an empty result;
other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import shuffle_partitions, stored, text_or_empty, texts_by_arrow
from .components import components
from .shingles import encoded, set_key, shingle_sets

BUCKET_ENTRIES = 1_500_000  # shingles in a bucket, on average
FLUSH = 500_000  # shingles a task holds before it deals them out
LOW = 44  # bits of a shingle's hash kept within its bucket
SUBSET = 2
_u = np.uint64


def linked(overlap, a, b):
    return 7 * overlap >= 3 * (a + b)


def prefix(n: int) -> int:
    return n - -(-3 * n // 4) + 1


# --- 1, 2: sets, classes, inverted lists ------------------------------------------------------------------------------

def _sets(batch: pa.RecordBatch):
    return shingle_sets(encoded(batch.column("text")))


def sets(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class (null for the empty set)."""
    d = texts_by_arrow(documents).select("doc_id", text_or_empty().alias("text"))

    def named(batches):
        for batch in batches:
            found = [(len(s), set_key(s) if len(s) else None) for s in _sets(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], names=["doc_id", "n_shingles", "class"])

    return stored(d.mapInArrow(named, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_shingles long, class long"), "sets")


DEALT = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("classes", "counts", "low", "high")]])
RETURNED = pa.schema([("dest", pa.int32()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("classes", "counts", "low", "high", "df")]])


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of equal neighbours."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return starts, np.diff(np.concatenate([starts, [len(values)]]))


def _packed(keys: np.ndarray, owners: np.ndarray) -> dict[str, bytes]:
    """Entries in owner order as columns: owners once with their counts, keys in 4 + 2 bytes."""
    starts, counts = _runs(owners)
    return {"classes": owners[starts].tobytes(), "counts": counts.astype(np.uint32).tobytes(),
            "low": keys.astype(np.uint32).tobytes(), "high": (keys >> _u(32)).astype(np.uint16).tobytes()}


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    join = lambda c, kind: np.concatenate([np.frombuffer(b, kind) for b in table[c].to_pylist()])
    keys = join("low", np.uint32).astype(np.uint64) | (join("high", np.uint16).astype(np.uint64) << _u(32))
    return keys, np.repeat(join("classes", np.int64), join("counts", np.uint32))


def _deal(buckets: int):
    def deal(batches):
        seen: set[int] = set()
        keys, owners, held = [], [], 0

        def flush():
            k, o = np.concatenate(keys), np.concatenate(owners)
            bucket = ((k >> _u(LOW)) * _u(buckets) >> _u(64 - LOW)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, k, o = bucket[order], k[order] & _u((1 << LOW) - 1), o[order]
            for start, n in zip(*_runs(bucket), strict=True):
                cut = slice(start, start + n)
                yield pa.RecordBatch.from_pylist([{"bucket": int(bucket[start])} | _packed(k[cut], o[cut])], schema=DEALT)

        for batch in batches:
            for s in _sets(batch):
                if not len(s) or (name := set_key(s)) in seen:
                    continue
                seen.add(name)
                keys.append(s)
                owners.append(np.full(len(s), name, np.int64))
                held += len(s)
                if held >= FLUSH:
                    yield from flush()
                    keys, owners, held = [], [], 0
        if held:
            yield from flush()
    return deal


def _share(dests: int):
    def share(table: pa.Table) -> pa.Table:
        """Of one bucket, the shingles that several classes hold, dealt back to the classes."""
        keys, owners = _unpacked(table)
        order = np.argsort(keys, kind="stable")
        _, n = _runs(keys[order])
        order = order[np.repeat(n > 1, n)]  # held more than once, maybe by one class from two tasks
        order = order[np.lexsort((owners[order], keys[order]))]
        keys, owners = keys[order], owners[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]) if len(keys) else np.empty(0, bool)
        keys, owners = keys[new], owners[new]
        _, n = _runs(keys)
        df = np.repeat(n, n)
        keys, owners, df = keys[df > 1], owners[df > 1], np.minimum(df[df > 1], 255).astype(np.uint8)
        dest = (owners % dests).astype(np.int32)
        order = np.lexsort((owners, dest))
        keys, owners, df, dest = keys[order], owners[order], df[order], dest[order]
        bucket = table["bucket"][0].as_py()
        return pa.Table.from_pylist(
            [{"dest": int(dest[a]), "bucket": bucket, "df": df[a:a + n].tobytes()} | _packed(keys[a:a + n], owners[a:a + n])
             for a, n in zip(*_runs(dest), strict=True)], schema=RETURNED)
    return share


INDEXED = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("alone", pa.int32()), ("q", pa.int32()), ("scan", pa.int64()), ("keys", pa.binary())])


def _index(returned: pa.Table, sizes: pa.Table) -> pa.Table:
    """Of one group of classes, those with a shared shingle in their prefix."""
    out = []
    if returned.num_rows:
        keys, owners = _unpacked(returned)
        bucket = np.repeat(returned["bucket"].to_numpy().astype(np.uint64), [len(b) for b in returned["df"].to_pylist()])
        df = np.concatenate([np.frombuffer(b, np.uint8) for b in returned["df"].to_pylist()])
        keys = keys | (bucket << _u(LOW))
        order = np.lexsort((keys, df, owners))  # the global order: rarest first (255 stands for more), then by hash
        keys, owners, df = keys[order], owners[order], df[order]
        size = dict(zip(sizes["class"].to_pylist(), sizes["n"].to_pylist(), strict=True))
        for start, n in zip(*_runs(owners), strict=True):
            name = int(owners[start])
            alone = size[name] - int(n)  # shingles of no other class come first in the order
            q = prefix(size[name]) - alone
            if q > 0:
                out.append({"class": name, "n": size[name], "alone": alone, "q": q, "scan": int(np.ceil(1 + np.log2(df[start:start + q])).sum()),
                            "keys": keys[start:start + n].astype(np.int64).tobytes()})
    return pa.Table.from_pylist(out, schema=INDEXED)


def index(documents: DataFrame, members: DataFrame) -> DataFrame:
    """class, n (set size), alone (shingles of no other class), q (shared shingles in
    the prefix), scan (cost of their lists), keys (the shared shingles in global order)."""
    total = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = min(1 << 19, max(shuffle_partitions(documents.sparkSession), math.ceil(total / BUCKET_ENTRIES)))
    dealt = documents.select(text_or_empty().alias("text")).mapInArrow(_deal(buckets), "bucket int, classes binary, counts binary, low binary, high binary")
    returned = (dealt.repartition(buckets, "bucket").groupBy("bucket")
                .applyInArrow(_share(buckets), "dest int, bucket int, classes binary, counts binary, low binary, high binary, df binary"))
    sizes = (members.where(F.col("class").isNotNull()).groupBy("class").agg(F.max("n_shingles").cast("int").alias("n"))
             .withColumn("dest", F.pmod("class", F.lit(buckets)).cast("int")))
    return stored(returned.groupBy("dest").cogroup(sizes.groupBy("dest"))
                  .applyInArrow(_index, "class long, n int, alone int, q int, scan long, keys binary"), "index")


# --- 3: light and heavy ------------------------------------------------------------------------------------------------

def boundary(indexed: DataFrame) -> int:
    """The size from which sets are heavy: least subsets enumerated plus lists scanned.

    Sizes are taken together in steps of 5 %, so the histogram stays small.
    """
    longer = F.least(F.col("q") + SUBSET - 1, F.col("n") - F.col("alone"))
    step = F.floor(F.log("n") / math.log(1.05)).cast("int")
    rows = (indexed.groupBy(step.alias("step")).agg(F.sum(longer * (longer - 1) / 2).alias("subsets"), F.sum("scan").alias("scan"), F.min("n").alias("least"))
            .orderBy("step").collect())
    cost, best, at = sum(r["scan"] for r in rows), None, 1
    best = cost
    for i, r in enumerate(rows):
        cost += r["subsets"] - r["scan"]
        if cost < best:
            best, at = cost, rows[i + 1]["least"] if i + 1 < len(rows) else None
    return at if at is not None else (1 << 31) - 1


LISTED = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("left", pa.int32()), ("alone", pa.int32()), ("scans", pa.bool_())])


def _entries(first_heavy: int):
    def mixed(x):
        x = (x ^ (x >> _u(31))) * _u(0x9FB21C651E98DF25)
        return x ^ (x >> _u(28))

    def entries(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], np.uint64)
                n, alone, q = row["n"], row["alone"], row["q"]
                parts = []
                if n < first_heavy:
                    i, j = np.triu_indices(min(q + SUBSET - 1, len(keys)), 1)
                    pair = mixed(keys[i] * _u(0xD1342543DE82EF95) + mixed(keys[j])) | _u(1)
                    parts.append((pair, SUBSET + n - 1 - (alone + j), True))
                if 4 * n >= 3 * first_heavy:
                    at = np.arange(q)
                    parts.append((mixed(keys[:q]) & ~_u(1), n - (alone + at), n >= first_heavy))
                for key, left, scans in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(key), row["class"], np.int64)), pa.array(np.full(len(key), n, np.int32)),
                         pa.array(left.astype(np.int32)), pa.array(np.full(len(key), alone, np.int32)), pa.array(np.full(len(key), scans))], schema=LISTED)
    return entries


def entries(indexed: DataFrame, first_heavy: int | None = None) -> DataFrame:
    """Entries of all lists: key (a shingle or a subset), class, n, left (most shingles
    two sets can share if this is the first shared), alone (shingles of no other
    class), scans (not only listed)."""
    at = boundary(indexed) if first_heavy is None else first_heavy
    return stored(indexed.select("class", "n", "alone", "q", "keys")
                  .mapInArrow(_entries(at), "key long, class long, n int, left int, alone int, scans boolean"), "entries")


# --- 4, 5: candidates, verification, components ------------------------------------------------------------------------

def _may_link(a: str, b: str):
    return F.expr(f"({a}.scans or {b}.scans) and 4 * {a}.n >= 3 * {b}.n and 4 * {b}.n >= 3 * {a}.n "
                  f"and 7L * least({a}.left, {b}.left) >= 3L * ({a}.n + {b}.n)")


def _in_reach(rows: DataFrame, also: str) -> DataFrame:
    """Pairs of a list's entries (x, and y no larger) that may link, met by size.

    An entry whose sets can share at most ``left`` shingles from here on links with none above
    7 left / 3 - n, nor below 3 n / 4: it looks for the bands of sizes (5 % wide, single sizes below
    twenty) in between, down from its own, and meets only these. Entries of one size
    with too many shingles of their own thus never meet, however many share the list.
    """
    band = lambda n: F.floor(F.log(n) / math.log(1.05)).cast("int")
    least, most = F.ceil(F.col("n") * 3 / 4), F.least(F.col("n"), F.floor(F.col("left") * 7 / 3 - F.col("n")))
    looking = rows.where(most >= least).withColumn("band", F.explode(F.sequence(band(least), band(most))))
    found = rows.where(7 * F.col("left") >= 6 * F.col("n")).withColumn("band", band(F.col("n")))
    return looking.alias("x").join(found.alias("y"), F.expr(f"x.key = y.key and x.band = y.band and y.n <= x.n and {also}") & _may_link("x", "y"))


def verified(pairs: DataFrame, indexed: DataFrame) -> DataFrame:
    """a, b, overlap, n_a, n_b of the pairs (a, b) that link."""
    side = lambda s: indexed.select(F.col("class").alias(s), F.col("n").alias(f"n_{s}"), F.col("keys").alias(f"keys_{s}"))

    def verify(batches):
        for batch in batches:
            keys = [[np.frombuffer(k, np.int64) for k in batch.column(c).to_pylist()] for c in ("keys_a", "keys_b")]
            overlap = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*keys, strict=True)], np.int64)
            sizes = [batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b")]
            keep = pa.array(linked(overlap, *sizes))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(overlap), pa.array(sizes[0]), pa.array(sizes[1])],
                                             names=["a", "b", "overlap", "n_a", "n_b"]).filter(keep)

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(verify, "a long, b long, overlap long, n_a long, n_b long")


def linked_pairs(listed: DataFrame, indexed: DataFrame) -> DataFrame:
    """All links between different classes: a < b, overlap and set sizes."""
    x, y = listed.alias("x"), listed.alias("y")
    pairs = x.join(y, F.expr("x.key = y.key and x.class < y.class") & _may_link("x", "y")).select(F.expr("x.class").alias("a"), F.expr("y.class").alias("b"))
    return verified(pairs.distinct(), indexed)


def class_components(listed: DataFrame, indexed: DataFrame) -> DataFrame:
    """class, component (a class of it) of every class that links with another.

    A list's hub is its set with the fewest shingles of its own: among copies with
    edits the original, which the others resemble more than each other.
    """
    rows = listed.withColumn("band", F.floor(F.log("n") / math.log(4 / 3)).cast("int"))
    hubs = (rows.groupBy("key", "band").agg(F.min(F.struct(~F.col("scans"), "alone", "class", "n", "left", "scans")).alias("h"), F.count("*").alias("m"))
            .where("m > 1").select("key", "band", "h.class", "h.n", "h.left", "h.scans"))
    to_hub = (rows.alias("x").join(hubs.alias("y"), F.expr("x.key = y.key and x.band = y.band and x.class <> y.class") & _may_link("x", "y"))
              .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct())
    links = stored(verified(to_hub, indexed).select("a", "b"), "links")
    label = components(links)

    named = (listed.join(label.select(F.col("node").alias("class"), "label"), "class", "left")
             .withColumn("label", F.coalesce("label", "class")))
    split = named.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("key")
    left = stored(named.join(split, "key"), "split")
    across = (_in_reach(left, "x.label <> y.label")
              .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct())
    more = stored(verified(across, indexed).select("a", "b"), "links")
    if more.isEmpty():
        return label.select(F.col("node").alias("class"), F.col("label").alias("component"))
    return components(links.unionByName(more)).select(F.col("node").alias("class"), F.col("label").alias("component"))


def _placed(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class, component (a class; null for the empty set) of each row."""
    members = sets(documents)
    indexed = index(documents, members)
    of_class = class_components(entries(indexed), indexed)
    return members.join(of_class, "class", "left").withColumn("component", F.coalesce("component", "class"))


def join(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class."""
    placed = _placed(documents)
    least = placed.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (placed.join(least, "component", "left")
            .select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    "class"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` without the near copies: of each component one row of its smallest
    doc_id stays (null after all others); documents without words all stay.

    Rows are found again by id and set, so a repeated id with another text is
    judged by its own text; of rows equal in both any one stays."""
    first = (_placed(documents).where(F.col("component").isNotNull()).groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class")).alias("first"))
             .select(F.col("first.doc_id").alias("__id"), F.col("first.class").alias("__set")))

    def named(batches):
        for batch in batches:
            names = [set_key(s) if len(s) else None for s in shingle_sets(encoded(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.int64())], names=[*batch.schema.names, "__class"])

    schema = StructType([*documents.schema.fields, StructField("__class", LongType())])
    rows = documents.mapInArrow(named, schema)
    kept = rows.alias("d").join(first.alias("f"), F.expr("d.__class = f.__set and d.doc_id <=> f.__id"), "left_semi")
    return (kept.dropDuplicates(["doc_id", "__class"]).unionByName(rows.where(F.col("__class").isNull())).drop("__class"))
