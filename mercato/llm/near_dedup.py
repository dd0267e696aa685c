"""MinHash near-duplicates by fast similarity sketching, exactly verified.

1. Every text becomes its set of distinct word shingles (64-bit names). The
   sketch has ``bins`` coordinates, filled by rounds of hashed placement: in
   round i each shingle offers the value (i, hash) to one hashed bin and a bin
   keeps its smallest offer. Rounds bins .. 2*bins - 1 offer every shingle to
   one given bin each, so all coordinates are always filled; large sets are
   done after a round or two. Texts with equal sets are one class.
2. ``bands`` groups of ``rows`` coordinates are the candidate buckets. The
   chance that two texts at the threshold share no bucket is
   (1 - 0.8**5)**40, about 1e-7.
3. In every bucket each class is verified against the bucket's first class on
   full sets. Components are then known for nearly all classes. Buckets that
   still hold several components are verified as a whole inside tasks (exact
   intersection counts by matrix products over the bucket's shared shingles),
   in blocks bounded by classes and by shingles, and only links that join two
   components come out. No pair of a bucket is left out, and no pair list is
   emitted.
4. Components by min-label propagation with pointer jumping over checkpoints.

Only the full sets of classes that share a bucket are built a second time,
from the documents whose id hits a fixed-size bitmap.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import bitmap, column, cut_lineage, drop_ids, id_bit, one_of_each, with_row_key
from mercato.llm.words import LOWER, Hasher, find_words, mix, text_slices, windows

BLOCK_ROWS = 2048               # classes of a block, at most about
BLOCK_SHINGLES = 1 << 21        # and their shingles (one longer text is a block of its own)
ROWS_AT_ONCE, COLUMNS_AT_ONCE = 128, 1024
_U = np.uint64


def give_back() -> None:
    """Returns freed memory to the system: a reused worker otherwise keeps the peak of each of its stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc
    if trim is not None:
        trim(0)


def giving_back(run):
    """A function over batches that gives its memory back when its partition ends."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def shingle_sets(s, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row of a slice, joined, and the row bounds.

    A text with fewer than k words has its whole word sequence as its one
    shingle, a text without words none."""
    w = find_words(s)
    h = Hasher.of(LOWER[s.data]).ranges(w.start, w.end)
    g, row = windows(h, w.first, k)
    counts = np.diff(w.first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.array([np.uint64(mix(_fold(h[w.first[r]:w.first[r + 1]]), 77)[0]) for r in short], dtype=np.uint64)
        g, row = np.concatenate([g, whole]), np.concatenate([row, short])
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(s.n + 1))


def _fold(h: np.ndarray) -> np.ndarray:
    out = np.zeros(1, np.uint64)
    for x in h:
        out = (out + x) * _U(0x9E3779B97F4A7C15)
    return out + _U(len(h))


def sketch(g: np.ndarray, bound: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketches of the sets g[bound[r]:bound[r+1]], one row each.

    A coordinate is round * 2**52 + 52 hash bits; a row of an empty set keeps
    the largest value throughout."""
    n = len(bound) - 1
    sizes = np.diff(bound)
    full = _U(2**64 - 1)
    out = np.full(n * bins, full, dtype=np.uint64)
    todo = np.flatnonzero(sizes > 0)
    for i in range(2 * bins):
        if not len(todo):
            break
        reps = sizes[todo]
        at = np.repeat(bound[todo] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        h = mix(g[at], 1000 + i)
        base = np.repeat(todo * bins, reps)
        cell = base + ((h >> _U(52)) * _U(bins) >> _U(12)).astype(np.int64) if i < bins else base + (i - bins)
        np.minimum.at(out, cell, (_U(i) << _U(52)) | (h & _U(2**52 - 1)))
        filled = (out.reshape(n, bins)[todo] != full).all(axis=1)
        todo = todo[~filled]
    return out.reshape(n, bins)


def _band_keys(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    n = len(sk)
    x = sk.reshape(n, bands, rows)
    key = np.zeros((n, bands), dtype=np.uint64)
    for j in range(rows):
        key = mix(key * _U(31) + x[:, :, j], j)
    return mix(key + np.arange(bands, dtype=np.uint64)[None, :] * _U(0xD6E8FEB86659FD93), 5)


def _class_names(g: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set: two wrapped sums of mixed shingles."""
    out = []
    for salt in (11, 12):
        total = np.zeros(len(g) + 1, dtype=np.uint64)
        np.cumsum(mix(g, salt), out=total[1:])
        out.append(mix(total[bound[1:]] - total[bound[:-1]], salt).view(np.int64))
    return out[0], out[1]


def _binary_rows(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column of the byte ranges of one array."""
    raw = np.ascontiguousarray(data).view(np.uint8).ravel()
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _sketches(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column("text")):
                g, bound = shingle_sets(s, k)
                keys = _band_keys(sketch(g, bound, bands * rows), bands, rows)
                c1, c2 = _class_names(g, bound)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s.first, s.n), pa.array(c1), pa.array(c2), pa.array(np.diff(bound).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(s.n + 1, dtype=np.int32) * bands), pa.array(keys.ravel().view(np.int64)))],
                    names=["doc_id", "c1", "c2", "n", "keys"])
    return run


def _sets(k: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            hit = bits[batch.column("bit").to_numpy()]
            batch = batch.filter(pa.array(hit))
            for s in text_slices(batch.column("text")):
                g, bound = shingle_sets(s, k)
                c1, c2 = _class_names(g, bound)
                yield pa.RecordBatch.from_arrays([pa.array(c1), pa.array(c2), _binary_rows(g, bound * 8)], names=["c1", "c2", "grams"])
    return run


def linked(inter, a, b, percent: int):
    """100 * |A n B| >= percent * |A u B|, for numbers or arrays."""
    return 100 * inter >= percent * (a + b - inter)


def _verify(percent: int):
    """Pairs (a, b, both sets) whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("grams_a"), batch.column("grams_b")
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(v[i].as_buffer(), dtype=np.uint64) for v in (x, y))
                inter = len(np.intersect1d(a, b, assume_unique=True))
                ok[i] = linked(inter, len(a), len(b), percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    return run


def _bucket_links(percent: int):
    """Links between components inside one block (or pair of blocks) of a bucket.

    Held at a time: the block's shingles, one count per pair of a row outside the largest component and any row, and
    slices of ROWS_AT_ONCE rows and COLUMNS_AT_ONCE shingles."""
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        comp = np.unique(table.column("comp").to_numpy(), return_inverse=True)[1]
        grams = table.column("grams").combine_chunks()
        size = np.array([len(v.as_buffer()) // 8 for v in grams])
        flat = np.concatenate([np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in grams])
        row = np.repeat(np.arange(len(size), dtype=np.int32), size)
        order = np.argsort(flat, kind="stable")
        flat, row = flat[order], row[order]
        del order
        new = np.ones(len(flat), dtype=bool)
        new[1:] = flat[1:] != flat[:-1]
        del flat
        start = np.flatnonzero(new)
        many = np.diff(np.append(start, len(row))) > 1            # shingles of one row alone count for no pair
        col = (np.cumsum(many) - 1).astype(np.int32)[np.cumsum(new) - 1]
        keep = many[np.cumsum(new) - 1]
        row, col = row[keep], col[keep]
        major = np.bincount(comp).argmax()
        rest = np.flatnonzero(comp != major)       # every pair of two components has one row here
        inter = np.zeros((len(rest), len(size)), dtype=np.float32)
        for c in range(0, int(col.max()) + 1 if len(col) else 0, COLUMNS_AT_ONCE):
            first, last = np.searchsorted(col, [c, c + COLUMNS_AT_ONCE])
            m = np.zeros((len(size), COLUMNS_AT_ONCE), dtype=np.float32)
            m[row[first:last], col[first:last] - c] = 1
            for r in range(0, len(rest), ROWS_AT_ONCE):
                inter[r:r + ROWS_AT_ONCE] += m[rest[r:r + ROWS_AT_ONCE]] @ m.T
        parent = list(range(int(comp.max()) + 1))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x
        out = []
        for r in range(0, len(rest), ROWS_AT_ONCE):
            some = rest[r:r + ROWS_AT_ONCE]
            both = np.rint(inter[r:r + ROWS_AT_ONCE]).astype(np.int64)
            good = linked(both, size[some][:, None], size[None, :], percent) & (comp[some][:, None] != comp[None, :])
            for i, j in zip(*np.nonzero(good)):
                p, q = find(comp[some[i]]), find(comp[j])
                if p != q:
                    parent[p] = q
                    out.append((int(node[some[i]]), int(node[j])))
        if len(size) > BLOCK_ROWS // 4:
            del grams, row, col, inter
            give_back()
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): for every node of the edges (a, b) the smallest node it reaches.

    Each round takes the least label among the neighbours, then jumps
    label -> label of the label; rounds grow with the logarithm of the longest
    chain. State is cut by reliable checkpoints."""
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("old"))
        step = cut_lineage(step)
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = cut_lineage(step.join(jump, "comp", "left")
                          .select("node", F.least("comp", F.coalesce("far", "comp")).alias("comp"), "old"))
        if new.filter("comp < old").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                    percent: int = 80, bands: int = 40, rows: int = 5) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) per row of docs.

    Null and empty texts, and texts without words, have no shingles and are
    linked with nothing. Rows that repeat an id are one document with several
    texts: they share the component only if their texts are linked. A null id
    is carried; it names a component only where no other id is in it. Other
    columns are ignored, whatever their names. An empty table gives no rows."""
    spark = docs.sparkSession
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    seen = cut_lineage(src.mapInArrow(giving_back(_sketches(shingle_words, bands, rows)), "doc_id long, c1 long, c2 long, n long, keys array<long>"))
    classes = (seen.filter("n > 0").groupBy("c1", "c2")
               .agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("keys").alias("keys"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = cut_lineage(classes)
    band = classes.select("node", "n", F.explode("keys").alias("key"))
    lead = (band.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("members"), F.sum("n").alias("shingles"))
            .filter("members > 1"))
    member = cut_lineage(band.join(lead, "key").select("key", "node", "n", "members", "shingles", F.col("lead.node").alias("a"), F.col("lead.n").alias("an")))
    star = (member.filter(F.col("a") != F.col("node"))
            .filter((100 * F.least("n", "an")) >= percent * F.greatest("n", "an"))
            .select("a", F.col("node").alias("b")).distinct())
    used = member.select("node").distinct().join(classes.select("node", "doc", "c1", "c2"), "node")
    used = cut_lineage(used)
    wanted = spark.sparkContext.broadcast(bitmap(used, "doc"))
    sets = (src.withColumn("bit", id_bit(F.col("doc_id")))
            .mapInArrow(giving_back(_sets(shingle_words, wanted)), "c1 long, c2 long, grams binary")
            .join(used.select("node", "c1", "c2"), ["c1", "c2"]).select("node", "grams").dropDuplicates(["node"]))
    sets = cut_lineage(sets)
    pairs = (star.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b")
             .join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a"))
    edges = cut_lineage(pairs.select("a", "b", "grams_a", "grams_b").mapInArrow(giving_back(_verify(percent)), "a long, b long"))
    comp = components(edges)
    # Buckets of three or more classes (in two the only pair is verified) that hold several components.
    known = member.filter("members > 2").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    open_rows = (known.join(mixed, "key")
                 .withColumn("blocks", F.ceil(F.greatest(F.col("members") / F.lit(BLOCK_ROWS // 2), F.col("shingles") / F.lit(BLOCK_SHINGLES // 2))).cast("int"))
                 .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("key", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "node", "comp"))
    more = (open_rows.join(sets, "node").groupBy("key", "b1", "b2").applyInArrow(_bucket_links(percent), "a long, b long"))
    edges = cut_lineage(edges.union(more).distinct())
    comp = components(edges)
    named = classes.select("node", "c1", "c2", "doc").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = cut_lineage(named)
    ids = named.groupBy("comp").agg(F.min("doc").alias("component_id"))
    found = named.join(ids, "comp").select("c1", "c2", "component_id")
    out = seen.select("doc_id", "c1", "c2", "n").join(found, ["c1", "c2"], "left")
    # n = 0 never matches a class: its name belongs to the empty set, which has no class row
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one with the smallest id (null last), and all rows without shingles (columns unchanged).

    Rows are told apart by id and text, so a null or repeated id drops no other
    text; of rows equal in both one stays."""
    rows, key = with_row_key(docs, id_col, text_col)
    found = near_duplicates(rows, key, text_col).filter("n_shingles > 0")
    keys = found.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("comp"), F.count("*").alias("n"))
    ids = rows.select(F.col(key).alias("key"), column(rows, id_col).cast("long").alias("id")).groupBy("key").agg(F.min("id").alias("id"))
    keys = cut_lineage(keys.join(ids, "key"))
    first = keys.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    keys = cut_lineage(keys.join(first, "comp").select("key", "n", (F.col("key") == F.col("first.key")).alias("stays")))
    left = drop_ids(rows, key, keys.filter("NOT stays"), "key")
    return one_of_each(left, key, keys.filter("stays AND n > 1"), "key").drop(key)
