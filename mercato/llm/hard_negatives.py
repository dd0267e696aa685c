"""Hard-negative mining by Four-Russians scoring: exact integer inner products from table lookups.

Every component becomes the integer floor(scale * x). Candidates are packed in
chunks: per bit plane (two's complement) and group of eight dimensions one
byte. For the anchors a table per group holds the sums of all 256 subsets of
the anchor's eight components. A candidate's byte is the index into that
table, so a score is the sum over planes and groups of looked-up subset sums,
shifted by the plane (the sign plane counts negative): every score is full and
exact, no candidate is left out.

Anchors are a stated query set (ids divisible by ``every``) against all rows, in
blocks: anchors lie in blocks of about ``ANCHORS``, chunks in salted groups of
about ``GROUP_ROWS`` candidates, and each pair of block and group is one
bounded task input. A pair gives the best few per anchor; the best of all pairs
follow from a ranking per anchor. The first pass finds the positives, the
second, whose tables are built anew, the negatives inside each positive's window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.tables import column, cut_lineage

ANCHORS = 1024          # anchors of a block, about
CHUNK_ROWS = 2048       # candidates of a chunk, at most
GROUP_ROWS = 16384      # candidates of a task's group, about
LANES = 64              # anchors whose tables are in use at a time
_NONE = np.iinfo(np.int64).min

CHUNK = "chunk long, n int, planes int, groups int, ids binary, no_id binary, labels binary, bits binary"
BLOCK = "block int, n int, dims int, ids binary, labels binary, parts binary"


def quantized(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, id-is-null, labels and integer components (shorter vectors filled up with zeros) of the rows that take part."""
    vectors = batch.column("vector")
    offsets = np.asarray(vectors.offsets, dtype=np.int64)
    flat = vectors.values.cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)            # nulls become NaN
    lengths = np.where(vectors.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    ok = (bad[offsets[:-1] + lengths] == bad[offsets[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    ok &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(ok)
    lengths = lengths[rows]
    dims = -(-int(lengths.max(initial=0)) // 8) * 8
    q = np.zeros((len(rows), dims))
    at = np.repeat(offsets[rows] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    q[np.arange(dims)[None, :] < lengths[:, None]] = np.floor(scale * x[at])
    if np.abs(q).max(initial=0) >= 2.0**40:
        raise ValueError("a component is too large for exact 64-bit scores")
    ids = batch.column("vec_id")
    return (ids.fill_null(0).to_numpy()[rows], ids.is_null().to_numpy(zero_copy_only=False)[rows],
            batch.column("label").fill_null(0).to_numpy()[rows], q.astype(np.int64))


def bit_planes(q: np.ndarray) -> np.ndarray:
    """Bytes [plane, group, row]: bit k of a byte is the plane's bit of dimension 8 * group + k."""
    most = max(int(q.max(initial=0)), -int(q.min(initial=0)) - 1, 0)
    n, dims = q.shape
    planes = [np.packbits(((q >> b) & 1).astype(np.uint8).reshape(n, dims // 8, 8), axis=2, bitorder="little")[:, :, 0].T
              for b in range(most.bit_length() + 1)]
    return np.ascontiguousarray(np.stack(planes))


def subset_tables(parts: np.ndarray, groups: int, dtype) -> np.ndarray:
    """[group, subset, anchor]: the sums of every subset of each anchor's eight components of a group."""
    a = np.zeros((len(parts), groups * 8), dtype=dtype)
    width = min(groups * 8, parts.shape[1])
    a[:, :width] = parts[:, :width]
    out = np.zeros((groups, 256, len(parts)), dtype=dtype)
    for k in range(8):
        out[:, 1 << k:2 << k] = out[:, :1 << k] + a[:, k::8].T[:, None, :]
    return out


def scores(bits: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """[row, anchor] exact inner products, from the highest plane down: double, then add the looked-up sums."""
    planes, groups, n = bits.shape
    acc = np.zeros((n, tables.shape[2]), dtype=tables.dtype)
    found = np.empty_like(acc)
    for b in range(planes - 1, -1, -1):
        acc += acc
        for g in range(min(groups, len(tables))):
            np.take(tables[g], bits[b, g], axis=0, out=found, mode="clip")
            if b == planes - 1:
                acc -= found
            else:
                acc += found
    return acc


def _score_type(bits: np.ndarray, parts: np.ndarray):
    """32 bits where no partial sum can leave them, else 64; refuses what 64 bits can't hold."""
    bound = (1 << len(bits)) * int(np.abs(parts).sum(axis=1).max(initial=0))
    if bound >= 2**51:                                 # keys hold a score times CHUNK_ROWS
        raise ValueError("scores are too large for 64 bits")
    return np.int32 if bound < 2**31 else np.int64


def _chunks(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                ids, none, labels, q = quantized(batch.slice(at, CHUNK_ROWS), scale)
                if not len(ids):
                    continue
                order = np.lexsort((ids, none))        # ties in a chunk go by place
                bits = bit_planes(q[order])
                yield pa.RecordBatch.from_pylist([{
                    "chunk": (part << 33) + made, "n": len(ids), "planes": bits.shape[0], "groups": bits.shape[1],
                    "ids": ids[order].tobytes(), "no_id": none[order].tobytes(), "labels": labels[order].tobytes(), "bits": bits.tobytes()}],
                    schema=_CHUNK_SCHEMA)
                made += 1
    return run


_CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("n", pa.int32()), ("planes", pa.int32()), ("groups", pa.int32()), ("ids", pa.binary()),
                           ("no_id", pa.binary()), ("labels", pa.binary()), ("bits", pa.binary())])
_BLOCK_SCHEMA = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
                           ("parts", pa.binary())])


def _blocks(scale: int):
    """The anchors of a block in one row, by id, label and vector."""
    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        ids, _, labels, q = quantized(batch, scale)
        order = np.lexsort((*q.T[::-1], labels, ids))
        return pa.Table.from_pylist([{"block": batch.column("block")[0].as_py(), "n": len(ids), "dims": q.shape[1], "ids": ids[order].tobytes(),
                                      "labels": labels[order].tobytes(), "parts": q[order].tobytes()}], schema=_BLOCK_SCHEMA)
    return run


def _first(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest keys of each column, those at _NONE left out."""
    k = min(k, len(keys))
    top = np.argpartition(keys, len(keys) - k, axis=0)[-k:]
    row, col = top.ravel(), np.tile(np.arange(keys.shape[1]), k)
    some = keys[row, col] > _NONE
    return row[some], col[some]


_HIT = [("block", pa.int32()), ("anchor", pa.int32()), ("positive", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())]
HIT = "block int, anchor int, positive int, score long, vec_id long"


def _best(k: int, percent: int | None):
    """The best k candidates per anchor (percent None: of its label) or per anchor and positive (of other labels, in the positive's window)."""
    def run(anchors: pa.Table, chunks: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[] for _ in range(5)]
        if not anchors.num_rows or not chunks.num_rows:
            return pa.Table.from_pylist([], schema=pa.schema(_HIT))
        a = anchors.to_pylist()[0]
        ids, labels = np.frombuffer(a["ids"], np.int64), np.frombuffer(a["labels"], np.int64)
        parts = np.frombuffer(a["parts"], np.int64).reshape(a["n"], a["dims"])
        limits = None if percent is None else np.frombuffer(a["limits"], np.int64).reshape(a["n"], -1)
        for batch in chunks.to_batches():
            for c in batch.to_pylist():
                bits = np.frombuffer(c["bits"], np.uint8).reshape(c["planes"], c["groups"], c["n"])
                cid, none, clabel = np.frombuffer(c["ids"], np.int64), np.frombuffer(c["no_id"], bool), np.frombuffer(c["labels"], np.int64)
                place = np.arange(c["n"])[::-1, None]
                dtype = _score_type(bits, parts)
                for at in range(0, a["n"], LANES):
                    s = scores(bits, subset_tables(parts[at:at + LANES], c["groups"], dtype)).astype(np.int64)
                    keys = s * CHUNK_ROWS + place
                    same = clabel[:, None] == labels[None, at:at + LANES]
                    if percent is None:
                        other = none[:, None] | (cid[:, None] != ids[None, at:at + LANES])
                        fits = [same & other]
                    else:
                        low = limits[at:at + LANES]
                        fits = [~same & (low[:, p] > _NONE) & (percent * low[:, p] <= 100 * s) & (s <= low[:, p]) for p in range(low.shape[1])]
                    for p, fit in enumerate(fits):
                        row, col = _first(np.where(fit, keys, _NONE), k)
                        for out, x in zip(found, (col + at, np.full(len(row), p), s[row, col], cid[row], none[row])):
                            out.append(x)
        anchor, p, s, cid, none = (np.concatenate(x) for x in found)
        order = np.lexsort((cid, none, -s, p, anchor))
        anchor, p, s, cid, none = (x[order] for x in (anchor, p, s, cid, none))
        group = np.concatenate([[0], np.cumsum((anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1]))]) if len(p) else np.zeros(0, np.int64)
        keep = np.arange(len(p)) - np.searchsorted(group, group) < k
        return pa.table([pa.array(np.full(int(keep.sum()), a["block"]), pa.int32()), pa.array(anchor[keep], pa.int32()), pa.array(p[keep], pa.int32()),
                         pa.array(s[keep]), pa.array(cid[keep], mask=none[keep])], schema=pa.schema(_HIT))
    return run


def _limits(count: int):
    """Joins the scores of a block's positives, as one row of numbers, onto the block."""
    def run(anchors: pa.Table, positives: pa.Table) -> pa.Table:
        limits = np.full((anchors.column("n")[0].as_py() if anchors.num_rows else 0, count), _NONE)
        limits[positives.column("anchor").to_numpy(), positives.column("rank").to_numpy() - 1] = positives.column("score").to_numpy()
        return anchors.append_column("limits", pa.array([limits.tobytes()] * anchors.num_rows, pa.binary()))
    return run


def _ranked(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100,
         positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Anchors are the rows whose id is divisible by `every`; their positives the
    best `positives` rows of the same label with another id; the negatives of a
    positive the best `negatives` rows of other labels whose score is at least
    `percent` % of the positive's and at most the positive's. Higher scores
    come first, then smaller ids, a null id last.

    Rows with a null label or vector, or with a null or non-finite component,
    take no part. Vectors may differ in length; missing components count as 0,
    so an empty vector scores 0. A row with a null id is a candidate only. Rows that
    repeat an id are candidates each for themselves, and an anchor once per different
    label or vector. Components of 2**40 and more, or scores that would not fit 64 bits,
    raise an error. Other columns are ignored. An empty table gives no rows."""
    label = column(rows, label_col).cast("long")
    src = rows.select(column(rows, id_col).cast("long").alias("vec_id"), label.alias("label"), column(rows, vector_col).cast("array<double>").alias("vector"))
    chunks = cut_lineage(src.mapInArrow(_chunks(scale), CHUNK))
    salts = max(1, -(-int(chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // GROUP_ROWS))
    chosen = cut_lineage(src.filter((F.col("vec_id") % every == 0) & F.col("label").isNotNull() & F.col("vector").isNotNull()
                                    & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).distinct())
    n_blocks = max(1, -(-chosen.count() // ANCHORS))
    blocks = cut_lineage(chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(n_blocks)).cast("int"))
                         .groupBy("block").applyInArrow(_blocks(scale), BLOCK))
    dealt = (chunks.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).groupBy("block", "salt"))

    def against(anchors: DataFrame, k: int, window: int | None) -> DataFrame:
        spread = anchors.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        return spread.groupBy("block", "salt").cogroup(dealt).applyInArrow(_best(k, window), HIT)

    near = cut_lineage(_ranked(against(blocks, positives, None), ["block", "anchor"], positives).select("block", "anchor", "rank", "score", "vec_id"))
    bounded = blocks.groupBy("block").cogroup(near.groupBy("block")).applyInArrow(_limits(positives), BLOCK + ", limits binary")
    hard = _ranked(against(bounded, negatives, percent), ["block", "anchor", "positive"], negatives)
    names = blocks.mapInArrow(_names, "block int, anchor int, anchor_id long")
    return (hard.select("block", "anchor", (F.col("positive") + 1).alias("p"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near.select("block", "anchor", F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                  ["block", "anchor", "p"])
            .join(names, ["block", "anchor"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in batch.select(["block", "n", "ids"]).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([b["block"]] * b["n"], pa.int32()), pa.array(range(b["n"]), pa.int32()),
                                              pa.array(np.frombuffer(b["ids"], np.int64))], names=["block", "anchor", "anchor_id"])


def shifted_label(id_col: str = "vec_id", label_col: str = "label"):
    """The contract's labels: where the id is divisible by 7 the next of ten."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
