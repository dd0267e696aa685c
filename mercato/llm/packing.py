"""Packing into fixed windows by Karmarkar-Karp multiway differencing.

Every document becomes its token ids and one end id. Whole windows are cut off
its front; the remainders of a task gather in a pool. A full pool is divided
into k = ceil(tokens / window) windows by multiway differencing: the two
partial partitions with the widest imbalance are merged, heaviest part of one
onto the lightest of the other, until one partition is left. While a part
exceeds the window, k rises. Then the lightest windows are taken apart and cut
to fill the others to the brim; what is left of the last one goes back into
the pool. Only the last window of a task can be padded.

Nothing is shuffled: a task packs the rows it reads, and its memory is one
input batch and one pool. A repeated task gives the same rows, and sequence
ids are partition id * 2**33 + position.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import vocab
from mercato.llm.tables import column

SCHEMA = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """text -> ids as little-endian unsigned 32-bit bytes, equal to the tokenizer library's.

    The merges run in a rank encoder over the same vocabulary. Texts with
    special strings, or with characters whose class differs between Unicode
    versions, are encoded by the tokenizer library itself."""

    def __init__(self, path: str):
        import tiktoken
        ids, _, self.special = vocab.load(path)
        pattern = vocab.SPLIT.format(L=r"\p{L}", N=r"\p{N}", S=vocab.WHITE, LL=r"\p{L}", NN=r"\p{N}")
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
        self.path, self.whole = path, None

    def ids(self, text: str) -> bytes:
        if vocab.UNSTABLE.search(text) or any(x in text for x in self.special):
            self.whole = self.whole or vocab.library(self.path)
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return np.fromiter(ids, dtype="<u4", count=len(ids)).tobytes()


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """Loads (falling) and item numbers of k parts of the sizes."""
    heap = []
    for i, size in enumerate(sizes):
        loads = np.zeros(k, dtype=np.int64)
        loads[0] = size
        heap.append((-size, i, loads, [(i,), *[()] * (k - 1)]))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        loads = a + b[::-1]
        parts = [x + y if y else x for x, y in zip(left, reversed(right))]
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        heapq.heappush(heap, (int(loads[-1] - loads[0]), made, loads, [parts[j] for j in order]))
        made += 1
    return heap[0][2], heap[0][3]


class Pool:
    """Remainder pieces (doc_id, start, ids, doc_tokens) of one task and the windows made of them."""

    def __init__(self, window: int):
        self.window, self.pieces, self.tokens = window, [], 0

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.tokens += len(piece[2]) // 4

    def windows(self, last: bool) -> Iterator[list[tuple]]:
        """Windows made of the pool; if not last, an unfilled one stays in it."""
        if not self.pieces:
            return
        sizes = [len(p[2]) // 4 for p in self.pieces]
        k = -(-self.tokens // self.window)
        while True:
            loads, parts = differencing(sizes, k)
            if loads[0] <= self.window:
                break
            k += 1 + int((loads[0] - self.window) * k // self.window)     # capacity exceeded: more windows
        order = sorted(range(k), key=lambda j: -loads[j])
        made = [[self.pieces[i] for i in parts[j]] for j in order]
        free = [self.window - int(loads[j]) for j in order]
        donors: list[tuple] = []
        for j in range(k):
            while j < len(made) and free[j]:
                if not donors:
                    if len(made) - 1 <= j:
                        break
                    donors = made.pop()
                doc, start, ids, total = donors.pop()
                take = min(free[j] * 4, len(ids))
                made[j].append((doc, start, ids[:take], total))
                free[j] -= take // 4
                if take < len(ids):
                    donors.append((doc, start + take // 4, ids[take:], total))
        self.pieces, self.tokens = [], 0
        if donors:
            made.append(donors)
        for window in made:
            if not last and sum(len(p[2]) for p in window) < 4 * self.window:
                for p in window:
                    self.add(p)
            elif window:
                yield window


def _pack(path: str, window: int, end_id: int, pool_windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pool = encoder(path).ids, Pool(window)
        end = np.array([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        size = 0

        def put(pieces: list[tuple]) -> None:
            nonlocal number, size
            at = 0
            for doc, start, ids, total in pieces:
                out.append((doc, start, ids, total, number, at))
                at += len(ids) // 4
            size += at
            number += 1

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                               names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])
            out, size = [], 0
            return batch

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                whole = total // window * window
                for at in range(0, whole, window):
                    put([(doc, at, ids[at * 4:(at + window) * 4], total)])
                if whole < total:
                    pool.add((doc, whole, ids[whole * 4:], total))
                if pool.tokens >= pool_windows * window:
                    for made in pool.windows(last=False):
                        put(made)
                if size >= 1 << 19:
                    yield flush()
        for made in pool.windows(last=True):
            put(made)
        if out:
            yield flush()
    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         end_id: int = 1, pool_windows: int = 128) -> DataFrame:
    """Pieces (doc_id, start, ids, doc_tokens, sequence_id, offset) of all rows.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit bytes.
    Each id of a row lies in exactly one piece. A null text is an empty one
    (one id, the end id). Rows that repeat an id or a text are packed each for
    itself, a null id is carried. Other columns are ignored. An empty table
    gives no rows."""
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    return src.mapInArrow(_pack(tokenizer_path, window, end_id, pool_windows), SCHEMA)


def piece_report(pieces: DataFrame, *keep: str) -> DataFrame:
    """The packed pieces with their digests in place of the ids; the columns in keep stay beside them."""
    return pieces.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", *keep)
