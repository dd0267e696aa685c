"""Benchmark decontamination by latent semantic retrieval.

1. Word weights: inverse frequency over all words of all documents (counted
   in hashed bins). No word is without weight: an item that many documents hold
   makes its own words frequent, and is still to be found.
2. The benchmark's passages (overlapping runs of ``PASSAGE`` words) as TF-IDF
   rows are factored by a distributed randomised SVD: a hashed Gaussian
   sketch, one power step, QR, and the eigenvectors of the small Gram matrix.
   The space has `rank` dimensions, whatever the number of passages; at most
   BINS x rank numbers and rank x rank matrices reach the driver.
3. Every document is read in runs of PASSAGE words, half overlapping. A
   truncated space keeps only a part of a passage's length, each its own, so
   the latent product of run and passage is measured by the passage's kept
   square: a copy scores 1, a paraphrase about its cosine. Both must also
   point the same way inside the space, where what has only words in common
   scatters by about 1 / sqrt(rank). Passages that keep less than
   ``LEAST_KEPT`` of their length are left to the exact runs.
   These are one run of ``ANCHOR`` words of each passage (its heaviest; an
   item with fewer words is one run), so an item that is there word for word is
   found whatever stands around it.
4. A candidate is confirmed on the words themselves: the longest common
   subsequence of the item and the run's surroundings covers enough of the
   item; between the lower and the upper threshold (paraphrases) the item's
   answer, its last sentence, must be there too. Of an item of more than ``PART``
   words, PART words around the candidate's passage are enough, so a long
   item quoted in part is found.

The benchmark is the query set. A pass over the documents scores up to
``PASS_PASSAGES`` passages, so what it broadcasts has a fixed bound;
the work grows with the number of passages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import column, cut_lineage, drop_ids, with_row_key
from mercato.llm.words import Hasher, TextSlice, find_words, mix, text_slices, windows

BIN_BITS = 17
BINS = 1 << BIN_BITS
COUNT_BLOCK = 2048
PASSAGE = 32
HALF = PASSAGE // 2
PASS_PASSAGES = 1 << 16
ANCHOR = 8
PART = 64
LEAST_KEPT = 0.1
#: Least cosine of both inside the space, whose chance values scatter by 1 / sqrt(rank) whatever the kept lengths.
ANGLE = 0.35
LEAST_WEIGHT = 0.1
#: Directions sketched beyond the rank, as a randomised SVD needs for a flat spectrum.
OVERSAMPLE = 32

#: Lower-cases A-Z and turns ASCII punctuation into blanks.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
_DOT = re.compile(r"[.!?]+\s")


@dataclass(frozen=True)
class LeakRules:
    """Fixed thresholds: cosine of a candidate; share of the item in the longest
    common subsequence that is enough alone, or with the answer; share of the answer."""

    cosine: float = 0.4
    sure: float = 0.8
    paraphrase: float = 0.6
    answer: float = 0.8


def plain_words(s: TextSlice) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of the words of a slice and the first word of each row."""
    data = _PLAIN[s.data]
    w = find_words(TextSlice(s.first, s.n, data, s.offsets))
    return Hasher.of(data).ranges(w.start, w.end, 9), w.first


def words_of(text: str) -> np.ndarray:
    s = next(text_slices(pa.array([text], pa.string())))
    return plain_words(s)[0]


def bins_of(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BINS, dtype="<i8")
    for batch in batches:
        for s in text_slices(batch.column("text")):
            total += np.bincount(bins_of(plain_words(s)[0]), minlength=BINS)
    blocks = total.reshape(-1, COUNT_BLOCK)
    some = np.flatnonzero(blocks.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([blocks[i].tobytes() for i in some], pa.binary())],
                                     names=["block", "counts"])


def _add(table: pa.Table) -> pa.Table:
    parts = table.column("counts").to_pylist()
    total = np.zeros(COUNT_BLOCK, dtype="<i8")
    for p in parts:
        total += np.frombuffer(p, dtype="<i8")
    return pa.table({"block": table.column("block").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def word_weights(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Weight of each bin: log(words / count), at least LEAST_WEIGHT (BINS numbers)."""
    schema = "block int, counts binary"
    rows = docs.select(column(docs, text_col).alias("text")).mapInArrow(_count, schema).groupBy("block").applyInArrow(_add, schema).collect()
    count = np.zeros(BINS, dtype=np.int64)
    for r in rows:
        count[r["block"] * COUNT_BLOCK:(r["block"] + 1) * COUNT_BLOCK] = np.frombuffer(bytes(r["counts"]), "<i8")
    total = max(int(count.sum()), 1)
    return np.maximum(np.log((total + 1) / (count + 1)), LEAST_WEIGHT).astype(np.float32)


def passages(names: np.ndarray, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bins, TF-IDF values of unit length) of each run of PASSAGE words, half overlapping."""
    out = []
    for at in range(0, max(len(names) - HALF, 1) if len(names) else 0, HALF):
        b, n = np.unique(bins_of(names[at:at + PASSAGE]), return_counts=True)
        v = n * weight[b]
        out.append((b, (v / np.sqrt((v * v).sum())).astype(np.float64)))
    return out


def _gauss(bins: np.ndarray, rank: int) -> np.ndarray:
    """Rows of a fixed Gaussian matrix, by hash (Box-Muller): equal in every task."""
    cell = bins[:, None].astype(np.uint64) * np.uint64(rank) + np.arange(rank, dtype=np.uint64)[None, :]
    u = ((mix(cell, 21) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    v = (mix(cell, 22) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


_VECS = "bin long, vec binary"


def _sum_vecs(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v, dtype="<f8") for v in table.column("vec").to_pylist())
    return pa.table({"bin": table.column("bin").slice(0, 1), "vec": pa.array([total.tobytes()], pa.binary())})


def _spread(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.astype("<f8").tobytes() for v in total.values()], pa.binary())],
                                      names=["bin", "vec"])


def _all_passages(batch: pa.RecordBatch, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for text in batch.column("text").to_pylist():
        yield from passages(words_of(text or ""), weight)


def _step(weight: np.ndarray, rank: int, vectors: dict[int, np.ndarray] | None):
    """Partial A'A X of a task's passages, by bin (X: the hashed Gaussian, or given vectors)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, v in _all_passages(batch, weight):
                key = b.tolist()
                x = _gauss(b, rank) if vectors is None else np.stack([vectors[i] for i in key])
                y = v @ x
                for i, z in zip(key, v):
                    total[i] = total[i] + z * y if i in total else z * y
        yield _spread(total)
    return run


def _collect(step: DataFrame) -> dict[int, np.ndarray]:
    rows = step.groupBy("bin").applyInArrow(_sum_vecs, _VECS).collect()
    return {b: np.frombuffer(v, "<f8") for b, v in sorted((r["bin"], bytes(r["vec"])) for r in rows)}


def _gram(weight: np.ndarray, vectors: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = 0
        for batch in batches:
            for b, v in _all_passages(batch, weight):
                y = v @ np.stack([vectors[i] for i in b.tolist()])
                g = g + np.outer(y, y).ravel()
        yield _spread({0: g} if np.ndim(g) else {})
    return run


def _ortho(z: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The vectors, orthonormalised over the bins."""
    return dict(zip(z, np.linalg.qr(np.stack(list(z.values())))[0])) if z else {}


def latent_terms(items: DataFrame, weight: np.ndarray, rank: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the items' passages and their rows of V (bins x rank, orthonormal columns), by randomised SVD.

    At most BINS vectors of rank + OVERSAMPLE numbers reach the driver."""
    items = items.select("text")
    q = _ortho(_collect(items.mapInArrow(_step(weight, rank + OVERSAMPLE, None), _VECS)))
    if not q:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 1), dtype=np.float32)
    q = _ortho(_collect(items.mapInArrow(_step(weight, 0, q), _VECS)))
    base = np.stack(list(q.values()))
    gram = _collect(items.mapInArrow(_gram(weight, q), _VECS))[0]
    value, vector = np.linalg.eigh(gram.reshape(base.shape[1], base.shape[1]))
    use = value > 1e-9 * max(value.max(), 1e-300)
    return np.array(list(q), dtype=np.int64), (base @ vector[:, use][:, ::-1][:, :rank]).astype(np.float32)


def lcs_length(item_at: dict[int, int], n: int, words: list[int]) -> int:
    """Longest common subsequence, bit-parallel over the item's places (item_at: word -> their bits)."""
    free = (1 << n) - 1
    v = free
    for w in words:
        m = item_at.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & free
    return n - v.bit_count()


def places(names: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(names):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class _Words:
    """The words of an item, or of a part or an answer: their number, the places of each (as bits) and how many those are."""

    n: int
    at: dict[int, int]
    times: dict[int, int]

    @classmethod
    def of(cls, names: list[int]) -> _Words:
        at = places(names)
        return cls(len(names), at, {w: bits.bit_count() for w, bits in at.items()})

    def share(self, near: list[int], least: float) -> float:
        """Share of the words in the longest common subsequence with near; 0 where too few of them occur there at all for `least`."""
        times = self.times
        if sum(times[w] for w in times.keys() & set(near)) < least * self.n:
            return 0.0
        return lcs_length(self.at, self.n, near) / self.n


def answer_words(text: str) -> list[int]:
    """Words of the last sentence that has at least three; else of the whole text."""
    for part in reversed(_DOT.split(text.strip())):
        names = words_of(part).tolist()
        if len(names) >= 3:
            return names
    return words_of(text).tolist()


@dataclass
class _Space:
    """Slot of each bin, term vectors; of every passage its latent direction, item, number and kept length."""

    slot: np.ndarray
    terms: np.ndarray
    unit: np.ndarray
    owner: np.ndarray
    part: np.ndarray
    kept: np.ndarray


@dataclass
class _Anchors:
    """Names of exact runs of k words (sorted), the item and passage of each, and a bitmap of their upper bits."""

    k: int
    name: np.ndarray
    owner: np.ndarray
    part: np.ndarray
    bits: np.ndarray


def _anchors(names: list[np.ndarray], weight: np.ndarray) -> list[_Anchors]:
    """The heaviest run of ANCHOR words in each passage of each item; shorter items whole."""
    found: dict[int, set] = {}
    for i, w in enumerate(names):
        k = min(ANCHOR, len(w))
        g = windows(w, np.array([0, len(w)]), k)[0]
        total = np.convolve(weight[bins_of(w)], np.ones(k), "valid")
        for p, at in enumerate(range(0, max(len(w) - HALF, 1), HALF)):
            lo, hi = min(at, len(g) - 1), max(min(at + PASSAGE - k + 1, len(g)), 1)
            found.setdefault(k, set()).add((int(g[lo + total[lo:hi].argmax()]), i, p))
    out = []
    for k, rows in sorted(found.items()):
        rows = sorted(rows)
        name, owner, part = np.array([g for g, _, _ in rows], dtype=np.uint64), *(np.array([r[j] for r in rows], dtype=np.int64) for j in (1, 2))
        bits = np.zeros(1 << 20, dtype=bool)
        bits[name >> np.uint64(44)] = True
        out.append(_Anchors(k, name, owner, part, bits))
    return out


def exact_runs(names: np.ndarray, first: np.ndarray, a: _Anchors) -> Iterator[tuple[int, int, int, int]]:
    """(row, first word of the block it starts in, item number, passage number) of the anchors in a slice."""
    g, row = windows(names, first, a.k)
    if not len(g):
        return
    whole = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.flatnonzero(whole[:len(names) - a.k + 1] == whole[a.k - 1:]) - first[row]
    hit = np.flatnonzero(a.bits[g >> np.uint64(44)])
    lo, hi = (np.searchsorted(a.name, g[hit], side) for side in ("left", "right"))
    for h, x, y in zip(hit[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
        for i in range(x, y):
            yield int(row[h]), int(start[h]) // HALF * HALF, int(a.owner[i]), int(a.part[i])


@dataclass
class _Queries:
    """The benchmark items of one pass: ids, words, answers; the space of their passages."""

    ids: list
    words: list[list[int]]
    answers: list[list[int]]
    space: _Space
    anchors: list[_Anchors]


def space_of(names: list[np.ndarray], weight: np.ndarray, bins: np.ndarray, terms: np.ndarray) -> _Space:
    """The passages of items (words by name) in a latent space."""
    slot = np.full(BINS, -1, dtype=np.int32)
    slot[bins] = np.arange(len(bins))
    vectors, owner, part, kept = [], [], [], []
    for i, w in enumerate(names):
        for p, (b, v) in enumerate(passages(w, weight)):
            x = v @ terms[slot[b]]
            norm = float(np.linalg.norm(x))
            if norm >= LEAST_KEPT:
                vectors.append(x / norm)
                owner.append(i)
                part.append(p)
                kept.append(norm)
    return _Space(slot, terms, np.array(vectors, dtype=np.float32).reshape(-1, terms.shape[1]), np.array(owner, dtype=np.int64),
                  np.array(part, dtype=np.int64), np.array(kept, dtype=np.float32))


def _queries(rows: list, weight: np.ndarray, bins: np.ndarray, terms: np.ndarray) -> _Queries:
    names = [words_of(r["text"]) for r in rows]
    return _Queries([r["item_id"] for r in rows], [n.tolist() for n in names], [answer_words(r["text"]) for r in rows],
                    space_of(names, weight, bins, terms), _anchors(names, weight))


@dataclass
class _Runs:
    """The words of a slice in blocks of HALF words; a run is a block and the next one of the same row."""

    bins: np.ndarray
    weight: np.ndarray
    block: np.ndarray     # block of each word
    row: np.ndarray       # row of each block
    start: np.ndarray     # first word of each block, counted in its row
    joined: np.ndarray
    norm2: np.ndarray

    @classmethod
    def of(cls, names: np.ndarray, first: np.ndarray, weight: np.ndarray) -> _Runs:
        n_words = np.diff(first)
        n_blocks = -(-n_words // HALF)
        block0 = np.concatenate([[0], np.cumsum(n_blocks)])
        row = np.repeat(np.arange(len(n_words)), n_words)
        block = block0[row] + (np.arange(len(names)) - first[row]) // HALF
        b = bins_of(names)
        brow = np.repeat(np.arange(len(n_words)), n_blocks)
        joined = np.zeros(block0[-1], dtype=bool)
        joined[:-1] = brow[1:] == brow[:-1]
        out = cls(b, weight[b], block, brow, (np.arange(block0[-1]) - block0[brow]) * HALF, joined, np.zeros(0))
        out.norm2 = out.energy(np.ones(len(b), dtype=bool))
        return out

    def energy(self, use: np.ndarray) -> np.ndarray:
        """Sum of the squared weights of a run's words, of those in use."""
        size = np.bincount(self.block[use], weights=self.weight[use].astype(np.float64) ** 2, minlength=len(self.row))
        return size + np.where(self.joined, np.append(size[1:], 0), 0)


def candidates(runs: _Runs, space: _Space, cosine: float) -> Iterator[tuple[int, int, int, int, float]]:
    """(row, first word of the run, item number, passage number, score) of the runs of a slice near a passage."""
    terms = space.terms
    known = (space.slot[runs.bins] >= 0) & (runs.weight > 0)
    # a run with this cosine to a passage has as large a share of its weight in the benchmark's words
    live = (runs.energy(known) >= 0.99 * cosine**2 * runs.norm2) & (runs.norm2 > 0)
    need = live.copy()
    need[1:] |= live[:-1] & runs.joined[:-1]
    use = np.flatnonzero(known & need[runs.block])
    if not len(use) or not len(space.unit):
        return
    at = np.cumsum(need) - 1                        # the needed blocks, numbered
    part = np.zeros((int(need.sum()) + 1, terms.shape[1]), dtype=np.float32)
    mine = at[runs.block[use]]
    new = np.append(True, mine[1:] != mine[:-1])
    place = np.arange(len(use)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    rows, weights = space.slot[runs.bins[use]], runs.weight[use][:, None]
    for j in range(HALF):                           # the j-th known word of every block
        i = np.flatnonzero(place == j)
        part[mine[i]] += terms[rows[i]] * weights[i]
    near = np.flatnonzero(live)
    x = part[at[near]] + np.where(runs.joined[near][:, None], part[at[near] + 1], 0)
    norm = np.sqrt(runs.norm2[near])
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    inside = size >= cosine * space.kept.min() * norm       # a smaller latent vector reaches no score
    near, x, norm, size = near[inside], x[inside], norm[inside], size[inside]
    scaled = (space.unit / space.kept[:, None]).T
    for lo in range(0, len(near), 4096):
        score = (x[lo:lo + 4096] / norm[lo:lo + 4096, None].astype(np.float32)) @ scaled
        r, c = np.nonzero(score >= cosine)
        score = score[r, c]
        angle = score * norm[lo + r] * space.kept[c] / size[lo + r]
        r, c, score = (v[angle >= ANGLE] for v in (r, c, score))
        k = near[lo + r]
        yield from zip(runs.row[k].tolist(), runs.start[k].tolist(), space.owner[c].tolist(), space.part[c].tolist(), score.tolist())


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, q, rules = shared.value
        items = [_Words.of(x) for x in q.words]
        answers = [_Words.of(x) for x in q.answers]
        parts: dict[tuple[int, int], _Words] = {}
        for batch in batches:
            for s in text_slices(batch.column("text")):
                names, first = plain_words(s)
                runs = _Runs.of(names, first, weight)
                best: dict[tuple[int, int], tuple] = {}
                tried = set()
                same_runs = ((*c, 0.0) for a in q.anchors for c in exact_runs(names, first, a))
                for row, start, item, p, cos in chain(candidates(runs, q.space, rules.cosine), same_runs):
                    words = items[item]
                    if words.n > PART:
                        lo, hi = first[row] + max(0, start - PART), min(first[row] + start + PASSAGE + PART, first[row + 1])
                        if (row, lo, item, p) not in tried:
                            tried.add((row, lo, item, p))
                            if (item, p) not in parts:
                                at = max(0, min(HALF * p - HALF, words.n - PART))
                                parts[item, p] = _Words.of(q.words[item][at:at + PART])
                            share = parts[item, p].share(names[lo:hi].tolist(), rules.sure)
                            if share >= rules.sure and (share, 0.0, cos, start) > best.get((row, item), (0,)):
                                best[row, item] = (share, 0.0, cos, start)
                    lo, hi = first[row] + max(0, start - words.n), min(first[row] + start + PASSAGE + words.n, first[row + 1])
                    if (row, lo, hi, item) in tried:
                        continue
                    tried.add((row, lo, hi, item))
                    near = names[lo:hi].tolist()
                    share = words.share(near, rules.paraphrase)
                    if share < rules.paraphrase:
                        continue
                    answer = answers[item].share(near, 0.0)
                    if share >= rules.sure or answer >= rules.answer:
                        found = (share, answer, cos, start)
                        if found > best.get((row, item), (0,)):
                            best[row, item] = found
                rows = sorted(best)
                docs = batch.column("doc_id").slice(s.first, s.n)
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array([r for r, _ in rows], pa.int64())), pa.array([q.ids[i] for _, i in rows], pa.int64()),
                     *(pa.array([best[k][j] for k in rows], pa.float64()) for j in range(3)),
                     pa.array([best[k][3] for k in rows], pa.int64())],
                    names=["doc_id", "item_id", "lcs_share", "answer_share", "cosine", "start_word"])
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items with words, and the number of their passages."""
    for batch in batches:
        for s in text_slices(batch.column("text")):
            n = np.diff(plain_words(s)[1])
            parts = np.where(n > 0, -(-np.maximum(n - HALF, 1) // HALF), 0)
            rows = batch.slice(s.first, s.n)
            yield pa.RecordBatch.from_arrays([rows.column("item_id"), rows.column("text"), pa.array(parts.astype(np.int32))],
                                             names=["item_id", "text", "parts"]).filter(pa.array(parts > 0))


SCHEMA = "doc_id long, item_id long, lcs_share double, answer_share double, cosine double, start_word long"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", rank: int = 128, rules: LeakRules = LeakRules()) -> DataFrame:
    """One row per document id and benchmark item found in it, with the best place's figures.

    lcs_share is of the item, or of PART words of a longer one. Null and empty texts, and items without words, match
    nothing. Rows that repeat an id count as one document, equal items each match. Null ids are carried. Other columns are
    ignored. An empty table on either side gives no rows."""
    spark = docs.sparkSession
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    items = benchmark.select(column(benchmark, item_col).cast("long").alias("item_id"), column(benchmark, item_text_col).alias("text"))
    items = items.mapInArrow(_counted, "item_id long, text string, parts int").withColumn("no", F.monotonically_increasing_id())
    items = cut_lineage(items)
    total = items.agg(F.sum("parts")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], SCHEMA)
    weight = word_weights(src)
    bins, terms = latent_terms(items, weight, rank)
    passes = -(-total // PASS_PASSAGES)
    found = None
    for k in range(passes):
        rows = items.filter(F.pmod(F.xxhash64("no"), F.lit(passes)) == k).select("item_id", "text").collect()
        if not rows:
            continue
        shared = spark.sparkContext.broadcast((weight, _queries(rows, weight, bins, terms), rules))
        part = src.mapInArrow(_search(shared), SCHEMA)
        found = part if found is None else found.union(part)
    top = F.max(F.struct("lcs_share", "answer_share", "cosine", "start_word")).alias("top")
    return found.groupBy("doc_id", "item_id").agg(top).select("doc_id", "item_id", "top.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose own text no benchmark item is found in (whatever their ids), all columns unchanged."""
    rows, key = with_row_key(docs, id_col, text_col)
    gone = cut_lineage(leaks(rows, benchmark, key, text_col).select("doc_id").distinct())
    return drop_ids(rows, key, gone, "doc_id").drop(key)
