"""Quality rules: base counts and a calibrated classifier of hashed n-grams.

A document's features are the shares of its words in ``WORD_BINS`` hashed bins
and of its byte trigrams in ``GRAM_BINS`` bins. A logistic regression over them
is fitted on a bounded sample of the labelled rows (the ``sample_rows`` labelled
ids with the smallest hashes), and its scores are turned into probabilities by
a logistic calibration on a third of the sample that the fit never sees. All
documents are scored in Arrow batches; the threshold is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import column
from mercato.llm.words import Hasher, find_words, segment_sum, text_slices, windows

WORD_BINS, GRAM_BINS = 1024, 4096
SCALE = 30.0
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True


@dataclass(frozen=True)
class QualityRules:
    """Fixed thresholds: too few words, too large a share of repeated words, too low a probability of good quality."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_probability: float = 0.5


@dataclass
class QualityModel:
    weights: np.ndarray       # WORD_BINS + GRAM_BINS
    bias: float
    slope: float              # calibration: probability = sigmoid(slope * score + shift)
    shift: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -50, 50)))


def _grams(s) -> tuple[np.ndarray, np.ndarray]:
    """Bin of the trigram that starts at each byte, and the bounds of each row's trigrams (none runs over two rows)."""
    d = s.data.astype(np.uint32)
    if len(d) < 3:
        return np.zeros(0, np.int64), np.zeros(s.n + 1, np.int64)
    code = (d[:-2] * np.uint32(0x01000193) ^ d[1:-1] * np.uint32(0x9E3779B1) ^ d[2:] * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35)
    start, end = s.offsets[:-1], np.maximum(s.offsets[1:] - 2, s.offsets[:-1])
    row = np.repeat(np.arange(s.n), end - start)
    at = np.arange(len(row)) + np.repeat(start - np.concatenate([[0], np.cumsum(end - start)[:-1]]), end - start)
    return (code[at] >> np.uint32(20)).astype(np.int64), np.concatenate([[0], np.cumsum(end - start)])


def features(s) -> np.ndarray:
    """Dense feature rows of a slice (for the bounded sample only)."""
    w = find_words(s)
    bins = (Hasher.of(s.data).ranges(w.start, w.end) >> np.uint64(54)).astype(np.int64)
    x = np.bincount(w.row * WORD_BINS + bins, minlength=s.n * WORD_BINS).reshape(s.n, WORD_BINS).astype(np.float32)
    g, first = _grams(s)
    row = np.repeat(np.arange(s.n), np.diff(first))
    y = np.bincount(row * GRAM_BINS + g, minlength=s.n * GRAM_BINS).reshape(s.n, GRAM_BINS).astype(np.float32)
    return np.hstack([x / np.maximum(x.sum(1, keepdims=True), 1), y / np.maximum(y.sum(1, keepdims=True), 1)])


def scores(s, m: QualityModel) -> np.ndarray:
    """The same features times the weights, without building the rows."""
    w = find_words(s)
    bins = (Hasher.of(s.data).ranges(w.start, w.end) >> np.uint64(54)).astype(np.int64)
    words = segment_sum(m.weights[:WORD_BINS][bins], w.first) / np.maximum(np.diff(w.first), 1)
    g, first = _grams(s)
    grams = segment_sum(m.weights[WORD_BINS:][g], first) / np.maximum(np.diff(first), 1)
    return SCALE * (words + grams) + m.bias


def base_counts(s) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    w = find_words(s)
    n_words = np.diff(w.first)
    h = Hasher.of(s.data)
    points = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[s.data])])
    # lines: cut at line feeds and at row ends
    feeds = np.flatnonzero(s.data == 10)
    begin = np.concatenate([s.offsets[:-1], feeds + 1])
    row = np.concatenate([np.arange(s.n), np.searchsorted(s.offsets, feeds, "right") - 1])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    stop = np.empty_like(begin)
    stop[:-1] = begin[1:] - 1
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    stop[last] = s.offsets[row[last] + 1]
    full = np.searchsorted(w.start, stop) > np.searchsorted(w.start, begin)
    line, row = h.ranges(begin[full], stop[full], 3), row[full]
    order = np.lexsort((line, row))
    line, row = line[order], row[order]
    again = np.zeros(len(line), dtype=bool)
    again[1:] = (line[1:] == line[:-1]) & (row[1:] == row[:-1])
    dup = np.bincount(row[again], minlength=s.n)
    # words inside a run of five that the text has more than once
    g, grow = windows(h.ranges(w.start, w.end, 4), w.first, 5)
    order = np.lexsort((g, grow))
    same = np.zeros(len(g), dtype=bool)
    if len(g):
        eq = (g[order][1:] == g[order][:-1]) & (grow[order][1:] == grow[order][:-1])
        both = np.zeros(len(g), dtype=bool)
        both[1:] |= eq
        both[:-1] |= eq
        same[order] = both
    first_window = np.concatenate([[0], np.cumsum(np.maximum(n_words - 4, 0))])[:-1]
    word_at = np.arange(len(g)) - first_window[grow] + w.first[grow]
    cover = np.zeros(len(w.row) + 6, dtype=np.int64)
    np.add.at(cover, word_at[same], 1)
    np.add.at(cover, word_at[same] + 5, -1)
    repeated = segment_sum((np.cumsum(cover)[:len(w.row)] > 0).astype(np.int64), w.first)
    return {"n_words": n_words.astype(np.int64), "word_chars": segment_sum(points[w.end] - points[w.start], w.first),
            "n_symbols": (symbols[s.offsets[1:]] - symbols[s.offsets[:-1]]).astype(np.int64),
            "n_dup_lines": dup.astype(np.int64), "n_repeat_words": repeated}


def fit(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-3) -> QualityModel | None:
    """Logistic regression (Adam, full batches) and calibration; None unless both classes are there."""
    held = np.arange(len(y)) % 3 == 2
    if len(np.unique(y[~held])) < 2:
        return None
    xt, yt = x[~held] * np.float32(SCALE), y[~held].astype(np.float32)
    each = np.where(yt == 1, 0.5 / yt.sum(), 0.5 / (1 - yt).sum()).astype(np.float32)   # both classes weigh the same
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(xt @ w + b, -50, 50)))
        err = (p - yt) * each
        g = np.append(xt.T @ err + decay * w / len(yt), err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, b = w - step[:-1].astype(np.float32), b - float(step[-1])
    score, yh = SCALE * (x[held] @ w) + b, y[held]
    slope, shift = 1.0, 0.0
    for _ in range(30 if len(np.unique(yh)) == 2 else 0):     # Newton steps with a weak pull to (1, 0)
        p = 1 / (1 + np.exp(-np.clip(slope * score + shift, -50, 50)))
        q = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - yh) * score).sum() + (slope - 1), (p - yh).sum() + 0.1 * shift])
        h = np.array([[(q * score * score).sum() + 1, (q * score).sum()], [(q * score).sum(), q.sum() + 0.1]])
        slope, shift = np.array([slope, shift]) - np.clip(np.linalg.solve(h, g), -1, 1)
    return QualityModel(w, b, float(slope), float(shift))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in text_slices(batch.column("text"), rows=256):      # feature rows are dense
            x = features(s).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(s.first, s.n), batch.column("quality").slice(s.first, s.n),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 3000) -> QualityModel | None:
    """Fits on at most sample_rows labelled ids; of several labels of an id the lowest holds, null ones and null ids don't."""
    chosen = (labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    # at most sample_rows narrow rows: a bounded broadcast
    rows = (src.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
            .mapInArrow(_features, "doc_id long, quality int, x binary").dropDuplicates(["doc_id"])
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect())
    if not rows:
        return None
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), dtype=np.float16).reshape(len(rows), -1).astype(np.float32)
    return fit(x, np.array([int(r["quality"] > 0) for r in rows]))


def _judge(model: QualityModel | None, rules: QualityRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column("text")):
                c = base_counts(s)
                failed = (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_percent * c["n_words"])
                p = model.probability(scores(s, model)) if model else np.ones(s.n)
                cols = {"doc_id": batch.column("doc_id").slice(s.first, s.n), **{k: pa.array(v) for k, v in c.items()},
                        "base_failed": pa.array(failed), "kept": pa.array(~failed & (p >= rules.min_probability)),
                        "probability": pa.array(p.astype(np.float64))}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, probability double")


def judge(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text",
          rules: QualityRules = QualityRules()) -> DataFrame:
    """Counts, verdict and probability of every row of docs.

    A null text is an empty one: no words, base_failed. Rows are judged each
    for itself (repeated rows stay, null ids are carried); other columns are
    ignored. Without labels of both classes there is no model and the base
    rules decide alone. An empty table gives no rows."""
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    return src.mapInArrow(_judge(model, rules), SCHEMA)


def _keep(model: QualityModel | None, rules: QualityRules, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, dtype=bool)
            for s in text_slices(batch.column(text_col)):
                c = base_counts(s)
                failed = (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_percent * c["n_words"])
                p = model.probability(scores(s, model)) if model else np.ones(s.n)
                ok[s.first:s.first + s.n] = ~failed & (p >= rules.min_probability)
            yield batch.filter(pa.array(ok))
    return run


def keep_good(docs: DataFrame, model: QualityModel | None, text_col: str = "text", rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of docs that the rules keep, all columns unchanged."""
    return docs.mapInArrow(_keep(model, rules, text_col), docs.schema)
