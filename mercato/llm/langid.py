"""Language identification by mixture inference.

Training counts hashed byte trigrams (over words with a blank on either side)
per language, over all training documents; the counts are summed in blocks of
bins. For a document, the likelihood of each word under each language is the
product of its trigrams' probabilities, and expectation-maximisation over the
words estimates the document's language proportions. The language set is then
chosen among the nested sets of the largest proportions by penalised
likelihood, and the largest proportion inside it names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import column
from mercato.llm.words import LOWER, find_words, text_slices

BINS = 1 << 15
BLOCK = 512
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Learned lang values and log probabilities (languages x BINS)."""

    langs: list[str]
    logp: np.ndarray


def _word_grams(s) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bins of a slice with a blank around every row, their bounds per word, each word's row, words per row."""
    lens = np.diff(s.offsets)
    row = np.repeat(np.arange(s.n), lens)
    text = np.full(len(s.data) + s.n + 2, 32, dtype=np.uint8)
    text[np.arange(len(s.data)) + 1 + row] = LOWER[s.data]
    text[(text >= 9) & (text <= 13)] = 32
    w = find_words(s)
    start, end = w.start + 1 + w.row, w.end + 1 + w.row
    d = text.astype(np.uint32)
    code = (d[:-2] * np.uint32(0x01000193) ^ d[1:-1] * np.uint32(0x9E3779B1) ^ d[2:] * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35)
    size = end - start                                  # trigrams start one byte before the word
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(first[-1]) + np.repeat(start - 1 - first[:-1], size)
    return (code[at] >> np.uint32(17)).astype(np.int64), first, w.row, np.diff(w.first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for s in text_slices(batch.column("text")):
            names = langs[s.first:s.first + s.n]
            g, first, wrow, _ = _word_grams(s)
            known = sorted(set(names))
            code = np.searchsorted(known, names)
            grow = np.repeat(code[wrow], np.diff(first))
            for i, lang in enumerate(known):
                c = np.bincount(g[grow == i], minlength=BINS)
                totals[lang] = totals[lang] + c if lang in totals else c
    for lang, c in totals.items():
        blocks = c.astype("<i8").reshape(-1, BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(blocks)), pa.array(np.arange(len(blocks), dtype=np.int32)),
                                          pa.array([b.tobytes() for b in blocks], pa.binary())], names=["lang", "block", "counts"])


def _add(table: pa.Table) -> pa.Table:
    parts = table.column("counts").to_pylist()
    total = np.frombuffer(b"".join(parts), dtype="<i8").reshape(len(parts), -1).sum(axis=0)
    return pa.table({"lang": table.column("lang").slice(0, 1), "block": table.column("block").slice(0, 1),
                     "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model of every non-null lang value of docs (pass the training rows only).

    One row of BINS counts a language reaches the driver, so the model is
    bounded by the number of languages."""
    schema = "lang string, block int, counts binary"
    src = docs.select(column(docs, lang_col).cast("string").alias("lang"), column(docs, text_col).alias("text")).dropna()
    rows = src.mapInArrow(_count, schema).groupBy("lang", "block").applyInArrow(_add, schema).collect()
    langs = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(langs), BINS))
    for r in rows:
        counts[langs.index(r["lang"]), r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(bytes(r["counts"]), "<i8")
    langs_known = counts.sum(1) > 0
    langs, counts = [x for x, ok in zip(langs, langs_known) if ok], counts[langs_known]
    p = counts + 0.5
    return LanguageModel(langs, np.log(p / p.sum(1, keepdims=True)).astype(np.float32))


def infer(s, m: LanguageModel, rounds: int = 10, refits: int = 3, sets: int = 3, penalty: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Language number and its proportion for each row of a slice (-1 and 0 without words)."""
    best, share = np.full(s.n, -1), np.zeros(s.n)
    g, first, wrow, n_words = _word_grams(s)
    some = np.flatnonzero(n_words)
    if not len(some) or not m.langs:
        return best, share
    like = np.stack([np.add.reduceat(lp[g], first[:-1]) for lp in m.logp], axis=1).astype(np.float32)
    top = like.max(axis=1, keepdims=True)
    like = np.maximum(np.exp(like - top), np.float32(1e-30))
    begin = np.concatenate([[0], np.cumsum(n_words[some])[:-1]])
    row = np.repeat(np.arange(len(some)), n_words[some])
    total = n_words[some][:, None].astype(np.float32)

    def em(pi: np.ndarray, n: int) -> np.ndarray:
        for _ in range(n):
            r = like * pi[row]
            r /= r.sum(axis=1, keepdims=True)
            pi = np.add.reduceat(r, begin, axis=0) / total
        return pi

    pi = em(np.full((len(some), len(m.langs)), 1 / len(m.langs), dtype=np.float32), rounds)
    rank = np.argsort(np.argsort(-pi, axis=1, kind="stable"), axis=1, kind="stable")
    chosen, found = np.full(len(some), -np.inf), np.zeros_like(pi)
    for k in range(1, min(sets, len(m.langs)) + 1):
        q = np.where(rank < k, np.maximum(pi, np.float32(1e-6)), 0).astype(np.float32)
        q /= q.sum(axis=1, keepdims=True)
        q = em(q, refits) if k > 1 else q
        fit = np.add.reduceat(np.log(np.maximum((like * q[row]).sum(axis=1), np.float32(1e-30))).astype(np.float64), begin)
        fit -= penalty * (k - 1) * np.log(total[:, 0] + 1)
        better = fit > chosen
        chosen[better], found[better] = fit[better], q[better]
    best[some], share[some] = found.argmax(axis=1), found.max(axis=1)
    return best, np.clip(share, 0, 1)


def _predict(m: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            lang, score = [], []
            for s in text_slices(batch.column("text")):
                best, share = infer(s, m)
                ok = letters[s.first:s.first + s.n] & (best >= 0)
                lang += [m.langs[b] if k else UNKNOWN for b, k in zip(best, ok)]
                score += np.where(ok, share, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, m: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; only the text is looked at.

    Null texts, texts without a letter, and any text when nothing was learned
    get ``und`` and 0. Repeated rows stay, null ids are carried, other columns
    are ignored. An empty table gives no rows."""
    text = column(docs, text_col)
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), text.alias("text"),
                      F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return src.mapInArrow(_predict(m), "doc_id long, lang_pred string, score double")
