"""Language-model scores: counts by brute force, attention token by token, gradients by differences, held-out text."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from mercato.llm import lm_score as L
from mercato.llm import queries, vocab
from mercato.llm.words import text_slices

from .conftest import ODD_TEXTS, odd_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = vocab.default_path()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def plain(rows):
    """(doc_id, text) -> sorted (doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    docs = [(i, WORD.findall(lower(t)) + [None]) for i, t in rows]
    c = Counter(w for i, ws in docs if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in docs]


def test_words_are_spelled_like_the_library():
    tokens, library = L.subwords(PATH), vocab.library(PATH)
    for text in ODD_TEXTS + ["a\xa0 \xa0b c", "x　 y", "it's Don't we'LL"]:
        (s,) = text_slices(pa.array([text], pa.string()))
        x, _ = L.read_slice(s, tokens)
        ids, first = L.joined(x, tokens.end)
        want = [i for w in WORD.findall(lower(text)) for i in library.encode(" " + w.replace("<|endoftext|>", "")).ids]
        if "<|endoftext|>" not in (text or ""):
            assert ids.tolist() == want + [tokens.end] and first.tolist() == [0, len(want) + 1]


def small_model(rng, scale=1.0):
    tokens = L.subwords(PATH)
    counts = rng.integers(0, 50, tokens.size)
    inputs, classes, inside = L.vocabulary(counts, tokens.opens)
    p = {"ask": rng.normal(0, scale, (L.OUTSIDE + 1, L.KEY_DIM + L.HIDDEN)), "give": np.hstack([rng.normal(0, scale, (L.OUTSIDE + 1, L.KEY_DIM + L.HIDDEN)), np.ones((L.OUTSIDE + 1, 1))]),
         "near": rng.normal(0, 1, 2 * L.STRIDE), "groups": rng.normal(0, 1, (L.HIDDEN + 1, L.GROUPS)), "classes": rng.normal(0, 1, (L.GROUPS, L.HIDDEN + 1, L.PER))}
    p["ask"][-1], p["give"][-1] = 0, 0
    return L.Model(inputs, classes, inside, {k: v.astype(np.float32) for k, v in p.items()})


def slow_score(m, ids, end):
    """Token by token: attention over the inputs from the window's start on, probabilities of all ids."""
    p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x = m.inputs[np.concatenate([[end], ids[:-1]])]
    total = 0.0
    for i in range(len(ids)):
        start = max(0, i // L.STRIDE * L.STRIDE - L.STRIDE)
        seen = x[start:i + 1]
        a = p["give"][seen, :L.KEY_DIM] @ p["ask"][x[i], :L.KEY_DIM] + p["near"][i - np.arange(start, i + 1)]
        a = np.exp(a - a.max())
        h = np.maximum((a / a.sum()) @ p["give"][seen, L.KEY_DIM:-1] + p["ask"][x[i], L.KEY_DIM:], 0)
        h = np.append(h, 1)
        g = np.exp(h @ p["groups"])
        each = np.exp(np.einsum("h,ghp->gp", h, p["classes"]))
        classes = (g / g.sum())[:, None] * each / each.sum(1, keepdims=True)
        prob = classes.ravel()[m.classes] * 10 ** m.inside
        assert abs(prob.sum() - 1) < 1e-9
        total += math.log10(prob[ids[i]])
    return total


def test_every_token_is_scored_once_with_masked_attention():
    rng = np.random.default_rng(3)
    m, end = small_model(rng, 0.3), L.subwords(PATH).end
    rows = [np.append(rng.integers(0, end, n), end) for n in (0, 1, L.STRIDE - 1, L.STRIDE, 3 * L.STRIDE + 5, 200)]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    got = L.score(m, np.concatenate(rows), first, end)
    for r, g in zip(rows, got):
        assert g == pytest.approx(slow_score(m, r, end), rel=1e-4)
        assert L.score(m, r, np.array([0, len(r)]), end)[0] == pytest.approx(g, rel=1e-5)     # neighbours don't matter


def test_gradients_equal_differences():
    rng = np.random.default_rng(5)
    m, end = small_model(rng, 0.3), L.subwords(PATH).end
    p = {k: v.astype(np.float64) for k, v in m.p.items()}
    ids = np.append(rng.integers(0, end, 50), end)
    first = np.array([0, 20, 51])
    _, places = L.windows(first)
    x, goals = L.model_inputs(m.inputs, ids, first, end)[places], np.append(m.classes[ids], -1)[places[:, L.STRIDE:]]
    loss, g = L.gradients(p, x, goals)
    assert loss == pytest.approx(-(L.score(m, ids, first, end).sum() - m.inside[ids].sum()) * math.log(10) / len(ids), rel=1e-4)
    for name in p:
        for at in rng.permutation(np.flatnonzero(np.abs(g[name].ravel()) > 1e-4))[:6]:
            old, eps = p[name].ravel()[at], 1e-5
            p[name].ravel()[at] = old + eps
            up = L.gradients(p, x, goals)[0]
            p[name].ravel()[at] = old - eps
            down = L.gradients(p, x, goals)[0]
            p[name].ravel()[at] = old
            assert g[name].ravel()[at] == pytest.approx((up - down) / (2 * eps), rel=1e-2, abs=1e-6), name


def scored(df, **kw):
    out = L.score_texts(df, queries.tenth(F.col("doc_id"), 0), PATH, steps=5, **kw).collect()
    return out


def compare(out, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=key)
    for a, b in zip(got, sorted(plain(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


@pytest.mark.parametrize("hot", [1 << 20, 40])
def test_counts_equal_brute_force(spark, odd, monkeypatch, hot):
    """With all words in the hot table, and with few."""
    monkeypatch.setattr(L, "HOT_WORDS", hot)
    monkeypatch.setattr(L, "MERGE_AT", 30)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    out = scored(odd)
    compare(out, rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_no_rows_and_nothing_to_learn_from(spark, nothing):
    assert scored(nothing) == []
    ids = [i for i in range(200) if held(i)][:3]
    rows = list(zip(ids, ["some words", None, "some"]))
    out = scored(odd_frame(spark, [t for _, t in rows], ids))
    compare(out, rows)
    assert all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)


def test_held_out_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = L.score_texts(docs, queries.tenth(F.col("doc_id"), 0), PATH).collect()
    compare(out, [(r["doc_id"], r["text"]) for r in docs.collect()])
    shares = {r["doc_id"]: r["score"] for r in L.score_texts(docs, queries.tenth(F.col("doc_id"), 0), PATH, sample=0).collect()}    # nothing fitted
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in unseen) > 0.85 * sum(shares[r["doc_id"]] for r in unseen)


def test_every_training_row_is_learned_from(spark, monkeypatch):
    """Classes and tables come from all rows, whatever the start's sample; the tasks' tables are averaged by their windows."""
    plain, rare = "the cat sat on the mat and the dog ran to the house", "quartz vexing jumble of zebra glyphs"
    rows = [(i, f"{rare if i % 40 == 0 else plain} {i}", True) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(5).persist()
    held = df.withColumn("learn", F.lit(False))
    c = L.count(df, PATH)
    tokens = L.subwords(PATH)
    _, classes, _ = L.vocabulary(c.ids, tokens.opens)
    want = np.zeros(L.CLASSES ** 2, np.int64)
    (s,) = text_slices(pa.array([t for _, t, _ in rows], pa.string()))
    ids, first = L.joined(L.read_slice(s, tokens)[0], tokens.end)
    np.add.at(want, L._pairs(classes[ids], first), 1)
    assert (L.class_pairs(df, c, PATH) == want).all()
    start = L.train([plain], c.ids, PATH, steps=5, pairs=want)          # a start that saw no rare text
    learned = L.learn(df, start, PATH, c.hot)
    assert all((learned.p[n] != start.p[n]).any() for n in learned.p)
    monkeypatch.setattr(L, "LEARN_BATCH", 4)                            # many steps over few rows
    (s,) = text_slices(pa.array([t for _, t, _ in rows], pa.string()))
    assert L.learn_rows(learned, iter([s]), PATH, c.hot) == len(L.windows(first)[1])
    (s,) = text_slices(pa.array([rare], pa.string()))
    text = L.joined(L.read_slice(s, tokens)[0], tokens.end)
    assert L.score(learned, *text, tokens.end)[0] > L.score(start, *text, tokens.end)[0] + 1
    parts = []
    for i, n in ((3, 1), (1, 3)):
        parts.append(L._part(i, n, {k: np.full_like(v, i) for k, v in start.p.items()}))
    mean = L._mean(pa.Table.from_batches(parts)).to_pylist()[0]
    assert (mean["part"], mean["n"]) == (1, 4) and all(np.allclose(v, 1.5) for v in L.pickle.loads(mean["p"]).values())
    assert L.learn(held, start, PATH) is start                          # nothing to learn from
