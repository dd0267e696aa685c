"""Hard negatives: scores, ties and windows against plain Python integers."""
import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from mercato.llm import hard_negatives as hn


def plain(rows, every=100, positives=5, negatives=5):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (id, label, vector)."""
    use = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
           if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    anchors = {(i, label, tuple(v)) for i, label, v in use if i is not None and i % every == 0}
    for i, label, v in sorted(anchors):
        def ranked(some):
            return sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for j, _, w in some))
        same = ranked([r for r in use if r[1] == label and r[0] != i])[:positives]
        other = ranked([r for r in use if r[1] != label])
        for ps, _, _, p in same:
            fit = [(ns, n) for ns, _, _, n in other if 80 * -ps <= 100 * -ns <= 100 * -ps][:negatives]
            out += [(i, p, k, n, -ps, -ns) for k, (ns, n) in enumerate(fit, 1)]
    return out


def mined(df, **kw):
    return [tuple(r) for r in hn.mine(df, **kw).collect()]


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("low,high", [(-130, 140), (0, 1), (-70000, 3), (-2**20, 2**20)])
def test_scores_are_exact(low, high):
    rng = np.random.default_rng(high)
    q, a = rng.integers(low, high, (57, 40)), rng.integers(low, high, (9, 24))
    bits = hn.bit_planes(q)
    got = hn.scores(bits, hn.subset_tables(a, 5, hn._score_type(bits, a)))
    assert (got == q[:, :24] @ a.T).all()


def test_scores_beyond_64_bits_are_refused():
    q = np.full((1, 8), 2**30)
    with pytest.raises(ValueError):
        hn._score_type(hn.bit_planes(q), q)


def frame(spark, rows):
    df = spark.createDataFrame([(i, label, v) for i, label, v in rows], "vec_id long, label int, embedding array<double>")
    return df.withColumn("block", df.label).withColumn("salt", df.label).withColumn("anchor", df.vec_id).withColumn("score", df.vec_id)


def odd_rows():
    rng = random.Random(6)
    rows = [(i, rng.randint(0, 3), [rng.choice([-.5, -.25, 0.0, .1, .3, .7]) for _ in range(rng.choice([11, 11, 11, 8, 17]))]) for i in range(400)]
    rows += [(500, 1, None), (600, None, [.1] * 11), (700, 2, [.1, None, .2]), (800, 2, [.1, float("nan")]), (900, 2, [float("inf")]), (1000, 3, []),
             (None, 0, [.7] * 11), (None, 1, [.7] * 11), (100, 2, [.3] * 11), (200, *rows[200][1:]), (7, *rows[7][1:]), (-100, 1, [.7] * 11)]
    return rows


def test_odd_rows_equal_plain_python(spark):
    rows = odd_rows()
    want = plain(rows, every=20)
    assert len(want) > 100
    same(mined(frame(spark, rows), every=20), want)


def test_many_blocks_groups_and_chunks(spark, monkeypatch):
    for name, value in (("ANCHORS", 7), ("GROUP_ROWS", 50), ("LANES", 3)):
        monkeypatch.setattr(hn, name, value)
    rows = odd_rows()
    same(mined(frame(spark, rows).repartition(6), every=10, positives=3, negatives=2), plain(rows, 10, 3, 2))


def test_a_row_repeated_and_empty_tables(spark):
    rows = [(i, 0, [.5, .5]) for i in range(0, 300, 3)] + [(400, 1, [.5, .5])] * 200
    same(mined(frame(spark, rows)), plain(rows))
    assert mined(frame(spark, []).limit(0)) == [] and mined(frame(spark, [(100, None, None)])) == []


def test_the_table_equals_plain_python(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").withColumn("label", hn.shifted_label())
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]
    same(mined(df), plain(rows))
