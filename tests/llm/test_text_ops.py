"""Packing, token counts, quality, language, words: against brute force and the tokenizer library."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL

from mercato.llm import langid, packing, quality, token_count, vocab
from mercato.llm.words import find_words, text_slices

from .conftest import LONG, ODD_TEXTS, odd_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = vocab.default_path()


@pytest.fixture(scope="module")
def library():
    return vocab.library(PATH)


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_words_equal_the_pattern():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \n\té日\x0b\x1c") for _ in range(rng.randint(0, 30))) for _ in range(400)] + [None, ""]
    for size in (7, 100, 1 << 20):
        got = [[] for _ in texts]
        for s in text_slices(pa.array(texts), size):
            w = find_words(s)
            for a, b, r in zip(w.start, w.end, w.row):
                got[s.first + r].append(bytes(s.data[a:b]).decode())
        assert got == [WORD.findall(t or "") for t in texts]


def odd_strings():
    rng = random.Random(3)
    out = [t or "" for t in ODD_TEXTS if t != LONG] + ["<|endoftext|>", "a <|endoftext|> b", "  a   b ", "x\x85 \x85y", "日本語 テキスト" * 40, "ab" * 3000]
    return out + ["".join(rng.choice(" \n\tab'stre1.<|ñé日\x85\x00𝟘Ⅷ　") for _ in range(rng.randint(0, 40))) for _ in range(500)]


@pytest.mark.parametrize("chunk", [5, 64, 1 << 16])
def test_transducer_counts_like_the_library(library, chunk):
    t = token_count.transducer(PATH)
    for text in odd_strings():
        assert t.tokens(text, chunk) == len(library.encode(text, add_special_tokens=False).ids), text[:60]


def test_transducer_survives_a_full_state_table(library, monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 50)
    t = token_count.Transducer(PATH)
    for text in ("the quick brown fox", "pneumonoultramicroscopic", LONG[:2000]):
        assert t.tokens(text) == len(library.encode(text).ids)


def test_encoder_equals_the_library(library):
    e = packing.encoder(PATH)
    for text in odd_strings():
        assert np.frombuffer(e.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_counts(spark, odd, nothing, library):
    got = token_count.token_counts(odd, PATH).collect()
    want = Counter((len((t or "").encode()), len(library.encode(t or "").ids)) for t in ODD_TEXTS)
    assert Counter((r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_count.token_counts(nothing, PATH).count() == 0


def check_packing(rows, texts, library):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, len(r.ids) // 4))
        by_doc[r.doc_id].append(r)
    for pieces in by_seq.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= 2048
    for doc, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        assert [r.start for r in pieces] == np.cumsum([0, *[len(r.ids) // 4 for r in pieces]])[:-1].tolist()
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == ids and pieces[0].doc_tokens == len(ids)
    return sum(2048 - sum(n for _, n in p) for p in by_seq.values())


def test_packing_loses_nothing_and_pads_one_window(spark, library):
    docs = documents(spark).coalesce(1)
    rows = packing.pack(docs, PATH).collect()
    assert check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, library) < 2048


def test_packing_odd_rows(spark, nothing, library):
    docs = odd_frame(spark, ODD_TEXTS)
    rows = packing.pack(docs, PATH, pool_windows=2).collect()
    check_packing(rows, dict(enumerate(ODD_TEXTS)), library)
    assert packing.pack(nothing, PATH).count() == 0
    report = packing.piece_report(packing.pack(docs, PATH)).collect()
    ids = np.array(library.encode("one").ids + [1], dtype="<u4").tobytes()
    assert next(r.ids_crc32 for r in report if r.doc_id == 3) == zlib.crc32(ids)


def test_differencing_balances_and_keeps_every_item():
    rng = random.Random(1)
    sizes = [rng.randint(1, 900) for _ in range(300)]
    loads, parts = packing.differencing(sizes, 64)
    assert sorted(i for p in parts for i in p) == list(range(300))
    assert [sum(sizes[i] for i in p) for p in parts] == loads.tolist()
    assert loads.max() - loads.min() < 0.1 * sum(sizes) / 64 + 200


def base(text):
    words = WORD.findall(text or "")
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, covered, seen, dup = Counter(runs), set(), set(), 0
    for i, x in enumerate(runs):
        if count[x] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_base_counts_and_verdict(spark, odd, nothing):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    docs = documents(spark)
    model = quality.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    for i, t in texts.items():
        r = got[i]
        want = base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
    lab = {r.doc_id: r.quality for r in labels.collect()}
    right = [got[i].kept == bool(q) for i, q in lab.items() if not got[i].base_failed or not q]
    assert np.mean(right) > 0.95
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    rows = quality.judge(odd, None).collect()
    assert Counter((r.n_words, r.n_dup_lines, r.n_repeat_words) for r in rows) == Counter(base(t)[0:1] + base(t)[3:5] for t in ODD_TEXTS)
    assert quality.judge(nothing, model).count() == 0 and quality.train(docs, labels.limit(0)) is None
    assert quality.train(docs, labels.filter("quality = 1")) is None
    assert quality.keep_good(odd, None).columns == odd.columns


def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fit, held = labels.filter("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1").collect()}
    got = {r.doc_id: r for r in quality.judge(docs, quality.train(docs, fit)).collect()}
    assert np.mean([got[i].kept == bool(q) for i, q in held.items() if q == 0 or not got[i].base_failed]) > 0.97


def test_language_held_out(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.filter("doc_id % 4 <> 1"))
    want = {r.doc_id: r.lang for r in docs.filter("doc_id % 4 = 1").collect()}
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert np.mean([got[i].lang_pred == x for i, x in want.items()]) > 0.98
    rows = langid.predict(odd.withColumnRenamed("lang", "other"), model).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == "und" for r in rows) == sum(not re.search(r"[^\W\d_]", t or "") for t in ODD_TEXTS)
    assert langid.predict(nothing, model).count() == 0
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}


def test_language_mixture_proportions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    one = {lang: " ".join(WORD.findall(docs.filter(f"lang = '{lang}' AND n_chars > 1500").first().text)[:200]) for lang in ("en", "fr")}
    mixed = " ".join([one["en"]] + one["fr"].split()[:60])
    s = next(text_slices(pa.array([mixed, one["fr"]])))
    best, share = langid.infer(s, model)
    assert model.langs[best[0]] == "en" and 0.65 < share[0] < 0.9
    assert model.langs[best[1]] == "fr" and share[1] == 1
