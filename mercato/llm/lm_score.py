"""Language-model scores: a causal self-attention model over subword ids, trained in numpy.

1. Words (ASCII-lowered) of all rows are counted on Spark; the distinct words are spelled in subword ids once, which
   gives the ids' corpus counts. What is gathered follows the corpus.
2. The ids are dealt into ``GROUPS * PER`` output classes by those counts: frequent ids stand alone, the others share
   classes of about equal mass, in which an id's probability is its smoothed share. The classes form ``GROUPS`` groups
   by the company they keep (bisection along singular vectors of all training rows' bigrams); the softmax is first over
   groups, then inside one. The ``OWN`` most frequent ids have input vectors of their own, the others share hashed ones.
3. One causal self-attention layer (learned distance bias, one rectified hidden layer) is trained with Adam on every
   token of every training row: each task goes on from the same start over its own rows, and the tasks' tables are
   averaged by their windows, a few at a time. The start is trained in one task on a bounded sample, so that the tasks' ways
   stay close enough to be averaged. Queries, keys, values and residuals are tables by input id, so a window costs
   lookups and batched products only.
4. A text is cut into windows of ``2 * STRIDE`` inputs that overlap by ``STRIDE``; each token is scored once, in the
   later half of its window, by masked attention over what precedes it there. Windows of many texts are one batch.
5. Counts reach the base score without a join on hot keys: words that hold at least one in ``HOT_WORDS`` of all words
   (no more than ``HOT_WORDS`` of them, whatever the corpus) go to the tasks as a table, with their ids; the other
   words of a document are joined by their 64-bit hash.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import vocab
from mercato.llm.tables import column, cut_lineage
from mercato.llm.words import LOWER, Hasher, Words, find_words, text_slices

STRIDE = 16
KEY_DIM, HIDDEN = 16, 32
GROUPS, PER = 32, 32
CLASSES = GROUPS * PER
OWN, SHARED = 2048, 64
WINDOWS = 128               # windows attended to at a time
BATCHES = 16                # such batches whose outputs are scored at a time
HOT_WORDS = 1 << 20
MERGE_AT = 1 << 19          # distinct words a counting task holds at a time
ALPHA = 0.1
SAMPLE_CHARS = 2000
_FAR, _MOST = np.float32(-1e9), np.float32(60)


# -- subword ids of words -----------------------------------------------------------------

_TOKENS: dict[str, Subwords] = {}


class Subwords:
    """Ids of words, each as it stands after a blank."""

    def __init__(self, path: str):
        import tiktoken
        ids, _, special = vocab.load(path)
        pattern = vocab.SPLIT.format(L=r"\p{L}", N=r"\p{N}", S=vocab.WHITE, LL=r"\p{L}", NN=r"\p{N}")
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
        self.size = max(max(ids.values()), *special.values(), 0) + 1
        self.end = max(special.values(), default=self.size - 1)
        self.opens = np.zeros(self.size, dtype=bool)             # ids that begin with the blank
        self.opens[[i for t, i in ids.items() if t[:1] == b" "]] = True

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Joined ids of the words and their bounds."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        text = " " + " ".join(words)
        ids = np.array(self.encoding.encode_ordinary(text), dtype=np.int64)
        start = np.flatnonzero(self.opens[ids])
        if len(start) == len(words) and start[0] == 0 and not _OTHER_WHITE.search(text):
            return ids, np.append(start, len(ids))
        each = [self.encoding.encode_ordinary(" " + w) for w in words]      # white space of other scripts inside words
        first = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
        return np.array([i for x in each for i in x], dtype=np.int64), first


_OTHER_WHITE = re.compile("[" + "".join(c for c in vocab.WHITE if ord(c) > 127) + "\x1c-\x1f]")


def subwords(path: str) -> Subwords:
    """One per worker process and vocabulary."""
    if path not in _TOKENS:
        _TOKENS[path] = Subwords(path)
    return _TOKENS[path]


@dataclass
class Slice:
    """Words of a slice of texts: distinct hashes, each word's place among them, first word of each row, ids of the distinct words."""

    names: np.ndarray
    which: np.ndarray
    first: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of every span, joined."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _words(s) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a slice, its lowered bytes and the words' hashes."""
    w, data = find_words(s), LOWER[s.data]
    return w, data, Hasher.of(data).ranges(w.start, w.end, 21)


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[_spans(start, size)].tobytes())])


@dataclass
class HotWords:
    """The most frequent words: sorted hashes, training counts, ids and their bounds."""

    names: np.ndarray
    learned: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray

    def find(self, names: np.ndarray) -> np.ndarray:
        """Place of each name, or -1."""
        if not len(self.names):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, at, -1)


NO_HOT = HotWords(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))


def read_slice(s, tokens: Subwords, hot: HotWords = NO_HOT) -> tuple[Slice, np.ndarray]:
    """The slice's words with their ids, and the distinct words' places in the hot table; only the others are spelled."""
    w, data, h = _words(s)
    names, at, which = np.unique(h, return_index=True, return_inverse=True)
    spot = hot.find(names)
    new = np.flatnonzero(spot < 0)
    ids, bounds = tokens.of(_strings(data, w.start[at[new]], w.end[at[new]]).to_pylist())
    size = np.empty(len(names), np.int64)
    size[new], size[spot >= 0] = np.diff(bounds), np.diff(hot.bounds)[spot[spot >= 0]]
    first = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(first[-1], np.int64)
    out[_spans(first[new], size[new])] = ids
    known = np.flatnonzero(spot >= 0)
    out[_spans(first[known], size[known])] = hot.ids[_spans(hot.bounds[spot[known]], size[known])]
    return Slice(names, which, w.first, out, first), spot


def joined(x: Slice, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the slice's rows, each followed by the end id, and the rows' bounds."""
    size = np.diff(x.bounds)[x.which]
    n = len(x.first) - 1
    upto = np.concatenate([[0], np.cumsum(size)])
    first = upto[x.first] + np.arange(n + 1)           # one end id per earlier row
    out = np.full(int(first[-1]), end, dtype=np.int64)
    inner = np.ones(len(out), dtype=bool)
    inner[first[1:] - 1] = False
    out[inner] = x.ids[_spans(x.bounds[x.which], size)]
    return out, first


# -- counts of the corpus --------------------------------------------------------------------

_COUNTED = "word string, learned long, seen long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def merged() -> tuple:
        names, at, which = np.unique(np.concatenate([x[0] for x in held]), return_index=True, return_inverse=True)
        words = pa.concat_arrays([x[1] for x in held]).take(pa.array(at))
        return names, words, *(np.bincount(which, np.concatenate([x[i] for x in held]), len(names)).astype(np.int64) for i in (2, 3))

    def emit(x: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([x[1], pa.array(x[2]), pa.array(x[3])], names=["word", "learned", "seen"])
    for batch in batches:
        learn = batch.column("learn").to_numpy(zero_copy_only=False)
        for s in text_slices(batch.column("text")):
            w, data, h = _words(s)
            names, at, which = np.unique(h, return_index=True, return_inverse=True)
            taught = np.repeat(learn[s.first:s.first + s.n], np.diff(w.first))
            held.append((names, _strings(data, w.start[at], w.end[at]), np.bincount(which, taught, len(names)), np.bincount(which, minlength=len(names))))
            if sum(len(x[0]) for x in held) > MERGE_AT:
                held = [merged()]
                if len(held[0][0]) > MERGE_AT // 2:
                    yield emit(held[0])
                    held = []
    if held:
        yield emit(merged())


def _spell(path: str):
    """Distinct words with hash and subword ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = subwords(path)
        for batch in batches:
            for s in text_slices(batch.column("word")):
                part = batch.slice(s.first, s.n)
                full = Hasher.of(s.data).ranges(s.offsets[:-1], s.offsets[1:], 21)
                ids, bounds = tokens.of(part.column("word").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(full.view(np.int64)), part.column("learned"), part.column("seen"),
                                                  pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                                                 names=["name", "learned", "seen", "ids"])
    return run


def _id_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            lists = batch.column("ids")
            total += np.bincount(lists.flatten().to_numpy(), np.repeat(batch.column("learned").to_numpy(), np.diff(lists.offsets.to_numpy())), size).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])
    return run


@dataclass
class Counts:
    """rare: (name, learned) of the words outside the hot table; tokens, words: all and distinct training tokens, the
    end token included; ends: training rows; ids: training counts of the subword ids."""

    rare: DataFrame
    tokens: int
    words: int
    ends: int
    hot: HotWords
    ids: np.ndarray


def count(rows: DataFrame, path: str) -> Counts:
    """Counts of rows (text, learn): every word (learned in training rows, seen in all) and the subword ids of training rows."""
    size = subwords(path).size
    ends = int(rows.agg(F.count_if("learn")).first()[0])
    table = cut_lineage(rows.select("text", "learn").mapInArrow(_count, _COUNTED)
                        .groupBy("word").agg(F.sum("learned").alias("learned"), F.sum("seen").alias("seen"))
                        .mapInArrow(_spell(path), "name long, learned long, seen long, ids array<int>"))
    sums = table.agg(F.coalesce(F.sum("learned"), F.lit(0)).alias("n"), F.count_if(F.col("learned") > 0).alias("v"), F.coalesce(F.sum("seen"), F.lit(0)).alias("all")).first()
    # at most HOT_WORDS rows, as their counts sum to no more than all
    hot = table.filter(F.col("seen") * HOT_WORDS >= int(sums["all"])).select("name", "learned", "ids").toArrow().combine_chunks()
    names = hot.column("name").to_numpy().view(np.uint64)
    order = np.argsort(names)
    lists = hot.column("ids").take(pa.array(order)).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    words = HotWords(names[order], hot.column("learned").to_numpy()[order], lists.flatten().to_numpy().astype(np.int64),
                     np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))]).astype(np.int64))
    # at most one row per id of the vocabulary
    by_id = table.select("learned", "ids").mapInArrow(_id_counts(size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids = np.zeros(size, dtype=np.int64)
    ids[by_id.column("id").to_numpy()] = by_id.column("n").to_numpy()
    ids[subwords(path).end] += ends
    rare = table.filter((F.col("seen") * HOT_WORDS < int(sums["all"])) & (F.col("learned") > 0)).select("name", "learned")
    return Counts(rare, int(sums["n"]) + ends, int(sums["v"]) + (ends > 0), ends, words, ids)


# -- the model ---------------------------------------------------------------------------------

@dataclass
class Model:
    """Input id, output class and log10 probability inside the class of every subword id; the trained tables.

    ask holds queries and residuals by input id, give keys, values and a last 1 that sums the attention; the last row
    of both stands for places outside the text: all zeros, it adds nothing to any sum."""

    inputs: np.ndarray
    classes: np.ndarray
    inside: np.ndarray
    p: dict[str, np.ndarray]


def vocabulary(ids: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, classes, inside) by the corpus counts of the ids; every id has a positive probability in its class."""
    size = len(ids)
    rank = np.empty(size, dtype=np.int64)
    rank[np.argsort(-ids, kind="stable")] = np.arange(size)
    inputs = np.where(rank < OWN, rank, OWN + np.arange(size) % SHARED)
    alone = min(3 * CLASSES // 4, size)
    rest = np.lexsort((-ids, ~opens))                  # word beginnings apart from the others, frequent ones first
    rest = rest[rank[rest] >= alone]
    classes = np.minimum(rank, alone)
    mass = np.cumsum(ids[rest] + ALPHA)
    if len(rest):
        classes[rest] = alone + np.minimum((mass - ids[rest] - ALPHA) / mass[-1] * (CLASSES - alone), CLASSES - alone - 1).astype(np.int64)
    weight = ids + ALPHA
    return inputs, classes, np.log10(weight / np.bincount(classes, weight, CLASSES)[classes])


def _pairs(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Codes (class * CLASSES + next class) of the neighbours inside rows."""
    inner = np.ones(max(len(classes) - 1, 0), dtype=bool)
    cut = first[1:-1]
    inner[cut[(cut > 0) & (cut < len(classes))] - 1] = False
    return (classes[:-1] * CLASSES + classes[1:])[inner]


def _company(pairs: np.ndarray) -> np.ndarray:
    """A number for every class so that classes of a group (number // PER) follow alike classes; `pairs`: how often each code occurs."""
    n = pairs.reshape(CLASSES, CLASSES).astype(np.float64)
    expected = (n.sum(1, keepdims=True) + 1) * (n.sum(0, keepdims=True) + 1) / (n.sum() + CLASSES)
    axes = np.linalg.svd(np.log1p(n / expected), full_matrices=False)[2][1:1 + GROUPS.bit_length()]
    parts = [np.arange(CLASSES)]
    for axis in axes:
        if len(parts) < GROUPS:
            parts = [half for part in parts for half in np.split(part[np.argsort(axis[part], kind="stable")], 2)]
    number = np.empty(CLASSES, dtype=np.int64)
    number[np.concatenate(parts)] = np.arange(CLASSES)
    return number


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each window and its input places [window, 2 * STRIDE] (-1, the last place: outside the text).

    The input at place i is the token before token i, which is its target; a window's targets are its last STRIDE places."""
    size = np.diff(first)
    n = -(-size // STRIDE)
    row = np.repeat(np.arange(len(size)), n)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    at = start[:, None] + np.arange(-STRIDE, STRIDE)[None, :]
    return row, np.where((at >= 0) & (at < size[row, None]), first[row, None] + at, -1)


def model_inputs(inputs: np.ndarray, ids: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """Input id at every place: that of the token before, at a text's first place the end id's; after the last place OUTSIDE."""
    out = np.empty(len(ids) + 1, dtype=np.int64)
    out[1:] = inputs[ids]
    out[first[:-1][np.diff(first) > 0]] = inputs[end]
    out[-1] = OUTSIDE
    return out


_GAP = np.arange(STRIDE, 2 * STRIDE)[:, None] - np.arange(2 * STRIDE)[None, :]
OUTSIDE = OWN + SHARED


def attend(p: dict[str, np.ndarray], seen: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden rows [window, STRIDE, HIDDEN + 1] (the last a 1) for input ids at all places, and what the backward pass
    needs: attention, its sums, asking and giving rows."""
    ask, give = p["ask"].take(seen[:, STRIDE:], axis=0), p["give"].take(seen, axis=0)
    a = np.matmul(ask[:, :, :KEY_DIM], give[:, :, :KEY_DIM].transpose(0, 2, 1))
    a += np.where(_GAP >= 0, p["near"][np.maximum(_GAP, 0)], _FAR)
    _bounded(a)
    np.exp(a, out=a)
    h = np.matmul(a, give[:, :, KEY_DIM:])
    total = np.maximum(h[:, :, HIDDEN:], np.float32(1e-30))       # 0 only where a place outside the text asks
    h /= total
    h[:, :, :HIDDEN] += ask[:, :, KEY_DIM:]
    np.maximum(h, 0, out=h)
    return h, a, total, ask, give


def _bounded(x: np.ndarray) -> None:
    """Logits stay where exp does not overflow."""
    if x.size and x.max() > _MOST:
        np.minimum(x, _MOST, out=x)


_ONES = np.ones(max(GROUPS, PER), dtype=np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    """exp of bounded logits in place, and their sums."""
    np.exp(x, out=x)
    return x @ _ONES[:x.shape[1]]


def log_odds(p: dict[str, np.ndarray], h: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural log probability of a class for every hidden row: its group's, and its own inside the group."""
    group, own = classes // PER, classes % PER
    each = np.arange(len(h))
    logits = h @ p["groups"]
    _bounded(logits)
    won = logits[each, group]
    won -= np.log(_softmax(logits))
    order = np.argsort(group.astype(np.int8), kind="stable")
    upto = np.searchsorted(group.take(order), np.arange(GROUPS + 1))
    h, own, inside = h.take(order, axis=0), own.take(order), np.empty(len(h), dtype=h.dtype)
    for g in range(GROUPS):
        a, b = upto[g], upto[g + 1]
        if b > a:
            logits = h[a:b] @ p["classes"][g]
            _bounded(logits)
            inside[a:b] = logits[each[:b - a], own[a:b]]
            inside[a:b] -= np.log(_softmax(logits))
    won[order] += inside
    return won


def _add_rows(grad: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(ids.astype(np.int16), kind="stable")       # input ids end at OUTSIDE; short ones are sorted by digits
    ids, rows = ids[order], rows[order]
    new = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    grad[ids[new]] += np.add.reduceat(rows, new, axis=0)


def gradients(p: dict[str, np.ndarray], seen: np.ndarray, goals: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss (nats a token) and gradients on windows with input ids `seen` and classes `goals` of their targets (-1: none)."""
    h, a, total, ask, give = attend(p, seen)
    a /= total
    some = goals >= 0
    flat, goal = h[some], goals[some]
    group, own, n = goal // PER, goal % PER, max(len(goal), 1)
    g = {name: np.zeros_like(value) for name, value in p.items()}
    each = np.arange(len(flat))
    loss = 0.0

    def errors(logits: np.ndarray, hit: np.ndarray) -> np.ndarray:
        nonlocal loss
        _bounded(logits)
        logits /= _softmax(logits)[:, None]
        loss -= np.log(np.maximum(logits[each[:len(hit)], hit], 1e-30)).sum()
        logits[each[:len(hit)], hit] -= 1
        logits /= logits.dtype.type(n)
        return logits
    error = errors(flat @ p["groups"], group)
    g["groups"], dflat = flat.T @ error, error @ p["groups"].T
    for i in range(GROUPS):
        at = np.flatnonzero(group == i)
        if len(at):
            error = errors(flat[at] @ p["classes"][i], own[at])
            g["classes"][i] = flat[at].T @ error
            dflat[at] += error @ p["classes"][i].T
    dh = np.zeros_like(h)
    dh[some] = dflat
    dh *= h > 0
    dh = np.ascontiguousarray(dh[:, :, :HIDDEN])
    da = np.matmul(dh, give[:, :, KEY_DIM:KEY_DIM + HIDDEN].transpose(0, 2, 1))
    inner = (seen < OUTSIDE)[:, None, :]
    a *= inner
    da = a * (da - (da * a).sum(axis=2, keepdims=True))
    g["near"] = np.bincount(np.maximum(_GAP, 0).ravel(), da.sum(axis=0).ravel(), 2 * STRIDE).astype(p["near"].dtype)
    dask = np.concatenate([np.matmul(da, give[:, :, :KEY_DIM]), dh], axis=2)
    dgive = np.concatenate([np.matmul(da.transpose(0, 2, 1), ask[:, :, :KEY_DIM]), np.matmul(a.transpose(0, 2, 1), dh),
                            np.zeros((*seen.shape, 1), dh.dtype)], axis=2)
    _add_rows(g["ask"], seen[:, STRIDE:][some], dask[some])
    _add_rows(g["give"], seen.ravel(), dgive.reshape(-1, dgive.shape[2]))
    g["give"][OUTSIDE] = 0
    return float(loss) / n, g


def train(texts: list[str], counts: np.ndarray, path: str, steps: int = 400, passes: int = 20, rate: float = 0.02, batch: int = 512,
          seed: int = 7, pairs: np.ndarray | None = None) -> Model:
    """Fits the tables on windows of the texts (Adam, `batch` windows a step, at most `passes` over the texts).

    `pairs`: counts of neighbouring classes, by default those of the texts. Without texts the class shares decide alone."""
    tokens = subwords(path)
    inputs, classes, inside = vocabulary(counts, tokens.opens)
    parts = [joined(read_slice(s, tokens)[0], tokens.end) for s in text_slices(pa.array(texts, pa.string()))]
    ids = np.concatenate([np.zeros(0, np.int64), *(s[0] for s in parts)])
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(np.diff(s[1]) for s in parts)]))]).astype(np.int64)
    if pairs is None:
        pairs = np.bincount(_pairs(classes[ids], first), minlength=CLASSES * CLASSES)
    classes = _company(pairs)[classes] if len(ids) else classes
    rng = np.random.default_rng(seed)
    share = np.bincount(classes, counts + ALPHA, CLASSES).reshape(GROUPS, PER) + 1e-9
    def table(width: int, scale: float) -> np.ndarray:
        return np.vstack([rng.normal(0, scale, (OUTSIDE, width)), np.zeros((1, width))])
    p = {"ask": np.hstack([table(KEY_DIM, 0.1), table(HIDDEN, 0.3)]),
         "give": np.hstack([table(KEY_DIM + HIDDEN, 0.1), np.append(np.ones(OUTSIDE), 0)[:, None]]), "near": np.linspace(1, -1, 2 * STRIDE),
         "groups": np.vstack([rng.normal(0, 0.1, (HIDDEN, GROUPS)), np.log(share.sum(1) / share.sum())]),
         "classes": np.concatenate([rng.normal(0, 0.1, (GROUPS, HIDDEN, PER)), np.log(share / share.sum(1, keepdims=True))[:, None, :]], axis=1)}
    p = {n: x.astype(np.float32) for n, x in p.items()}
    if not len(ids):
        p["groups"][:HIDDEN], p["classes"][:, :HIDDEN] = 0, 0
        return Model(inputs, classes, inside, p)
    x = model_inputs(inputs, ids, first, tokens.end)
    goals = np.append(classes[ids], -1)
    _, places = windows(first)
    adam = Adam(p)
    left = np.zeros(0, np.int64)
    steps = min(steps, -(-passes * len(places) // batch))
    for t in range(1, steps + 1):
        if len(left) < batch:
            left = np.concatenate([left, rng.permutation(len(places))])
        where = places[left[:batch]]
        _, g = gradients(p, x[where], goals[where[:, STRIDE:]])
        left = left[batch:]
        adam.step(g, rate * min(1, t / 20) * (1 - t / (steps + 1)))
    return Model(inputs, classes, inside, p)


class Adam:
    """Steps on the tables `p`, in place."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.t = p, 0
        self.m, self.v = {n: np.zeros_like(a) for n, a in p.items()}, {n: np.zeros_like(a) for n, a in p.items()}

    def step(self, g: dict[str, np.ndarray], pace: float) -> None:
        self.t += 1
        for name, grad in g.items():
            m, v = self.m[name], self.v[name]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            self.p[name] -= (pace * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)).astype(np.float32)


def score(model: Model, ids: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """log10 probability of each row of the joined ids."""
    x = model_inputs(model.inputs, ids, first, end)
    row, places = windows(first)
    goals = np.append(model.classes[ids], -1)
    total = np.zeros(len(places))
    for at in range(0, len(places), WINDOWS * BATCHES):
        upto = min(at + WINDOWS * BATCHES, len(places))
        hidden = [attend(model.p, x.take(places[i:min(i + WINDOWS, upto)]))[0] for i in range(at, upto, WINDOWS)]
        goal = goals.take(places[at:upto, STRIDE:])
        won = log_odds(model.p, np.concatenate(hidden).reshape(-1, HIDDEN + 1), np.maximum(goal, 0).ravel())
        won[goal.ravel() < 0] = 0
        total[at:upto] = won.reshape(-1, STRIDE).sum(axis=1, dtype=np.float64)
    inside = np.concatenate([[0], np.cumsum(model.inside[ids])])
    return np.bincount(row, total, len(first) - 1) / np.log(10) + inside[first[1:]] - inside[first[:-1]]


# -- all rows ------------------------------------------------------------------------------------

_SEEN = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
         "names array<long>, times array<long>")


def _score_rows(shared, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hot, tokens_n, words_n, ends = shared.value
        tokens = subwords(path)
        scale = tokens_n + ALPHA * (words_n + 1)
        made = TaskContext.get().partitionId() << 33
        for batch in batches:
            for s in text_slices(batch.column("text"), 1 << 19):
                x, spot = read_slice(s, tokens, hot)
                is_hot = spot >= 0
                c = np.where(is_hot, hot.learned[spot], 0) if len(hot.names) else np.zeros(len(spot), np.int64)
                row = np.repeat(np.arange(s.n), np.diff(x.first))
                known = np.bincount(row, (c > 0)[x.which], s.n).astype(np.int64) + (ends > 0)
                base = np.bincount(row, np.where(is_hot, np.log10((c + ALPHA) / scale), 0)[x.which], s.n) + np.log10((ends + ALPHA) / scale)
                # the other words of each row, with their numbers
                other = ~is_hot[x.which]
                width = max(len(x.names), 1)
                code, times = np.unique(row[other] * width + x.which[other], return_counts=True)
                bounds = np.searchsorted(code, np.arange(s.n + 1) * width).astype(np.int32)
                names = x.names[code % width].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made + np.arange(s.n)), batch.column("doc_id").slice(s.first, s.n), batch.column("held_out").slice(s.first, s.n),
                     pa.array(np.diff(x.first) + 1), pa.array(known), pa.array(base), pa.array(score(model, *joined(x, tokens.end), tokens.end)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(names)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(times))],
                    names=[c.split()[0] for c in _SEEN.split(", ")])
                made += s.n
    return run


def sample_texts(rows: DataFrame, n_rows: int, sample: int) -> DataFrame:
    """Slices (t) of at most `sample` different training texts, those with the smallest hashes; SAMPLE_CHARS characters of each, from a hashed place on."""
    h = F.xxhash64("text")
    share = min(1.0, 4 * sample / max(n_rows, 1))
    begin = F.pmod(F.xxhash64(h), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    few = rows.filter("learn AND length(text) > 0").withColumn("h", h).filter(F.pmod(F.col("h"), F.lit(1 << 20)) < share * (1 << 20))
    return few.groupBy("h").agg(F.min(F.substr("text", begin.cast("int"), F.lit(SAMPLE_CHARS))).alias("t")).orderBy("h").limit(sample).select("t")


def _count_pairs(shared, path: str):
    """(code, n) of the neighbouring classes of a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, hot = shared.value
        tokens, n = subwords(path), np.zeros(CLASSES * CLASSES, np.int64)
        classes = vocabulary(counts, tokens.opens)[1]
        for batch in batches:
            for s in text_slices(batch.column("text"), 1 << 19):
                ids, first = joined(read_slice(s, tokens, hot)[0], tokens.end)
                code, times = np.unique(_pairs(classes[ids], first), return_counts=True)
                n[code] += times
        some = np.flatnonzero(n)
        for at in range(0, len(some), 1 << 16):
            code = some[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n[code])], names=["code", "n"])
    return run


def class_pairs(rows: DataFrame, c: Counts, path: str) -> np.ndarray:
    """How often each pair of classes follows one another in all training rows: at most CLASSES ** 2 rows are gathered."""
    shared = rows.sparkSession.sparkContext.broadcast((c.ids, c.hot))
    found = rows.filter("learn").select("text").mapInArrow(_count_pairs(shared, path), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(CLASSES * CLASSES, np.int64)
    n[found.column("code").to_numpy()] = found.column("n").to_numpy()
    return n


LEARN_RATE, LEARN_BATCH, LEARN_WARM = 0.004, 512, 20
MEAN_OF = 16                # tasks' tables averaged at a time
_PARTS = "part long, n long, p binary"


def learn_rows(model: Model, slices: Iterator, path: str, hot: HotWords = NO_HOT) -> int:
    """Trains on all windows of the slices, once, in place; the number of windows."""
    tokens, adam, done = subwords(path), Adam(model.p), 0
    rng = np.random.default_rng(7)
    for s in slices:
        ids, first = joined(read_slice(s, tokens, hot)[0], tokens.end)
        x, goals = model_inputs(model.inputs, ids, first, tokens.end), np.append(model.classes[ids], -1)
        places = windows(first)[1]
        for at in np.array_split(rng.permutation(len(places)), max(1, -(-len(places) // LEARN_BATCH))):
            if len(at):
                _, g = gradients(model.p, x[places[at]], goals[places[at, STRIDE:]])
                adam.step(g, LEARN_RATE * min(1, (adam.t + 1) / LEARN_WARM) / np.sqrt(1 + adam.t / 200) * min(1, len(at) / LEARN_BATCH))
        done += len(places)
    return done


def _learn(shared, path: str):
    """A task's tables after all its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, hot = shared.value
        model = Model(start.inputs, start.classes, start.inside, {n: a.copy() for n, a in start.p.items()})
        n = learn_rows(model, (s for batch in batches for s in text_slices(batch.column("text"), 1 << 19)), path, hot)
        if n:
            yield _part(TaskContext.get().partitionId(), n, model.p)
    return run


def _part(part: int, n: int, p: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([pickle.dumps(p)], pa.binary())], names=["part", "n", "p"])


def _mean(group: pa.Table) -> pa.Table:
    """One row of a few: the tables' mean by windows, in the order of their parts."""
    found = sorted(((r["part"], r["n"], pickle.loads(r["p"])) for r in group.to_pylist()), key=lambda r: r[0])
    total = sum(n for _, n, _ in found)
    p = {name: sum(q[name] * (n / total) for _, n, q in found).astype(np.float32) for name in found[0][2]}
    return pa.Table.from_batches([_part(found[0][0], total, p)])


def learn(rows: DataFrame, start: Model, path: str, hot: HotWords = NO_HOT) -> Model:
    """The start, trained on by every task over its training rows; the tasks' tables are averaged MEAN_OF at a time."""
    shared = rows.sparkSession.sparkContext.broadcast((start, hot))
    parts = cut_lineage(rows.filter("learn").select("text").mapInArrow(_learn(shared, path), _PARTS))
    n = parts.count()
    while n > 1:
        bounds = parts.agg(F.max("part").alias("most")).first()["most"] + 1
        width = min(bounds, MEAN_OF)
        near = parts.groupBy(F.floor(F.col("part") / width).alias("g")).applyInArrow(_mean, _PARTS)
        parts = cut_lineage(near.withColumn("part", F.floor(F.col("part") / width).cast("long")))
        n = parts.count()
    last = parts.first()
    return start if last is None else Model(start.inputs, start.classes, start.inside, pickle.loads(bytes(last["p"])))


def _train(counts, path: str, steps: int, pairs=None):
    """The model of all texts of a task, pickled in one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, counts.value, path, steps, pairs=pairs.value if pairs else None))], pa.binary())], names=["model"])
    return run


def fit(rows: DataFrame, c: Counts, path: str, sample: int, steps: int) -> Model:
    """Starts in one task, on the bounded sample, and goes on over all training rows; the model's size is fixed by its
    dimensions and the vocabulary's."""
    counts = rows.sparkSession.sparkContext.broadcast(c.ids)
    pairs = rows.sparkSession.sparkContext.broadcast(class_pairs(rows, c, path))
    texts = sample_texts(rows, c.ends, sample).toArrow().column("t").to_pylist()
    one = rows.sparkSession.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    start = pickle.loads(bytes(one.mapInArrow(_train(counts, path, steps, pairs), "model binary").first()["model"]))
    return learn(rows, start, path, c.hot)


def score_texts(docs: DataFrame, held_out: Column, path: str, id_col: str = "doc_id", text_col: str = "text", sample: int = 3000, steps: int = 400) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs.

    held_out: a boolean column of docs; rows where it isn't true are learned from. A null text is an empty one: its end
    token alone. Repeated rows stay, null ids are carried, other columns are ignored. Without training rows nothing is
    known and the model is untrained. An empty table gives no rows. Counts, classes and the model cover all training rows;
    slices of at most `sample` different training texts give the model its start."""
    spark = docs.sparkSession
    rows = docs.select(column(docs, id_col).cast("long").alias("doc_id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out")).withColumn("learn", ~F.col("held_out"))
    c = count(rows, path)
    model = fit(rows, c, path, sample, steps)
    shared = spark.sparkContext.broadcast((model, c.hot, c.tokens, c.words, c.ends))
    seen = cut_lineage(rows.select("doc_id", "text", "held_out").mapInArrow(_score_rows(shared, path), _SEEN))
    scale = c.tokens + ALPHA * (c.words + 1)
    rare = (seen.select("row", F.inline(F.arrays_zip("names", "times"))).join(c.rare.withColumnRenamed("name", "names"), "names", "left")
            .withColumn("n", F.coalesce("learned", F.lit(0)))
            .groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
                                F.sum(F.col("times") * F.log10((F.col("n") + ALPHA) / scale)).alias("more")))
    out = seen.drop("names", "times").join(rare, "row", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(c.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
