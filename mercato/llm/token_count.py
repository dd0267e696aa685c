"""Token counts by a compiled finite-state tokenizer.

The byte BPE is compiled, as texts need it, into a deterministic transducer
over the bytes of a pre-token; the transition on a byte carries the change in
the number of tokens. It rests on two properties of a BPE whose tokens all
encode to themselves: the last token of a prefix is unique, and a token may
follow another exactly when the two alone encode to that pair. So the count of
a prefix is the count of the prefix without its last token, plus one, and all
that later bytes can depend on is the end of the prefix that may still grow
into a token and the tokens that end inside it: that is a state.

Long texts are run in chunks. The map of a chunk takes the open piece that a
text brings into it to a count and the open piece that leaves it; chunk maps
are composed pairwise in a prefix scan (the operation is associative), so
chunks can be run in any order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from mercato.llm import vocab
from mercato.llm.tables import column

CHUNK_CHARS = 1 << 16
MAX_STATES = 400_000
MEMO_PIECES = 200_000
MEMO_CHARS = 32

_COMPILED: dict[str, Transducer] = {}


class Transducer(dict):
    """Counts tokens of pieces; the dictionary keeps the counts of short pieces."""

    def __init__(self, path: str):
        super().__init__()
        import regex
        self.vocab, self.merges, special = vocab.load(path)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.split = regex.compile(vocab.SPLIT.format(L=r"\p{L}", N=r"\p{N}", S=vocab.WHITE, LL=r"\p{L}", NN=r"\p{N}"))
        self.path, self.pre = path, None
        self.known: dict[str, int] = {}               # counts of pre-tokens, bounded like those of pieces
        self.classes: dict[int, str] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.prefixes = {t[:i] for t in self.vocab for i in range(len(t) + 1)}
        self._reset()

    def _reset(self) -> None:
        #: state * 256 + byte -> next state * 256 + (emitted count + 128)
        self.step: dict[int, int] = {}
        start = (b"", ((None, 0),))
        self.states, self.number = [start], {start: 0}

    # -- byte pair merges of two tokens ------------------------------------------
    def _merge(self, data: bytes) -> list[int]:
        parts = [self.vocab[data[i:i + 1]] for i in range(len(data))]
        while True:
            best = min(((self.merges[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges), default=None)
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [self.merges[parts[i], parts[i + 1]][1]]

    def _follows(self, a: bytes, b: bytes) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= MAX_STATES:
                self.pairs.clear()
            got = self.pairs[a, b] = self._merge(a + b) == [self.vocab[a], self.vocab[b]]
        return got

    def _compile(self, state: int, byte: int) -> int:
        """The transition of a state on a byte, with the state it leads to.

        A state is (u, marks): u the longest end of the prefix that begins a
        token, marks one entry for each place in u (its end included) from
        which a token can still grow: the token that ends there (None at the
        start of the pre-token) and its count against the prefix's; or None."""
        u, marks = self.states[state]
        v = u + bytes((byte,))
        for j, mark in enumerate(marks):
            if mark and v[j:] in self.vocab and (mark[0] is None or self._follows(mark[0], v[j:])):
                last, emitted = v[j:], mark[1] + 1
                break
        else:
            raise ValueError("not a byte BPE whose tokens encode to themselves")
        k = next(j for j in range(len(v) + 1) if v[j:] in self.prefixes)
        moved = [(m[0], m[1] - emitted) if m and v[j:] in self.prefixes else None for j, m in enumerate(marks)]
        to = (v[k:], (*moved[k:], (last, 0)))
        n = self.number.get(to)
        if n is None:
            n = self.number[to] = len(self.states)
            self.states.append(to)
        step = self.step[state << 8 | byte] = n << 8 | (emitted + 128)
        return step

    def word(self, word: bytes) -> int:
        """Tokens of one pre-token."""
        if len(self.states) >= MAX_STATES:
            self._reset()
        step, state, total = self.step, 0, 0
        for byte in word:
            to = step.get(state << 8 | byte) or self._compile(state, byte)
            total += (to & 255) - 128
            state = to >> 8
        return total

    # -- pieces and texts -----------------------------------------------------------
    def __missing__(self, piece: str) -> int:
        n, known = 0, self.known
        for w in self.split.findall(piece):
            c = known.get(w)
            if c is None:
                c = self.word(w.encode())
                if len(w) <= MEMO_CHARS and len(known) < MEMO_PIECES:
                    known[w] = c
            n += c
        if len(piece) <= MEMO_CHARS and len(self) < MEMO_PIECES:
            self[piece] = n
        return n

    def _stand_in(self, c: int) -> str:
        """A character of the same class with the same class everywhere; the class
        is the one the tokenizer's own pre-tokenizer gives."""
        if c not in self.classes:
            self.pre = self.pre or vocab.library(self.path).pre_tokenizer
            x, cut = chr(c), self.pre.pre_tokenize_str
            other = len(cut("!" + x + x + "!")) == 1
            self.classes[c] = "!" if other else "a" if len(cut("a" + x + "a")) == 1 else "1" if len(cut("1" + x + "1")) == 1 else "\xa0"
        return self.classes[c]

    def _count(self, text: str) -> int:
        if vocab.UNSTABLE.search(text):
            shape = vocab.UNSTABLE.sub(lambda m: self._stand_in(ord(m[0])), text)
            # a stand-in letter must not complete a contraction: the pattern's are lower-case ASCII, and 'a' is in none
            return sum(self.word(text[m.start():m.end()].encode()) for m in self.split.finditer(shape))
        return sum(map(self.__getitem__, vocab.blank_pieces(text)))

    def chunk(self, text: str) -> ChunkMap:
        cuts = [m.start() for m in vocab.LONE_BLANK.finditer(text)]
        if not cuts:
            return ChunkMap(text, None, "")
        return ChunkMap(text[:cuts[0]], self._count(text[cuts[0]:cuts[-1]]), text[cuts[-1]:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.middle is None and b.middle is None:
            return self._joined(a.head + b.head)
        if a.middle is None:
            c = self._joined(a.head + b.head)
            return ChunkMap(c.head, b.middle, b.tail) if c.middle is None else ChunkMap(c.head, c.middle + self._count(c.tail) + b.middle, b.tail)
        if b.middle is None:
            c = self._joined(a.tail + b.head)
            return ChunkMap(a.head, a.middle, c.head) if c.middle is None else ChunkMap(a.head, a.middle + self._count(c.head) + c.middle, c.tail)
        return ChunkMap(a.head, a.middle + self._count(a.tail + b.head) + b.middle, b.tail)

    def _joined(self, text: str) -> ChunkMap:
        return self.chunk(text)

    def finish(self, m: ChunkMap) -> int:
        return self._count(m.head) + (m.middle or 0) + self._count(m.tail)

    def tokens(self, text: str, chunk: int = CHUNK_CHARS) -> int:
        if self.special and (marks := self.special.findall(text)):
            return len(marks) + sum(self.tokens(x, chunk) for x in self.special.split(text))
        if len(text) <= chunk:
            return self._count(text)
        maps = [self.chunk(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:                           # one level of the scan tree
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.finish(maps[0])


@dataclass
class ChunkMap:
    """head: up to the first certain boundary; middle: tokens between the first
    and the last (None without any boundary, then head is all); tail: the rest."""

    head: str
    middle: int | None
    tail: str


def transducer(path: str) -> Transducer:
    """One transducer per worker process and vocabulary."""
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = transducer(path).tokens
        for batch in batches:
            n = [count(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    A null text counts as empty (0 bytes, 0 tokens). Every row is counted for
    itself, so repeated rows and ids stay; a null id is carried. Other columns
    are ignored. An empty table gives no rows."""
    from pyspark.sql import functions as F
    text = F.coalesce(column(docs, text_col), F.lit(""))
    src = docs.select(column(docs, id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return (src.mapInArrow(_counts(tokenizer_path), "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
