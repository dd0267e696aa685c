"""Conversation structure repair: Re-Pair compressed role/fault sequences and min-plus transfer matrices.

1. The rows of every conversation are put in order by one range-partitioned
   sort of narrow rows (identity of a text: its SHA-256), and each gets one of
   16 symbols: role initial (s, u, a, other) and first fault (none, blank,
   duplicate, truncated). A conversation is cut into pieces of at most
   ``PIECE_ROWS`` rows of one sorted partition, so one of any length is spread.
2. Re-Pair over all distinct pieces: rounds on Spark count adjacent pairs, and
   the most frequent ones that can't overlap become rules, until no pair
   repeats (or ``max_rules``, which bounds only the compression).
3. A symbol's transfer matrix holds, from each of the four grammar states
   (nothing yet, after system, after user, after assistant) to each, the least
   cost of "some insertions, then the row's edit", and the ASCII-least audit of
   that cost. A rule's matrix is the min-plus product of its two sides',
   evaluated bottom-up once and broadcast; its audits are ropes: for each entry
   the state between both sides. Audits of equal start hold equally many rows
   and end with a row's edit, so none is a prefix of another, and products need
   only their order, kept as ranks, never the strings.
4. Pieces are multiplied out of their compressed symbols; a conversation folds
   its pieces' matrices and chooses the states between them; pieces expand
   their ropes into audits.
5. Rows and audits of a conversation meet in one sorted stream, read row by
   row: edits are applied and the digest grows without holding the conversation.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import column, cut_lineage

PIECE_ROWS = 4096
WHITE = " \t\n\x0b\x0c\r"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = 16
INF = 1 << 60
#: Costs of the edits and of leaving a truncated row in.
RETITLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
_LEGAL = {(0, 1), (1, 2), (2, 1)}


@dataclass(frozen=True)
class Matrix:
    """cost[4 * i + j] from state i to j (INF: none), rank of each entry's audit among those of state i, and the rope.

    The rope of a symbol is its audit per entry; that of a rule the state between its sides."""

    cost: tuple[int, ...]
    rank: tuple[int, ...]
    rope: tuple


def _step(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _wanted(state: int) -> str:
    return "a" if state == USER else "u"


def symbol_matrix(symbol: int) -> Matrix:
    """The best edits of one row, with the insertions before it."""
    initial, fault = (INITIALS + "?")[symbol // 4], symbol % 4
    cost, audit = [INF] * 16, [""] * 16
    for i in range(4):
        state = i
        for inserted in range(3):
            moves = [("D", state, DELETE)]
            if fault in (NONE, TRUNCATED):
                extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
                kept = _step(state, initial)
                if kept is not None:
                    moves.append(("K", kept, extra))
                moves.append(("R", _step(state, _wanted(state)), RETITLE + extra))
            for letter, j, c in moves:
                found = (INSERT * inserted + c, "I" * inserted + letter)
                if found < (cost[4 * i + j], audit[4 * i + j]):
                    cost[4 * i + j], audit[4 * i + j] = found
            state = _step(state, _wanted(state))
    rank = [0] * 16
    for i in range(4):
        for place, j in enumerate(sorted(range(4), key=lambda j: audit[4 * i + j])):
            rank[4 * i + j] = place
    return Matrix(tuple(cost), tuple(rank), tuple(audit))


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; of equal costs the path whose audit is ASCII-least."""
    cost, rank, middle = [INF] * 16, [0] * 16, [0] * 16
    for i in range(0, 16, 4):
        for j in range(4):
            best = (INF, 0)
            for k in range(4):
                c = a.cost[i + k] + b.cost[4 * k + j]
                if c < INF and (c, a.rank[i + k]) < best:
                    best, middle[i + j] = (c, a.rank[i + k]), k
            cost[i + j] = best[0]
        order = sorted(range(4), key=lambda j: (a.rank[i + middle[i + j]], b.rank[4 * middle[i + j] + j]))
        for place, j in enumerate(order):
            rank[i + j] = place
    return Matrix(tuple(cost), tuple(rank), tuple(middle))


SYMBOLS = tuple(symbol_matrix(s) for s in range(LETTERS))


@dataclass(frozen=True)
class Grammar:
    """Rules LETTERS + n -> (left, right) in the order they were made, and their rounds' bounds (rules of a round can't overlap)."""

    rules: tuple[tuple[int, int], ...] = ()
    rounds: tuple[int, ...] = ()

    def matrices(self) -> list[Matrix]:
        out = list(SYMBOLS)
        for left, right in self.rules:
            out.append(product(out[left], out[right]))
        return out

    def compress(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rewrites joined sequences (bounds `first`) round by round; no pair runs over two sequences."""
        at = 0
        for upto in self.rounds:
            symbols, first = _rewrite(symbols, first, self.rules[at:upto], LETTERS + at)
            at = upto
        return symbols, first

    def audit(self, symbol: int, i: int, j: int, matrices: list[Matrix]) -> str:
        """The rope of one entry, written out."""
        out, todo = [], [(symbol, i, j)]
        while todo:
            s, i, j = todo.pop()
            if s < LETTERS:
                out.append(SYMBOLS[s].rope[4 * i + j])
            else:
                k = matrices[s].rope[4 * i + j]
                left, right = self.rules[s - LETTERS]
                todo += [(right, k, j), (left, i, k)]
        return "".join(out)


def _pairs(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether place p and p + 1 lie in one sequence."""
    inside = np.ones(max(len(symbols) - 1, 0), dtype=bool)
    cut = first[1:-1]
    inside[cut[(cut > 0) & (cut < len(symbols))] - 1] = False
    return inside


def _rewrite(symbols: np.ndarray, first: np.ndarray, rules, base: int) -> tuple[np.ndarray, np.ndarray]:
    inside = _pairs(symbols, first)
    code = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
    gone, out = np.zeros(len(symbols), dtype=bool), symbols.copy()
    for n, (left, right) in enumerate(rules):
        hit = np.flatnonzero(inside & (code == (left << 32 | right)))
        if left == right and len(hit):                 # in a run the 1st, 3rd, ... place
            run = np.concatenate([[0], np.cumsum(np.diff(hit) != 1)])
            hit = hit[(np.arange(len(hit)) - np.searchsorted(run, run)) % 2 == 0]
        out[hit] = base + n
        gone[hit + 1] = True
    kept = np.concatenate([[0], np.cumsum(~gone)])
    return out[~gone], kept[first]


def _joined(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])]).astype(np.int64)
    return np.frombuffer(b"".join(seqs), np.uint8).astype(np.int64) - 97, first


def _count_pairs(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, first = grammar.compress(*_joined([s.encode() for s in batch.column("seq").to_pylist()]))
            inside = _pairs(symbols, first)
            weight = np.repeat(batch.column("times").to_numpy(), np.diff(first))[:-1][inside]
            code, which = np.unique((symbols[:-1] << 32 | symbols[1:])[inside], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(np.bincount(which, weight, len(code)).astype(np.int64))], names=["pair", "n"])
    return run


def learn_grammar(seqs: DataFrame, max_rules: int = 512, per_round: int = 64) -> Grammar:
    """Re-Pair over all distinct sequences (seq, times), several rules a round.

    At most `per_round` pairs and their counts reach the driver in a round."""
    grammar = Grammar()
    while len(grammar.rules) < max_rules:
        top = (seqs.mapInArrow(_count_pairs(grammar), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
               .filter("n > 1").orderBy(F.desc("n"), "pair").limit(min(per_round, max_rules - len(grammar.rules))).collect())
        chosen: list[tuple[int, int]] = []
        lefts, rights = set(), set()
        for r in top:
            left, right = r["pair"] >> 32, r["pair"] & 0xFFFFFFFF
            if left not in rights and right not in lefts and (left != right or left not in lefts):
                chosen.append((left, right))
                lefts.add(left)
                rights.add(right)
        if not chosen:
            break
        grammar = Grammar(grammar.rules + tuple(chosen), grammar.rounds + (len(grammar.rules) + len(chosen),))
    return grammar


# -- rows -> symbols -> pieces -------------------------------------------------------------

def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by crc32 of "conv_id:turn" modulo 20; nulls read as one space."""
    blank = F.lit(" ")
    src = turns.select(column(turns, conv_col).cast("long").alias("conv_id"), column(turns, turn_col).cast("long").alias("turn"),
                       F.coalesce(column(turns, role_col), blank).alias("role"), F.coalesce(column(turns, text_col), blank).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    n = F.col("_fate")
    return (src.withColumn("_fate", F.crc32(name.cast("binary")) % 20).filter(n != 0)
            .withColumn("text", F.when(n == 1, F.lit("")).when(n == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(n == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("_copy", F.explode(F.when(n == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("_fate", "_copy"))


def _order() -> list[Column]:
    return [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the conversation's key (a null id is a conversation too) and the text's identity."""
    return rows.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("ck"), "turn",
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
                       ).withColumn("key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Narrow rows in their conversations' order, with row number `rid` and symbol. Ties of a turn go by role and text identity."""
    end = F.rtrim("text", F.lit(WHITE))
    state = (F.when(F.length(end) == 0, BLANK)
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE))
    initial = F.left("role", F.lit(1))
    initial = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = _keyed(rows).select("ck", "turn", "role", "key", initial.alias("initial"), state.alias("state"))
    # the tie keeps endless equal rows from landing in one range
    ordered = cut_lineage(narrow.withColumn("tie", F.monotonically_increasing_id()).orderBy(*_order(), "tie").drop("tie")
                          .withColumn("rid", F.monotonically_increasing_id()))
    firsts = ordered.groupBy("ck", "role", "key").agg(F.min("rid").alias("rid")).select("rid", F.lit(True).alias("is_first"))
    fault = F.when(F.col("state") == BLANK, BLANK).when(F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("state"))
    return ordered.join(firsts, "rid", "left").select("ck", "turn", "role", "key", "rid", (F.col("initial") * 4 + fault).alias("symbol"))


def pieces(ordered: DataFrame) -> DataFrame:
    """(piece = its first rid, ck, seq, place of its first row): consecutive rows of one conversation, at most PIECE_ROWS.

    Rows of a conversation inside one sorted partition are consecutive, so a piece is a key of the row number alone."""
    part = F.shiftright("rid", 33)
    block = F.floor((F.col("rid") - F.shiftleft(part, 33)) / PIECE_ROWS)
    return (ordered.groupBy("ck", part.alias("part"), block.alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("rid", "symbol"))).alias("rows"), F.min(F.struct("rid", "turn", "role", "key")).alias("head"))
            .select(F.col("head.rid").alias("piece"), "ck", F.struct("head.turn", "head.role", "head.key").alias("place"),
                    F.array_join(F.transform("rows", lambda r: F.chr(r["symbol"] + 97)), "").alias("seq")))


# -- pieces -> conversations -> audits --------------------------------------------------------

_SUMMARY = ("piece long, ck string, cost array<long>, rank array<int>, blank long, duplicate long, truncated long, illegal long, "
            "first int, last int")


def _compressed(seqs: list[str], grammar: Grammar) -> Iterator[tuple[str, list[int]]]:
    """Each distinct sequence and its compressed symbols."""
    distinct = list(dict.fromkeys(seqs))
    symbols, first = grammar.compress(*_joined([s.encode() for s in distinct]))
    for n, s in enumerate(distinct):
        yield s, symbols[first[n]:first[n + 1]].tolist()


def _summaries(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, matrices = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):                    # a bounded number of sequences in memory
                batch = whole.slice(at, 512)
                seqs = batch.column("seq").to_pylist()
                known = {}
                for s, short in _compressed(seqs, grammar):
                    m = reduce(product, (matrices[x] for x in short))
                    x = np.frombuffer(s.encode(), np.uint8).astype(np.int64) - 97
                    faults = np.bincount(x % 4, minlength=4)
                    who = x // 4
                    bad = sum(n for (a, b), n in zip(*_counted(who)) if (a, b) not in _LEGAL)
                    known[s] = (list(m.cost), list(m.rank), *faults[1:].tolist(), int(bad), int(who[0]), int(who[-1]))
                cols = list(zip(*(known[s] for s in seqs)))
                kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.int64()] * 4, pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("ck"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                                 names=[x.split()[0] for x in _SUMMARY.split(", ")])
    return run


def _counted(who: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    code, n = np.unique(who[:-1] * 4 + who[1:], return_counts=True)
    return [(c // 4, c % 4) for c in code.tolist()], n.tolist()


_CHOSEN = ("ck string, blank long, duplicate long, truncated long, illegal long, cost long, "
           "steps array<struct<piece: long, enter: int, leave: int, tail: string>>")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chooses the states between the pieces of each conversation, from the first piece on with one (cost, order) per state."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            cost, rank, back = [0, INF, INF, INF], [0] * 4, []
            illegal, last = 0, None
            for p in row["parts"]:
                illegal += p["illegal"] + (last is not None and (last, p["first"]) not in _LEGAL)
                last = p["last"]
                new, via = [INF] * 4, [0] * 4
                for j in range(4):
                    best = (INF, 0)
                    for i in range(4):
                        c = cost[i] + p["cost"][4 * i + j]
                        if c < INF and (c, rank[i]) < best:
                            best, via[j] = (c, rank[i]), i
                    new[j] = best[0]
                order = sorted(range(4), key=lambda j: (rank[via[j]], p["rank"][4 * via[j] + j]))
                cost, rank = new, [order.index(j) for j in range(4)]
                back.append(via)
            tail = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
            state = min((cost[j] + INSERT * len(tail[j]), rank[j], j) for j in range(4))[2]
            total, added = cost[state] + INSERT * len(tail[state]), tail[state]
            steps = []
            for p, via in zip(reversed(row["parts"]), reversed(back)):
                steps.append({"piece": p["piece"], "enter": via[state], "leave": state, "tail": added})
                state, added = via[state], ""
            out.append({"ck": row["ck"], **{k: sum(p[k] for p in row["parts"]) for k in ("blank", "duplicate", "truncated")},
                        "illegal": illegal, "cost": total, "steps": steps[::-1]})
        yield pa.RecordBatch.from_pylist(out, schema=_CHOSEN_SCHEMA)


_CHOSEN_SCHEMA = pa.schema([("ck", pa.string()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")],
                            ("steps", pa.list_(pa.struct([("piece", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("tail", pa.string())])))])


def _audits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, matrices = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = batch.select(["seq", "enter", "leave", "tail"]).to_pylist()
                asked: dict[str, set] = {}
                for r in rows:
                    asked.setdefault(r["seq"], set()).add((r["enter"], r["leave"]))
                made: dict[tuple, str] = {}
                for s, short in _compressed(list(asked), grammar):
                    prefix = list(accumulate((matrices[x] for x in short), product))
                    for enter, leave in asked[s]:
                        parts, j = [], leave
                        for n in range(len(short) - 1, -1, -1):
                            i = enter if n == 0 else prefix[n].rope[4 * enter + j]
                            parts.append(grammar.audit(short[n], i, j, matrices))
                            j = i
                        made[s, enter, leave] = "".join(reversed(parts))
                yield batch.select(["ck", "piece", "place"]).append_column(
                    "letters", pa.array([made[r["seq"], r["enter"], r["leave"]] + r["tail"] for r in rows], pa.string()))
    return run


@dataclass
class Repair:
    """summary: one row per conversation with rows; audits: letters per piece; rows: the rows that were judged."""

    summary: DataFrame
    audits: DataFrame
    rows: DataFrame

    def audit_strings(self) -> DataFrame:
        """(ck, audit): a conversation's letters joined."""
        return (self.audits.groupBy("ck").agg(F.sort_array(F.collect_list(F.struct("piece", "letters"))).alias("p"))
                .select("ck", F.array_join(F.transform("p", lambda x: x["letters"]), "").alias("audit")))

    def _stream(self) -> DataFrame:
        """Rows and audits of each conversation in order, a piece's letters ahead of its rows."""
        said = _keyed(self.rows).select("ck", "conv_id", "turn", "role", "key", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("piece"), "text")
        letters = self.audits.select("ck", F.lit(None).cast("long").alias("conv_id"), "place.turn", "place.role", "place.key", F.lit(0).alias("kind"),
                                     "piece", F.col("letters").alias("text"))
        return (said.unionByName(letters).repartition("ck").sortWithinPartitions(*_order(), "kind", "piece")
                .select("ck", "conv_id", "turn", "role", "kind", "text"))

    def repaired(self) -> DataFrame:
        """(conv_id, position, turn, role, text, edit): every kept, reroled (R) and inserted (I) row, in order.

        A conversation is read as one sorted stream in one task, whatever its length; the task holds a batch, and one letter a row."""
        return self._stream().mapInArrow(_repaired, "conv_id long, position long, turn long, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """(ck, repaired_sha256) of the repaired "role:text" lines, joined by line feeds."""
        return self._stream().mapInArrow(_digests, "ck string, repaired_sha256 string")


class _Editor:
    """Applies a conversation's letters to its rows as they come."""

    def __init__(self):
        self.letters: deque[str] = deque()
        self.state = START

    def inserted(self) -> Iterator[str]:
        while self.letters and self.letters[0] == "I":
            self.letters.popleft()
            yield self._take(_wanted(self.state))

    def edit(self, role: str) -> tuple[str, str | None]:
        letter = self.letters.popleft()
        if letter == "D":
            return letter, None
        if letter == "R":
            return letter, self._take(_wanted(self.state))
        self.state = _step(self.state, role[:1])
        return letter, role

    def _take(self, initial: str) -> str:
        self.state = _step(self.state, initial)
        return {"u": "user", "a": "assistant"}[initial]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict | None, str | None, str | None]]:
    """(ck, row, edit, role) of every edit; a None row is an insertion, a None edit the conversation's end."""
    now, editor = None, _Editor()
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            for r in batch.slice(at, 1024).to_pylist():
                if r["ck"] != now:
                    if now is not None:
                        for role in editor.inserted():
                            yield now, None, "I", role
                        yield now, None, None, None
                    now, editor = r["ck"], _Editor()
                if r["kind"] == 0:
                    editor.letters.extend(r["text"])
                    continue
                for role in editor.inserted():
                    yield now, None, "I", role
                yield now, r, *editor.edit(r["role"])
    if now is not None:
        for role in editor.inserted():
            yield now, None, "I", role
        yield now, None, None, None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, digest, lines = [], hashlib.sha256(), 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.string()), pa.array([d for _, d in out], pa.string())],
                                          names=["ck", "repaired_sha256"])
    for ck, row, edit, role in _conversations(batches):
        if edit is None:
            out.append((ck, digest.hexdigest()))
            digest, lines = hashlib.sha256(), 0
            if len(out) >= 4096:
                yield flush()
                out = []
        elif edit != "D":
            digest.update(f"{chr(10) if lines else ''}{role}:{row['text'] if row else ''}".encode())
            lines += 1
    yield flush()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    out, position = [], 0
    for ck, row, edit, role in _conversations(batches):
        if edit is None:
            position = 0
        elif edit != "D":
            out.append({"conv_id": None if ck == "none" else int(ck), "position": position, "turn": row["turn"] if row else None, "role": role,
                        "text": row["text"] if row else "", "edit": edit})
            position += 1
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def repair(rows: DataFrame, grammar: Grammar | None = None) -> Repair:
    """The cheapest edits that give every conversation of rows (conv_id, turn, role, text) the structure system? (user assistant)+, or nothing.

    Rows are taken by turn (nulls first), ties by role and text identity. A
    row's first fault counts: blank, duplicate (role and text seen earlier in
    the conversation) or truncated. Blank and duplicate rows are deleted;
    truncated ones may stay at a price. A null role or text reads as one space;
    a null conv_id is a conversation. Equal rows are rows each. An empty table
    has no conversations. Extra columns are ignored. Without a grammar, one is
    learned from these rows."""
    spark = rows.sparkSession
    rows = rows.select(column(rows, "conv_id").cast("long").alias("conv_id"), column(rows, "turn").cast("long").alias("turn"),
                       column(rows, "role").alias("role"), column(rows, "text").alias("text"))
    cut = cut_lineage(pieces(ordered_rows(rows)))
    if grammar is None:
        grammar = learn_grammar(cut_lineage(cut.groupBy("seq").agg(F.count("*").alias("times"))))
    shared = spark.sparkContext.broadcast((grammar, grammar.matrices()))        # at most max_rules rules
    summaries = cut.select("piece", "ck", "seq").mapInArrow(_summaries(shared), _SUMMARY)
    names = ["piece", "cost", "rank", "blank", "duplicate", "truncated", "illegal", "first", "last"]
    chosen = cut_lineage(summaries.groupBy("ck").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("parts")).mapInArrow(_fold, _CHOSEN))
    steps = chosen.select(F.inline("steps"))
    place = "struct<turn: long, role: string, key: binary>"
    audits = cut_lineage(cut.join(steps, "piece").mapInArrow(_audits(shared), f"ck string, piece long, place {place}, letters string"))
    return Repair(chosen.drop("steps"), audits, rows)


def conversation_report(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """The contract's row per original conv_id."""
    ids = original.select(column(original, "conv_id").cast("long").alias("conv_id")).distinct()
    ids = ids.withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")))
    fixed = repair(damaged)
    # distinct turns first: a conversation's rows are then counted without being gathered
    turns = (damaged.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("ck"), "turn").filter("turn IS NOT NULL").distinct()
             .groupBy("ck").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    out = (ids.join(fixed.summary, "ck", "left").join(turns, "ck", "left").join(fixed.audit_strings(), "ck", "left").join(fixed.digests(), "ck", "left"))
    zero = F.lit(0).cast("long")
    return out.select("conv_id", *[F.coalesce(n, zero).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
