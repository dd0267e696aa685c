"""Conversation repair: against exhaustive search and a plain dynamic program over whole conversations."""
import hashlib
import random
import re
import zlib
from itertools import product as cross

import pytest
from conftest import SF_SMALL

from mercato.llm import repair

STRUCTURE = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        core = text.strip(repair.WHITE)
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best(rows):
    """(cost, audit, lines) by a dynamic program on strings: all paths of equal state compared whole."""
    fault = faults(rows)
    state = {"": (0, "", ())}               # role initials' last letter -> best

    def insertions(now):
        for _ in range(3):
            for last, (c, a, lines) in list(now.items()):
                role = "assistant" if last == "u" else "user"
                new = (c + 5, a + "I", lines + (f"{role}:",))
                if role[0] not in now or new < now[role[0]]:
                    now[role[0]] = new
        return now
    for (role, text), f in zip(rows, fault):
        new = {}

        def offer(key, value):
            if key not in new or value < new[key]:
                new[key] = value
        for last, (c, a, lines) in insertions(dict(state)).items():
            offer(last, (c + 2, a + "D", lines))
            if f in ("", "truncated"):
                extra = 5 if f else 0
                k = role[:1]
                if k == "s" and last == "" or k == "u" and last != "u" or k == "a" and last == "u":
                    offer(k, (c + extra, a + "K", lines + (f"{role}:{text}",)))
                to = "assistant" if last == "u" else "user"
                offer(to[0], (c + 1 + extra, a + "R", lines + (f"{to}:{text}",)))
        state = new
    ends = [v for last, v in insertions(dict(state)).items() if last in ("", "a")]
    return min(ends)


def exhaustive(rows, most=3):
    """The same over every edit string and number of insertions."""
    fault, found = faults(rows), []
    for edits in cross("DKR", repeat=len(rows)):
        for gaps in cross(range(most), repeat=len(rows) + 1):
            cost, audit, roles, ok = 0, "", "", True
            for n, ((role, _), f, e) in enumerate(zip(rows + [("", "")], fault + [""], edits + ("",))):
                for _ in range(gaps[n]):
                    cost, audit, roles = cost + 5, audit + "I", roles + ("a" if roles.endswith("u") else "u")
                if e == "D":
                    cost += 2
                elif e:
                    ok &= f in ("", "truncated")
                    cost += (5 if f else 0) + (e == "R")
                    roles += role[:1] if e == "K" else ("a" if roles.endswith("u") else "u")
                audit += e
            if ok and STRUCTURE.match(roles):
                found.append((cost, audit))
    return min(found)


def test_plain_program_equals_exhaustive_search():
    rng = random.Random(4)
    for _ in range(150):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", " ", "c!"])) for _ in range(rng.randint(0, 4))]
        assert best(rows)[:2] == exhaustive(rows), rows


def plain(rows):
    """The contract's columns of one conversation, rows in order (conv_id, turn, role, text)."""
    order = [(r[2], r[3]) for r in rows]
    turns = {r[1] for r in rows if r[1] is not None}
    f = faults(order)
    cost, audit, lines = best(order)
    initials = [r[0][:1] for r in order]
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{k: f.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out += [] if n == 0 else [(conv, turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return out


def check(spark, rows, extra=None):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra or ():
        df = df.withColumn(name, df.text)
    got = {r["conv_id"]: r.asDict() for r in repair.conversation_report(df, repair.damage(df)).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = {"conv_id": conv, **plain(in_order([r for r in damaged(rows) if r[0] == conv]))}
    assert got == want


def test_report_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
             rng.choice(["Hello there.", "no end", None, "", " \t\n", "What?\x0b ", "日本。", "é!", "dup.", "dup."]))
            for conv in [None, *range(120)] for turn in rng.sample(range(40), rng.randint(1, 12))]
    rows += [(7, None, "user", "x."), (7, None, "user", "x."), (8, None, None, None), (9, 3, "user", "same turn."), (9, 3, "assistant", "same turn.")]
    check(spark, rows, extra=("rid", "ck", "symbol", "kind"))


def test_report_on_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


@pytest.mark.parametrize("piece", [3, 64])
def test_long_conversations_in_pieces(spark, monkeypatch, piece):
    """One conversation in many pieces and partitions, with runs of equal rows, beside short ones."""
    monkeypatch.setattr(repair, "PIECE_ROWS", piece)
    rng = random.Random(piece)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", "c?", "", f"{t}."])) for t in range(900)]
    rows += [(2, None, "user", "again.")] * 300 + [(3, 0, "user", "Hi."), (3, 1, "assistant", "Ho.")]
    check(spark, rows)


def test_nothing_left_and_empty_tables(spark):
    gone = next(c for c in range(100000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(gone, 0, "user", "x.")])
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.conversation_report(nothing, repair.damage(nothing)).count() == 0


def test_repaired_rows(spark):
    rows = [(5, 0, "user", "Hi."), (5, 1, "user", "There."), (5, 2, "assistant", "cut"), (None, 0, "assistant", "Only.")]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA)).repaired().orderBy("conv_id", "position").collect()
    assert [(r["conv_id"], r["role"], r["text"], r["edit"]) for r in got] == [(5, "user", "Hi.", "K"), (5, "assistant", "There.", "R")]


def test_grammar_rewrites_and_expands():
    rng = random.Random(2)
    seqs = ["".join(rng.choice("aeim") for _ in range(rng.randint(1, 60))) + "iiiiiii" for _ in range(40)]
    rules, rounds = ((0, 4), (8, 8), (16, 17), (8, 12)), (2, 4)
    grammar = repair.Grammar(rules, rounds)
    matrices = grammar.matrices()

    def spell(x):
        return [x] if x < 16 else spell(rules[x - 16][0]) + spell(rules[x - 16][1])
    for s, short in repair._compressed(seqs, grammar):
        assert "".join(chr(97 + y) for x in short for y in spell(x)) == s
        assert len(short) < len(s)
    for n, x in enumerate(matrices):
        for i in range(4):
            strings = {j: grammar.audit(n, i, j, matrices) for j in range(4) if x.cost[4 * i + j] < repair.INF}
            assert sorted(strings, key=strings.get) == sorted(strings, key=lambda j: x.rank[4 * i + j])
