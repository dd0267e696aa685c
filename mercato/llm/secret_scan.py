"""Secret scan: fixed patterns, and random-looking strings by Markov models.

The base patterns give spans per kind. Beyond them, runs of at least
``MIN_RUN`` key-like characters are judged by two first-order character models
with the log-likelihood ratio of their transitions: one of random strings,
trained on the values of all base spans, one of ordinary identifiers, trained
on all runs without a digit outside base spans. Both sets are labelled by
those rules over the whole corpus; transition counts are aggregated on Spark
and only the fixed-size table of ratios reaches the driver.

DataFrame operations only. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import column, cut_lineage

# The base patterns and the least length of what they match.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_K = len(ALPHABET) + 1
MIN_RUN = 16
_RUN = f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_RUN},}}+"
#: A run is a secret if its summed and its mean log-likelihood ratio reach these.
MIN_SUM, MIN_MEAN = 16.0, 0.75
#: Weight, in characters, of the single-character frequencies in a transition.
BACKOFF = 8.0
MASK = "[SECRET]"


#: Matches that one step of an array function gathers: a list grows by copies, so lists are grown in chunks.
CHUNK = 128
_NO_SPANS = "cast(array() as array<struct<start: int, stop: int, value: string>>)"


def _bind(value: str, name: str, body: str) -> str:
    """SQL: body with a name for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _before(list_: str, start: str, step: str) -> str:
    """SQL: for each element x of an array the state before it (state a, from `start` on, `step` gives the next)."""
    return f"""aggregate({list_}, named_struct('at', {start}, 'list', cast(array() as array<int>)),
        (a, x) -> named_struct('at', {step}, 'list', concat(a.list, array(a.at))), a -> a.list)"""


def _chunks(size: str) -> str:
    return f"sequence(0, cast(greatest({size} - 1, 0) div {CHUNK} as int))"


def _found(text: str, pattern: str, group: int = 0) -> str:
    """SQL: array of (start, stop, value) of the leftmost non-overlapping matches.

    Starts come from the lengths of the parts between the matches, summed in
    chunks; a text without a match is not split."""
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    parts = f"""transform({_chunks('size(zz)')}, c -> aggregate(slice(zz, c * {CHUNK} + 1, {CHUNK}), named_struct('at', 0, 'out', {_NO_SPANS}),
        (a, x) -> if(x.`0` IS NULL, a, named_struct('at', a.at + length(x.`2`) + length(x.`0`),
            'out', concat(a.out, array(named_struct('start', a.at + length(x.`2`), 'stop', a.at + length(x.`2`) + length(x.`0`), 'value', x.`1`)))))))"""
    shifted = """flatten(transform(sequence(0, size(pp) - 1), i -> transform(get(pp, i).out,
        o -> named_struct('start', o.start + get(oo, i), 'stop', o.stop + get(oo, i), 'value', o.value))))"""
    zipped = f"arrays_zip(regexp_extract_all({text}, '{p}', 0), regexp_extract_all({text}, '{p}', {group}), split({text}, '{p}', -1))"
    return f"""if(rlike({text}, '{p}'), {_bind(zipped, 'zz', _bind(parts, 'pp', _bind(_before('pp', '0', 'a.at + x.at'), 'oo', shifted)))}, {_NO_SPANS})"""


def _replaced(text: str, spans: str, fill: str, more: str) -> str:
    """SQL: text with spans (by start) replaced: a span by `fill` (of span s); where it overlaps one before by `more`, of s and
    the end `a.at` of what is done. The text is cut in pieces of CHUNK spans, each read in its own short string."""
    ends = f"transform({_chunks('size(ss)')}, c -> array_max(transform(slice(ss, c * {CHUNK} + 1, {CHUNK}), s -> s.stop)))"
    piece = f"""aggregate(slice(ss, i * {CHUNK} + 1, {CHUNK}), named_struct('at', get(oo, i), 'out', ''),
        (a, s) -> named_struct('at', greatest(a.at, s.stop), 'out', if(s.start < a.at, concat(a.out, {more}),
            concat(a.out, substring(part, a.at - get(oo, i) + 1, s.start - a.at), {fill}))), a -> a.out)"""
    cut = f"substring({text}, get(oo, i) + 1, greatest(get(ee, i) - get(oo, i), 0))"
    pieces = f"transform(sequence(0, size(ee) - 1), i -> {_bind(cut, 'part', piece)})"
    whole = f"concat(array_join({pieces}, ''), substring({text}, array_max(ee) + 1))"
    return f"if(size({spans}) = 0, {text}, {_bind(spans, 'ss', _bind(ends, 'ee', _bind(_before('ee', '0', 'greatest(a.at, x)'), 'oo', whole)))})"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with two more columns: _base, array of (start, kind_no, stop, value) by
    start, then kind; _runs, array of (start, stop, value) of the key-like runs outside
    the base spans (of a run that a span touches, what is left of it)."""
    t = "_text"
    cols = docs.columns
    kinds = {"assign": _found(t, ASSIGN, 2), "access": _found(t, ACCESS.replace("+", "{12,}")), "hex": _found(t, HEX.replace("+", "{32,}"))}
    parts = [f"transform(filter({sql}, x -> length(x.value) >= {LEAST[k]}), x -> named_struct('start', x.start, 'kind_no', {KINDS.index(k)}, 'stop', x.stop, 'value', x.value))"
             for k, sql in kinds.items()]
    out = docs.withColumn(t, F.coalesce(column(docs, text_col), F.lit("")))
    out = out.withColumn("_base", F.expr(f"array_sort(concat({', '.join(parts)}))"))
    # base spans become line feeds of the same length, so runs end at them
    blank = _replaced(t, "_base", "repeat('\n', s.stop - s.start)", "repeat('\n', greatest(s.stop - a.at, 0))")
    out = out.withColumn(t, F.expr(blank)).withColumn("_runs", F.expr(_found(t, _RUN)))
    return out.select(*[column(docs, c) for c in cols], "_base", "_runs")


def _codes(value: Column) -> Column:
    """Transition numbers of a string: place of a character in ALPHABET times _K plus that of the next."""
    at = lambda i: F.instr(F.lit(ALPHABET), F.substr(value, i, F.lit(1)))
    return F.when(F.length(value) >= 2, F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: at(i) * _K + at(i + 1))).otherwise(
        F.array().cast("array<int>"))


def train(scanned: DataFrame) -> list[float] | None:
    """Log-likelihood ratio (random against ordinary) of every transition, or None if either set is empty."""
    random = scanned.select(F.lit(1).alias("random"), F.explode("_base.value").alias("value"))
    ordinary = scanned.select(F.lit(0).alias("random"), F.explode("_runs.value").alias("value")).filter(~F.col("value").rlike("[0-9]"))
    rows = (random.union(ordinary).select("random", F.explode(_codes(F.col("value"))).alias("code"))
            .groupBy("random", "code").count().collect())          # at most 2 * _K * _K rows
    counts = {(r["random"], r["code"]): r["count"] for r in rows}
    if len({k for k, _ in counts}) < 2:
        return None
    def model(k: int) -> list[float]:
        """log P(next | character), a character's transitions smoothed by the frequency of the next one alone."""
        single = [sum(counts.get((k, a * _K + b), 0) for a in range(_K)) + 0.5 for b in range(_K)]
        total = sum(single)
        out = []
        for a in range(_K):
            seen = sum(counts.get((k, a * _K + b), 0) for b in range(_K))
            out += [math.log((counts.get((k, a * _K + b), 0) + BACKOFF * single[b] / total) / (seen + BACKOFF)) for b in range(_K)]
        return out
    return [r - o for r, o in zip(model(1), model(0))]


def with_spans(scanned: DataFrame, ratios: list[float] | None) -> DataFrame:
    """scanned with a column _spans: array of (start, kind_no, stop), base and random, by start, then kind."""
    base = F.transform("_base", lambda b: F.struct(b["start"].alias("start"), b["kind_no"].alias("kind_no"), b["stop"].alias("stop")))
    if ratios is None:
        return scanned.withColumn("_spans", base)
    table = F.split(F.lit(" ".join(f"{x:.6f}" for x in ratios)), " ").cast("array<double>")     # folded into one literal
    scored = F.transform("_runs", lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop"), F.aggregate(
        _codes(r["value"]), F.lit(0.0), lambda acc, c: acc + F.get(table, c)).alias("ratio")))
    hits = F.filter(scored, lambda r: (r["ratio"] >= MIN_SUM) & (r["ratio"] >= MIN_MEAN * (r["stop"] - r["start"])))
    more = F.transform(hits, lambda r: F.struct(r["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind_no"), r["stop"].alias("stop")))
    return scanned.withColumn("_spans", F.array_sort(F.concat(base, more)))


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row.

    A null text is an empty one: no spans, and the digest of an empty string.
    Repeated rows stay, null ids are carried, other columns are ignored.
    Without base spans or ordinary runs there are no models and no random
    spans. An empty table gives no rows."""
    narrow = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    seen = cut_lineage(scan(narrow).select("doc_id", "_base", "_runs"))
    out = with_spans(seen, train(seen))
    count = lambda k, c: F.size(F.filter(c, lambda s: s["kind_no"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k, "_base") for k in KINDS[:3]],
                      F.sha2(_text_of(F.col("_base")).cast("binary"), 256).alias("base_sha256"), _text_of(F.col("_spans")).alias("spans"), count("random", "_spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = MASK) -> DataFrame:
    """docs with every span of the text replaced by the mask (overlapping spans
    by one), all columns and their order kept; null texts stay null. n_chars,
    if there is one, is the new length."""
    names, at = docs.columns, docs.columns.index(text_col)
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])           # no name of the caller's can clash
    text = f"c{at}"
    ratios = train(cut_lineage(scan(rows.select(text), text).select("_base", "_runs")))
    out = with_spans(scan(rows, text), ratios)
    new = F.expr(_replaced(text, "_spans", f"'{mask}'", "''"))
    out = out.withColumn(text, new)
    if "n_chars" in names:
        n = f"c{names.index('n_chars')}"
        out = out.withColumn(n, F.when(F.col(text).isNull(), F.col(n)).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*rows.columns).toDF(*names)
