"""Chat formatting in budgeted, turn-aligned windows (DataFrame operations only).

A turn's tokens are prefix-summed over its conversation. With a stride of
``budget - history - system`` tokens, a turn is a target of the window its end
falls into; a window starts at its first target. Turns that end before a
window's stride and start at most ``history`` tokens before it are repeated in
front of its targets, and a system turn that opens the conversation is
retained in every window. Repeated and retained turns are masked: loss spans
cover the texts of assistant targets only, so every assistant text is learned
once. A window exceeds the budget only through a turn longer than ``history``
or a system turn longer than half the budget; turns are never cut.

Prefix sums are taken per block of ``BLOCK_TURNS`` turn numbers, then over the
blocks, so a conversation of any length is spread over tasks; a window is a
bounded group.

The template: ``### <role>:\\n<text></turn>\\n``. Inside texts a backslash is
doubled, ``###`` becomes ``\\###`` and ``</turn>`` becomes ``<\\/turn>``;
removing one backslash of each escape restores the text. Roles are URL-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.tables import column

BLOCK_TURNS = 256
TURN_END = "</turn>\n"


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("###", "\\###"), ("</turn>", "<\\/turn>")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def estimated_tokens(text: Column) -> Column:
    """A turn's budgeted tokens: a quarter of its bytes, and six for the template."""
    return F.ceil(F.octet_length(text) / 4) + F.lit(6)


def format_windows(turns: DataFrame, budget: int = 1024, history: int = 256, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv_id, window, formatted, n_turns, n_repeated (leading
    turns that are masked repeats), loss_spans (start, length in code points).

    Null texts and roles count as empty. Rows are ordered by turn (null first),
    then role and text; rows that repeat a turn number are all turns, equal rows
    too. A null conv_id is a conversation of its own. Other columns are
    ignored. An empty table gives no rows."""
    rows = turns.select(column(turns, conv_col).cast("long").alias("conv_id"), column(turns, turn_col).cast("long").alias("turn"),
                        F.coalesce(column(turns, role_col), F.lit("")).alias("role"), F.coalesce(column(turns, text_col), F.lit("")).alias("text"))
    rows = (rows.withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")))
            .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-2**62)))
            .withColumn("esc", escape(F.col("text"))).withColumn("tok", estimated_tokens(F.col("esc"))))
    blocks = rows.groupBy("ck", "block").agg(F.sum("tok").alias("tok"), F.count("*").alias("n"), F.min(F.struct("turn", "role", "text", "esc", "tok")).alias("head"))
    before = Window.partitionBy("ck").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opening = F.first("head").over(Window.partitionBy("ck").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.select("ck", "block", F.coalesce(F.sum("tok").over(before), F.lit(0)).alias("tok0"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), opening.alias("head"))
    inside = Window.partitionBy("ck", "block").orderBy("turn", "role", "text")
    rows = (rows.join(blocks, ["ck", "block"])
            .withColumn("pos", F.col("n0") + F.row_number().over(inside))
            .withColumn("end", F.col("tok0") + F.sum("tok").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("has_system", F.col("head.role") == "system")
            .withColumn("system_tok", F.when(F.col("has_system"), F.col("head.tok")).otherwise(0))
            .withColumn("stride", F.greatest(F.lit(budget - history) - F.col("system_tok"), F.lit(budget // 2 - history).cast("long"), F.lit(1).cast("long"))))
    # positions without the system turn, which is in every window
    rows = (rows.withColumn("opens", F.col("has_system") & (F.col("pos") == 1))
            .withColumn("e", F.col("end") - F.col("system_tok")).withColumn("s", F.col("e") - F.col("tok"))
            .withColumn("own", F.when(F.col("opens"), F.lit(0).cast("long")).otherwise(F.floor((F.col("e") - 1) / F.col("stride"))))
            .withColumn("upto", F.when(F.col("opens"), F.lit(0).cast("long")).otherwise(F.greatest("own", F.floor((F.col("s") + history) / F.col("stride")))))
            .withColumn("window", F.explode(F.sequence("own", "upto"))))
    retained = F.when(F.col("has_system"), F.struct(F.col("head.role").alias("role"), F.col("head.esc").alias("esc")))
    windows = (rows.groupBy("ck", "window")
               .agg(F.min("conv_id").alias("conv_id"), F.max((F.col("window") == F.col("own"))).alias("has_target"),
                    F.sort_array(F.collect_list(F.struct("pos", "role", "esc", (F.col("window") > F.col("own")).alias("repeated")))).alias("turns"),
                    F.first(F.when(F.col("window") > 0, retained)).alias("system"))
               .filter("has_target"))
    all_turns = F.expr("""concat(if(system IS NULL, array(), array(named_struct('pos', 0L, 'role', system.role, 'esc', system.esc, 'repeated', true))),
                                 transform(turns, t -> named_struct('pos', cast(t.pos as bigint), 'role', t.role, 'esc', t.esc, 'repeated', t.repeated)))""")
    shown = F.transform("all_turns", lambda t: F.struct(
        F.concat(F.lit("### "), F.url_encode(t["role"]), F.lit(":\n")).alias("header"), t["esc"].alias("esc"),
        (~t["repeated"] & (t["role"] == "assistant")).alias("learned"), t["repeated"].alias("repeated")))
    spans = F.expr(f"""filter(aggregate(shown, named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, length: int>>)),
        (a, t) -> named_struct('at', a.at + length(t.header) + length(t.esc) + {len(TURN_END)},
            'spans', if(t.learned, concat(a.spans, array(named_struct('start', a.at + length(t.header), 'length', length(t.esc)))), a.spans))).spans,
        x -> x.length > 0)""")
    return (windows.withColumn("all_turns", all_turns).withColumn("shown", shown)
            .select("conv_id", "ck", "window",
                    F.array_join(F.transform("shown", lambda t: F.concat(t["header"], t["esc"], F.lit(TURN_END))), "").alias("formatted"),
                    F.size("shown").alias("n_turns"), F.size(F.filter("shown", lambda t: t["repeated"])).alias("n_repeated"),
                    spans.alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """array of (role, text), read back from a formatted window."""
    pieces = F.filter(F.split(formatted, TURN_END), lambda p: F.length(p) > 0)
    return F.transform(pieces, lambda p: F.struct(
        F.url_decode(F.substring_index(F.substr(p, F.lit(5)), ":\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit(":\n")) + 2)).alias("text")))


def odd_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the template's own control strings."""
    said = "\\### Assistant: </turn> ok"
    return spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit(said).alias("text")),
        F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit(said).alias("text")))).alias("t")
    ).select("conv_id", "t.*")


def conversation_report(windows: DataFrame) -> DataFrame:
    """Per conversation, what its windows hold when read back: turns without
    repeats, the text under the loss mask, characters written. A digest of a
    whole conversation needs the conversation in one row."""
    read = windows.select(
        "conv_id", "ck", "window", F.length("formatted").alias("chars"),
        F.expr("slice(turns, n_repeated + 1, n_turns)").alias("turns"),
        F.array_join(F.transform("loss_spans", lambda x: unescape(F.substr(F.col("formatted"), x["start"] + 1, x["length"]))), "").alias("loss")
    ) if "turns" in windows.columns else None
    if read is None:
        return conversation_report(windows.withColumn("turns", read_turns(F.col("formatted"))))
    whole = read.groupBy("ck").agg(F.min("conv_id").alias("conv_id"), F.sum("chars").alias("formatted_chars"),
                                   F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts"))
    turns = F.flatten(F.transform("parts", lambda p: p["turns"]))
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long"))
