"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import chat, decontam, hard_negatives, langid, lm_score, near_dedup, packing, quality, repair, secret_scan, sharding, sql, token_count, url_rules, vocab
from mercato.llm.tables import read_table

TOKENIZER = "byte_bpe_50k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_report(packing.pack(read_table(spark, sf_dir, "documents"), vocab.default_path(TOKENIZER)))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read_table(spark, sf_dir, "documents"), vocab.default_path(TOKENIZER))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"), F.lit(False))
    model = langid.train(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(read_table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_report(chat.format_windows(turns.unionByName(chat.odd_conversation(spark))))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def tenth(doc_id: Column, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder modulo 10; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 10 == remainder


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(read_table(spark, sf_dir, "documents"), tenth(F.col("doc_id"), 0), vocab.default_path(TOKENIZER))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return repair.conversation_report(turns, repair.damage(turns))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(rows.withColumn("label", hard_negatives.shifted_label()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_near_dedup, op3_url_filter, op4_quality_rules, op5_token_counts, op6_language_id,
                            op7_secret_scan, op8_sharding, op9_chat_format, op10_decontamination, op11_lm_score, op12_conversation_repair, op13_hard_negatives)}
ORACLE: dict[str, str] = {"op13_hard_negatives": sql.HARD_NEGATIVES}
