"""Training-corpus pipeline: five stages over documents, each written as Parquet
and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontam, near_dedup, packing, quality, secret_scan, vocab
from mercato.llm.queries import TOKENIZER
from mercato.llm.tables import ensure_checkpoint_dir, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets inside the texts are masked."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all that is left, packed into windows."""
    return packing.piece_report(packing.pack(docs, vocab.default_path(TOKENIZER)), "ids")


STAGES = [("quality rules", quality_rules), ("near dedup", minhash_dedup), ("decontamination", benchmark_decontamination),
          ("secret scans", secret_scans), ("packing", packed)]

#: Fitted models and sketches are not expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, through written tables in the cluster's shared folder."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/stage-{i + 1}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
