"""Incremental loading: upsert by key, quarantine of failing rows, and a
Structured Streaming ingest that quarantines per micro-batch.

* ``latest_per_key`` keeps the newest row per id with an aggregate
  (``max`` of a struct led by the ordering columns), not a window: the
  aggregate combines map-side, so an id that holds a third of all rows
  ships one partial row per task instead of landing whole in one task.
  Ids are counted first, by their hashes alone; only rows whose id may
  repeat go through the aggregate, the others are not shuffled.
* ``upsert`` = target rows whose id is not in the batch (``left_anti``
  against the batch's distinct ids) plus the newest batch row per id.
* ``upsert_table`` does the same to a stored, partitioned table and rewrites
  only the partitions it touches.
* ``quarantine`` flags rows failing the row-level checks; valid rows go to
  the fact, the rest to a quarantine table with the failed check ids.
* ``stream_ingest`` reads new CSV files with ``readStream`` and, per
  micro-batch (``foreachBatch``), quarantines and writes to
  ``year/month/load_batch`` partitions. The checkpoint location makes it
  restartable; the batch write is idempotent, so a micro-batch replayed
  after a failure between its write and its commit replaces its own
  partitions instead of appending its rows a second time (exactly once per
  file, not at least once).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas as S
from mercato.operators import quality as Q
from mercato.operators.key_filter import split_repeated
from mercato.session import cut_lineage


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Newest row per key; ties on ``order`` are broken by all other columns,
    so the choice is deterministic. Rows without a key cannot replace each
    other: all of them are kept."""
    single, best = newest_apart(df, key, order)
    return best.unionByName(single)


def newest_apart(df: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``latest_per_key`` in two parts: rows that lie where they lay, and those shuffled by key."""
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    single, some = split_repeated(df, key)
    best = some.groupBy(key).agg(F.max(packed).alias("_best"))
    return single, best.select(key, *[F.col("_best").getField(c).alias(c) for c in order + rest]).select(*df.columns)


def upsert(target: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    # distinct ids first (map-side combined): a hot id becomes one row, so the
    # anti join's build side is unique and AQE may split skewed target partitions
    touched = batch.select(key).distinct()
    kept = target.join(touched, key, "left_anti")
    return kept.unionByName(latest_per_key(batch, key, order))


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: str, order: list[str],
                 partition_by: list[str]) -> dict:
    """Upserts ``batch`` into the partitioned Parquet table at ``path``, rewriting only the partitions
    that hold a row of the batch or a stored row that the batch replaces. Readers may see it half done; ``sources.loads`` has
    the upsert that they see whole, with a ledger.

    A replay after a failure gives the same table, but for rows without an id: those are inserts. A partition that the batch empties (its rows moved to
    another one) is overwritten with an empty file. The driver sees partition values only."""
    batch = cut_lineage(latest_per_key(batch, key, order))
    stored = spark.read.parquet(path)
    ids = batch.select(key).distinct()
    old = stored.select(key, *partition_by).join(ids, key, "left_semi").select(*partition_by).distinct()
    touched = cut_lineage(batch.select(*partition_by).union(old).distinct())
    parts = [tuple(r) for r in touched.collect()]
    if not parts:
        return {"touched": 0, "emptied": 0}
    # a table of partitions, however many: joined on plain values it prunes the scan, null values are read apart
    some_null = F.lit(False)
    for name in partition_by:
        some_null |= F.col(name).isNull()
    inside = stored.join(touched.filter(~some_null), partition_by, "left_semi").select(*stored.columns)
    same, side = F.lit(True), touched.filter(some_null).select(*[F.col(c).alias(f"_p_{c}") for c in partition_by])
    for name in partition_by:
        same &= F.col(name).eqNullSafe(F.col(f"_p_{name}"))
    nulls = stored.filter(some_null).join(side, same, "left_semi").select(*stored.columns)
    kept = inside.unionByName(nulls).join(ids, key, "left_anti").select(*batch.columns)
    merged = cut_lineage(kept.unionByName(batch))             # fixed before its own source is overwritten
    (merged.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    filled = {tuple(r) for r in merged.select(*partition_by).distinct().collect()}
    emptied = [p for p in parts if p not in filled]
    for values in emptied:
        folder = "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in zip(partition_by, values))
        merged.drop(*partition_by).limit(0).write.mode("overwrite").parquet(f"{path}/{folder}")
    return {"touched": len(parts), "emptied": len(emptied)}


def row_violations(columns: list[str], cfg: S.CheckConfig | None = None) -> dict[str, Column]:
    """The HIGH row-level quality checks that apply to a frame with these columns: id -> violation.

    The checks themselves are those of :mod:`mercato.operators.quality`. A raw row has no keys yet;
    its date decides K2 (a NULL store, product or customer value gets a key of its own)."""
    cfg = cfg or S.CheckConfig()
    out = {}
    for c in Q.default_checks(cfg):
        if c.table != "fact" or c.severity != "HIGH":
            continue
        if c.kind == "not_null":
            name = "date" if c.columns[0] == "date_key" and "date_key" not in columns else c.columns[0]
            if name in columns:
                out[c.check_id] = F.col(name).isNull()
        elif c.kind == "predicate":
            out[c.check_id] = c.violation(cfg)
    # a value that did not cast, or a record whose fields do not match the header
    for name, tag in (("_bad_columns", "BAD_VALUE"), ("_corrupt_record", "BAD_RECORD")):
        if name in columns:
            out[tag] = F.coalesce(F.col(name), F.lit("")) != ""
    return out


def quarantine(df: DataFrame, cfg: S.CheckConfig | None = None) -> DataFrame:
    """Adds ``failed_checks`` (comma list, '' when clean) and ``quarantined``."""
    checks = row_violations(df.columns, cfg)
    tags = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(cid)) for cid, cond in checks.items()])
    failed = F.array_join(F.filter(tags, lambda x: x.isNotNull()), ",")
    return df.withColumn("failed_checks", failed).withColumn(
        "quarantined", (F.col("failed_checks") != "").cast("int"))


def split_valid(df: DataFrame, cfg: S.CheckConfig | None = None) -> tuple[DataFrame, DataFrame]:
    q = quarantine(df, cfg)
    return (q.filter(F.col("quarantined") == 0).drop("failed_checks", "quarantined"),
            q.filter(F.col("quarantined") == 1))


def _tag(rows: DataFrame, failed: Column, check_id: str) -> DataFrame:
    """Adds a check id to the failed checks where `failed` holds."""
    tags = F.when(failed, F.concat_ws(",", F.nullif(F.col("failed_checks"), F.lit("")), F.lit(check_id))).otherwise(F.col("failed_checks"))
    return rows.withColumn("failed_checks", tags).withColumn("quarantined", (F.col("failed_checks") != "").cast("int"))


def tag_repeats(rows: DataFrame, stored: DataFrame | None, key: str = "transaction_id") -> DataFrame:
    """Tags K9 on valid rows whose id an earlier row has: in `stored` (a table of ids), or in these rows (one row of an id stays valid).

    Both sides are narrow: ids are counted first, and a row number is chosen per id by an aggregate."""
    rows = cut_lineage(rows.withColumn("_rid", F.monotonically_increasing_id()))
    valid = rows.filter(F.col("quarantined") == 0).filter(F.col(key).isNotNull())
    first = valid.groupBy(key).agg(F.min("_rid").alias("_rid"))
    if stored is not None:
        first = first.join(stored.select(key).distinct(), key, "left_anti")
    rows = rows.join(first.select("_rid", F.lit(True).alias("_first")), "_rid", "left")
    return _tag(rows, (F.col("quarantined") == 0) & F.col(key).isNotNull() & F.col("_first").isNull(), "K9").drop("_rid", "_first")


def tag_unknown(rows: DataFrame, members: DataFrame, columns: list[str], check_id: str) -> DataFrame:
    """Tags rows whose natural key (NULL equals NULL) is not among the members: distinct values are joined, then the rows flagged."""
    known = members.select(*[F.col(c).alias(f"_m_{c}") for c in columns], F.lit(True).alias("_known")).distinct()
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    return _tag(rows.join(known, cond, "left"), F.col("_known").isNull(), check_id).drop("_known", *[f"_m_{c}" for c in columns])


def _stored_ids(spark: SparkSession, fact_dir: str, epoch: int) -> DataFrame | None:
    """Ids that other micro-batches stored (a replayed batch is not held against itself)."""
    try:
        return spark.read.parquet(fact_dir).filter(F.col("load_batch") != epoch).select("transaction_id")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def batch_writer(fact_dir: str, quarantine_dir: str, cfg: S.CheckConfig | None = None, members: dict[str, tuple[DataFrame, list[str]]] | None = None):
    """The ``foreachBatch`` function of :func:`stream_ingest`. Rows carry
    their micro-batch id as ``load_batch`` and are written with dynamic
    partition overwrite: a replay of batch N (same files, by the stream's
    offset log) rewrites exactly the partitions batch N wrote.

    An id that an earlier micro-batch stored, or that repeats in this one,
    goes to the quarantine (K9). ``members``: check id -> (members, natural
    key columns); rows that refer to none of them go there too."""
    def write_batch(batch: DataFrame, epoch: int) -> None:
        marked = quarantine(batch, cfg)
        for check_id, (known, columns) in (members or {}).items():
            marked = tag_unknown(marked, known, columns, check_id)
        if "transaction_id" in batch.columns:
            marked = tag_repeats(marked, _stored_ids(batch.sparkSession, fact_dir, epoch))
        # written once, so that the files are parsed once for both sides
        checked = cut_lineage(marked.withColumn("load_batch", F.lit(epoch).cast("long")))
        # rows with a bad value or record are all in the quarantine, with their flags
        good = checked.filter(F.col("quarantined") == 0).drop("failed_checks", "quarantined", "_bad_columns", "_corrupt_record")
        (good.withColumn("year", F.year("date")).withColumn("month", F.month("date"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("year", "month", "load_batch").parquet(fact_dir))
        (checked.filter(F.col("quarantined") == 1)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("load_batch").parquet(quarantine_dir))
    return write_batch


def stream_ingest(spark, source_dir: str, fact_dir: str, quarantine_dir: str, checkpoint_dir: str,
                  columns: list[str] | None = None, schema=S.RAW_SCHEMA, cfg: S.CheckConfig | None = None,
                  trigger_once: bool = True, members: dict[str, tuple[DataFrame, list[str]]] | None = None):
    """File-stream ingest: every new CSV file batch is typed (by header name),
    checked, valid rows are appended to year/month partitions and failing rows
    to the quarantine. ``columns`` is the CSV header; by default it is read
    from the files already present."""
    from mercato.sources.csv_ingest import CORRUPT, csv_header, text_schema, typed_from_text

    header = columns or csv_header(spark, source_dir)
    text = (spark.readStream.schema(text_schema(header + [CORRUPT])).option("header", True)
            .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(source_dir))
    typed = typed_from_text(text, schema)
    write_batch = batch_writer(fact_dir, quarantine_dir, cfg, members)
    writer = typed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()
