"""Small helpers shared by the operators: checkpoints, id bitmaps, id filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import cut_lineage, ensure_checkpoint_dir  # noqa: F401
from mercato.sources.tables import read_table  # noqa: F401

#: Bits of an id bitmap: a fixed 512 KiB, whatever the number of ids. More ids
#: only let more rows through to the exact join that always follows.
BITMAP_BITS = 1 << 22


def id_bit(col) -> F.Column:
    """Bit of an id in a bitmap (null has one too)."""
    return F.pmod(F.xxhash64(col), F.lit(BITMAP_BITS)).cast("int")


def bitmap(ids: DataFrame, col: str) -> np.ndarray:
    """The bits of all ids as a boolean array (aggregated on Spark; at most
    BITMAP_BITS / 64 rows of one long reach the driver)."""
    bit = id_bit(F.col(col))
    words = (ids.select(bit.alias("_bit"))
             .groupBy(F.shiftright("_bit", 6).alias("_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, _bit & 63)")).alias("_bits")).collect())
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for r in words:
        out[r["_word"]] = r["_bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def with_row_key(rows: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """rows with a further column, a 64-bit hash of id and text, and its name: only rows equal in both share it."""
    name = "_row_key"
    while name in rows.columns:
        name += "_"
    return rows.withColumn(name, F.xxhash64(column(rows, id_col).cast("long"), column(rows, text_col).isNull(), column(rows, text_col))), name


def drop_ids(rows: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose key is not among the ids (null equals null), every column kept."""
    others, hit = _split(rows, key, ids, id_col, "left_anti")
    return others.union(hit)


def one_of_each(rows: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """One row of each key among the ids, and all rows of other keys, every column kept."""
    others, hit = _split(rows, key, ids, id_col, "left_anti")
    return others.union(hit).union(_split(rows, key, ids, id_col, "left_semi")[1].dropDuplicates([key]))


def _split(rows: DataFrame, key: str, ids: DataFrame, id_col: str, how: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key misses the ids' bitmap; the others joined with the ids.

    Only rows whose key hits the bitmap go through the shuffled join, so texts
    of the others are not shuffled. The bitmap is a table of fixed size and is
    broadcast."""
    names = rows.columns
    rows = rows.toDF(*[f"c{i}" for i in range(len(names))])           # no name of the caller's can clash
    key = f"c{names.index(key)}"
    bits = ids.select(id_bit(F.col(id_col)).alias("_bit"))
    words = (bits.groupBy(F.shiftright("_bit", 6).alias("_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, _bit & 63)")).alias("_bits")))
    probe = (rows.withColumn("_b", id_bit(F.col(key)))
             .join(F.broadcast(words), F.shiftright(F.col("_b"), 6) == F.col("_word"), "left")
             .withColumn("_hit", F.expr("coalesce((shiftrightunsigned(_bits, _b & 63) & 1L) = 1L, false)")))
    keep = probe.filter(~F.col("_hit")).select(*rows.columns)
    wanted = ids.select(F.col(id_col).alias("_drop_id"))
    check = probe.filter("_hit").select(*rows.columns)
    left = check.join(wanted, check[key].eqNullSafe(wanted["_drop_id"]), how)
    return keep.toDF(*names), left.toDF(*names)


def column(df: DataFrame, name: str) -> F.Column:
    """A column by its exact name, quoted."""
    return F.col("`" + name.replace("`", "``") + "`")
