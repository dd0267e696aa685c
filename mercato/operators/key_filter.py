"""Rows apart by what a set of keys says about them, without a shuffle of the rows.

The keys' hashes set two bits each of a word of a bitmap, a table of (word, 64 bits)
that holds no more rows than there are keys and no more than ``BITS / 64``, and is
broadcast. A row whose key misses a bit is in none of the keys for certain. The others
may be: an exact join or aggregate has to follow, over these rows alone. More
keys than bits only let more rows through to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.session import cut_lineage

#: Two million words at most, whatever the number of keys.
BITS = 1 << 27
_WORD, _MASK, _AT = "_key_word", "_key_bits", "_key_at"


def _word(h: str) -> Column:
    return F.shiftright(F.pmod(F.col(h), F.lit(BITS)), 6)


def _bits(h: str) -> Column:
    """Two bits of a word, by bits of the hash that did not choose the word."""
    return F.expr(f"shiftleft(1L, cast({h} & 63 AS int)) | shiftleft(1L, cast(shiftrightunsigned({h}, 58) AS int))")


def _words(hashes: DataFrame) -> DataFrame:
    """(word, bits) of a column `_h`."""
    return hashes.groupBy(_word("_h").alias(_WORD)).agg(F.bit_or(_bits("_h")).alias(_MASK))


def _split(rows: DataFrame, key: str, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    probe = rows.withColumn(_AT, F.xxhash64(key))
    probe = (probe.join(F.broadcast(words), _word(_AT) == F.col(_WORD), "left")
             .withColumn("_key_hit", F.col(key).isNotNull() & F.coalesce(F.col(_MASK).bitwiseAND(_bits(_AT)) == _bits(_AT), F.lit(False))))
    return probe.filter(~F.col("_key_hit")).select(*rows.columns), probe.filter("_key_hit").select(*rows.columns)


def split_by_keys(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not among `keys` (a column of that name) for certain, null keys included; and the others."""
    return _split(rows, key, cut_lineage(_words(keys.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_h")))))


def split_repeated(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key no other row has for certain, null keys included; and the others. Hashes alone are shuffled. Where no hash comes twice,
    all rows are the former, and are not read a second time for the others."""
    twice = (rows.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_h"))
             .groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    words = cut_lineage(_words(twice))
    return (rows, rows.filter(F.lit(False))) if words.isEmpty() else _split(rows, key, words)


def without_keys(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is not among `keys`; null keys stay."""
    miss, rest = without_keys_apart(rows, key, keys)
    return miss.unionByName(rest)


def without_keys_apart(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``without_keys`` in two parts: rows that lie where they lay, and those joined by key to be certain."""
    miss, hit = split_by_keys(rows, key, keys)
    return miss, hit.join(keys.select(key), key, "left_anti").select(*rows.columns)
