"""CSV ingest with a fixed schema.

``read_csv`` in the source pipeline infers types and turns common null
words into NaN. Here the schema is fixed: columns are read as text under
the file's own header, the same null words become NULL, values are cast to
the fixed types, and a value that does not cast is NULL with its column
named in ``_bad_columns`` (the row is kept). A number with more places than
its type is rounded and its column named in ``_rounded_columns``. A record
with more or fewer fields than the header is kept whole, as text, in
``_corrupt_record``. A missing file raises Spark's PATH_NOT_FOUND as is.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato import schemas as S

# Strings pandas read_csv treats as missing by default.
NULL_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


CORRUPT = "_corrupt_record"
FLAGS = ["_bad_columns", "_rounded_columns", CORRUPT]
#: Wide enough to hold a number of any column with all its places.
_EXACT = "decimal(38,18)"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (reads the first line only)."""
    return spark.read.option("header", True).csv(path).columns


def typed_from_text(text: DataFrame, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Text columns (by header name) -> the fixed schema.

    Null words become NULL; a value that does not cast becomes NULL and its
    column is listed in ``_bad_columns``; a number that its type rounds is
    listed in ``_rounded_columns``; schema columns absent from the file
    arrive as NULL; extra file columns are kept after the schema columns."""
    header = [c for c in text.columns if c != CORRUPT]
    record = [F.col(CORRUPT)] if CORRUPT in text.columns else []
    cleaned = text.select(*[F.when(F.trim(F.col(c)).isin(NULL_WORDS), F.lit(None)).otherwise(F.col(c)).alias(c)
                            for c in header], *record)
    out_cols, bad, rounded = [], [], []
    for f in schema.fields:
        if f.name not in header:
            out_cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType):
            # flags may be written as 0/1 or True/False
            src = F.when(F.lower(src) == "true", F.lit("1")).when(F.lower(src) == "false", F.lit("0")).otherwise(src)
        typed = src.try_cast(f.dataType)
        out_cols.append(typed.alias(f.name))
        bad.append(F.when(src.isNotNull() & typed.isNull(), F.lit(f.name)))
        if isinstance(f.dataType, T.DecimalType):
            rounded.append(F.when(src.try_cast(_EXACT) != typed, F.lit(f.name)))
    extras = [F.col(c) for c in header if c not in schema.fieldNames()]
    return cleaned.select(*out_cols, *extras, _listed(bad).alias("_bad_columns"),
                          _listed(rounded).alias("_rounded_columns"), *record)


def _listed(names: list) -> F.Column:
    return F.array_join(F.array_compact(F.array(*names)), ",") if names else F.lit("")


def read_transactions_csv(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA,
                          keep_flags: bool = True) -> DataFrame:
    """CSV -> fixed schema. Columns are matched by header name, not position.
    Every file of a folder is checked against the header (``enforceSchema`` is
    off): files whose headers differ stop the read, they are never misaligned."""
    header = csv_header(spark, path)
    text = (spark.read.schema(text_schema(header + [CORRUPT])).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(path))
    df = typed_from_text(text, schema)
    return df if keep_flags else df.drop(*FLAGS)


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Column names -> files that begin with them, read by tasks; one row per different header, with its file names, reaches the driver.

    The first line of a file is the first row of its first split. Files without a line are left out."""
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
             .withColumn("place", F.monotonically_increasing_id()).filter("start = 0"))
    found = lines.groupBy("file").agg(F.min_by("value", "place").alias("line")).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for r in found:
        names = tuple(next(csv.reader([r["line"].lstrip("\ufeff").rstrip("\r")])))
        out.setdefault(names, []).extend(r["files"])
    return out


def read_transactions_folder(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA, keep_flags: bool = True) -> DataFrame:
    """CSV files whose headers may differ in order and columns -> the fixed schema, united by column name.

    Files are grouped by header and each group is read under its own; a column that a group lacks is NULL in its rows, and
    extra columns are kept. Flags are those of ``read_transactions_csv``."""
    groups = headers(spark, path)
    if not groups:
        return read_transactions_csv(spark, path, schema, keep_flags)
    out = None
    for names, files in sorted(groups.items()):
        text = (spark.read.schema(text_schema([*names, CORRUPT])).option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(files))
        part = typed_from_text(text, schema)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if keep_flags else out.drop(*FLAGS)


def missing_in_header(spark: SparkSession, path: str, required: list[str] = S.REQUIRED_COLUMNS) -> list[str]:
    """Required columns that the files themselves lack (the typed frame has them as NULL)."""
    found = list(headers(spark, path)) or [tuple(csv_header(spark, path))]
    return [c for c in required if any(c not in names for names in found)]


def conformance(df: DataFrame, schema: T.StructType = S.RAW_SCHEMA,
                required: list[str] = S.REQUIRED_COLUMNS) -> dict:
    """Required columns present and types equal to the fixed schema."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return {
        "missing_required": [c for c in required if c not in have],
        "type_mismatch": [f.name for f in schema.fields if f.name in have and have[f.name] != f.dataType],
        "unknown_columns": [c for c in have if c not in schema.fieldNames() and not c.startswith("_")],
    }
