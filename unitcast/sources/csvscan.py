"""CSV scans that know where a row stands: first rows in file order (A3) and
rejected rows with file and record number (A1).

Columns are read as text under the header's names and cast by name.  A row is
rejected if its line has too few or too many fields, or if a filled cell has
no value in its column's type.  Positions come from the scan itself: within a
split, rows get ascending ids as they are read, and a split's first position
is the number of rows in the file's splits before it (one small row per
split).  The scanned rows are stored once, so positions and rows cannot drift
apart when a task is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitcast.operators.joins import materialize

CORRUPT, FILE, BLOCK, SEQUENCE, RECORD, REASON = "_corrupt", "_file", "_block", "_sequence", "_record", "_reason"


def listed(spark: SparkSession, path: str) -> list[str]:
    """The CSV files of a path in name order (names only, no content is read)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return [r["path"] for r in found.filter("length > 0").orderBy("path").collect()]


def scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All records as text with file, split and reading sequence (stored)."""
    header = spark.read.csv(paths[0], header=True).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    return materialize(raw.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
                                  F.monotonically_increasing_id().alias(SEQUENCE)))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` of a scan with ``_record``: 1, 2, .. within each file."""
    splits = rows.groupBy(FILE, BLOCK).agg(F.min(SEQUENCE).alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select(F.col(FILE).alias("_f"), F.col(BLOCK).alias("_b"), "_first", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    out = rows.join(starts, (F.col(FILE) == F.col("_f")) & (F.col(BLOCK) == F.col("_b")))
    return out.withColumn(RECORD, F.col("_ahead") + F.col(SEQUENCE) - F.col("_first") + 1).drop("_f", "_b", "_first", "_ahead")


def first_records(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` records over all files in name order, as text, with
    ``_file`` and ``_record``.  Files are scanned in doubling groups until
    ``n`` records are there; later files are not read, nothing is sorted."""
    files = listed(spark, path)
    parts, at, size, have = [], 0, 1, 0
    while at < len(files) and (have < n or not parts):
        part = scan(spark, files[at:at + size])
        parts.append(part)
        have, at, size = have + part.count(), at + size, size * 2
    if not parts:
        raise FileNotFoundError(path)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    totals = rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("_n"))      # a row per scanned file
    ahead = F.sum("_n").over(Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col(FILE).alias("_f"), F.coalesce(ahead, F.lit(0)).alias("_offset"))
    out = numbered(rows).join(offsets, F.col(FILE) == F.col("_f"))
    return out.filter(F.col("_offset") + F.col(RECORD) <= n).drop("_f", "_offset")


def typed(rows: DataFrame, types: dict[str, str], date_format: str = "dd.MM.yyyy") -> DataFrame:
    """Cast by name; ``_reason`` says what is wrong with a row (null if nothing).
    ``date`` cells are day-first.  An empty cell is null in any type."""
    checks, values = [], []
    for c, kind in types.items():
        if kind == "date":
            value = F.to_date(F.try_to_timestamp(F.col(f"`{c}`"), F.lit(date_format)))
        else:
            value = F.col(f"`{c}`").try_cast(kind)
        filled = F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "")
        checks.append(F.when(filled & value.isNull(), F.concat(F.lit(f"{c}="), F.col(f"`{c}`"))))
        values.append(value.alias(c))
    kept = [c for c in rows.columns if c in (FILE, BLOCK, SEQUENCE, RECORD)]
    bad = F.nullif(F.concat_ws(", ", *checks), F.lit(""))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit("fields: "), F.col(CORRUPT))).otherwise(bad)
    return rows.select(*values, *kept, reason.alias(REASON))


def read_checked(spark: SparkSession, path: str, types: dict[str, str], date_format: str = "dd.MM.yyyy") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects (file, record, reason)); each record is in
    exactly one of them.  One scan; only rejected rows are numbered."""
    files = listed(spark, path)
    if not files:
        raise FileNotFoundError(path)
    rows = typed(scan(spark, files), types, date_format)
    splits = rows.select(FILE, BLOCK, SEQUENCE, REASON)
    rejects = numbered(splits).filter(F.col(REASON).isNotNull())
    return (rows.filter(F.col(REASON).isNull()).select(*types),
            rejects.select(F.col(FILE).alias("file"), F.col(RECORD).alias("record"), F.col(REASON).alias("reason")))
