"""File sources and sinks: A1-A8.

CSV reads take an explicit schema (no inference pass over the data);
everything written goes to paths the caller passes, normally under the
shared folder named by ``spark.checkpoint.dir`` (see ``config.scratch_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from unitcast.functions.columns import parse_day_first
from unitcast.sources import csvscan

SALES_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("date_block_num", T.IntegerType()),
    T.StructField("shop_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("item_price", T.DoubleType()),
    T.StructField("item_cnt_day", T.DoubleType()),
])
REQUEST_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("shop_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
])


def read_sales(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = SALES_SCHEMA,
               date_format: str = "dd.MM.yyyy", rows_read: int | None = None,
               order: list[str] | None = None) -> DataFrame:
    """A1-A3: daily sales with a day-first date parsed to DateType.

    ``rows_read`` keeps the first n rows (A3; None = all rows): of CSV files in
    file order, reading only the files that the limit needs; with ``order``,
    or of a format without an order of its own, in that order.
    """
    if fmt == "csv" and rows_read is not None and order is None:
        types = {f.name: "date" if f.name == "date" else f.dataType.simpleString() for f in schema.fields}
        return csvscan.typed(csvscan.first_records(spark, path, rows_read), types, date_format).select(*types)
    if fmt == "csv":
        df = spark.read.schema(schema).csv(path, header=True)
    else:
        df = spark.read.format(fmt).load(path)
    if "date" in df.columns and isinstance(df.schema["date"].dataType, T.StringType):
        df = df.withColumn("date", parse_day_first("date", date_format))
    if rows_read is not None:
        df = df.orderBy(*(order or ["date", "date_block_num", "shop_id", "item_id"])).limit(rows_read)
    return df


def read_sales_checked(spark: SparkSession, path: str, rejects: str, schema: T.StructType = SALES_SCHEMA,
                       date_format: str = "dd.MM.yyyy") -> DataFrame:
    """A1: accepted sales rows; malformed ones go to a table at ``rejects``
    (file, record, reason) instead of turning into nulls."""
    types = {f.name: "date" if f.name == "date" else f.dataType.simpleString() for f in schema.fields}
    accepted, bad = csvscan.read_checked(spark, path, types, date_format)
    bad.write.mode("overwrite").parquet(rejects)
    return accepted


def read_dim(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.format(fmt).load(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "ID",
                      value_col: str = "item_cnt_month") -> None:
    """A4/A5: (ID, value) CSV with header; ID is carried through the plan
    rather than taken from row position."""
    (df.select(F.col(id_col).alias("ID"), F.col(value_col).alias("item_cnt_month"))
       .write.mode("overwrite").csv(path, header=True))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("item_cnt_month", T.DoubleType())])
    return spark.read.schema(schema).csv(path, header=True)


def save_features(df: DataFrame, path: str, partition_by: str = "date_block_num",
                  cluster_by: tuple = ("shop_id", "item_id")) -> None:
    """Feature table as parquet partitioned by month (month filters prune).

    Rows are range-partitioned on (month, cluster keys) first, so each task
    writes a contiguous month range (about one file per task and month
    boundary instead of one per task and month), and a month holding a large
    share of the rows is still split over several tasks by the cluster keys.
    """
    keys = [partition_by] + [c for c in cluster_by if c in df.columns]
    (df.repartitionByRange(*keys).write.mode("overwrite")
       .partitionBy(partition_by).parquet(path))


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}-manifest"


def months_appended(spark: SparkSession, path: str) -> DataFrame | None:
    """(date_block_num, rows, digest) of the months that ``append_month`` wrote; None before the first."""
    try:
        return spark.read.schema("rows long, digest decimal(38,0), date_block_num int").parquet(_manifest(path))
    except AnalysisException:
        return None


def append_month(df: DataFrame, path: str, month: int, partition_by: str = "date_block_num",
                 cluster_by: tuple = ("shop_id", "item_id")) -> bool:
    """Write one month of the feature table, touching only its partition.

    The manifest records rows and content digest (a sum of row hashes, so row
    order does not matter) once the partition is written: a retry after a
    failure writes the partition again, a repeated append of the same rows
    writes nothing, other rows for the month replace its partition.  Returns
    whether anything was written."""
    spark, keys = df.sparkSession, [c for c in cluster_by if c in df.columns]
    columns = sorted(df.columns)
    found = df.agg(F.min(partition_by).alias("lo"), F.max(partition_by).alias("hi"), F.count(F.lit(1)).alias("rows"),
                   F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("digest"))
    found = found.first()
    if found["rows"] and (found["lo"], found["hi"]) != (month, month):
        raise ValueError(f"rows of months {found['lo']} to {found['hi']}, expected {month} only")
    if not found["rows"]:
        return False
    known = months_appended(spark, path)
    if known is not None and known.filter((F.col("date_block_num") == month) & (F.col("rows") == found["rows"])
                                          & (F.col("digest") == F.lit(found["digest"]))).count():
        return False
    out = df.repartitionByRange(*keys) if keys else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    (df.limit(0).agg(F.lit(found["rows"]).cast("long").alias("rows"), F.lit(found["digest"]).cast("decimal(38,0)").alias("digest"),
                     F.lit(month).cast("int").alias("date_block_num"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_block_num").parquet(_manifest(path)))
    return True


def load_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """Spark ML writer."""
    model.write().overwrite().save(path)


def save_predictions(df: DataFrame, path: str, split: str) -> None:
    """(split, keys, prediction) rows for later ensembling.  Saving a
    split again replaces it; other splits stay."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/split={split}")


def save_model_predictions(df: DataFrame, path: str, split: str, model: str) -> None:
    """(split, model, keys, prediction) rows to blend later.  Saving a
    model's split again replaces it; other models and splits stay."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/split={split}/model={model}")


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The prediction store; filters on split and model prune folders."""
    return spark.read.parquet(path)


# File names and column types of the original input tables.
CSV_TABLES = {
    "sales": ("sales_train.csv", {"date": "string", "date_block_num": "int", "shop_id": "bigint",
                                  "item_id": "bigint", "item_price": "double", "item_cnt_day": "double"}),
    "request": ("test.csv", {"ID": "bigint", "shop_id": "bigint", "item_id": "bigint"}),
    "items": ("items.csv", {"item_id": "bigint", "item_name": "string", "item_category_id": "bigint"}),
    "categories": ("item_categories.csv", {"item_category_id": "bigint", "item_category_name": "string"}),
    "shops": ("shops.csv", {"shop_id": "bigint", "shop_name": "string"}),
}


def read_csv_tables(spark: SparkSession, data_dir: str, date_format: str = "dd.MM.yyyy", rows_read: int | None = None,
                    rejects: str | None = None) -> dict:
    """A1-A3: the five input CSVs as sales-model frames.  ``rows_read`` limits
    the sales to the file's first rows; with ``rejects`` (a folder) malformed
    rows of a table are left out and listed in its sub-folder.

    Columns are read as text under their header names and cast by name, so
    the column order inside a file does not matter and no inference pass is
    made over the data; the sales date is parsed day-first.
    """
    out = {}
    for key, (name, types) in CSV_TABLES.items():
        at = f"{data_dir.rstrip('/')}/{name}"
        if key == "sales" and rows_read is not None or rejects:
            kinds = {c: "date" if c == "date" else t for c, t in types.items()}
            limited = key == "sales" and rows_read is not None
            rows = csvscan.numbered(csvscan.scan(spark, csvscan.listed(spark, at))) if not limited else csvscan.first_records(spark, at, rows_read)
            rows = csvscan.typed(rows, kinds, date_format)
            if rejects:
                (rows.filter(F.col(csvscan.REASON).isNotNull())
                 .select(F.col(csvscan.FILE).alias("file"), F.col(csvscan.RECORD).alias("record"), F.col(csvscan.REASON).alias("reason"))
                 .write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/{key}"))
                rows = rows.filter(F.col(csvscan.REASON).isNull())
            out[key] = rows.select(*types)
            continue
        raw = spark.read.csv(at, header=True)
        df = raw.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
        if key == "sales":
            df = df.withColumn("date", parse_day_first("date", date_format))
        out[key] = df
    return out
