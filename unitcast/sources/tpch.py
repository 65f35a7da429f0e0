"""Adapter from the star-schema test tables to the sales data model.

No sales CSVs ship with the test data, so the daily sales fact and its
dimensions are derived from ``lineitem``, ``supplier``, ``nation`` and
``part``.  The mapping (fixed, mirrored by the oracle SQL):

* date            = ship date
* date_block_num  = (year - 1995) * 12 + month - 1
* shop_id         = l_suppkey            (grain A, C) / s_nationkey (grain B)
* item_id         = l_partkey            (grain A) / category code (grain B, C)
* item_price      = l_extendedprice / l_quantity
* item_cnt_day    = l_quantity, negated for returned lines (flag 'R')
* shop_name       = n_name || ' ' || s_name   (first token = "city")
* item_name       = p_name
* item_category_name = p_type || ' - ' || p_brand, id = rank in binary order

Dimension joins are left to the planner: file statistics let Spark
broadcast the small ones and AQE re-plans from the real shuffle sizes, so a
dimension that grows with the data is never forced into a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast import config
from unitcast.operators.ids import consecutive_ids

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


_MEMO: dict = {}


def fingerprint(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """What tells one content of tables from another: path, files, bytes and
    latest change of each.  Results kept per session are keyed by it, so a
    table rewritten at the same path is not answered from the old one."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in names:
        at = hadoop.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        found = at.getFileSystem(conf).listStatus(at)
        out.append((str(at), len(found), sum(f.getLen() for f in found), max((f.getModificationTime() for f in found), default=0)))
    return tuple(out)


#: Tables that the sales model is derived from.
MODEL_TABLES = ("lineitem", "supplier", "nation", "part")


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Derived dimension tables are materialised once per session and content
    (small, reused by most queries; stored in the shared checkpoint folder).
    ``key``: name, folder and parameters."""
    from unitcast.operators.joins import materialize
    k = (spark.sparkContext.applicationId, config.ensure_checkpoint_dir(spark), fingerprint(spark, key[1], *MODEL_TABLES)) + key
    if k not in _MEMO:
        _MEMO[k] = materialize(build())
    return _MEMO[k]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def month_index(ts) -> F.Column:
    """Month number counted from January of ``config.BASE_YEAR``."""
    return ((F.year(ts) - config.BASE_YEAR) * 12 + F.month(ts) - 1).cast("int")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales fact at grain A (shop = supplier, item = part)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        month_index(F.col("l_shipdate")).alias("date_block_num"),
        F.col("l_suppkey").alias("shop_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("item_price"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
         .otherwise(F.col("l_quantity")).alias("item_cnt_day"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
    )


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey, "left")
            .select(F.col("s_suppkey").alias("shop_id"),
                    F.concat_ws(" ", "n_name", "s_name").alias("shop_name")))


def _category_name() -> F.Column:
    return F.concat(F.col("p_type"), F.lit(" - "), F.col("p_brand"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_category_id, item_category_name); ids in binary name order."""
    def build():
        names = (table(spark, sf_dir, "part")
                 .select(_category_name().alias("item_category_name")).distinct())
        return consecutive_ids(names, ["item_category_name"], "item_category_id")
    return _memo(spark, ("categories", sf_dir), build)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", _category_name().alias("item_category_name"))
    return (part.join(categories(spark, sf_dir), "item_category_name", "left")
            .select(F.col("p_partkey").alias("item_id"),
                    F.col("p_name").alias("item_name"),
                    "item_category_id"))


def sales_grain(spark: SparkSession, sf_dir: str, grain: str = "A") -> DataFrame:
    """Sales fact at grain A, B or C (see SURVEY §7.2)."""
    s = sales(spark, sf_dir)
    if grain == "A":
        return s
    it = items(spark, sf_dir).select(F.col("item_id").alias("_part"),
                                     F.col("item_category_id").alias("_cat"))
    s = s.join(it, s.item_id == it._part, "inner").withColumn("item_id", F.col("_cat"))
    if grain == "B":
        sup = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("_supp"),
            F.col("s_nationkey").cast("bigint").alias("_nation"))
        s = s.join(sup, s.shop_id == sup._supp, "inner").withColumn("shop_id", F.col("_nation"))
    elif grain != "C":
        raise ValueError(f"unknown grain {grain!r}")
    return s.select("date", "date_block_num", "shop_id", "item_id", "item_price",
                    "item_cnt_day", "order_key", "line_no")


def shops_grain(spark: SparkSession, sf_dir: str, grain: str = "A") -> DataFrame:
    if grain == "B":
        nat = table(spark, sf_dir, "nation")
        return nat.select(F.col("n_nationkey").cast("bigint").alias("shop_id"),
                          F.col("n_name").alias("shop_name"))
    return shops(spark, sf_dir)


def items_grain(spark: SparkSession, sf_dir: str, grain: str = "A") -> DataFrame:
    if grain == "A":
        return items(spark, sf_dir)
    c = categories(spark, sf_dir)
    return c.select(F.col("item_category_id").alias("item_id"),
                    F.col("item_category_name").alias("item_name"),
                    "item_category_id")


def request(spark: SparkSession, sf_dir: str, grain: str = "A",
            first_month: int = config.HOLDOUT_MONTH - 11,
            last_month: int = config.TARGET_MONTH) -> DataFrame:
    """Stand-in for the request table: pairs sold in months first..last.

    Pairs first sold in the (partial) target month are cold starts.
    ``ID`` numbers the pairs 0..n-1 in (shop_id, item_id) order.
    """
    def build():
        s = sales_grain(spark, sf_dir, grain)
        pairs = (s.filter(F.col("date_block_num").between(first_month, last_month))
                 .select("shop_id", "item_id").distinct())
        return consecutive_ids(pairs, ["shop_id", "item_id"], "ID").select("ID", "shop_id", "item_id")
    return _memo(spark, ("request", sf_dir, grain, first_month, last_month), build)
