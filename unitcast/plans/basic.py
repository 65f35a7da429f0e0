"""Phase 0-2 queries: load, clean, aggregate, pivot (grain A, whole tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import clip, month_label, rnd
from unitcast.operators import aggregate as agg
from unitcast.operators import clean
from unitcast.operators.panel import previous_month_units
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, exact_mean, median, rnd as srnd, share_sql, sql
from unitcast.sources import tpch

SALES_COLS = "date, date_block_num, shop_id, item_id, item_price, item_cnt_day, order_key, line_no"
MONTHS = list(range(0, TM + 1))

# Query parameters on the test data (prices run ~19 to ~105,000 there).
OUTLIER = dict(price_gt=2000.0, price_lt=50000.0, count_lt=50.0)
BAD_PRICE_LT = 500.0
# Duplicate-shop remapping of the reference.
SHOP_REMAP = {0: 57, 1: 58, 10: 11}


def monthly(spark, sf_dir, grain="A"):
    return (agg.monthly_of_pairs if grain == "A" else agg.monthly_sales)(tpch.sales_grain(spark, sf_dir, grain))


@query("load_sales", sql(["sales"], f"SELECT {SALES_COLS} FROM sales"))
def q_load_sales(spark, sf_dir):
    """A1/A2: daily sales fact read from the star schema (adapter, grain A)."""
    return tpch.sales(spark, sf_dir)


@query("monthly_sales", sql(["monthly"], "SELECT * FROM monthly"))
def q_monthly_sales(spark, sf_dir):
    """Units per (month, shop, item) — the minimum slice."""
    return monthly(spark, sf_dir)


@query("clean_outliers", sql(["sales"], f"""SELECT {SALES_COLS} FROM sales
WHERE item_price > {OUTLIER['price_gt']} AND item_price < {OUTLIER['price_lt']}
  AND item_cnt_day < {OUTLIER['count_lt']}"""))
def q_clean_outliers(spark, sf_dir):
    """Price and count range filter (pushed into the parquet scan)."""
    return clean.clean_outliers(tpch.sales(spark, sf_dir), **OUTLIER)


def _median_filter(df):
    return df.filter((F.col("date_block_num") == H) & (F.col("item_price") > 0))


_MED_SRC = f"sales WHERE date_block_num = {H} AND item_price > 0"


@query("median_price", sql(["sales"], f"SELECT {srnd(median(_MED_SRC, 'item_price'), 6)} AS median_price"))
def q_median_price(spark, sf_dir):
    """Exact median under a conjunctive filter."""
    m = clean.exact_median(_median_filter(tpch.sales(spark, sf_dir)), "item_price")
    return spark.range(1).select(rnd(F.lit(m).cast("double"), 6).alias("median_price"))


@query("repair_price", sql(["sales"], f"""SELECT date, date_block_num, shop_id, item_id,
  {srnd(f"CASE WHEN item_price < {BAD_PRICE_LT} THEN {median(_MED_SRC, 'item_price')} ELSE item_price END", 6)}
    AS item_price, item_cnt_day, order_key, line_no FROM sales"""))
def q_repair_price(spark, sf_dir):
    """Prices under the bound replaced by the median."""
    s = tpch.sales(spark, sf_dir)
    m = clean.exact_median(_median_filter(s), "item_price")
    out = clean.repair_price(s, F.col("item_price") < BAD_PRICE_LT, m)
    return out.withColumn("item_price", rnd("item_price", 6))


@query("remap_keys", sql(["sales"], """SELECT date_block_num,
  CASE shop_id WHEN 0 THEN 57 WHEN 1 THEN 58 WHEN 10 THEN 11 ELSE shop_id END AS shop_id,
  item_id, sum(item_cnt_day) AS item_cnt_month FROM sales GROUP BY ALL"""))
def q_remap_keys(spark, sf_dir):
    """Merge duplicate shops, then monthly units."""
    s = clean.remap_keys(tpch.sales(spark, sf_dir), SHOP_REMAP, "shop_id")
    return agg.monthly_sales(s)


@query("clip_target", sql(["monthly"], f"""SELECT date_block_num, shop_id, item_id,
  CASE WHEN item_cnt_month IS NULL THEN NULL
       ELSE least(greatest(item_cnt_month, {config.CLIP_LO}), {config.CLIP_HI}) END AS item_cnt_month
FROM monthly"""))
def q_clip_target(spark, sf_dir):
    """Monthly units clipped to [0, 20], NULL kept."""
    return monthly(spark, sf_dir).withColumn("item_cnt_month", clip("item_cnt_month"))


@query("log_target", sql(["monthly"], f"""SELECT date_block_num, shop_id, item_id,
  {srnd(f"ln(1 + least(greatest(item_cnt_month, {config.CLIP_LO}), {config.CLIP_HI}))", 6)} AS log_cnt
FROM monthly"""))
def q_log_target(spark, sf_dir):
    """log1p of the clipped target."""
    m = monthly(spark, sf_dir).withColumn("item_cnt_month", clip("item_cnt_month"))
    m = clean.log_target(m, "item_cnt_month", "log_cnt")
    return m.select("date_block_num", "shop_id", "item_id", rnd("log_cnt", 6).alias("log_cnt"))


@query("dedupe_keep_first", sql(["sales"], f"""SELECT {SALES_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_key, line_no
     ORDER BY date, item_id, shop_id, item_price, item_cnt_day) AS rn FROM sales) WHERE rn = 1"""))
def q_dedupe_keep_first(spark, sf_dir):
    """One row per (order, line); first by date, item, shop, price, units."""
    return clean.dedupe_keep_first(tpch.sales(spark, sf_dir), ["order_key", "line_no"],
                                   ["date", "item_id", "shop_id", "item_price", "item_cnt_day"])


@query("dedupe_full_row", sql(["sales"], """SELECT DISTINCT date_block_num, shop_id, item_id, item_cnt_day
FROM sales"""))
def q_dedupe_full_row(spark, sf_dir):
    """Exact duplicate rows removed."""
    return tpch.sales(spark, sf_dir).select("date_block_num", "shop_id", "item_id", "item_cnt_day").distinct()


@query("distinct_per_month", sql(["sales"], """SELECT DISTINCT date_block_num, item_id FROM sales"""))
def q_distinct_per_month(spark, sf_dir):
    """Distinct items of each month."""
    return tpch.sales(spark, sf_dir).select("date_block_num", "item_id").distinct()


@query("category_groups", sql(["categories"], """SELECT item_category_id, item_category_name,
  CASE WHEN item_category_id BETWEEN 1 AND 7 THEN 'Access'
       WHEN item_category_id BETWEEN 10 AND 17 THEN 'Consoles'
       WHEN item_category_id BETWEEN 18 AND 24 THEN 'Consoles Games'
       WHEN item_category_id BETWEEN 26 AND 27 THEN 'phone games'
       WHEN item_category_id BETWEEN 28 AND 31 THEN 'CD games'
       WHEN item_category_id BETWEEN 32 AND 36 THEN 'Card'
       WHEN item_category_id BETWEEN 37 AND 42 THEN 'Movie'
       WHEN item_category_id BETWEEN 43 AND 54 THEN 'Books'
       WHEN item_category_id BETWEEN 55 AND 60 THEN 'Music'
       WHEN item_category_id BETWEEN 61 AND 72 THEN 'Gifts'
       WHEN item_category_id BETWEEN 73 AND 78 THEN 'Soft'
       ELSE item_category_name END AS cats
FROM categories"""))
def q_category_groups(spark, sf_dir):
    """Category super-groups by id range."""
    return clean.category_groups(tpch.categories(spark, sf_dir))


@query("revenue_by_month", sql(["sales"], f"""SELECT date_block_num,
  {srnd("CAST(sum(CAST(item_price * item_cnt_day AS DECIMAL(28,10))) AS DOUBLE)", 2)} AS revenue
FROM sales GROUP BY date_block_num"""))
def q_revenue_by_month(spark, sf_dir):
    """revenue = price x units, summed per month."""
    s = tpch.sales(spark, sf_dir).withColumn("revenue", F.col("item_price") * F.col("item_cnt_day"))
    total = F.sum(F.col("revenue").cast("decimal(28,10)")).cast("double")
    return s.groupBy("date_block_num").agg(rnd(total, 2).alias("revenue"))


@query("months_ago", sql(["monthly"], f"""SELECT date_block_num, shop_id, item_id, item_cnt_month,
  {H} - date_block_num AS months_ago FROM monthly WHERE date_block_num <= {H}"""))
def q_months_ago(spark, sf_dir):
    """Reversed month index relative to the holdout month."""
    m = monthly(spark, sf_dir).filter(F.col("date_block_num") <= H)
    return m.withColumn("months_ago", (F.lit(H) - F.col("date_block_num")).cast("int"))


@query("complete_cases", sql(["monthly"], f"""SELECT m.date_block_num, m.shop_id, m.item_id,
  m.item_cnt_month, p.item_cnt_month AS item_cnt_prev_month
FROM monthly m JOIN (SELECT shop_id, item_id, item_cnt_month FROM monthly WHERE date_block_num = {H}) p
  ON m.shop_id = p.shop_id AND m.item_id = p.item_id"""))
def q_complete_cases(spark, sf_dir):
    """Rows with a NULL (no holdout-month units) dropped."""
    m = monthly(spark, sf_dir)
    prev = previous_month_units(m, H)
    return clean.complete_cases(m.join(prev, ["shop_id", "item_id"], "left")).select(
        "date_block_num", "shop_id", "item_id", "item_cnt_month", "item_cnt_prev_month")


# ---- phase 2: aggregates and pivots ---------------------------------------

@query("monthly_sales_by_label", sql(["sales"], """SELECT strftime(date, '%Y-%m') AS month_label,
  item_id, shop_id, sum(item_cnt_day) AS item_cnt_month FROM sales GROUP BY ALL"""))
def q_monthly_sales_by_label(spark, sf_dir):
    """Units by 'yyyy-MM' label."""
    s = tpch.sales(spark, sf_dir)
    return agg.monthly_sales(s.withColumn("month_label", month_label("date")),
                             keys=("month_label", "item_id", "shop_id"))


@query("monthly_sales_calendar", sql(["sales"], """SELECT date_block_num, shop_id, item_id,
  CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
  sum(item_cnt_day) AS item_cnt_month FROM sales GROUP BY ALL"""))
def q_monthly_sales_calendar(spark, sf_dir):
    """Group by every column but the measure (month and year parts)."""
    s = tpch.sales(spark, sf_dir).select(
        "date_block_num", "shop_id", "item_id", F.month("date").alias("month"),
        F.year("date").alias("year"), "item_cnt_day")
    return agg.sum_all_but(s, "item_cnt_day", "item_cnt_month")


@query("daily_price_grain", sql(["sales"], """SELECT date, date_block_num, shop_id, item_id, item_price,
  sum(item_cnt_day) AS item_cnt_month FROM sales GROUP BY ALL"""))
def q_daily_price_grain(spark, sf_dir):
    """Keys still include date and price, so the grain stays daily."""
    s = tpch.sales(spark, sf_dir).select("date", "date_block_num", "shop_id", "item_id",
                                         "item_price", "item_cnt_day")
    return agg.sum_all_but(s, "item_cnt_day", "item_cnt_month")


@query("shop_item_mean", sql(["monthly"], f"""SELECT shop_id, item_id,
  {srnd("avg(item_cnt_month)", 6)} AS item_cnt_month_mean FROM monthly GROUP BY shop_id, item_id"""))
def q_shop_item_mean(spark, sf_dir):
    """Mean monthly units per pair over observed months."""
    m = agg.mean_by(monthly(spark, sf_dir), ["shop_id", "item_id"], "item_cnt_month", "item_cnt_month_mean")
    return m.withColumn("item_cnt_month_mean", rnd("item_cnt_month_mean", 6))


@query("item_mean_price", sql(["sales"], f"""SELECT item_id, {exact_mean('item_price')} AS item_avg_item_price
FROM sales GROUP BY item_id"""))
def q_item_mean_price(spark, sf_dir):
    """Mean price per item over all rows."""
    return agg.mean_by(tpch.sales(spark, sf_dir), ["item_id"], "item_price", "item_avg_item_price",
                       exact=True)


@query("item_month_mean_price", sql(["sales"], f"""SELECT date_block_num, item_id,
  {exact_mean('item_price')} AS date_item_avg_item_price FROM sales GROUP BY date_block_num, item_id"""))
def q_item_month_mean_price(spark, sf_dir):
    """Mean price per (month, item)."""
    return agg.mean_by(tpch.sales(spark, sf_dir), ["date_block_num", "item_id"], "item_price",
                       "date_item_avg_item_price", exact=True)


def clipped_monthly_sql():
    return f"""cm AS (SELECT date_block_num, shop_id, item_id,
  least(greatest(item_cnt_month, {config.CLIP_LO}), {config.CLIP_HI}) AS item_cnt_month FROM monthly
  WHERE date_block_num <= {H})"""


def _clipped_monthly(spark, sf_dir, grain="A"):
    m = monthly(spark, sf_dir, grain).filter(F.col("date_block_num") <= H)
    return m.withColumn("item_cnt_month", clip("item_cnt_month"))


@query("shop_share_index", sql(["monthly"], f"""SELECT shop_id, {srnd("shop_share", 6)} AS shop_share
FROM ({share_sql("cm", "shop_id", "item_cnt_month", "shop_share")})""", [clipped_monthly_sql()]))
def q_shop_share_index(spark, sf_dir):
    """Shop units as a share of the average shop."""
    s = agg.share_index(_clipped_monthly(spark, sf_dir), "shop_id", "item_cnt_month", "shop_share")
    return s.withColumn("shop_share", rnd("shop_share", 6))


@query("item_share_index", sql(["monthly"], f"""SELECT item_id, {srnd("item_share", 6)} AS item_share
FROM ({share_sql("cm", "item_id", "item_cnt_month", "item_share")})""", [clipped_monthly_sql()]))
def q_item_share_index(spark, sf_dir):
    """Item units as a share of the average item."""
    s = agg.share_index(_clipped_monthly(spark, sf_dir), "item_id", "item_cnt_month", "item_share")
    return s.withColumn("item_share", rnd("item_share", 6))


def _pivot_sql(source: str, keys: str, value: str, fn: str, months, prefix="m_", else_=None):
    cols = ",\n  ".join(
        f"coalesce({fn}(CASE WHEN date_block_num = {m} THEN {value} END), 0) AS {prefix}{m}" for m in months)
    return f"SELECT {keys},\n  {cols}\nFROM {source} GROUP BY {keys}"


@query("pivot_month_sum", sql(["sales"], _pivot_sql("sales", "shop_id, item_id", "item_cnt_day", "sum", MONTHS)))
def q_pivot_month_sum(spark, sf_dir):
    """(shop, item) x month matrix of unit sums, missing -> 0."""
    return agg.pivot_months(tpch.sales(spark, sf_dir), ["shop_id", "item_id"], "date_block_num",
                            "item_cnt_day", "sum")


@query("pivot_month_mean", sql(["monthly"], _pivot_sql("monthly", "item_id, shop_id", "item_cnt_month", "avg",
                                                       MONTHS)))
def q_pivot_month_mean(spark, sf_dir):
    """Pivot with the mean aggregate over the (unique) monthly rows."""
    return agg.pivot_months(monthly(spark, sf_dir), ["item_id", "shop_id"], "date_block_num",
                            "item_cnt_month", "avg", dealt=True)


@query("table_shape", sql(["monthly"], """SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_cols FROM monthly"""))
def q_table_shape(spark, sf_dir):
    """Rows and columns of the monthly table."""
    return agg.table_shape(monthly(spark, sf_dir))
