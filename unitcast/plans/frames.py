"""The frames that the flat-table models train on and score, and CSV-side
steps on the test tables (A2, A3, B9, H12)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import parse_day_first, rnd
from unitcast.plans import pipelines
from unitcast.plans.modelq import flat_tables
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, rnd as srnd, sql
from unitcast.sources import csvscan, tpch

FLAT_CTES = [
    f"""hm AS (SELECT date_block_num, shop_id, item_id, CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year, sum(item_cnt_day) AS item_cnt_month
  FROM sales WHERE date_block_num <= {H} GROUP BY ALL)""",
    "mm AS (SELECT shop_id, item_id, avg(item_cnt_month) AS item_cnt_month_mean FROM hm GROUP BY ALL)",
    f"pm AS (SELECT shop_id, item_id, item_cnt_month AS item_cnt_prev_month FROM hm WHERE date_block_num = {H})",
    """rows_h AS (SELECT hm.date_block_num, hm.shop_id, hm.item_id, hm.month, hm.year, hm.item_cnt_month FROM hm)""",
    f"""rows_r AS (SELECT ID, CAST({TM} AS INTEGER) AS date_block_num, shop_id, item_id, CAST({TM % 12 + 1} AS INTEGER) AS month,
         CAST({config.BASE_YEAR + TM // 12} AS INTEGER) AS year, CAST(0.0 AS DOUBLE) AS item_cnt_month FROM request)""",
    """both_rows AS (SELECT shop_id, item_id FROM rows_h UNION SELECT shop_id, item_id FROM rows_r)""",
    """named AS (SELECT DISTINCT s.shop_name, c.item_category_name, i.item_name FROM both_rows b
  LEFT JOIN items i ON b.item_id = i.item_id LEFT JOIN categories c ON i.item_category_id = c.item_category_id
  LEFT JOIN shops s ON b.shop_id = s.shop_id)""",
    *[f"""code_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code
  FROM (SELECT DISTINCT {c} FROM named WHERE {c} IS NOT NULL))""" for c in pipelines.NAME_COLS],
]
FRAME_COLS = ["date_block_num", "shop_id", "item_id", "month", "year", "item_cnt_month", "item_cnt_month_mean",
              "item_cnt_prev_month", "item_category_id", *pipelines.NAME_COLS]


def _frame_sql(rows: str, target: str, extra: str = "") -> str:
    codes = ", ".join(f"coalesce(code_{c}.code, -1) AS {c}" for c in pipelines.NAME_COLS)
    return sql(["sales", "request", "items", "shops"], f"""SELECT {extra}r.date_block_num, r.shop_id, r.item_id, r.month, r.year,
  {target} AS item_cnt_month, {srnd('coalesce(mm.item_cnt_month_mean, 0.0)', 6)} AS item_cnt_month_mean,
  coalesce(pm.item_cnt_prev_month, 0.0) AS item_cnt_prev_month, coalesce(i.item_category_id, 0) AS item_category_id, {codes}
FROM {rows} r LEFT JOIN mm ON r.shop_id = mm.shop_id AND r.item_id = mm.item_id
LEFT JOIN pm ON r.shop_id = pm.shop_id AND r.item_id = pm.item_id
LEFT JOIN items i ON r.item_id = i.item_id LEFT JOIN categories c ON i.item_category_id = c.item_category_id
LEFT JOIN shops s ON r.shop_id = s.shop_id
""" + "\n".join(f"LEFT JOIN code_{n} ON {a}.{n} = code_{n}.{n}" for n, a in
                zip(pipelines.NAME_COLS, ("s", "c", "i"))), FLAT_CTES)


@query("flat_model_frame", _frame_sql("rows_h", f"least(greatest(r.item_cnt_month, {config.CLIP_LO}), {config.CLIP_HI})"))
def q_flat_model_frame(spark, sf_dir):
    """The history frame (shop x item) that the flat forests and flat boosted models train on."""
    hist, _ = flat_tables(spark, sf_dir)
    return hist.withColumn("item_cnt_month_mean", rnd("item_cnt_month_mean", 6)).select(*FRAME_COLS)


@query("flat_scoring_frame", _frame_sql("rows_r", "r.item_cnt_month", "r.ID, "))
def q_flat_scoring_frame(spark, sf_dir):
    """The request frame those models score, with the calendar continued from the sales."""
    _, req = flat_tables(spark, sf_dir)
    return req.withColumn("item_cnt_month_mean", rnd("item_cnt_month_mean", 6)).select("ID", *FRAME_COLS)


ROW_CAP = 1000      # the feature itself: a scan that stops after so many rows


CSV_COLS = ["date", "shop_id", "item_id", "item_cnt_day", "order_key", "line_no"]
CSV_TYPES = {"date": "date", "shop_id": "bigint", "item_id": "bigint", "item_cnt_day": "double", "order_key": "bigint", "line_no": "int"}
CSV_ORDER = ["order_key", "line_no", "date", "shop_id", "item_id", "item_cnt_day"]


ROWS_PER_FILE = 1_000_000      # a task sorts and writes one file


def _written(spark, rows):
    """``rows`` as several CSV files whose names follow their order, dates
    day-first; more rows give more files, not larger ones."""
    n = max(4, -(-rows.count() // ROWS_PER_FILE))
    path = config.scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    text = rows.withColumn("date", F.date_format("date", "dd.MM.yyyy"))
    text.repartitionByRange(n, *CSV_ORDER[:2]).sortWithinPartitions(*CSV_ORDER[:2], F.to_date("date", "dd.MM.yyyy"), *CSV_ORDER[3:]).write.csv(path, header=True)
    return path


@query("row_limited_scan", sql(["sales"], f"""SELECT {", ".join(CSV_COLS)} FROM sales
ORDER BY {", ".join(CSV_ORDER)} LIMIT {ROW_CAP}"""))
def q_row_limited_scan(spark, sf_dir):
    """A3: the sales written as CSV files in (order, line) order, and the first
    rows read back in file order."""
    path = _written(spark, tpch.sales(spark, sf_dir).select(*CSV_COLS))
    return csvscan.typed(csvscan.first_records(spark, path, ROW_CAP), CSV_TYPES).select(*CSV_COLS)


@query("rejected_rows", sql(["sales"], """SELECT 'accepted' AS reason, count(*) AS n FROM sales WHERE line_no <> 7
UNION ALL SELECT 'item_id=x' || item_id, count(*) FROM sales WHERE line_no = 7 GROUP BY item_id"""))
def q_rejected_rows(spark, sf_dir):
    """A1: the sales written as CSV files with a malformed item id on every
    seventh line of an order; rejects by reason, and how many rows were accepted."""
    s = tpch.sales(spark, sf_dir).select(*CSV_COLS)
    bad = s.withColumn("item_id", F.when(F.col("line_no") == 7, F.concat(F.lit("x"), "item_id")).otherwise(F.col("item_id").cast("string")))
    accepted, rejects = csvscan.read_checked(spark, _written(spark, bad), CSV_TYPES)
    return (accepted.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("reason"), "n")
            .unionByName(rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))))


@query("day_first_dates", sql(["sales"], """SELECT strftime(date, '%d.%m.%Y') AS text_date, date, count(*) AS n
FROM sales GROUP BY ALL"""))
def q_day_first_dates(spark, sf_dir):
    """Dates written day-first as text and parsed back."""
    s = tpch.sales(spark, sf_dir).select(F.date_format("date", "dd.MM.yyyy").alias("text_date"))
    return (s.withColumn("date", parse_day_first("text_date")).groupBy("text_date", "date")
            .agg(F.count(F.lit(1)).alias("n")))
