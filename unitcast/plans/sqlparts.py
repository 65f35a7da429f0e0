"""Oracle SQL building blocks (DuckDB dialect) mirroring ``sources.tpch``."""

from __future__ import annotations

from unitcast import config

H, TM = config.HOLDOUT_MONTH, config.TARGET_MONTH

CTE = {
    "sales": f"""sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST((year(l_shipdate) - {config.BASE_YEAR}) * 12 + month(l_shipdate) - 1 AS INTEGER) AS date_block_num,
         l_suppkey AS shop_id, l_partkey AS item_id,
         l_extendedprice / l_quantity AS item_price,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS item_cnt_day,
         l_orderkey AS order_key, l_linenumber AS line_no
  FROM lineitem)""",
    "categories": """categories AS (
  SELECT CAST(row_number() OVER (ORDER BY item_category_name) - 1 AS BIGINT) AS item_category_id,
         item_category_name
  FROM (SELECT DISTINCT p_type || ' - ' || p_brand AS item_category_name FROM part))""",
    "items": """items AS (
  SELECT p_partkey AS item_id, p_name AS item_name, c.item_category_id
  FROM part LEFT JOIN categories c ON p_type || ' - ' || p_brand = c.item_category_name)""",
    "shops": """shops AS (
  SELECT s_suppkey AS shop_id, concat_ws(' ', n_name, s_name) AS shop_name
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "sales_b": """sales_b AS (
  SELECT s.date, s.date_block_num, CAST(sup.s_nationkey AS BIGINT) AS shop_id,
         i.item_category_id AS item_id, s.item_price, s.item_cnt_day, s.order_key, s.line_no
  FROM sales s JOIN items i ON s.item_id = i.item_id
  JOIN supplier sup ON s.shop_id = sup.s_suppkey)""",
    "sales_c": """sales_c AS (
  SELECT s.date, s.date_block_num, s.shop_id, i.item_category_id AS item_id,
         s.item_price, s.item_cnt_day, s.order_key, s.line_no
  FROM sales s JOIN items i ON s.item_id = i.item_id)""",
    "monthly": """monthly AS (
  SELECT date_block_num, shop_id, item_id, sum(item_cnt_day) AS item_cnt_month
  FROM sales GROUP BY date_block_num, shop_id, item_id)""",
    "request": f"""request AS (
  SELECT CAST(row_number() OVER (ORDER BY shop_id, item_id) - 1 AS BIGINT) AS ID, shop_id, item_id
  FROM (SELECT DISTINCT shop_id, item_id FROM sales
        WHERE date_block_num BETWEEN {H - 11} AND {TM}))""",
    "request_b": f"""request_b AS (
  SELECT CAST(row_number() OVER (ORDER BY shop_id, item_id) - 1 AS BIGINT) AS ID, shop_id, item_id
  FROM (SELECT DISTINCT shop_id, item_id FROM sales_b
        WHERE date_block_num BETWEEN {H - 11} AND {TM}))""",
}

DEPS = {
    "items": ["categories"],
    "sales_b": ["sales", "items"],
    "sales_c": ["sales", "items"],
    "monthly": ["sales"],
    "request": ["sales"],
    "request_b": ["sales_b"],
}


def with_ctes(names: list[str], extra: list[str] | None = None) -> str:
    """WITH clause holding ``names`` (plus dependencies) then ``extra`` CTEs."""
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [CTE[n] for n in order] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"


def sql(names: list[str], body: str, extra: list[str] | None = None) -> str:
    return with_ctes(names, extra) + body


def exact_mean(x: str, scale: int = 10) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,{scale}))) AS DOUBLE) / nullif(count({x}), 0)"


def rnd(x: str, digits: int) -> str:
    return f"round(({x}) * {float(10 ** digits)}, 0) / {float(10 ** digits)}"


def median(source: str, x: str) -> str:
    """Exact median as the mean of the two middle values."""
    return (f"(SELECT avg(v) FROM (SELECT {x} AS v, row_number() OVER (ORDER BY {x}) AS rn, "
            f"count(*) OVER () AS n FROM {source}) WHERE rn IN ((n + 1) // 2, n // 2 + 1))")


def exact_sum(x: str, scale: int = 12) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(30,{scale}))) AS DOUBLE)"


def share_sql(source: str, key: str, value: str, name: str) -> str:
    """E10 in SQL with the same exact sums as ``aggregate.share_index``."""
    return (f"SELECT {key}, s / nullif((SELECT {exact_sum('s')} / count(s) FROM "
            f"(SELECT {exact_sum(value)} AS s FROM {source} GROUP BY {key})), 0) AS {name} "
            f"FROM (SELECT {key}, {exact_sum(value)} AS s FROM {source} GROUP BY {key})")
