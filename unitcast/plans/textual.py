"""Phase 3 queries: text features, encoders, TF-IDF and dimension joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import TOKEN_PATTERN, clip, rnd
from unitcast.operators import aggregate as agg
from unitcast.operators import clean, encode, panel, text
from unitcast.plans.basic import monthly
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, rnd as srnd, sql
from unitcast.sources import tpch

# ---- G1/G2 -----------------------------------------------------------------

def _names(spark, sf_dir):
    it = tpch.items(spark, sf_dir).select(F.lit("item").alias("kind"), F.col("item_id").alias("id"),
                                          F.col("item_name").alias("name"))
    ca = tpch.categories(spark, sf_dir).select(F.lit("category").alias("kind"),
                                               F.col("item_category_id").alias("id"),
                                               F.col("item_category_name").alias("name"))
    sh = tpch.shops(spark, sf_dir).select(F.lit("shop").alias("kind"), F.col("shop_id").alias("id"),
                                          F.col("shop_name").alias("name"))
    return it.unionByName(ca).unionByName(sh)


@query("text_stats", sql(["items", "shops"], """SELECT kind, id, name,
  CAST(length(name) AS INTEGER) AS name_length,
  CAST(len(string_split(name, ' ')) AS INTEGER) AS name_word_count
FROM (SELECT 'item' AS kind, item_id AS id, item_name AS name FROM items
      UNION ALL SELECT 'category', item_category_id, item_category_name FROM categories
      UNION ALL SELECT 'shop', shop_id, shop_name FROM shops)"""))
def q_text_stats(spark, sf_dir):
    """Name length and space-separated piece count for all three names."""
    return text.text_stats(_names(spark, sf_dir), "name", "name")


# ---- G4-G6 -----------------------------------------------------------------

@query("shop_city", sql(["shops"], """SELECT shop_id, city,
  CAST(dense_rank() OVER (ORDER BY city) - 1 AS BIGINT) AS city_code
FROM (SELECT shop_id, string_split(shop_name, ' ')[1] AS city FROM shops)"""))
def q_shop_city(spark, sf_dir):
    """G4 + G6: first token of the shop name, label-encoded."""
    s = text.shop_city(tpch.shops(spark, sf_dir))
    return encode.encode_apply(s, "city", encode.encode_fit(s, c="city"), out="city_code").select(
        "shop_id", "city", "city_code")


@query("category_type_subtype", sql(["categories"], """SELECT item_category_id, type, subtype,
  CAST(dense_rank() OVER (ORDER BY type) - 1 AS BIGINT) AS type_code,
  CAST(dense_rank() OVER (ORDER BY subtype) - 1 AS BIGINT) AS subtype_code
FROM (SELECT item_category_id,
        trim(string_split(item_category_name, '-')[1]) AS type,
        CASE WHEN len(string_split(item_category_name, '-')) > 1
             THEN trim(string_split(item_category_name, '-')[2])
             ELSE trim(string_split(item_category_name, '-')[1]) END AS subtype
      FROM categories)"""))
def q_category_type_subtype(spark, sf_dir):
    """G5 + G6: 'type - subtype' split and both parts label-encoded."""
    c = text.category_type_subtype(tpch.categories(spark, sf_dir))
    c = encode.encode_apply(c, "type", encode.encode_fit(c, c="type"), out="type_code")
    c = encode.encode_apply(c, "subtype", encode.encode_fit(c, c="subtype"), out="subtype_code")
    return c.select("item_category_id", "type", "subtype", "type_code", "subtype_code")


@query("label_encode", sql(["shops"], """SELECT shop_id,
  CAST(dense_rank() OVER (ORDER BY shop_name) - 1 AS BIGINT) AS shop_name_code FROM shops"""))
def q_label_encode(spark, sf_dir):
    """Sorted distinct shop names -> 0-based code."""
    s = tpch.shops(spark, sf_dir)
    return encode.label_encode(s, "shop_name", out="shop_name_code").select("shop_id", "shop_name_code")


@query("label_encode_union", sql(["monthly", "items", "request"], """,
dom AS (SELECT DISTINCT i.item_name FROM monthly m JOIN items i ON m.item_id = i.item_id
        UNION SELECT DISTINCT i.item_name FROM request r JOIN items i ON r.item_id = i.item_id),
codes AS (SELECT item_name, CAST(row_number() OVER (ORDER BY item_name) - 1 AS BIGINT) AS code FROM dom)
SELECT r.ID, coalesce(c.code, -1) AS item_name_code
FROM request r LEFT JOIN items i ON r.item_id = i.item_id LEFT JOIN codes c ON i.item_name = c.item_name"""
                                .replace("\n,\n", ",\n", 1)))
def q_label_encode_union(spark, sf_dir):
    """C5 + G6: encoder fitted on history names union request names."""
    items = tpch.items(spark, sf_dir).select("item_id", "item_name")
    hist = monthly(spark, sf_dir).select("item_id").join(items, "item_id")
    req = tpch.request(spark, sf_dir).join(items, "item_id", "left")
    codes = encode.encode_fit(hist, req, c="item_name")
    return encode.encode_apply(req, "item_name", codes, out="item_name_code").select("ID", "item_name_code")


# ---- G3 TF-IDF -------------------------------------------------------------

def _tfidf_sql(source: str, id_col: str, text_col: str, ctes: list[str]) -> str:
    pat = TOKEN_PATTERN
    body = f""",
docs AS (SELECT {id_col} AS id, {text_col} AS txt FROM {source}),
toks AS (SELECT id, unnest(regexp_extract_all(lower(txt), '{pat}')) AS term FROM docs),
tf AS (SELECT id, term, count(*) AS tf FROM toks GROUP BY id, term),
top AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term
        ORDER BY total DESC, term LIMIT {config.TFIDF_TERMS}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx,
                 ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1 AS idf FROM top),
w AS (SELECT id, term, idx, tf * idf AS w FROM tf JOIN vocab USING (term))
SELECT id AS {id_col}, term, idx, {srnd("w / sqrt(sum(w * w) OVER (PARTITION BY id))", 6)} AS weight FROM w"""
    return sql(ctes, body).replace("\n,\ndocs", ",\ndocs", 1) if ctes else "WITH " + body.lstrip(",\n")


def _tfidf(df, id_col, text_col):
    out = text.tfidf(df, id_col, text_col)
    return out.withColumn("weight", rnd("weight", 6))


@query("tfidf_item", _tfidf_sql("items", "item_id", "item_name", ["items"]))
def q_tfidf_item(spark, sf_dir):
    """G3 on item names."""
    return _tfidf(tpch.items(spark, sf_dir), "item_id", "item_name")


@query("tfidf_category", _tfidf_sql("categories", "item_category_id", "item_category_name", ["categories"]))
def q_tfidf_category(spark, sf_dir):
    """G3 on category names."""
    return _tfidf(tpch.categories(spark, sf_dir), "item_category_id", "item_category_name")


@query("tfidf_shop", _tfidf_sql("shops", "shop_id", "shop_name", ["shops"]))
def q_tfidf_shop(spark, sf_dir):
    """G3 on shop names."""
    return _tfidf(tpch.shops(spark, sf_dir), "shop_id", "shop_name")


@query("tfidf_documents", _tfidf_sql("documents", "doc_id", "text", []))
def q_tfidf_documents(spark, sf_dir):
    """G3 on the whole text of every document (large vocabulary case)."""
    return _tfidf(tpch.table(spark, sf_dir, "documents"), "doc_id", "text")


# ---- D1-D3, D6 -------------------------------------------------------------

@query("sales_with_category", sql(["monthly", "items"], """SELECT m.date_block_num, m.shop_id, m.item_id,
  m.item_cnt_month, i.item_category_id,
  CASE WHEN i.item_category_id BETWEEN 1 AND 7 THEN 'Access'
       WHEN i.item_category_id BETWEEN 10 AND 17 THEN 'Consoles'
       WHEN i.item_category_id BETWEEN 18 AND 24 THEN 'Consoles Games'
       WHEN i.item_category_id BETWEEN 26 AND 27 THEN 'phone games'
       WHEN i.item_category_id BETWEEN 28 AND 31 THEN 'CD games'
       WHEN i.item_category_id BETWEEN 32 AND 36 THEN 'Card'
       WHEN i.item_category_id BETWEEN 37 AND 42 THEN 'Movie'
       WHEN i.item_category_id BETWEEN 43 AND 54 THEN 'Books'
       WHEN i.item_category_id BETWEEN 55 AND 60 THEN 'Music'
       WHEN i.item_category_id BETWEEN 61 AND 72 THEN 'Gifts'
       WHEN i.item_category_id BETWEEN 73 AND 78 THEN 'Soft'
       ELSE c.item_category_name END AS cats
FROM monthly m JOIN items i ON m.item_id = i.item_id
JOIN categories c ON i.item_category_id = c.item_category_id"""))
def q_sales_with_category(spark, sf_dir):
    """D1 + G7: inner joins of monthly units to item and category group."""
    cats = clean.category_groups(tpch.categories(spark, sf_dir))
    m = monthly(spark, sf_dir).join(tpch.items(spark, sf_dir).select("item_id", "item_category_id"), "item_id")
    return m.join(cats.select("item_category_id", "cats"), "item_category_id").select(
        "date_block_num", "shop_id", "item_id", "item_cnt_month", "item_category_id", "cats")


@query("enrich_star", sql(["monthly", "items", "shops"], """SELECT m.date_block_num, m.shop_id, m.item_id,
  m.item_cnt_month, i.item_name, i.item_category_id, c.item_category_name, s.shop_name
FROM monthly m LEFT JOIN items i ON m.item_id = i.item_id
LEFT JOIN categories c ON i.item_category_id = c.item_category_id
LEFT JOIN shops s ON m.shop_id = s.shop_id"""))
def q_enrich_star(spark, sf_dir):
    """Left lookups of item, category and shop names."""
    m = monthly(spark, sf_dir)
    out = (m.join(tpch.items(spark, sf_dir), "item_id", "left")
            .join(tpch.categories(spark, sf_dir), "item_category_id", "left")
            .join(tpch.shops(spark, sf_dir), "shop_id", "left"))
    return out.select("date_block_num", "shop_id", "item_id", "item_cnt_month", "item_name",
                      "item_category_id", "item_category_name", "shop_name")


def request_history(sales, request, last_month: int = H):
    """Request rows with the units of every month from the first of
    the sales to ``last_month``; missing -> 0."""
    s = sales.filter(F.col("date_block_num") <= last_month)
    first = panel.first_month(s)
    months = [] if first is None else list(range(first, last_month + 1))
    cells = agg.month_cells(s, ["shop_id", "item_id"], "date_block_num", "item_cnt_day")
    out = request.join(cells, ["shop_id", "item_id"], "left").select("ID", "shop_id", "item_id", "_cells")
    return agg.spread_months(out, months, 0.0)


@query("request_left_history", sql(["sales", "request"], f""",
u AS (SELECT date_block_num AS m, shop_id, item_id, sum(item_cnt_day) AS n FROM sales WHERE date_block_num <= {H} GROUP BY ALL),
cells AS (SELECT ID, shop_id, item_id, 'm_' || m AS c, coalesce(n, 0.0) AS n
          FROM request CROSS JOIN (SELECT unnest(range((SELECT min(m) FROM u), {H + 1})) AS m)
          LEFT JOIN u USING (m, shop_id, item_id))
SELECT * FROM (PIVOT cells ON c USING sum(n) GROUP BY ID, shop_id, item_id)"""
                                   .replace("\n,\nu AS", ",\nu AS", 1)))
def q_request_left_history(spark, sf_dir):
    """Request rows with their month history, missing -> 0."""
    return request_history(tpch.sales(spark, sf_dir), tpch.request(spark, sf_dir))


@query("request_fanout_dedupe", sql(["sales", "request"], f"""SELECT DISTINCT r.ID,
  CASE WHEN d.cnt IS NULL THEN NULL ELSE least(greatest(d.cnt, {config.CLIP_LO}), {config.CLIP_HI}) END
    AS item_cnt_month
FROM request r LEFT JOIN (SELECT date, shop_id, item_id, item_price, sum(item_cnt_day) AS cnt
                          FROM sales GROUP BY ALL) d
  ON r.shop_id = d.shop_id AND r.item_id = d.item_id"""))
def q_request_fanout_dedupe(spark, sf_dir):
    """D6 + C2: request x daily-grain history (fan-out), then exact duplicates removed."""
    daily = agg.sum_all_but(tpch.sales(spark, sf_dir).select("date", "shop_id", "item_id", "item_price",
                                                             "item_cnt_day"), "item_cnt_day", "cnt")
    # a pair's equal values are one row before they meet the request rows
    values = daily.select("shop_id", "item_id", clip("cnt").alias("item_cnt_month")).distinct()
    return tpch.request(spark, sf_dir).join(values, ["shop_id", "item_id"], "left").select("ID", "item_cnt_month").distinct()


@query("null_profile", sql(["monthly", "request"], f""",
j AS (SELECT r.ID, r.shop_id, r.item_id, m.item_cnt_month FROM request r
      LEFT JOIN (SELECT * FROM monthly WHERE date_block_num = {H}) m
      ON r.shop_id = m.shop_id AND r.item_id = m.item_id)
SELECT column_name, null_count FROM (
  SELECT 'ID' AS column_name, CAST(count(*) - count(ID) AS BIGINT) AS null_count FROM j
  UNION ALL SELECT 'shop_id', CAST(count(*) - count(shop_id) AS BIGINT) FROM j
  UNION ALL SELECT 'item_id', CAST(count(*) - count(item_id) AS BIGINT) FROM j
  UNION ALL SELECT 'item_cnt_month', CAST(count(*) - count(item_cnt_month) AS BIGINT) FROM j)"""
                           .replace("\n,\nj AS", ",\nj AS", 1)))
def q_null_profile(spark, sf_dir):
    """B16 (re-aimed): NULL count per column of request x holdout-month units."""
    m = monthly(spark, sf_dir).filter(F.col("date_block_num") == H).drop("date_block_num")
    j = tpch.request(spark, sf_dir).join(m, ["shop_id", "item_id"], "left").select(
        "ID", "shop_id", "item_id", "item_cnt_month")
    return clean.null_profile(j)
