"""Script flows over sales-model frames from any source: fit to a bundle,
score from a bundle, or both in one call from CSV files to a prediction file.

A flow's bundle holds every table that scoring needs (pair means, last month's
units, dimensions with their text features, label codes), so a request can be
scored in another session without the sales.  Values that the codes do not
know get -1.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import clip
from unitcast.operators import aggregate as agg
from unitcast.operators import encode, models, panel
from unitcast.operators.joins import materialize
from unitcast.plans import pipelines
from unitcast.plans.pipelines import DIMENSIONS, LABEL, NAME_COLS, I, S, T
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, sql
from unitcast.sources import bundle as bundles
from unitcast.sources import files, tpch


@dataclass(frozen=True)
class Flow:
    """One script: its model, whether names give text features, whether the target is log1p."""
    model: str                      # forest, boosted, slow, linear
    with_text: bool = False
    log_target: bool = False
    top: int | None = None          # refit on so many of the most important features
    settings: dict = field(default_factory=dict)


FLOWS = {
    "forest": Flow("forest"),
    "forest_top6": Flow("forest", top=6),
    "forest_text": Flow("forest", with_text=True),
    "boosted_text": Flow("boosted", with_text=True, log_target=True),
    "slow_text": Flow("slow", with_text=True, log_target=True),
    "linear": Flow("linear"),
}


def dimension(frame: DataFrame, key: str, name: str, with_text: bool) -> DataFrame:
    """A lookup table, with name length, word count and TF-IDF columns if wanted."""
    return pipelines.with_text_features(frame, key, name) if with_text else frame


def history_rows(sales: DataFrame, holdout_month: int) -> DataFrame:
    """Units per observed month and pair, with the calendar parts."""
    s = sales.filter(F.col(T) <= holdout_month)
    return agg.sum_all_but(s.select(T, S, I, F.month("date").alias("month"), F.year("date").alias("year"), "item_cnt_day"),
                           "item_cnt_day", LABEL)


def enrich(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """History or request rows with means, last units and lookups, names as
    codes (-1 if unknown); numeric NULL -> 0."""
    out = rows.join(tables["mean"], [S, I], "left").join(tables["previous"], [S, I], "left")
    return pipelines.with_lookups(out, pipelines.coded_lookups(tables, {c: tables[f"codes_{c}"] for c in NAME_COLS}))


def encoded(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Codes for names that are still text; ``enrich`` attaches codes already."""
    kinds = dict(rows.dtypes)
    for c in NAME_COLS:
        if kinds[c] == "string":
            rows = encode.encode_apply(rows, c, tables[f"codes_{c}"])
    return rows


def request_rows(request: DataFrame, settings: dict) -> DataFrame:
    return (request.withColumn("month", F.lit(settings["month"]).cast("int")).withColumn("year", F.lit(settings["year"]).cast("int"))
            .withColumn(T, F.lit(settings["target_month"]).cast("int")))


def flat_tables(sales: DataFrame, request: DataFrame, items: DataFrame, categories: DataFrame, shops: DataFrame,
                holdout_month: int, target_month: int, with_text: bool) -> tuple[DataFrame, dict[str, DataFrame], dict]:
    """(encoded history with the clipped target, lookup tables, settings)."""
    m = materialize(history_rows(sales, holdout_month))
    tables = {"mean": agg.mean_by(m, [S, I], LABEL, "item_cnt_month_mean"),
              "previous": panel.previous_month_units(m, holdout_month)}
    for name, frame in (("items", items), ("categories", categories), ("shops", shops)):
        tables[name] = dimension(frame, *DIMENSIONS[name], with_text)
    tables = {name: materialize(df) for name, df in tables.items()}
    first = sales.filter(F.col(T) <= holdout_month).agg(F.min(F.year("date") - F.floor(F.col(T) / 12))).first()[0]
    settings = {"target_month": target_month, "holdout_month": holdout_month, "month": target_month % 12 + 1,
                "year": None if first is None else first + target_month // 12}
    seen = pipelines.seen_lookups(tables, m, request)      # domains: history and request names
    for name, (_, c) in DIMENSIONS.items():
        tables[f"codes_{c}"] = materialize(encode.encode_fit(seen[name], c=c))
    return materialize(enrich(m, tables).withColumn(LABEL, clip(LABEL))), tables, settings


def fit(flow: Flow, sales: DataFrame, request: DataFrame, items: DataFrame, categories: DataFrame, shops: DataFrame,
        holdout_month: int = config.HOLDOUT_MONTH, target_month: int = config.TARGET_MONTH, **params) -> bundles.Bundle:
    """Fit a flow; the bundle scores requests without the sales."""
    history, tables, settings = flat_tables(sales, request, items, categories, shops, holdout_month, target_month, flow.with_text)
    features = models.feature_columns(history, LABEL)
    rows = history.withColumn(LABEL, F.log1p(LABEL)) if flow.log_target else history
    before, held, _ = models.temporal_split(rows, holdout_month, target_month)

    def fitted(names):
        if flow.model == "forest":
            return models.fit_forest(rows, names, LABEL, **params)
        if flow.model == "linear":
            return models.fit_linear(rows, names, LABEL, **params)
        if flow.model == "slow":
            return models.fit_boosted(before, names, LABEL, **{**models.BOOSTED_SLOW, **params})
        return models.fit_boosted(before, names, LABEL, valid=held, patience=models.PATIENCE, **{**models.BOOSTED_ES, **params})

    model = fitted(features)
    if flow.top:
        features = [f for f, _ in models.importances(model, features)[:flow.top]]
        model = fitted(features)
    settings |= {"log_target": flow.log_target, "clip": [config.CLIP_LO, config.CLIP_HI]}
    return bundles.Bundle(model, features, LABEL, tables, settings)


def score(bundle: bundles.Bundle, request: DataFrame) -> DataFrame:
    """(ID, units) of request rows, by the bundle alone."""
    rows = encoded(enrich(request_rows(request, bundle.settings), bundle.tables), bundle.tables)
    out = models.score(bundle.model, rows.select("ID", *bundle.features), tuple(bundle.settings["clip"]), bundle.settings["log_target"],
                       out=bundle.label)
    return out.select("ID", bundle.label)


def run_csv(spark: SparkSession, data_dir: str, flow: str, out: str, holdout_month: int, target_month: int,
            keep: str | None = None, **params) -> bundles.Bundle:
    """One script from its CSV files to its prediction file; ``keep`` also
    saves the bundle there."""
    t = files.read_csv_tables(spark, data_dir)
    made = fit(FLOWS[flow], t["sales"], t["request"], t["items"], t["categories"], t["shops"], holdout_month, target_month, **params)
    files.write_predictions(score(made, t["request"]), out)
    if keep:
        bundles.save_bundle(made, keep)
    return made


# ---- registered queries ------------------------------------------------------------

_SAVED: dict = {}


def _saved(spark, sf_dir) -> bundles.Bundle:
    """A linear flow over the test tables, saved and loaded once per session and content."""
    key = (spark.sparkContext.applicationId, sf_dir, tpch.fingerprint(spark, sf_dir, *tpch.MODEL_TABLES))
    if key not in _SAVED:
        made = fit(FLOWS["linear"], tpch.sales(spark, sf_dir), tpch.request(spark, sf_dir), tpch.items(spark, sf_dir),
                   tpch.categories(spark, sf_dir), tpch.shops(spark, sf_dir), H, TM)
        path = config.scratch_path(spark, f"bundle-{uuid.uuid4().hex}")
        bundles.save_bundle(made, path)
        _SAVED[key] = path
    return bundles.load_bundle(spark, _SAVED[key])


@query("bundle_codes", sql(["sales", "items", "shops", "request"], f""",
seen AS (SELECT shop_id, item_id FROM sales WHERE date_block_num <= {H} UNION SELECT shop_id, item_id FROM request),
names AS (SELECT DISTINCT 'item_name' AS column_name, i.item_name AS value FROM seen JOIN items i USING (item_id)
  UNION SELECT 'item_category_name', c.item_category_name FROM seen JOIN items i USING (item_id) JOIN categories c USING (item_category_id)
  UNION SELECT 'shop_name', s.shop_name FROM seen JOIN shops s USING (shop_id))
SELECT column_name, value, CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS BIGINT) AS code
FROM names WHERE value IS NOT NULL""").replace("\n,\nseen", ",\nseen", 1))
def q_bundle_codes(spark, sf_dir):
    """A7 + C5 + G6: the label codes of a saved model bundle, loaded back."""
    tables = _saved(spark, sf_dir).tables
    parts = [tables[f"codes_{c}"].select(F.lit(c).alias("column_name"), "value", F.col("code").cast("bigint").alias("code"))
             for c in NAME_COLS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("bundle_predictions")
def q_bundle_predictions(spark, sf_dir):
    """A7 + H9: request rows scored by the loaded bundle alone."""
    return score(_saved(spark, sf_dir), tpch.request(spark, sf_dir))
