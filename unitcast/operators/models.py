"""Modelling operators on Spark ML: H1-H10.

All estimators train data-parallel on the executors (tree learners aggregate
split statistics per partition; the linear solver aggregates the normal
equations), so no training set is ever collected to the driver.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import clip
from unitcast.operators import forest
from unitcast.operators.boosting import boost, early_stop
from unitcast.operators.joins import materialize

T = "date_block_num"


def temporal_split(df: DataFrame, holdout: int = config.HOLDOUT_MONTH,
                   target: int = config.TARGET_MONTH, time_col: str = T):
    """H1: train (< holdout), holdout (== holdout), request (== target)."""
    c = F.col(time_col)
    return df.filter(c < holdout), df.filter(c == holdout), df.filter(c == target)


def feature_columns(df: DataFrame, label: str, drop_month: bool = True,
                    exclude=("ID",)) -> list[str]:
    """H2: every column but the label.  With ``drop_month`` the reference's
    substring test is kept: a column whose name occurs inside the label's
    name (e.g. ``month`` in ``item_cnt_month``) is dropped too."""
    out = []
    for c in df.columns:
        if c == label or c in exclude:
            continue
        if drop_month and c in label:
            continue
        out.append(c)
    return out


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def fit_linear(train: DataFrame, features: list[str], label: str, **params) -> PipelineModel:
    """H3: ordinary least squares (normal equations, no regularisation)."""
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0,
                          solver="normal", **params)
    return Pipeline(stages=[_assembler(features), lr]).fit(train)


def _memory_mb(value: str) -> int:
    v = value.strip().lower()
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    if v[-1:] == "b":
        v = v[:-1]
    return int(float(v[:-1]) * units[v[-1]]) if v[-1:] in units else int(v)   # no unit: MiB


def tree_memory_mb(spark, share: float = 0.3, floor: int = 64, cap: int = 1024) -> int:
    """Per-task budget for split statistics of deep trees, from the session's
    executor memory and task slots: each running task may hold one such
    buffer, so a fixed large value would exhaust a small heap."""
    conf = spark.sparkContext.getConf()
    master = conf.get("spark.master", "")
    if master.startswith("local"):
        mem = conf.get("spark.driver.memory", "1g")
        slots = master[6:-1] if master.startswith("local[") else "1"
        slots = int(slots) if slots.isdigit() else (spark.sparkContext.defaultParallelism or 1)
    else:
        mem = conf.get("spark.executor.memory", "1g")
        slots = int(conf.get("spark.executor.cores", "1")) // max(1, int(conf.get("spark.task.cpus", "1")))
    return max(floor, min(cap, int(_memory_mb(mem) * share / max(1, slots))))


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per task slot: fitting is bound by CPU, not by
    the bytes that the stored frame was split by."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


# Columns compared with the label by one scan, and features that decide the order of the rows.
COMPARED_COLUMNS, ORDER_FEATURES = 8, 8


def feature_order(rows: DataFrame, features: list[str], label: str) -> list[str]:
    """The features (vectors aside) by falling linear correlation with the label."""
    kinds, y, tie = dict(rows.dtypes), F.col(label).cast("double"), {}
    plain = [c for c in features if kinds[c] != "vector"]
    for at in range(0, len(plain), COMPARED_COLUMNS):
        part = plain[at:at + COMPARED_COLUMNS]
        found = rows.agg(*[F.struct(F.covar_pop(F.col(c).cast("double"), y), F.stddev_pop(F.col(c).cast("double"))) for c in part]).first()
        for c, (both, own) in zip(part, found):      # up to the label's own deviation, the same for all
            tie[c] = float(f"{abs(both / own):.6g}") if own and both is not None and both == both else 0.0
    return sorted(plain, key=lambda c: -tie[c])


def in_feature_order(train: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows, sorted by their leading features in each task: neighbours then
    fall into the same tree nodes, so that a pass over deep levels updates split
    statistics which are still in the processor's cache, and walks the same
    branches again.  All rows are kept; which split is best does not depend on
    their order."""
    return materialize(train.sortWithinPartitions(*order[:ORDER_FEATURES]))


#: Settings that ``operators.forest`` has; a forest with others (row weights,
#: feature subsets), or of vector columns, is fitted by the ML learner.
SUBTREE_SETTINGS = {"numTrees", "maxDepth", "seed", "maxBins", "minInstancesPerNode", "minInfoGain", "bootstrap"}


def _grows_by_subtree(train: DataFrame, features: list[str], settings: dict) -> bool:
    kinds = dict(train.dtypes)
    return bool(features) and set(settings) <= SUBTREE_SETTINGS and settings.get("maxBins", 32) <= 256 and settings["maxDepth"] <= 30 and all(
        kinds[f] != "vector" for f in features)


def _forest_by_subtree(train: DataFrame, features: list[str], label: str, settings: dict) -> PipelineModel:
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, featureSubsetStrategy="all", cacheNodeIds=False, **settings)
    train = train.select(*dict.fromkeys([label, *features]))
    sample = forest.split_sample(train, settings["seed"])
    layout, order = forest.layout_of(sample, features, rf.getMaxBins()), feature_order(sample, features, label)
    with forest.rows_a_batch(train.sparkSession, forest.SCORED_ROWS):
        rows = in_feature_order(forest.binned_rows(spread(train), features, label, layout, order[:ORDER_FEATURES]), order)
    return PipelineModel(stages=[_assembler(features), forest.fit(rows, label, layout, rf)])


def fit_forest(train: DataFrame, features: list[str], label: str, num_trees: int = 25,
               max_depth: int = 15, seed: int = 42, **params) -> PipelineModel:
    """H4/H5: random forest; every tree sees all features at each split."""
    config.ensure_checkpoint_dir(train.sparkSession)
    settings = dict(params, numTrees=num_trees, maxDepth=max_depth, seed=seed)
    if _grows_by_subtree(train, features, settings):
        return _forest_by_subtree(train, features, label, settings)
    order = feature_order(train, features, label)
    train = spread(train.select(*dict.fromkeys([label, *features, *([params["weightCol"]] if params.get("weightCol") else [])])))
    if order:
        train = in_feature_order(train, order)
    params.setdefault("featureSubsetStrategy", "all")
    # Deep trees: split as many nodes per pass as the per-task memory budget allows.
    # Ordered rows take the same branches one after the other, so walking the
    # trees again costs little, and no row keeps its nodes of all trees.
    params.setdefault("maxMemoryInMB", tree_memory_mb(train.sparkSession))
    params.setdefault("cacheNodeIds", False)
    params.setdefault("checkpointInterval", 10)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, seed=seed, **params)
    return Pipeline(stages=[_assembler(features), rf]).fit(train)


# Boosted-tree settings of the reference (H6, H7, H8), mapped to
# Spark ML names.  Spark has no L1/L2 leaf penalty or leaf-wise growth; 32
# leaves are expressed as depth 5.
BOOSTED_ES = dict(maxDepth=8, stepSize=0.3, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                  minInstancesPerNode=300, seed=42)
BOOSTED_SLOW = dict(maxDepth=5, maxIter=200, stepSize=0.03, subsamplingRate=0.8715623,
                    featureSubsetStrategy="0.9497036", minInstancesPerNode=40,
                    minInfoGain=0.0222415, seed=42)
BOOSTED_MATRIX = dict(maxDepth=10, maxIter=10, stepSize=0.3, subsamplingRate=1.0, seed=1)
# Early stopping: up to the reference's 1000 rounds with patience 5; the first
# FIRST_ROUNDS are one fit, later ones are continued one by one.
MAX_BOOST_ROUNDS = 1000
FIRST_ROUNDS = 10
PATIENCE = 5


def best_round(errors: list[float], patience: int) -> int:
    return early_stop(errors, patience)[0]


def fit_boosted(train: DataFrame, features: list[str], label: str, valid: DataFrame | None = None,
                patience: int | None = None, max_rounds: int = MAX_BOOST_ROUNDS,
                first_rounds: int = FIRST_ROUNDS, **params) -> PipelineModel:
    """H6-H8: gradient-boosted trees.

    With ``valid`` and ``patience``: boost until ``patience`` rounds pass
    without a better holdout error (or ``max_rounds``), each round fitted once,
    and keep the leading trees up to the best round (``boosting.boost``).
    """
    asm, train = _assembler(features), spread(train)
    if valid is None or patience is None:
        gbt = GBTRegressor(featuresCol="features", labelCol=label, **dict(params, maxIter=params.get("maxIter", max_rounds)))
        return Pipeline(stages=[asm, gbt]).fit(train)
    params.pop("maxIter", None)
    ready = [asm.transform(df).select("features", F.col(label).cast("double").alias(label)) for df in (train, valid)]
    model, _ = boost(*ready, label, patience, max_rounds, first_rounds, params)
    return PipelineModel(stages=[asm, model])


def score(model: PipelineModel, df: DataFrame, clip_range=(config.CLIP_LO, config.CLIP_HI),
          invert_log: bool = False, out: str = "item_cnt_month") -> DataFrame:
    """H9: predict, optionally undo log1p, clip."""
    pred = model.transform(df)
    p = F.expm1("prediction") if invert_log else F.col("prediction")
    if clip_range is not None:
        p = clip(p, *clip_range)
    return pred.drop("features").withColumn(out, p).drop("prediction")


def in_sample(model: PipelineModel, rows: DataFrame, features: list[str], label: str) -> DataFrame:
    """(label, prediction) of the rows that a forest was fitted on, stored: the
    predictions of ``model.transform``, for whole tables."""
    return forest.scored(model.stages[-1], rows, features, label)


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda x: (-x[1], x[0]))
