"""A fitted model with everything needed to use it again.

A bundle is a folder of numbered versions; each holds the fitted pipeline (ML
writer), the named tables that scoring looks things up in (codes, vocabularies,
means; parquet) and a description: format, feature order, label, calendar and
settings, with the columns and row count of every table.  The description is
written last, so a version without it is unfinished and never loaded; a failed
save is retried as the next version.  Loading checks the description against
what is found.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

FORMAT = 1
DESCRIPTION = "description"


@dataclass
class Bundle:
    """A model, its lookup tables and what they mean."""
    model: PipelineModel
    features: list[str]
    label: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    settings: dict = field(default_factory=dict)


class BundleError(ValueError):
    """A bundle that is absent, unfinished, of another format or not as described."""


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, hadoop


def versions(spark: SparkSession, path: str, finished: bool = True) -> list[int]:
    """Ascending version numbers under ``path``; by default the finished ones."""
    fs, at, hadoop = _folder(spark, path)
    if not fs.exists(at):
        return []
    out = []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit():
            if not finished or fs.exists(hadoop.Path(status.getPath(), f"{DESCRIPTION}/_SUCCESS")):
                out.append(int(name[1:]))
    return sorted(out)


def save_bundle(bundle: Bundle, path: str) -> int:
    """Write ``bundle`` as the next version under ``path``; returns its number."""
    missing = [t for t, df in bundle.tables.items() if not df.columns]
    if missing or not bundle.features:
        raise BundleError(f"nothing to save: tables {missing}, {len(bundle.features)} features")
    spark = SparkSession.getActiveSession()
    number = max(versions(spark, path, finished=False), default=0) + 1
    base = f"{path.rstrip('/')}/v{number}"
    bundle.model.write().save(f"{base}/model")
    described = {}
    for name, df in bundle.tables.items():
        df.write.parquet(f"{base}/tables/{name}")
        stored = spark.read.parquet(f"{base}/tables/{name}")
        described[name] = {"schema": json.loads(df.schema.json()), "rows": stored.count()}
    text = json.dumps({"format": FORMAT, "features": bundle.features, "label": bundle.label, "settings": bundle.settings,
                       "tables": described}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/{DESCRIPTION}")
    return number


def load_bundle(spark: SparkSession, path: str, version: int | None = None) -> Bundle:
    """The given or newest finished version, checked."""
    found = versions(spark, path)
    if version is None and found:
        version = found[-1]
    if version not in found:
        raise BundleError(f"no finished version {version or ''} under {path}: {found}")
    base = f"{path.rstrip('/')}/v{version}"
    d = json.loads(spark.read.text(f"{base}/{DESCRIPTION}").first()[0])
    if d.get("format") != FORMAT:
        raise BundleError(f"format {d.get('format')}, expected {FORMAT}")
    tables = {}
    for name, want in d["tables"].items():
        df = spark.read.parquet(f"{base}/tables/{name}")
        columns = [(f["name"], f["type"]) for f in want["schema"]["fields"]]
        if [(f["name"], f["type"]) for f in json.loads(df.schema.json())["fields"]] != columns or df.count() != want["rows"]:
            raise BundleError(f"table {name} is not the one that was saved")
        tables[name] = df
    model = PipelineModel.load(f"{base}/model")
    inputs = model.stages[0].getInputCols()
    if inputs != d["features"]:
        raise BundleError(f"the model reads {inputs}, the description says {d['features']}")
    return Bundle(model, d["features"], d["label"], tables, d["settings"])
