"""Constants and session helpers.

Calendar constants are parameters here; the reference hard-codes a 34-month
history with holdout 33 and request month 34.  On the star-schema test data
the month index runs 0..82, so the defaults below are 81 / 82.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Month index = (year - BASE_YEAR) * 12 + month - 1 on the test data.
BASE_YEAR = 1995
HOLDOUT_MONTH = 81
TARGET_MONTH = 82

# Fixed values that must equal the reference for equal results:
# target clip bounds, lag sets, trend lags, cold-start factor, vocabulary size.
CLIP_LO, CLIP_HI = 0.0, 20.0
COUNT_LAGS = (1, 2, 3, 6, 12)
PRICE_LAGS = (1, 2, 3, 4, 5, 6)
COLD_START_FACTOR = 0.225
TFIDF_TERMS = 25
REGRESSION_LAGS = 9

# Bytes under which a derived side may be broadcast (measured, see
# operators.joins.checked_broadcast).
BROADCAST_MAX_BYTES = 64 << 20


def cluster_conf() -> dict[str, str]:
    """Settings meant for a large cluster (AQE sizes the shuffles at runtime)."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        # honour the advisory size when coalescing (the default favours task count)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "4000",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "unitcast", extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("UNITCAST_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session configuration and must be
    shared storage.  Only in a local session without it (tests, local runs)
    is a fresh scratch folder created; elsewhere a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="unitcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables/models."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
