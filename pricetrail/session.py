"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What every session needs: days are days in UTC, and hot keys are split.  All of it can be
# set in a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot keys also where that costs a further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Where every partition of one side proves this small at run time, hash it: the large
    # side then needs no sort.  Works with the splitting of hot keys.  The size is of
    # compressed shuffle data, and several tasks share an executor.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Give a session of any cluster the library's settings; others stay as they are.

    ``cost_daily`` and the other daily operators take a timestamp's day in the session's zone.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pricetrail")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {"spark.ui.enabled": "false", **SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory name below the folder that the cluster shares.

    ``spark.checkpoint.dir`` names that folder.  Only a local session without the setting
    falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="pricetrail-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/pricetrail-{uuid.uuid4().hex}/{label}"
