"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "entitymart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    For tables that several branches read and that are costly or not repeatable:
    a lost executor then costs a read, not the work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its
    own; on a cluster a machine-local folder would not be seen by executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="entitymart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")
