"""Models from a landed JSON list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.text import blank_if_null, collapse, is_present, strip
from entitymart.operators.ordering import ORD
from entitymart.sources.tables import read_json

RAW = "id string, downloads bigint, likes bigint, pipeline_tag string, library_name string"
TARGET = 2000


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """The landed list, one object per line or one array per file."""
    return read_json(spark, path, RAW)


def most_downloaded(raw: DataFrame, n: int = TARGET) -> DataFrame:
    """The ``n`` models with most downloads, as the hub's list is asked for."""
    return raw.orderBy(F.desc_nulls_last("downloads"), F.asc(ORD)).limit(n)


def models(raw: DataFrame) -> DataFrame:
    """Model records: organisation before the first slash, name after the last."""
    rows = raw.filter(is_present(F.col("id"))).withColumn("id", strip(F.col("id")))
    slash = F.contains("id", F.lit("/"))
    return rows.select(
        ORD,
        F.when(slash, F.split_part("id", F.lit("/"), F.lit(-1))).otherwise(F.col("id")).alias("model_name"),
        F.when(slash, F.split_part("id", F.lit("/"), F.lit(1))).otherwise("").alias("organization"),
        F.concat(F.lit(fixed.HUB), "id").alias("source_url"),
        F.coalesce("downloads", F.lit(0)).alias("downloads"),
        F.coalesce("likes", F.lit(0)).alias("likes"),
        blank_if_null(F.col("pipeline_tag")).alias("pipeline_tag"),
        blank_if_null(F.col("library_name")).alias("library_name"),
    )


def cleaned_models(rows: DataFrame) -> DataFrame:
    """White space collapsed in every field; rows without name or url dropped."""
    text = ["model_name", "organization", "source_url", "pipeline_tag", "library_name"]
    both = is_present(F.col("model_name")) & is_present(F.col("source_url"))
    return rows.filter(both).select(
        ORD, *[collapse(F.col(c)).alias(c) for c in text], "downloads", "likes"
    )
