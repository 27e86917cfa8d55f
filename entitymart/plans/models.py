"""From a landed model list to final models and organisation sources."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.functions.cards import prompt_with_source
from entitymart.functions.text import blank_if_null, strip
from entitymart.operators import dedup, descriptions, models, organizations
from entitymart.operators.ordering import ORD
from entitymart.schemas import MODELS_ENRICHED, PROGRESS
from entitymart.session import materialise
from entitymart.sources import models as landed
from entitymart.sources.tables import write_csv


@dataclass
class Described:
    progress: DataFrame
    failed: DataFrame
    summary: DataFrame
    final: DataFrame


def collect_and_enrich(raw: DataFrame, cards: DataFrame) -> DataFrame:
    """Model records, one per organisation and name, with descriptions."""
    return models.enriched_models(dedup.models(landed.models(raw)), cards)


def describe(
    enriched: DataFrame, progress: DataFrame, generator: Callable[[pd.Series], Iterable[str]]
) -> Described:
    """One run of the generator over the pending models.

    Results are used three times and the generator may be costly or answer
    differently when asked again, so they are written to the shared folder once.
    """
    done = descriptions.finished(progress)
    work = descriptions.with_prompt(descriptions.pending(enriched, done), prompt_with_source())
    results = materialise(descriptions.generate(work, generator), "descriptions")
    new = descriptions.successes(results)
    merged = descriptions.merged_progress(done, new)
    return Described(
        progress=merged,
        failed=descriptions.failures(results, new),
        summary=descriptions.progress_summary(enriched, merged),
        final=descriptions.final_models(enriched, merged),
    )


def describe_in_chunks(
    enriched: DataFrame, progress: DataFrame, generator: Callable[[pd.Series], Iterable[str]], path: str, chunks: int = 16
) -> DataFrame:
    """As ``describe``, with the finished descriptions of each chunk committed under ``path``.

    The models are dealt into chunks by their url. A chunk's results are one
    version, ``path/version=<time>-<chunk>``, written as a whole, and versions are
    only ever added. A run that stops loses the chunk at work; the next one reads
    what is there and goes on. Returns all finished descriptions.
    """
    spark, began = enriched.sparkSession, time.strftime("%Y%m%dT%H%M%S")
    part = F.pmod(F.xxhash64(strip(blank_if_null(F.col("source_url")))), F.lit(chunks))
    for k in range(chunks):
        done = descriptions.finished(committed(spark, progress, path))
        work = descriptions.pending(enriched.where(part == k), done)
        results = descriptions.generate(descriptions.with_prompt(work, prompt_with_source()), generator)
        descriptions.successes(results).select("source_url", "description").write.parquet(f"{path}/version={began}-{k:05d}")
    return descriptions.finished(committed(spark, progress, path)).select("source_url", "description")


def committed(spark: SparkSession, progress: DataFrame, path: str) -> DataFrame:
    """Earlier progress and the versions under ``path``, later ones last.

    A version without Spark's success mark is a chunk that never ended and is left out.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(s.getPath().toString() for s in fs.listStatus(fs_path)) if fs.exists(fs_path) else []
    whole = [p for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS"))]
    order = lambda version, inner: F.struct(F.lit(version).alias("version"), inner.cast("string").alias("at"))
    rows = progress.select(order("", F.to_json(F.struct(ORD))).alias(ORD), "source_url", "description")
    if not whole:
        return rows
    read = spark.read.schema(PROGRESS).parquet(*whole)
    return rows.unionByName(read.select(F.struct(F.col("_metadata.file_path").alias("version"), F.lit("").alias("at")).alias(ORD), "source_url", "description"))


def organization_sources(final: DataFrame) -> DataFrame:
    return organizations.organization_sources(organizations.organizations(final))


def write_final(enriched: DataFrame, progress: DataFrame, path: str, always: bool = False) -> bool:
    """Final models as a CSV table once every model has a description, or
    ``always``; tells whether it was written."""
    if not (always or descriptions.is_complete(enriched, progress)):
        return False
    write_csv(descriptions.final_models(enriched, progress), path, MODELS_ENRICHED)
    return True
