"""Resumable generation of model descriptions by a user's function."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.functions.text import blank_if_null, is_present, strip
from entitymart.operators.dedup import keep_one
from entitymart.operators.ordering import ORD
from entitymart.schemas import FAILED, MODELS_ENRICHED, columns


def finished(progress: DataFrame) -> DataFrame:
    """Last finished description per url; rows lacking either are ignored."""
    both = is_present(F.col("source_url")) & is_present(F.col("description"))
    rows = progress.filter(both).select(
        ORD, *[strip(F.col(c)).alias(c) for c in ("source_url", "description")]
    )
    return keep_one(rows, ["source_url"], "last", blank="keep").select(
        ORD, "source_url", "description"
    )


def pending(models: DataFrame, done: DataFrame) -> DataFrame:
    """Models whose url has no finished description."""
    rows = models.withColumn("source_url", strip(blank_if_null(F.col("source_url"))))
    return rows.join(done.select("source_url"), "source_url", "left_anti")


def with_prompt(rows: DataFrame, prompt: Column) -> DataFrame:
    return rows.withColumn("prompt", prompt)


def generate(rows: DataFrame, generator: Callable[[pd.Series], Iterable[str]]) -> DataFrame:
    """Apply ``generator`` to batches of prompts; adds ``generated``, trimmed.

    The function runs in Python on executors, one Arrow batch at a time; only
    the order and the prompt travel there with the names of the model.
    """
    kept = [ORD, *columns(FAILED)]
    sent = rows.select(*kept, "prompt")

    def run(batches):
        for batch in batches:
            texts = pd.Series(list(generator(batch["prompt"])), index=batch.index, dtype="object")
            yield batch[kept].assign(generated=texts.fillna("").astype(str).str.strip())

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema if f.name != "prompt")
    return sent.mapInPandas(run, f"{fields}, generated string")


def successes(results: DataFrame) -> DataFrame:
    """First non-empty result per url."""
    return keep_one(results.filter("generated <> ''"), ["source_url"], "first", blank="keep").select(
        ORD, "source_url", F.col("generated").alias("description")
    )


def merged_progress(done: DataFrame, new: DataFrame) -> DataFrame:
    """Finished descriptions with the new ones; write it to a new version, the
    table being read cannot be replaced."""
    cols = ["source_url", "description"]
    return done.select(cols).unionByName(new.select(cols))


def failures(results: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of this run without a result: no earlier row of the same url had one."""
    first = new.select("source_url", F.col(ORD).alias("_success"))
    empty = results.filter("generated = ''")
    joined = empty.join(first, "source_url", "left")
    return joined.filter(F.col("_success").isNull() | (F.col(ORD) < F.col("_success"))).select(
        ORD, *columns(FAILED)
    )


def final_models(models: DataFrame, done: DataFrame) -> DataFrame:
    """Models with the finished description, blank where there is none."""
    rows = models.withColumn("source_url", strip(blank_if_null(F.col("source_url")))).drop("description")
    joined = rows.join(done.select("source_url", "description"), "source_url", "left")
    return joined.withColumn("description", blank_if_null(F.col("description"))).select(
        ORD, *columns(MODELS_ENRICHED)
    )


def progress_summary(models: DataFrame, done: DataFrame) -> DataFrame:
    """One row: models, finished urls, their difference, and whether it is zero.

    Finished urls that no model has count as well, so the difference can be off
    or negative; duplicate urls keep it from ever closing.
    """
    n, d = models.agg(F.count(F.lit(1)).alias("total")), done.agg(F.count(F.lit(1)).alias("done"))
    counts = n.select("total", F.lit(0).cast("bigint").alias("done")).unionByName(
        d.select(F.lit(0).cast("bigint").alias("total"), "done")
    )
    return counts.agg(F.sum("total").alias("total"), F.sum("done").alias("done")).select(
        "total",
        "done",
        (F.col("total") - F.col("done")).alias("remaining"),
        (F.col("total") == F.col("done")).alias("complete"),
    )


def is_complete(models: DataFrame, done: DataFrame) -> bool:
    """Completion gate of the final table."""
    return progress_summary(models, done).first()["complete"]
