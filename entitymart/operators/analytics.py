"""Counts over relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.text import blank_if_null, is_present, strip
from entitymart.operators.ordering import ORD

COUNTS = {
    "productCount": fixed.HAS_PRODUCT,
    "jobCount": fixed.HAS_JOB,
    "researchMentionCount": fixed.MENTIONED_IN_RESEARCH,
    "newsMentionCount": fixed.MENTIONED_IN_NEWS,
}


def _stripped(c: str):
    return strip(blank_if_null(F.col(c)))


def _total() -> Column:
    return sum((F.col(n) for n in list(COUNTS)[1:]), F.col(list(COUNTS)[0]))


def named_counts(relationships: DataFrame, *more: Column) -> DataFrame:
    """Four counts per entity id and name, and the greatest of further columns.

    Rows are counted as they are written first, so that names and types are stripped once per
    spelling; both steps hold only numbers and hash and combine map-side.
    """
    spelled = relationships.groupBy("entityId", "entityName", "relationshipType").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(f"_max_{i}") for i, c in enumerate(more)]
    )
    rows = spelled.filter(is_present(F.col("entityId"))).withColumns(
        {"entityId": _stripped("entityId"), "entityName": _stripped("entityName"), "_type": _stripped("relationshipType")}
    )
    counts = [F.coalesce(F.sum(F.when(F.col("_type") == t, F.col("_n"))), F.lit(0)).alias(n) for n, t in COUNTS.items()]
    return rows.groupBy("entityId", "entityName").agg(*counts, *[F.max(f"_max_{i}").alias(f"_max_{i}") for i in range(len(more))])


def entity_analytics(relationships: DataFrame) -> DataFrame:
    """Four counts and their total per entity; the name is the last one seen.

    Counted per (entity, name) first, which leaves a table of a few rows per
    entity from which the last name is taken.
    """
    return (
        named_counts(relationships, F.col(ORD))
        .groupBy("entityId")
        .agg(F.max_by("entityName", "_max_0").alias("entityName"), *[F.sum(n).alias(n) for n in COUNTS])
        .withColumn("totalRelationships", _total())
    )


def linked_analytics(relationships: DataFrame) -> DataFrame:
    """``entity_analytics`` of rows on which an entity always has one name: no second step."""
    return named_counts(relationships).withColumn("totalRelationships", _total())


def relationship_counts(relationships: DataFrame) -> DataFrame:
    """Rows per relationship type, blank left out, sorted by type."""
    return (
        relationships.filter(is_present(F.col("relationshipType")))
        .select(_stripped("relationshipType").alias("relationshipType"))
        .groupBy("relationshipType")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("relationshipType")
    )


def mapped_counts(relationships: DataFrame) -> DataFrame:
    """Mapped rows per relationship type before removal of duplicates, one row."""
    return relationships.agg(
        *[F.count_if(F.col("relationshipType") == t).alias(n) for n, t in COUNTS.items()],
        F.count(F.lit(1)).alias("mappedRows"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, object]:
    """Count rows while they pass, without a second scan."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
