"""Data-quality checks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.functions.text import blank_if_null, is_present, strip


@dataclass(frozen=True)
class Rule:
    dataset: str
    required: tuple[str, ...]
    unique: str


# Required columns and unique column of each dataset.
RULES = [
    Rule("STARTUPS", ("entityName", "source_url"), "entityName"),
    Rule("PRODUCTS", ("productName", "startupName", "source_url"), "productName"),
    Rule("RESEARCH PAPERS", ("title", "source_url"), "paper_url"),
    Rule("NEWS", ("title", "source_url"), "source_url"),
    Rule("JOBS", ("company", "title", "source_url"), "source_url"),
    Rule(
        "MODELS",
        ("model_name", "organization", "source_url", "official_website", "logo_url", "description"),
        "source_url",
    ),
]

NUMBER = r"^[+-]?(\d(_?\d)*\.?|(\d(_?\d)*)?\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"
NOT_A_NUMBER = r"(?i)^[+-]?nan$"


def missing_cells(df: DataFrame, required: tuple[str, ...]) -> Column:
    """Aggregate: blank cells in required columns; an absent column is blank on every row."""
    cells = [
        (~is_present(F.col(c).cast("string"))).cast("bigint") if c in df.columns else F.lit(1).cast("bigint")
        for c in required
    ]
    return F.coalesce(F.sum(reduce(lambda a, b: a + b, cells)), F.lit(0))


def duplicate_values(df: DataFrame, column: str) -> Column:
    """Aggregate: non-blank values beyond the first of each, case and outer space ignored."""
    if column not in df.columns:
        return F.lit(0).cast("bigint")
    value = F.nullif(F.lower(strip(F.col(column).cast("string"))), F.lit(""))
    return F.count(value) - F.count_distinct(value)


def _status(count: str) -> Column:
    return F.when(F.col(count) == 0, "PASS").when(F.col(count) > 0, "CHECK")


def dataset_report(df: DataFrame, rule: Rule) -> DataFrame:
    """One row: rows, missing cells, duplicates, and a status for each; an empty
    dataset reports its row count only."""
    rows = F.count(F.lit(1))
    checked = df.agg(
        rows.alias("rows"),
        F.when(rows > 0, missing_cells(df, rule.required)).alias("missing"),
        F.when(rows > 0, duplicate_values(df, rule.unique)).alias("duplicates"),
    )
    return checked.select(
        F.lit(rule.dataset).alias("dataset"),
        "rows",
        "missing",
        "duplicates",
        _status("missing").alias("required_status"),
        _status("duplicates").alias("duplicate_status"),
    )


def quality_report(datasets: dict[str, DataFrame], rules: list[Rule] | None = None) -> DataFrame:
    """A report row for each dataset that has a rule."""
    reports = [dataset_report(datasets[r.dataset], r) for r in rules or RULES if r.dataset in datasets]
    return reduce(DataFrame.unionByName, reports)


def is_invalid_confidence(c: Column) -> Column:
    """Not a number, or outside [0, 1]; NaN is accepted."""
    text = strip(blank_if_null(c.cast("string")))
    value = F.when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
    inside = F.coalesce(value.between(0.0, 1.0), F.lit(False))
    return ~(text.rlike(NOT_A_NUMBER) | inside)


def relationship_report(relationships: DataFrame) -> DataFrame:
    """One row: relationships, invalid confidences, status. The rows per type
    are ``analytics.relationship_counts``."""
    total = F.count(F.lit(1))
    return relationships.agg(
        total.alias("relationships"),
        F.when(total > 0, F.count_if(is_invalid_confidence(F.col("confidence")))).alias(
            "invalid_confidence"
        ),
    ).withColumn("confidence_status", _status("invalid_confidence"))
