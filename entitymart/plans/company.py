"""From normalised company records to relationships, checks and counts."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.operators import analytics, entities, mentions, quality
from entitymart.operators.lookup import MAX_BROADCAST_BYTES
from entitymart.operators.ordering import ORD
from entitymart.schemas import ANALYTICS, RELATIONSHIPS
from entitymart.session import materialise
from entitymart.sources import jobs
from entitymart.sources.tables import write_csv


@dataclass
class Inputs:
    startups: DataFrame
    products: DataFrame
    papers: DataFrame
    news: DataFrame
    jobs: DataFrame
    models: DataFrame | None = None


@dataclass
class Outputs:
    entities: DataFrame
    mapped: DataFrame
    relationships: DataFrame
    quality: DataFrame
    relationship_quality: DataFrame
    relationship_counts: DataFrame
    analytics: DataFrame


@dataclass
class Linker:
    """The four kinds of links to one entity table.

    The table is written to the shared folder once, since each kind reads it;
    its names are checked for size once for both exact and both text links.
    """

    entities: DataFrame
    exact: entities.Names
    searched: mentions.MentionNames

    @classmethod
    def of(cls, startups: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> Linker:
        rows = materialise(entities.canonical_entities(startups), "entities")
        return cls(rows, entities.exact_names(rows, limit), mentions.searched_names(rows, limit))

    def links(self, inputs: Inputs, as_of: datetime, unique: bool) -> list[DataFrame]:
        """Product, job, paper and news links, in this order."""
        return [
            entities.link_products(inputs.products, self.exact, as_of, unique),
            entities.link_jobs(inputs.jobs, self.exact, as_of, unique),
            mentions.link_papers(inputs.papers, self.searched, as_of, unique),
            mentions.link_news(inputs.news, self.searched, as_of, unique),
        ]

    def mapped(self, inputs: Inputs, as_of: datetime) -> DataFrame:
        """All links before duplicates are removed, with the ordinal of their kind.

        The kinds' inputs may be ordered in different ways, so no common
        ``_ord`` is kept; rows of one entity, kind and url are equal anyway.
        """
        parts = self.links(inputs, as_of, unique=False)
        return reduce(
            DataFrame.unionByName, [p.drop(ORD).withColumn("kind", F.lit(i)) for i, p in enumerate(parts)]
        )

    def relationships(self, inputs: Inputs, as_of: datetime) -> DataFrame:
        """One link per entity, record type and url.

        Each record type comes from one kind of link, so kinds cannot collide.
        ``dedup.relationships`` is the general form for tables from elsewhere.
        """
        return reduce(DataFrame.unionByName, self.links(inputs, as_of, unique=True))


def count_relationships(relationships: DataFrame) -> DataFrame:
    """Entity counts of linked rows; the name is the same on every row of an entity."""
    return analytics.linked_analytics(relationships)


def run(inputs: Inputs, as_of: datetime) -> Outputs:
    """Link, check and count; any failure raises.

    The relationships are written to the shared folder once, since the checks
    and the counts both read them.
    """
    linker = Linker.of(inputs.startups)
    unique = materialise(linker.relationships(inputs, as_of), "relationships")
    datasets = {
        "STARTUPS": inputs.startups,
        "PRODUCTS": inputs.products,
        "RESEARCH PAPERS": inputs.papers,
        "NEWS": inputs.news,
        "JOBS": inputs.jobs,
    }
    if inputs.models is not None:
        datasets["MODELS"] = inputs.models
    return Outputs(
        entities=linker.entities,
        mapped=linker.mapped(inputs, as_of),
        relationships=unique,
        quality=quality.quality_report(datasets),
        relationship_quality=quality.relationship_report(unique),
        relationship_counts=analytics.relationship_counts(unique),
        analytics=count_relationships(unique),
    )


def run_with_intake(
    board_1: DataFrame, board_2: DataFrame, inputs: Inputs, as_of: datetime
) -> Outputs:
    """``run`` with the jobs taken fresh from the two boards' payloads; the other
    inputs are those collected before."""
    found = [jobs.board_1_jobs(board_1, as_of), jobs.board_2_jobs(board_2, as_of)]
    return run(replace(inputs, jobs=materialise(jobs.unique_jobs(found), "jobs")), as_of)


def write(outputs: Outputs, path: str) -> None:
    """Relationships and counts as CSV tables under ``path``."""
    write_csv(outputs.relationships, f"{path}/entity_relationships", RELATIONSHIPS)
    write_csv(outputs.analytics, f"{path}/entity_analytics", ANALYTICS)
