"""Canonical company entities and the exact-name links to them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.dates import instant
from entitymart.functions.text import blank_if_null, is_present, match_key, settled, strip
from entitymart.operators.dedup import keep_one
from entitymart.operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join
from entitymart.operators.ordering import ORD, with_position


def entity_id(position: Column) -> Column:
    """``STARTUP-0001``; wider when the number needs it."""
    return F.format_string("STARTUP-%04d", position)


def canonical_entities(startups: DataFrame) -> DataFrame:
    """One entity per startup row with a name; the id is the row's position.

    Rows without a name take up a number but give no entity.
    """
    rows = with_position(startups.select(ORD, "entityName", "source_url"))
    return rows.filter(is_present(F.col("entityName"))).select(
        entity_id(F.col("position")).alias("entityId"),
        strip(F.col("entityName")).alias("entityName"),
        match_key(strip(F.col("entityName"))).alias("normalizedName"),
        F.lit("STARTUP").alias("entityType"),
        F.col("source_url").alias("startupUrl"),
        "position",
    )


def name_lookup(entities: DataFrame) -> DataFrame:
    """One entity per name for exact links: the last one wins."""
    return keep_one(entities, ["normalizedName"], "last", order=["position"])


def mention_names(entities: DataFrame) -> DataFrame:
    """One entity per name for text mentions: the first one wins.

    Single words of under five characters are not searched for.
    """
    name = F.col("normalizedName")
    long_enough = F.contains(name, F.lit(" ")) | (F.length(name) >= 5)
    return keep_one(entities.filter(long_enough), ["normalizedName"], "first", order=["position"])


def relationship(
    record_type: str, relationship_type: str, url: Column, confidence: float, as_of: datetime
) -> list[Column]:
    """The columns of a relationship, from a joined entity and record."""
    return [
        F.col("entityId"),
        F.col("entityName"),
        F.col("entityType"),
        F.lit(record_type).alias("recordType"),
        F.lit(relationship_type).alias("relationshipType"),
        url.alias("source_url"),
        F.lit(confidence).alias("confidence"),
        instant(as_of).alias("mappedAt"),
    ]


@dataclass(frozen=True)
class Names:
    """Names to link to, and whether they were found to fit a broadcast."""

    lookup: DataFrame
    small: bool


def exact_names(entities: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> Names:
    """The lookup of exact links, with its size checked."""
    lookup = name_lookup(entities).select("normalizedName", "entityId", "entityName", "entityType")
    return Names(lookup, fits_broadcast(lookup, limit))


def link_by_name(
    records: DataFrame,
    name: str,
    names: Names,
    record_type: str,
    relationship_type: str,
    as_of: datetime,
    unique: bool = False,
) -> DataFrame:
    """Relationships of records whose name column equals an entity's name.

    The lookup has no blank name, so records without a name drop out in the
    join. ``unique`` keeps one per entity and url, and no ``_ord``.
    """
    facts = records.select(
        ORD,
        settled(match_key(F.col(name))).alias("normalizedName"),
        blank_if_null(F.col("source_url")).alias("source_url"),
    )
    joined = lookup_join(facts, names.lookup, ["normalizedName"], [ORD], small=names.small)
    return finish_links(joined, record_type, relationship_type, fixed.EXACT, as_of, unique)


def finish_links(
    joined: DataFrame, record_type: str, relationship_type: str, confidence: float, as_of: datetime, unique: bool
) -> DataFrame:
    """Joined entities and records as relationships.

    All columns of one kind of link follow from entity and url. One row for each
    pair is therefore the same as the last of its rows; equal pairs are removed
    on the varying columns alone, which hashes and combines map-side.
    """
    varying = ["entityId", "entityName", "entityType", "source_url"]
    rows = joined.select(varying).distinct() if unique else joined.select(*varying, ORD)
    columns = relationship(record_type, relationship_type, F.col("source_url"), confidence, as_of)
    return rows.select(*columns, *([] if unique else [ORD]))


def link_products(products: DataFrame, names: Names, as_of: datetime, unique: bool = False) -> DataFrame:
    return link_by_name(products, "startupName", names, "PRODUCT", fixed.HAS_PRODUCT, as_of, unique)


def link_jobs(jobs: DataFrame, names: Names, as_of: datetime, unique: bool = False) -> DataFrame:
    return link_by_name(jobs, "company", names, "JOB", fixed.HAS_JOB, as_of, unique)
