"""Organisations of models: counts and official sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.text import blank_if_null, collapse, is_present, settled, strip
from entitymart.functions.urls import favicon, is_official_site, organization_key
from entitymart.operators.dedup import keep_one
from entitymart.operators.ordering import ORD


def organization_counts(models: DataFrame) -> DataFrame:
    """Models per organisation, letter case ignored, most first; the name is the
    first spelling seen and decides ties by its place.

    Counted per spelling first, with numbers only, so it hashes and combines
    map-side; the few spellings of each name are merged after that.
    """
    named = models.filter(is_present(F.col("organization")))
    rows = named.select(ORD, collapse(F.col("organization")).alias("organization"))
    spelled = rows.groupBy("organization").agg(
        F.count(F.lit(1)).alias("n"), F.min(ORD).alias("seen")
    )
    merged = spelled.groupBy(F.lower("organization").alias("key")).agg(
        F.min_by("organization", "seen").alias("organization"),
        F.sum("n").alias("model_count"),
        F.min("seen").alias("seen"),
    )
    return merged.orderBy(F.desc("model_count"), F.asc("seen")).select(
        "organization",
        "model_count",
        F.lit("").alias("official_website"),
        F.lit("").alias("logo_url"),
    )


def exact_organization_counts(models: DataFrame) -> DataFrame:
    """Models per organisation as spelled, with the place of the first one."""
    named = models.filter(is_present(F.col("organization")))
    rows = named.select(ORD, strip(F.col("organization")).alias("organization"))
    return rows.groupBy("organization").agg(
        F.count(F.lit(1)).alias("model_count"), F.min(ORD).alias("seen")
    )


def top_organizations(models: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` organisations with most models; ties by first place."""
    return (
        exact_organization_counts(models)
        .orderBy(F.desc("model_count"), F.asc("seen"))
        .limit(n)
        .drop("seen")
    )


def distinct_organizations(models: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of organisations as spelled, blank left out."""
    name = F.nullif(strip(F.col("organization")), F.lit(""))
    count = F.approx_count_distinct(name) if approximate else F.count_distinct(name)
    return models.agg(count.alias("organizations"))


def organizations(models: DataFrame) -> DataFrame:
    """First model row per organisation after alias resolution."""
    rows = models.filter(is_present(F.col("organization"))).select(
        ORD,
        strip(F.col("organization")).alias("organization"),
        strip(blank_if_null(F.col("source_url"))).alias("model_url"),
    )
    keyed = rows.select("*", settled(organization_key(F.col("organization"))).alias("key"))
    return keep_one(keyed, ["key"], "first")


def known_sites(spark) -> DataFrame:
    """Known official sites; a constant table of fixed size."""
    return spark.createDataFrame(list(fixed.KNOWN_SITES.items()), "key string, known_site string")


def organization_sources(organization_rows: DataFrame) -> DataFrame:
    """Official site of each organisation: a known and acceptable site, else its
    model page on the hub, else nothing."""
    joined = organization_rows.join(
        F.broadcast(known_sites(organization_rows.sparkSession)), "key", "left"
    )
    verified = is_official_site(F.col("known_site"))
    primary = F.contains("model_url", F.lit("huggingface.co/"))

    def pick(when_verified, when_primary, name: str):
        return (
            F.when(verified, when_verified).when(primary, when_primary).otherwise(F.lit("")).alias(name)
        )

    status = F.when(verified, fixed.VERIFIED).when(primary, fixed.PRIMARY).otherwise(fixed.UNVERIFIED)
    return joined.select(
        ORD,
        "organization",
        pick(F.col("known_site"), F.col("model_url"), "official_website"),
        pick(favicon(F.col("known_site")), F.lit(fixed.HUB_LOGO), "logo_url"),
        status.alias("verification_status"),
        pick(F.lit(fixed.VERIFIED_BY), F.lit(fixed.PRIMARY_BY), "source_type"),
    )


def verification_counts(sources: DataFrame) -> DataFrame:
    """One row: organisations, and how many have each status."""
    status = F.col("verification_status")
    return sources.agg(
        F.count(F.lit(1)).alias("organizations"),
        F.count_if(status == fixed.VERIFIED).alias("verified"),
        F.count_if(status == fixed.PRIMARY).alias("primary"),
        F.count_if(status == fixed.UNVERIFIED).alias("unverified"),
    )
