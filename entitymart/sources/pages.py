"""Companies and products from landed web pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.dates import instant
from entitymart.functions.html import decode_entities, visible_text
from entitymart.functions.rules import pricing_model
from entitymart.functions.text import collapse, is_filled, is_present
from entitymart.operators import dedup
from entitymart.operators.ordering import ORD, first_rows

ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["']/companies/[^>]*>.*?</a\s*>"""
HREF = r"""(?is)href\s*=\s*["']([^"']*)["']"""
DESCRIPTION_SIZE = 1000


def company_links(pages: DataFrame) -> DataFrame:
    """Links into the company directory: ``href`` and the link's text."""
    anchors = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))
    return pages.select(F.col(ORD).alias("_page"), F.posexplode(anchors).alias("_pos", "a")).select(
        F.struct("_page", "_pos").alias(ORD),
        decode_entities(F.regexp_extract("a", HREF, 1)).alias("href"),
        visible_text(F.col("a")).alias("name"),
    )


def _startups(links: DataFrame, as_of: datetime) -> DataFrame:
    rows = links.select(
        ORD,
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("STARTUP").alias("recordType"),
        F.lit(fixed.DIRECTORY).alias("source_name"),
        F.concat(F.lit(fixed.DIRECTORY_SITE), F.col("path")).alias("source_url"),
        F.col("name").alias("entityName"),
        F.lit(None).cast("bigint").alias("employeeCount"),
        instant(as_of).alias("collectedAt"),
    )
    return dedup.by_source_url(rows)


def _path() -> Column:
    return F.split_part("href", F.lit("?"), F.lit(1))


def is_company_link() -> Column:
    """A company's page: named, below the directory, and no navigation link."""
    return (
        F.startswith(_path(), F.lit("/companies/"))
        & (F.regexp_replace(_path(), "/+$", "") != "/companies")
        & is_present(F.col("name"))
        & ~F.lower(collapse(F.col("name"))).isin(fixed.NAVIGATION)
    )


def startups(links: DataFrame, as_of: datetime) -> DataFrame:
    """Startup records, the last link per company; navigation links are left out
    and trailing slashes cut."""
    path = F.regexp_replace(_path(), "/+$", "")
    kept = links.filter(is_company_link())
    return _startups(kept.select(ORD, collapse(F.col("name")).alias("name"), path.alias("path")), as_of)


def startups_plain(links: DataFrame, as_of: datetime) -> DataFrame:
    """As ``startups``, with trailing slashes kept and only the directory itself left out."""
    kept = links.filter((_path() != "/companies/") & is_present(F.col("name")))
    return _startups(kept.select(ORD, collapse(F.col("name")).alias("name"), _path().alias("path")), as_of)


def products(
    startup_rows: DataFrame, pages: DataFrame, as_of: datetime, n: int | None = None
) -> DataFrame:
    """Nested product records from the pages of all startups, or of the first ``n``.

    The label rules read the whole text; the description keeps its start.
    """
    chosen = first_rows(startup_rows, n) if n is not None else startup_rows
    page = pages.select(F.col("url").alias("source_url"), "html")
    # the pages are the large side: only those of chosen startups are parsed
    joined = page.join(chosen.select(ORD, "source_url", "entityName"), "source_url")
    joined = joined.withColumn("text", visible_text(F.col("html"))).filter(is_filled(F.col("text")))
    return joined.select(
        ORD,
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("PRODUCT").alias("recordType"),
        F.struct(F.lit(fixed.DIRECTORY).alias("name"), F.col("source_url").alias("url")).alias("source"),
        F.struct(
            F.col("entityName").alias("productName"),
            F.col("entityName").alias("startupName"),
            F.substring("text", 1, DESCRIPTION_SIZE).alias("productDescription"),
            pricing_model(F.col("text")).alias("pricingModel"),
        ).alias("content"),
        instant(as_of).alias("collectedAt"),
    )
