"""Research papers from landed Atom feeds and listing pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.dates import instant
from entitymart.functions.html import content, decode_entities, fragment_text
from entitymart.functions.text import (
    blank_if_null, collapse, search_keywords, strip,
)
from entitymart.functions.urls import repository_from_url, repository_in_text, repository_url
from entitymart.operators import dedup
from entitymart.operators.ordering import ORD

ENTRY = """entry array<struct<id: string, title: string, summary: string, published: string,
    updated: string, author: array<struct<name: string>>, link: array<struct<_href: string>>>>"""
TARGET = 1000


def paper_entries(feeds: DataFrame) -> DataFrame:
    """One row per entry of each feed."""
    entries = F.from_xml("payload", ENTRY, {"ignoreNamespace": "true"})["entry"]
    return feeds.select(F.col(ORD).alias("_feed"), F.posexplode(entries).alias("_pos", "e")).select(
        F.struct("_feed", "_pos").alias(ORD), "e"
    )


def papers(feeds: DataFrame, as_of: datetime) -> DataFrame:
    """Papers with an abstract page; the first repository url of the summary is theirs."""
    e = lambda name: blank_if_null(F.col(f"e.{name}"))
    abstract = F.get(
        F.filter(F.col("e.link"), lambda x: F.contains(x["_href"], F.lit("/abs/"))), F.lit(0)
    )["_href"]
    names = F.transform(F.col("e.author"), lambda a: strip(blank_if_null(a["name"])))
    url = blank_if_null(abstract)
    return paper_entries(feeds).filter(abstract.isNotNull()).select(
        ORD,
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("RESEARCH_PAPER").alias("recordType"),
        F.lit(fixed.PAPER_ARCHIVE).alias("source_name"),
        url.alias("source_url"),
        collapse(e("title")).alias("title"),
        F.coalesce(F.filter(names, lambda n: n != ""), F.array().cast("array<string>")).alias("authors"),
        url.alias("paper_url"),
        repository_url(repository_in_text(collapse(e("summary")))).alias("github_url"),
        F.lit(None).cast("bigint").alias("github_stars"),
        strip(e("published")).alias("published_date"),
        strip(e("updated")).alias("updated_date"),
        instant(as_of).alias("collectedAt"),
    )


def newest_papers(records: DataFrame, n: int = TARGET) -> DataFrame:
    """The newest ``n`` papers, one per url; equal dates in arrival order."""
    return dedup.papers(records).orderBy(F.desc("published_date"), F.asc(ORD)).limit(n)


def with_stars(records: DataFrame, repositories: DataFrame) -> DataFrame:
    """Star count of each paper's repository; without one it stays null."""
    lookup = repositories.select(
        F.col("full_name").alias("_repository"), F.col("stargazers_count").alias("_stars")
    )
    keyed = records.withColumn("_repository", repository_from_url(F.col("github_url")))
    joined = keyed.join(lookup, "_repository", "left")
    return joined.withColumn("github_stars", F.col("_stars")).drop("_repository", "_stars").select(
        *records.columns
    )


def papers_by_id(feeds: DataFrame) -> DataFrame:
    """Papers known by their feed id, authors as one text; no duplicates removed.
    An absent node gives null, an empty one an empty text."""
    text = lambda name: strip(F.col(f"e.{name}"))
    names = F.filter(F.transform(F.col("e.author"), lambda a: strip(a["name"])), lambda n: n.isNotNull())
    return paper_entries(feeds).select(
        ORD,
        collapse(F.col("e.title")).alias("title"),
        blank_if_null(F.array_join(names, ", ")).alias("authors"),
        text("id").alias("paper_url"),
        text("published").alias("published_date"),
        text("updated").alias("updated_date"),
    )


def best_repositories(results: DataFrame) -> DataFrame:
    """The starred-most search result per keyword text, the earliest among equals."""
    return dedup.keep_one(
        results, ["keywords"], "first", best=[F.desc_nulls_last("stargazers_count")]
    ).select("keywords", "html_url", "stargazers_count")


def searched_papers(records: DataFrame, results: DataFrame, as_of: datetime) -> DataFrame:
    """Paper rows with the best repository found for the title's first words."""
    # a blank title finds nothing; as null its rows are not gathered under one key
    keyed = records.withColumn("keywords", F.nullif(search_keywords(F.col("title")), F.lit("")))
    # about one result per paper: a plain join, adaptive execution sees to size and skew
    joined = keyed.join(best_repositories(results), "keywords", "left")
    return joined.select(
        ORD,
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("RESEARCH_PAPER").alias("recordType"),
        "title",
        "authors",
        "paper_url",
        F.col("html_url").alias("github_url"),
        F.col("stargazers_count").alias("github_stars"),
        "published_date",
        "updated_date",
        F.lit(fixed.PAPER_ARCHIVE).alias("source"),
        instant(as_of).alias("collected_at"),
    )


def listed_papers(pages: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` papers of each listing page: url, title and authors."""
    listing = content(F.col("html"), r"""<dl\s[^>]*?id\s*=\s*["']?articles(?:["'\s][^>]*)?>""", "dl")
    pair = r"(?is)<dt(?:\s[^>]*)?>.*?</dt\s*>\s*<dd(?:\s[^>]*)?>.*?</dd\s*>"
    pairs = F.slice(F.regexp_extract_all(listing, F.lit(pair), F.lit(0)), 1, n)

    def attribute(tag: Column, name: str) -> Column:
        return F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*["']([^"']*)["']""", 1)

    def part(css: str) -> Column:
        return content(F.col("pair"), rf"""<div\s[^>]*class\s*=\s*["'][^"']*\b{css}\b[^"']*["'][^>]*>""", "div")

    link = F.regexp_extract(
        F.col("pair"), r"""(?is)<a\s[^>]*title\s*=\s*["']Abstract["'][^>]*>""", 0
    )
    authors = F.transform(
        F.regexp_extract_all(part("list-authors"), F.lit(r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>"), F.lit(1)),
        fragment_text,
    )
    return pages.select(F.col(ORD).alias("_page"), F.posexplode(pairs).alias("_pos", "pair")).select(
        F.struct("_page", "_pos").alias(ORD),
        F.concat(F.lit(fixed.LISTING_SITE), decode_entities(attribute(link, "href"))).alias("paper_url"),
        strip(F.replace(fragment_text(part("list-title")), F.lit("Title:"), F.lit(""))).alias("title"),
        authors.alias("authors"),
    )
