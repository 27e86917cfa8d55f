"""Job postings from landed JSON payloads.

A payload table has ``payload`` (one response body) and ``_ord``. Elements are
read as variants, so one odd element does not spoil its payload.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.dates import instant, is_fresh, parse_date, parse_iso
from entitymart.functions.rules import role_family, role_family_wide
from entitymart.functions.text import blank_if_null, first_filled, is_filled, let, strip
from entitymart.operators import dedup
from entitymart.operators.ordering import ORD


def get(item: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(item, f"$.{name}", kind)


def array_items(payloads: DataFrame, fields, path: str = "$") -> DataFrame:
    """One row per object in a payload's JSON array; other elements, and
    payloads that are no JSON or hold no such array, give nothing.

    ``fields(item)`` names the columns. They are made inside the array, so a
    filter on a parsed date does not have the date parsed again.
    """
    items = F.try_variant_get(F.try_parse_json("payload"), path, "array<variant>")
    is_object = lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    row = lambda v: F.when(is_object(v), F.struct(*[c.alias(n) for n, c in fields(v).items()]))
    rows = payloads.select(F.col(ORD).alias("_payload"), F.posexplode(F.transform(items, row)).alias("_pos", "_item"))
    return rows.filter("_item is not null").select(F.struct("_payload", "_pos").alias(ORD), "_item.*")


def _job(title: Column, company: Column, url: Column, published: Column, source: str, as_of) -> list[Column]:
    return [
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("JOB").alias("recordType"),
        company.alias("company"),
        published.alias("date"),
        F.lit(True).alias("is_remote"),
        role_family(title).alias("role_family"),
        title.alias("title"),
        F.lit(source).alias("source_name"),
        url.alias("source_url"),
        instant(as_of).alias("collectedAt"),
    ]


def _number(value: Column) -> Column:
    """A JSON number other than zero, else null."""
    is_number = F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(is_number, F.nullif(F.try_variant_get(value, "$", "double"), F.lit(0.0)))


def _stamp(value: Column, as_of: datetime) -> Column:
    """Seconds since 1970, or text."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(F.timestamp_seconds(_number(value)), parse_date(text, instant(as_of)))


def _is_truthy(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    is_text = F.coalesce(kind == "STRING", F.lit(False)) & is_filled(F.try_variant_get(value, "$", "string"))
    return is_text | _number(value).isNotNull()


def board_1_items(payloads: DataFrame, as_of: datetime) -> DataFrame:
    """Source 1: the payload is an array of postings, dated by ``date`` or else
    ``epoch``; a number is seconds since 1970."""

    def fields(item: Column) -> dict[str, Column]:
        date, epoch = get(item, "date", "variant"), get(item, "epoch", "variant")
        return {
            "title": get(item, "position"),
            "company": get(item, "company"),
            "url": get(item, "url"),
            "published": let(F.when(_is_truthy(date), date).otherwise(epoch), lambda v: _stamp(v, as_of)),
        }

    return array_items(payloads, fields)


def board_2_items(payloads: DataFrame, as_of: datetime) -> DataFrame:
    """Source 2: an object with postings under ``jobs``, dated by ``pubDate`` or else ``date``."""

    def fields(item: Column) -> dict[str, Column]:
        filled = lambda name: let(get(item, name), lambda v: first_filled(v))
        when = F.coalesce(filled("pubDate"), filled("date"))
        return {
            "title": get(item, "jobTitle"),
            "company": get(item, "companyName"),
            "url": get(item, "url"),
            "published": parse_date(when, instant(as_of)),
        }

    return array_items(payloads, fields, "$.jobs")


def board_3_items(payloads: DataFrame) -> DataFrame:
    """Source 3: an object with postings under ``jobs``; fields trimmed."""

    def fields(item: Column) -> dict[str, Column]:
        trimmed = {n: strip(blank_if_null(get(item, n))) for n in ("title", "company_name", "url")}
        return {
            **trimmed,
            "date": parse_iso(get(item, "publication_date")),
            "category": blank_if_null(get(item, "category")),
            "job_type": get(item, "job_type"),
            "candidate_required_location": get(item, "candidate_required_location"),
        }

    return array_items(payloads, fields, "$.jobs")


def board_1_jobs(payloads: DataFrame, as_of: datetime) -> DataFrame:
    """Fresh postings of source 1; a relative url gets the site in front."""
    rows = board_1_items(payloads, as_of).filter(is_filled(F.col("url")))
    absolute = F.when(F.startswith("url", F.lit("http")), F.col("url")).otherwise(
        F.concat(F.lit(fixed.BOARD_SITE), "url")
    )
    return _finish(rows.withColumn("url", absolute), fixed.BOARD_1, as_of)


def board_2_jobs(payloads: DataFrame, as_of: datetime) -> DataFrame:
    """Fresh postings of source 2."""
    return _finish(board_2_items(payloads, as_of), fixed.BOARD_2, as_of)


def _finish(rows: DataFrame, source: str, as_of: datetime) -> DataFrame:
    """Required fields, freshness, record columns."""
    c = F.col
    kept = rows.filter(is_filled(c("title")) & is_filled(c("url")) & is_fresh(c("published"), as_of))
    return kept.select(ORD, *_job(c("title"), c("company"), c("url"), c("published"), source, as_of))


def board_3_jobs(payloads: DataFrame, as_of: datetime) -> DataFrame:
    """Source 3: trimmed fields, nested content, first posting per url."""
    rows = board_3_items(payloads)
    kept = rows.filter(
        is_filled(F.col("title")) & is_filled(F.col("url")) & is_fresh(F.col("date"), as_of)
    )
    return dedup.jobs_by_lower_url(kept.withColumnRenamed("url", "source_url")).select(
        ORD,
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("JOB").alias("recordType"),
        F.lit(fixed.BOARD_3).alias("source_name"),
        "source_url",
        F.struct(
            F.col("company_name").alias("company"),
            "title",
            "date",
            F.lit(True).alias("is_remote"),
            role_family_wide(F.col("title")).alias("role_family"),
            "category",
            "job_type",
            "candidate_required_location",
        ).alias("content"),
        instant(as_of).alias("collectedAt"),
    )


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """All records of all sources, later sources after earlier ones."""
    out = None
    for i, df in enumerate(sources):
        part = df.withColumn("_source", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def unique_jobs(sources: list[DataFrame]) -> DataFrame:
    """Last job per url over all sources."""
    return dedup.by_source_url(union_sources(sources), order=["_source", ORD]).drop("_source")
