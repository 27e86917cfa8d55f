"""Entities, links, checks and counts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from entitymart.functions.text import match_key, mention_text, record_url
from entitymart.operators import analytics, dedup, entities, mentions, quality
from entitymart.operators.ordering import ORD, first_rows, with_position
from entitymart.plans import company
from entitymart.sources import feeds, papers
from entitymart.sources.jobs import union_sources
from workload.inputs import JOBS_AS_OF, NEWS_AS_OF
from workload.records import NEWS_RECORDS, all_feed_items
from workload.registry import query
from workload.sqlkit import FRESH_JOB, URL_1, job_links_of, key, news_links_of, paper_links_of, q, sql, strip

LINK = ["entityId", "entityName", "entityType", "recordType", "relationshipType", "source_url", "confidence"]
ALL = ", ".join(f'"{c}"' for c in LINK)
ENTITY = '"entityId", "entityName", "normalizedName", "entityType", "startupUrl"'


def all_inputs(i):
    return company.Inputs(i.startups, i.products, i.papers, i.news, i.jobs)


def entity_rows(i):
    return entities.canonical_entities(i.startups)


def exact(i):
    return entities.exact_names(entity_rows(i))


def searched(i):
    return mentions.searched_names(entity_rows(i))


@query("rk1_entity_ids", sql('SELECT "entityId", source_url FROM (SELECT printf(\'STARTUP-%04d\', position) AS "entityId", source_url FROM positions)'))
def rk1(i):
    return with_position(i.startups).select(entities.entity_id(F.col("position")).alias("entityId"), "source_url")


@query("prj17_canonical_entities", sql(f"SELECT {ENTITY} FROM entities"))
def prj17(i):
    return entity_rows(i).drop("position")


@query("dd10_name_lookup", sql(f"SELECT {ENTITY} FROM name_lookup"))
def dd10(i):
    return entities.name_lookup(entity_rows(i)).drop("position")


@query("dd11_first_names", sql(f'SELECT {ENTITY} FROM entities WHERE "normalizedName" <> \'\' QUALIFY row_number() OVER (PARTITION BY "normalizedName" ORDER BY position) = 1'))
def dd11(i):
    return dedup.keep_one(entity_rows(i), ["normalizedName"], "first", order=["position"]).drop("position")


@query("flt6_mention_names", sql(f"SELECT {ENTITY} FROM mention_names"))
def flt6(i):
    return entities.mention_names(entity_rows(i)).drop("position")


@query("srt1_names_by_length", sql('SELECT "normalizedName", length("normalizedName") AS len, row_number() OVER (ORDER BY length("normalizedName") DESC, position) AS place FROM entities'))
def srt1(i):
    """The place of each entity when longer names come first."""
    rows = entity_rows(i).select("normalizedName", F.length("normalizedName").alias("len"), "position")
    # longer names get smaller order values, equal ones follow their position
    longest = F.lit(1 << 20).cast("bigint")
    order = rows.withColumn(ORD, F.shiftleft(longest - F.col("len").cast("bigint"), 32) + F.col("position"))
    return with_position(order, "place").select("normalizedName", "len", "place")


@query("jn1_products_to_entities", sql(f"SELECT {ALL} FROM product_links"))
def jn1(i):
    return entities.link_products(i.products, exact(i), JOBS_AS_OF).select(LINK)


@query("jn2_jobs_to_entities", sql(f"SELECT {ALL} FROM job_links"))
def jn2(i):
    return entities.link_jobs(i.jobs, exact(i), JOBS_AS_OF).select(LINK)


@query("jn3_paper_mentions", sql(f"SELECT {ALL} FROM paper_links"))
def jn3_papers(i):
    return mentions.link_papers(i.papers, searched(i), NEWS_AS_OF).select(LINK)


@query("jn3_news_mentions", sql(f"SELECT {ALL} FROM news_links"))
def jn3_news(i):
    return mentions.link_news(i.news, searched(i), NEWS_AS_OF).select(LINK)


@query(
    "rk2_longest_mention",
    sql(
        'SELECT r._ord AS record, e."normalizedName", length(e."normalizedName") AS len, e."entityId" FROM '
        f"(SELECT _ord, {key(chr(34) + 'content' + chr(34))} AS k FROM news) r "
        "JOIN mention_names e ON contains(' ' || r.k || ' ', ' ' || e.\"normalizedName\" || ' ') "
        'QUALIFY row_number() OVER (PARTITION BY r._ord ORDER BY length(e."normalizedName") DESC, e.position) = 1'
    ),
)
def rk2(i):
    texts = i.news.select(ORD, F.col("content").alias("text"))
    hits = mentions.longest_mentions(texts, searched(i))
    return hits.select(
        F.col(ORD).alias("record"), "normalizedName", F.length("normalizedName").cast("bigint").alias("len"), "entityId"
    )


@query("prj16_relationship_records", sql(f"SELECT {ALL}, '1998-10-03 00:00:00' AS \"mappedAt\" FROM job_links"))
def prj16(i):
    linked = entities.link_jobs(i.jobs, exact(i), JOBS_AS_OF)
    return linked.select(*LINK, F.date_format("mappedAt", "yyyy-MM-dd HH:mm:ss").alias("mappedAt"))


@query("set2_all_relationships", sql(f"SELECT {ALL} FROM mapped"))
def set2(i):
    return company.Linker.of(i.startups).mapped(all_inputs(i), NEWS_AS_OF).select(LINK)


@query("dd1_unique_relationships", sql(f"SELECT {ALL} FROM relationships"))
def dd1(i):
    return company.Linker.of(i.startups).relationships(all_inputs(i), NEWS_AS_OF).select(LINK)


@query(
    "dd1_last_relationship",
    sql(
        'SELECT "entityId", "recordType", source_url, "entityName", confidence FROM relationship_rows '
        'QUALIFY row_number() OVER (PARTITION BY "entityId", "recordType", source_url ORDER BY _ord DESC) = 1'
    ),
)
def dd1_last(i):
    kept = dedup.relationships(i.relationship_rows)
    return kept.select("entityId", "recordType", "source_url", "entityName", "confidence")


COUNTS = (
    'count(*) FILTER (t = \'HAS_PRODUCT\') AS "productCount", count(*) FILTER (t = \'HAS_JOB\') AS "jobCount", '
    'count(*) FILTER (t = \'MENTIONED_IN_RESEARCH\') AS "researchMentionCount", '
    'count(*) FILTER (t = \'MENTIONED_IN_NEWS\') AS "newsMentionCount", '
    "count(*) FILTER (t IN ('HAS_PRODUCT', 'HAS_JOB', 'MENTIONED_IN_RESEARCH', 'MENTIONED_IN_NEWS')) "
)


@query(
    "ag1_entity_analytics",
    sql(
        f'SELECT "entityId", arg_max(name, _ord) AS "entityName", {COUNTS} AS "totalRelationships" FROM '
        f'(SELECT {strip(chr(34) + "entityId" + chr(34))} AS "entityId", {strip(chr(34) + "entityName" + chr(34))} AS name, '
        f'{strip(chr(34) + "relationshipType" + chr(34))} AS t, _ord FROM relationship_rows) '
        'WHERE "entityId" <> \'\' GROUP BY "entityId"'
    ),
)
def ag1(i):
    return analytics.entity_analytics(i.relationship_rows)


ANALYTICS_SQL = sql(
    f'SELECT "entityId", "entityName", {COUNTS} AS "totalRelationships" FROM '
    '(SELECT *, "relationshipType" AS t FROM relationships) GROUP BY "entityId", "entityName"'
)


@query("ag1_mapping_analytics", ANALYTICS_SQL)
def ag1_mapping(i):
    unique = company.Linker.of(i.startups).relationships(all_inputs(i), NEWS_AS_OF)
    return company.count_relationships(unique)


@query(
    "ag1_products_per_company",
    sql(
        'SELECT "entityId", "entityName", count(*) AS "productCount" FROM '
        f'(SELECT DISTINCT {ALL} FROM product_links) GROUP BY "entityId", "entityName"'
    ),
)
def products_per_company(i):
    linked = entities.link_products(i.products, exact(i), JOBS_AS_OF, unique=True)
    counted = company.count_relationships(linked)
    return counted.select("entityId", "entityName", "productCount")


@query(
    "ag2_relationship_counts",
    sql('SELECT "relationshipType", count(*) AS count FROM relationship_rows WHERE "relationshipType" <> \'\' GROUP BY 1 ORDER BY 1'),
)
def ag2(i):
    return analytics.relationship_counts(i.relationship_rows)


@query(
    "srt3_relationship_order",
    sql(
        'SELECT "relationshipType", count, row_number() OVER (ORDER BY "relationshipType") AS place FROM '
        '(SELECT "relationshipType", count(*) AS count FROM relationship_rows WHERE "relationshipType" <> \'\' GROUP BY 1)'
    ),
)
def srt3(i):
    """Types are few rows after counting, so one ordered window numbers them."""
    counts = analytics.relationship_counts(i.relationship_rows)
    place = F.row_number().over(Window.orderBy("relationshipType")).cast("bigint")
    return counts.withColumn("place", place)


@query(
    "ag8_mapped_counts",
    sql(f'SELECT {COUNTS} AS "mappedRows" FROM (SELECT *, "relationshipType" AS t FROM mapped)'),
)
def ag8(i):
    return analytics.mapped_counts(company.Linker.of(i.startups).mapped(all_inputs(i), NEWS_AS_OF))


def _blank(c: str) -> str:
    return f"({strip(c)} = '')"


def report_sql(dataset: str, table: str, required: list[str], unique: str | None, absent: int = 0) -> str:
    cells = " + ".join([f"CAST({_blank(chr(34) + c + chr(34))} AS BIGINT)" for c in required] + [str(absent)])
    value = f"nullif(lower({strip(chr(34) + unique + chr(34))}), '')" if unique else "NULL::VARCHAR"
    return (
        "SELECT *, CASE WHEN missing = 0 THEN 'PASS' ELSE 'CHECK' END AS required_status, "
        "CASE WHEN duplicates = 0 THEN 'PASS' ELSE 'CHECK' END AS duplicate_status FROM ("
        f"SELECT {q(dataset)} AS dataset, count(*) AS rows, CAST(sum({cells}) AS BIGINT) AS missing, "
        f"count({value}) - count(DISTINCT {value}) AS duplicates FROM {table})"
    )


REPORTS = {
    "STARTUPS": report_sql("STARTUPS", "startups", ["entityName", "source_url"], "entityName"),
    "PRODUCTS": report_sql("PRODUCTS", "products", ["productName", "startupName", "source_url"], "productName"),
    "RESEARCH PAPERS": report_sql("RESEARCH PAPERS", "papers", ["title", "source_url"], "paper_url"),
    "NEWS": report_sql("NEWS", "news", ["title", "source_url"], "source_url"),
    "JOBS": report_sql("JOBS", "jobs", ["company", "title", "source_url"], "source_url"),
    "MODELS": report_sql("MODELS", "models", ["model_name", "organization", "source_url"], "source_url", 3),
}


def datasets(i):
    return {
        "STARTUPS": i.startups, "PRODUCTS": i.products, "RESEARCH PAPERS": i.papers, "NEWS": i.news,
        "JOBS": i.jobs, "MODELS": i.models,
    }


@query("dq1_missing_cells", sql(f"SELECT rows, missing FROM ({REPORTS['MODELS']})"))
def dq1(i):
    required = ("model_name", "organization", "source_url", "official_website", "logo_url", "description")
    return i.models.agg(F.count(F.lit(1)).alias("rows"), quality.missing_cells(i.models, required).alias("missing"))


@query("dq2_duplicate_values", sql(f"SELECT rows, duplicates FROM ({REPORTS['JOBS']})"))
def dq2(i):
    return i.jobs.agg(F.count(F.lit(1)).alias("rows"), quality.duplicate_values(i.jobs, "source_url").alias("duplicates"))


@query("dq3_dataset_report", sql(REPORTS["PRODUCTS"]))
def dq3(i):
    return quality.dataset_report(i.products, quality.RULES[1])


@query("dq4_quality_report", sql(" UNION ALL ".join(f"SELECT * FROM ({r})" for r in REPORTS.values())))
def dq4(i):
    return quality.quality_report(datasets(i))


VALID = (
    "(regexp_matches(c, '(?i)^[+-]?nan$') OR (regexp_matches(c, '^[+-]?[0-9]') AND NOT regexp_matches(c, '[a-df-z]') "
    "AND TRY_CAST(replace(c, '_', '') AS DOUBLE) BETWEEN 0 AND 1))"
)


@query(
    "dq5_invalid_confidence",
    sql(f"SELECT _ord AS id, confidence, NOT coalesce({VALID}, false) AS invalid FROM (SELECT *, trim(confidence) AS c FROM relationship_rows)"),
)
def dq5(i):
    return i.relationship_rows.select(
        F.col(ORD).alias("id"), "confidence", quality.is_invalid_confidence(F.col("confidence")).alias("invalid")
    )


@query(
    "dq6_relationship_report",
    sql(
        "SELECT *, CASE WHEN invalid_confidence = 0 THEN 'PASS' ELSE 'CHECK' END AS confidence_status FROM "
        f"(SELECT count(*) AS relationships, count(*) FILTER (NOT coalesce({VALID}, false)) AS invalid_confidence "
        "FROM (SELECT *, trim(confidence) AS c FROM relationship_rows))"
    ),
)
def dq6(i):
    return quality.relationship_report(i.relationship_rows)


@query("en7_full_run", ANALYTICS_SQL)
def en7(i):
    return company.run(all_inputs(i), NEWS_AS_OF).analytics


FRESH_LINKS = job_links_of(
    f"(SELECT * FROM (SELECT 0 AS s, _ord, company, {URL_1} AS source_url FROM jobs WHERE {FRESH_JOB} AND source_url <> '' "
    f"UNION ALL SELECT 1, _ord, company, source_url FROM jobs WHERE {FRESH_JOB} AND source_url <> '') "
    "QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY s DESC, _ord DESC) = 1)"
)


@query(
    "en7_run_with_intake",
    sql(
        f'SELECT "entityId", "entityName", {COUNTS} AS "totalRelationships" FROM '
        '(SELECT *, "relationshipType" AS t FROM (SELECT * FROM product_links UNION SELECT * FROM paper_links '
        f'UNION SELECT * FROM news_links UNION {FRESH_LINKS})) GROUP BY "entityId", "entityName"'
    ),
)
def en7_intake(i):
    inputs = company.Inputs(i.startups, i.products, i.papers, i.news, i.jobs)
    return company.run_with_intake(i.board_1, i.board_2, inputs, JOBS_AS_OF).analytics


LANDED_PAPERS = paper_links_of("(SELECT _ord, title, authors, paper_url AS source_url, paper_url FROM papers WHERE source_url <> '')")


@query(
    "en7_landed_run",
    sql(
        f'SELECT "entityId", "entityName", {COUNTS} AS "totalRelationships" FROM '
        f'(SELECT *, "relationshipType" AS t FROM (SELECT * FROM product_links UNION (SELECT * FROM ({LANDED_PAPERS})) '
        f'UNION (SELECT * FROM ({news_links_of(f"({NEWS_RECORDS})")})) UNION {FRESH_LINKS})) GROUP BY "entityId", "entityName"'
    ),
)
def en7_landed(i):
    """Jobs, papers and news straight from board, paper-feed, news-feed and page payloads."""
    news = feeds.news(all_feed_items(i), i.pages, NEWS_AS_OF)
    inputs = company.Inputs(i.startups, i.products, papers.papers(i.paper_feeds, NEWS_AS_OF), news, i.jobs)
    return company.run_with_intake(i.board_1, i.board_2, inputs, JOBS_AS_OF).analytics


@query(
    "set1_union_of_sources",
    sql(
        "SELECT 0 AS source, title, source_url, company FROM jobs UNION ALL "
        "SELECT 1 AS source, title, source_url, NULL AS company FROM news"
    ),
)
def set1(i):
    jobs = i.jobs.select("title", "source_url", "company")
    return union_sources([jobs, i.news.select("title", "source_url")]).withColumnRenamed("_source", "source")


@query("top5_first_rows", sql('SELECT "entityName", source_url FROM startups ORDER BY _ord LIMIT 20'))
def top5(i):
    return first_rows(i.startups, 20).select("entityName", "source_url")


@query("fn23_mention_text", sql("SELECT _ord AS id, title || ' ' || authors AS text FROM papers"))
def fn23(i):
    return i.papers.select(F.col(ORD).alias("id"), mention_text(F.col("title"), F.col("authors")).alias("text"))


@query(
    "fn24_record_url",
    sql("SELECT _ord AS id, CASE WHEN source_url <> '' THEN source_url ELSE paper_url END AS url FROM papers"),
)
def fn24(i):
    return i.papers.select(F.col(ORD).alias("id"), record_url(F.col("source_url"), F.col("paper_url")).alias("url"))


@query("fn1_match_key", sql(f"SELECT _ord AS id, {key('content')} AS key FROM news"))
def fn1(i):
    return i.news.select(F.col(ORD).alias("id"), match_key(F.col("content")).alias("key"))
