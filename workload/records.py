"""Landed payloads, normalised records, classification and removal of duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitymart import fixed, schemas
from entitymart.functions import dates, html, rules, text, urls
from entitymart.operators import dedup
from entitymart.operators.entities import entity_id
from entitymart.operators.ordering import ORD, with_position
from entitymart.session import scratch_path
from entitymart.sources import feeds, jobs, pages, papers, tables
from workload.inputs import JOBS_AS_OF, NEWS_AS_OF
from workload.registry import query
from workload.sqlkit import (
    FRESH_JOB, JOBS_AS_OF as JOBS_TIME, NEWS_AS_OF as NEWS_TIME, URL_1, article, collapse, drop_all, fragment, official, q, rules as rule_sql,
    sql, stamp, visible, domain,
)

TIME = "yyyy-MM-dd HH:mm:ss"


def shown(c: str):
    return F.date_format(c, TIME).alias(c)


# job boards

ROLE = rule_sql("title", rules.ROLE_FAMILIES, "'Other'")
ROLE_WIDE = rule_sql("title", rules.ROLE_FAMILIES_WIDE, "'Other'")


def job_sql(source: str, url: str) -> str:
    return (
        f"SELECT '1.0' AS \"schemaVersion\", 'JOB' AS \"recordType\", company, {stamp('date')} AS date, true AS is_remote, "
        f"{ROLE} AS role_family, title, {q(source)} AS source_name, {url} AS source_url, "
        f"{stamp(JOBS_TIME)} AS \"collectedAt\" FROM jobs WHERE {FRESH_JOB} AND source_url <> ''"
    )


def as_shown(df, *times):
    return df.drop(ORD).select(*[shown(c) if c in times else c for c in df.columns if c != ORD])


@query(
    "src3_board_1_items",
    sql(f"SELECT title, company, {URL_1.replace('https://remoteok.com', '')} AS url FROM jobs"),
)
def src3(i):
    return jobs.board_1_items(i.board_1, JOBS_AS_OF).select("title", "company", "url")


@query("src4_board_2_items", sql("SELECT title, company, source_url AS url FROM jobs"))
def src4(i):
    return jobs.board_2_items(i.board_2, JOBS_AS_OF).select("title", "company", "url")


@query("prj1_board_1_jobs", sql(job_sql(fixed.BOARD_1, URL_1)))
def prj1(i):
    return as_shown(jobs.board_1_jobs(i.board_1, JOBS_AS_OF), "date", "collectedAt")


@query("prj2_board_2_jobs", sql(job_sql(fixed.BOARD_2, "source_url")))
def prj2(i):
    return as_shown(jobs.board_2_jobs(i.board_2, JOBS_AS_OF), "date", "collectedAt")


BOARD_3 = (
    f"SELECT source_url, company, title, {stamp('date')} AS date, {ROLE_WIDE} AS role_family, "
    "CASE WHEN priority = '5-LOW' THEN '' ELSE priority END AS category, 'full_time' AS job_type, "
    f"lower(priority) AS candidate_required_location FROM jobs WHERE {FRESH_JOB} AND source_url <> '' "
    "QUALIFY row_number() OVER (PARTITION BY lower(source_url) ORDER BY _ord) = 1"
)


@query("prj3_board_3_jobs", sql(BOARD_3))
def prj3(i):
    nested = jobs.board_3_jobs(i.board_3, JOBS_AS_OF)
    return nested.select("source_url", "content.*").drop("is_remote").withColumn("date", F.date_format("date", TIME))


@query(
    "prj8_flat_jobs",
    sql(
        f"SELECT '1.0' AS \"schemaVersion\", 'JOB' AS \"recordType\", 'Remotive' AS source_name, *, "
        f"true AS is_remote, {stamp(JOBS_TIME)} AS \"collectedAt\" FROM ({BOARD_3})"
    ),
)
def prj8_jobs(i):
    return as_shown(tables.flat_job(jobs.board_3_jobs(i.board_3, JOBS_AS_OF)), "date", "collectedAt")


@query(
    "dd2_last_job_per_url",
    sql(
        f"SELECT title, company, source_url, source_name FROM (SELECT 0 AS s, _ord, title, company, {URL_1} AS source_url, "
        f"'Remote OK' AS source_name FROM jobs WHERE {FRESH_JOB} AND source_url <> '' UNION ALL "
        f"SELECT 1, _ord, title, company, source_url, 'Jobicy' FROM jobs WHERE {FRESH_JOB} AND source_url <> '') "
        "QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY s DESC, _ord DESC) = 1"
    ),
)
def dd2(i):
    found = [jobs.board_1_jobs(i.board_1, JOBS_AS_OF), jobs.board_2_jobs(i.board_2, JOBS_AS_OF)]
    return jobs.unique_jobs(found).select("title", "company", "source_url", "source_name")


@query(
    "dd5_first_job_per_url",
    sql(
        "SELECT _ord AS id, title, source_url FROM jobs WHERE source_url <> '' "
        "QUALIFY row_number() OVER (PARTITION BY lower(source_url) ORDER BY _ord) = 1"
    ),
)
def dd5(i):
    return dedup.jobs_by_lower_url(i.jobs).select(F.col(ORD).alias("id"), "title", "source_url")


@query("flt1_fresh_jobs", sql(f"SELECT _ord AS id, title FROM jobs WHERE {FRESH_JOB}"))
def flt1(i):
    return i.jobs.filter(dates.is_fresh(F.col("date"), JOBS_AS_OF)).select(F.col(ORD).alias("id"), "title")


@query("flt2_fresh_iso_jobs", sql(f"SELECT _ord AS id FROM jobs WHERE {FRESH_JOB}"))
def flt2(i):
    written = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")
    return i.jobs.filter(dates.is_fresh(dates.parse_iso(written), JOBS_AS_OF)).select(F.col(ORD).alias("id"))


@query("flt3_required_fields", sql("SELECT _ord AS id, source_url FROM jobs WHERE title <> '' AND source_url <> ''"))
def flt3(i):
    kept = i.jobs.filter(text.is_filled(F.col("title")) & text.is_filled(F.col("source_url")))
    return kept.select(F.col(ORD).alias("id"), "source_url")


@query("fn7_role_family", sql(f"SELECT _ord AS id, title, {ROLE} AS role_family FROM jobs"))
def fn7(i):
    return i.jobs.select(F.col(ORD).alias("id"), "title", rules.role_family(F.col("title")).alias("role_family"))


@query("fn8_role_family_wide", sql(f"SELECT _ord AS id, title, {ROLE_WIDE} AS role_family FROM jobs"))
def fn8(i):
    return i.jobs.select(F.col(ORD).alias("id"), rules.role_family_wide(F.col("title")).alias("role_family"), "title")


REMOTE = " OR ".join(f"contains(lower(title || ' ' || content), {q(w)})" for w in rules.REMOTE)


@query("fn9_is_remote", sql(f"SELECT _ord AS id, {REMOTE} AS remote FROM news"))
def fn9(i):
    return i.news.select(F.col(ORD).alias("id"), rules.is_remote(F.col("title"), F.col("content")).alias("remote"))


DATE_FORMS = [
    "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss.SSS", "yyyyMMdd", "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "dd MMM yyyy HH:mm:ss '-0500'", "yyyy-MM-dd'T'HH:mm:ss'+0230'", "'posted 'd' hrs ago'", "'on 'yyyy",
]


def written_dates(i):
    form = F.pmod(F.col("event_id"), F.lit(len(DATE_FORMS)))
    value = F.lit(None).cast("string")
    for n, pattern in enumerate(DATE_FORMS):
        value = F.when(form == n, F.date_format("ts", pattern)).otherwise(value)
    return i.table("events").select(F.col("event_id").alias("id"), value.alias("value"))


@query(
    "fn5_parse_date",
    sql(
        "SELECT event_id AS id, strftime(CASE event_id % 8 WHEN 0 THEN date_trunc('second', ts) "
        "WHEN 1 THEN date_trunc('millisecond', ts) WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('second', ts) "
        "WHEN 4 THEN date_trunc('second', ts) + INTERVAL 5 HOUR WHEN 5 THEN date_trunc('second', ts) - INTERVAL 150 MINUTE "
        f"WHEN 6 THEN {NEWS_TIME} - to_hours(day(ts)) END, '%Y-%m-%d %H:%M:%S.%g') AS parsed FROM events"
    ),
)
def fn5(i):
    parsed = dates.parse_date(F.col("value"), dates.instant(NEWS_AS_OF))
    return written_dates(i).select("id", F.date_format(parsed, TIME + ".SSS").alias("parsed"))


@query(
    "fn6_parse_iso",
    sql(
        "SELECT event_id AS id, strftime(CASE event_id % 8 WHEN 0 THEN date_trunc('second', ts) "
        "WHEN 1 THEN date_trunc('millisecond', ts) WHEN 2 THEN date_trunc('day', ts) "
        "WHEN 5 THEN date_trunc('second', ts) - INTERVAL 150 MINUTE END, '%Y-%m-%d %H:%M:%S.%g') AS parsed FROM events"
    ),
)
def fn6(i):
    return written_dates(i).select("id", F.date_format(dates.parse_iso(F.col("value")), TIME + ".SSS").alias("parsed"))


# Week dates and mail years of two digits, written from the events' times by plain arithmetic on both sides.

@query(
    "fn5_week_dates_and_short_years",
    sql(
        "SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d 00:00:00') "
        "WHEN 1 THEN strftime(date_trunc('week', ts), '%Y-%m-%d 00:00:00') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:00') "
        "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed FROM events"
    ),
)
def fn5_weeks(i):
    thursday = F.date_add(F.date_trunc("week", "ts").cast("date"), 3)
    week = F.concat(F.year(thursday).cast("string"), F.lit("-W"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"))
    day = (F.weekday("ts") + 1).cast("string")
    value = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.replace(week, F.lit("-"), F.lit("")), day))
        .when(F.col("event_id") % 4 == 1, week)
        .when(F.col("event_id") % 4 == 2, F.concat(week, F.lit("-"), day, F.lit("T"), F.date_format("ts", "HH:mm"), F.lit("Z")))
        .otherwise(F.date_format("ts", "EEE, dd MMM yy HH:mm:ss 'GMT'"))
    )
    parsed = dates.parse_date(value, dates.instant(NEWS_AS_OF))
    return i.table("events").select(F.col("event_id").alias("id"), F.date_format(parsed, TIME).alias("parsed"))


# feeds

ITEM_TITLE, ITEM_TEXT = fragment("title"), fragment("'<p>' || content || '</p>'")
PUBLISHED = stamp('"publishedAt"')
FRESH_NEWS = f'"publishedAt" BETWEEN {NEWS_TIME} - INTERVAL 24 HOUR AND {NEWS_TIME}'


def items(df):
    return df.select("title", "url", "description", F.date_format("published", TIME).alias("published"))


@query(
    "src6_rss_items",
    sql(f"SELECT {ITEM_TITLE} AS title, source_url AS url, {ITEM_TEXT} AS description, {PUBLISHED} AS published FROM news"),
)
def src6(i):
    return items(feeds.feed_items(i.rss, NEWS_AS_OF))


@query(
    "src6_rss_items_at_any_depth",
    sql(f"SELECT {ITEM_TITLE} AS title, source_url AS url, {ITEM_TEXT} AS description, {PUBLISHED} AS published FROM news"),
)
def src6_deep(i):
    deep = F.replace("payload", F.lit("<channel><title>feed</title>"), F.lit("<channel><!-- <item> --><group id='1'><list>"))
    deep = F.replace(deep, F.lit("</channel>"), F.lit("</list></group></channel>"))
    return items(feeds.feed_items(i.rss.withColumn("payload", deep), NEWS_AS_OF))


@query(
    "src7_atom_items",
    sql(
        f"SELECT {ITEM_TITLE} AS title, source_url AS url, {fragment('content')} AS description, {PUBLISHED} AS published "
        "FROM news"
    ),
)
def src7(i):
    return items(feeds.feed_items(i.atom, NEWS_AS_OF))


def all_feed_items(i):
    both = i.rss.unionByName(i.page_rss.withColumn(ORD, F.col(ORD) + (1 << 40)))
    return feeds.feed_items(both, NEWS_AS_OF)


PAGE_TEXT = f"coalesce(nullif({article('p.html')}, ''), 'about ' || p.page_id)"
LAST_PAGE = "(SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1)"
NEWS_RECORDS = (
    f"SELECT _ord, source_url, {ITEM_TITLE} AS title, {PUBLISHED} AS \"publishedAt\", {ITEM_TEXT} AS content FROM news "
    f"WHERE {FRESH_NEWS} AND {ITEM_TITLE} <> '' UNION ALL "
    f"SELECT i.page_id + {1 << 44}, i.url, 'Page ' || i.page_id, {stamp(NEWS_TIME + ' - INTERVAL 5 HOUR')}, {PAGE_TEXT} "
    f"FROM pages i JOIN {LAST_PAGE} p ON i.url = p.url"
)


@query(
    "jn10_articles",
    sql(f"SELECT i.page_id AS id, {PAGE_TEXT} AS content FROM pages i JOIN {LAST_PAGE} p ON i.url = p.url"),
)
def jn10(i):
    found = feeds.feed_items(i.page_rss, NEWS_AS_OF)
    records = feeds.news(found, i.pages, NEWS_AS_OF)
    return records.select(F.split_part("title", F.lit(" "), F.lit(2)).cast("bigint").alias("id"), "content")


@query("prj4_news_records", sql(f"SELECT source_url, title, \"publishedAt\", content FROM ({NEWS_RECORDS})"))
def prj4(i):
    records = feeds.news(all_feed_items(i), i.pages, NEWS_AS_OF)
    return records.select("source_url", "title", shown("publishedAt"), "content")


@query(
    "dd3_last_news_per_url",
    sql("SELECT source_url, title, content FROM news QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY _ord DESC) = 1"),
)
def dd3(i):
    return feeds.unique_news(i.news).select("source_url", "title", "content")


@query("fn2_collapse_space", sql(f"SELECT _ord AS id, {collapse('content')} AS text FROM news"))
def fn2(i):
    return i.news.select(F.col(ORD).alias("id"), text.collapse(F.col("content")).alias("text"))


@query("fn3_fragment_text", sql(f"SELECT page_id AS id, {fragment('html')} AS text FROM pages"))
def fn3(i):
    return i.pages.select(F.col(ORD).alias("id"), html.fragment_text(F.col("html")).alias("text"))


@query("fn4_article_text", sql(f"SELECT page_id AS id, {article('html')} AS text FROM pages"))
def fn4(i):
    return i.pages.select(F.col(ORD).alias("id"), html.article_text(F.col("html")).alias("text"))


# Each page inside an article inside another, below furniture that nests as well.
WRAPPED = ("<div><header>top<nav>one<nav>two</nav></nav></header><article>Start <div><article>", "</article></div> end</article><article>next</article></div>")
BARE_PAGE = drop_all("coalesce(html, '')", [html.COMMENT, *[html.element(n) for n in html.FURNITURE]])


@query(
    "fn4_nested_article_text",
    sql(f"SELECT page_id AS id, {fragment(fragment(f"'Start ' || {BARE_PAGE} || ' end'"))} AS text FROM pages"),
)
def fn4_nested(i):
    page = F.concat(F.lit(WRAPPED[0]), F.coalesce("html", F.lit("")), F.lit(WRAPPED[1]))
    return i.pages.select(F.col(ORD).alias("id"), html.article_text(page).alias("text"))


PRICED = rule_sql("content", rules.PRICING)


@query("fn14_pricing_model", sql(f"SELECT _ord AS id, {PRICED} AS pricing FROM news"))
def fn14(i):
    return i.news.select(F.col(ORD).alias("id"), rules.pricing_model(F.col("content")).alias("pricing"))


@query("fn25_collection_time", sql(f"SELECT _ord AS id, {stamp(NEWS_TIME)} AS collected FROM news"))
def fn25(i):
    return i.news.select(F.col(ORD).alias("id"), F.date_format(dates.instant(NEWS_AS_OF), TIME).alias("collected"))


@query(
    "fn26_record_constants",
    sql("SELECT _ord AS id, '1.0' AS \"schemaVersion\", 'NEWS' AS \"recordType\" FROM news WHERE " + FRESH_NEWS + f" AND {ITEM_TITLE} <> ''"),
)
def fn26(i):
    records = feeds.news(feeds.feed_items(i.rss, NEWS_AS_OF), i.pages, NEWS_AS_OF)
    order = F.col(f"{ORD}._feed") * 16 + F.col(f"{ORD}._pos")
    return records.select(order.alias("id"), "schemaVersion", "recordType")


# papers

REPO = "source || '/' || lang || '.'"
TITLE_ONE = collapse("title")


@query(
    "src8_paper_entries",
    sql(
        f"SELECT paper_url, {TITLE_ONE} AS title, lang || '|' || source AS authors, published_date, "
        f"'https://github.com/' || {REPO} AS github_url FROM papers WHERE lang <> 'de'"
    ),
)
def src8(i):
    return papers.papers(i.paper_feeds, NEWS_AS_OF).select(
        "paper_url", "title", F.array_join("authors", "|").alias("authors"), "published_date", "github_url"
    )


@query(
    "src9_papers_by_id",
    sql(f"SELECT paper_url, {TITLE_ONE} AS title, lang || ', ' || source AS authors, published_date, NULL AS updated_date FROM papers"),
)
def src9(i):
    return papers.papers_by_id(i.paper_feeds).drop(ORD)


@query("flt4_papers_with_url", sql("SELECT paper_url FROM papers WHERE lang <> 'de'"))
def flt4(i):
    return papers.papers(i.paper_feeds, NEWS_AS_OF).select("paper_url")


@query(
    "jn7_repository_stars",
    sql(
        f"SELECT p.paper_url, r.stars AS github_stars FROM (SELECT *, {REPO} AS repo FROM papers WHERE lang <> 'de') p "
        f"LEFT JOIN (SELECT {REPO} AS repo, CAST(sum(n_chars) AS BIGINT) AS stars FROM documents WHERE lang <> 'es' "
        "GROUP BY 1) r ON p.repo = r.repo"
    ),
)
def jn7(i):
    records = papers.papers(i.paper_feeds, NEWS_AS_OF)
    return papers.with_stars(records, i.repositories).select("paper_url", "github_stars")


WORDS_6 = f"array_to_string(list_slice(string_split({collapse('text')}, ' '), 1, 6), ' ')"
BEST = (
    "SELECT keywords, html_url, stars FROM (SELECT doc_id, CASE WHEN lang <> 'fr' THEN n_chars END AS stars, "
    f"{WORDS_6} AS keywords, 'https://github.com/' || source || '/' || doc_id AS html_url FROM documents) "
    "WHERE keywords <> '' QUALIFY row_number() OVER (PARTITION BY keywords ORDER BY stars DESC NULLS LAST, doc_id) = 1"
)


@query("top3_best_repository", sql(f"SELECT keywords, html_url, stars AS stargazers_count FROM ({BEST})"))
def top3(i):
    return papers.best_repositories(i.search_results)


SEARCHED = (
    f"SELECT p.paper_url, r.html_url AS github_url, r.stars AS github_stars FROM (SELECT *, {WORDS_6} AS kw FROM "
    f"(SELECT paper_url, title AS text FROM papers)) p LEFT JOIN ({BEST}) r ON p.kw = r.keywords"
)


@query("jn8_searched_repositories", sql(SEARCHED))
def jn8(i):
    found = papers.searched_papers(papers.papers_by_id(i.paper_feeds), i.search_results, NEWS_AS_OF)
    return found.select("paper_url", "github_url", "github_stars")


@query(
    "prj14_searched_papers",
    sql(
        f"SELECT s.*, {TITLE_ONE} AS title, lang || ', ' || source AS authors, 'arXiv' AS origin, "
        f"{stamp(NEWS_TIME)} AS collected_at FROM ({SEARCHED}) s JOIN papers p ON s.paper_url = p.paper_url"
    ),
)
def prj14(i):
    found = papers.searched_papers(papers.papers_by_id(i.paper_feeds), i.search_results, NEWS_AS_OF)
    return found.select(
        "paper_url", "github_url", "github_stars", "title", "authors", F.col("source").alias("origin"), shown("collected_at")
    )


@query("fn21_search_keywords", sql(f"SELECT doc_id AS id, {WORDS_6} AS keywords FROM documents"))
def fn21(i):
    return i.table("documents").select(F.col("doc_id").alias("id"), text.search_keywords(F.col("text")).alias("keywords"))


@query("fn15_repository_in_text", sql(f"SELECT _ord AS id, {REPO} AS repository FROM papers"))
def fn15(i):
    return i.papers.select(F.col(ORD).alias("id"), urls.repository_in_text(F.col("summary")).alias("repository"))


@query(
    "fn16_repository_urls",
    sql(f"SELECT _ord AS id, 'https://github.com/' || {REPO} AS url, {REPO} AS repository FROM papers"),
)
def fn16(i):
    url = urls.repository_url(urls.repository_in_text(F.col("summary")))
    return i.papers.select(
        F.col(ORD).alias("id"), url.alias("url"), urls.repository_from_url(url).alias("repository")
    )


@query(
    "prj13_authors_json",
    sql("SELECT paper_url, '[\"' || lang || '\", \"' || source || '\"]' AS authors FROM papers WHERE lang <> 'de'"),
)
def prj13(i):
    return tables.flat_paper(papers.papers(i.paper_feeds, NEWS_AS_OF)).select("paper_url", "authors")


@query(
    "dd8_first_paper_per_url",
    sql("SELECT _ord AS id, source_url FROM news QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY _ord) = 1"),
)
def dd8(i):
    kept = dedup.papers(i.news.withColumn("paper_url", F.col("source_url")))
    return kept.select(F.col(ORD).alias("id"), "source_url")


@query(
    "top2_newest_papers",
    sql("SELECT paper_url, published_date FROM papers WHERE lang <> 'de' ORDER BY published_date DESC LIMIT 400"),
)
def top2(i):
    return papers.newest_papers(papers.papers(i.paper_feeds, NEWS_AS_OF), 400).select("paper_url", "published_date")


@query(
    "src11_listed_papers",
    sql(
        f"SELECT 'https://arxiv.org/abs/' || doc_id AS paper_url, {fragment('title')} AS title, lang || ', ' || source AS authors "
        "FROM (SELECT *, split_part(text, chr(10), 1) AS title FROM documents) "
        "QUALIFY row_number() OVER (PARTITION BY doc_id // 8 ORDER BY doc_id) <= 5"
    ),
)
def src11(i):
    return papers.listed_papers(i.listings).select(
        "paper_url", "title", F.array_join("authors", ", ").alias("authors")
    )


# company directory

ANCHORS = (
    "SELECT page_id, pos, a[1] AS href, a[2] AS name FROM (SELECT page_id, unnest(hits) AS a, "
    "generate_subscripts(hits, 1) AS pos FROM (SELECT page_id, list_transform(regexp_extract_all(html, "
    "'(?is)<a\\s[^>]*?href=\"/[^\"]*\"[^>]*>.*?</a\\s*>'), lambda x: [regexp_extract(x, 'href=\"(/[^\"]*)\"', 1), x]) AS hits "
    "FROM pages))"
)
LINKS = (
    "SELECT page_id, pos, CASE WHEN href = '/to' THEN '/companies/to/?page=1' ELSE '/companies' || href END AS href, "
    f"{visible('name')} AS name FROM ({ANCHORS})"
)
NAVIGATION = ", ".join(q(n) for n in fixed.NAVIGATION)


@query("src10_company_links", sql(f"SELECT page_id, href, name FROM ({LINKS})"))
def src10(i):
    return pages.company_links(i.directory).select(F.col(f"{ORD}._page").alias("page_id"), "href", "name")


@query(
    "rk1_directory_entity_ids",
    sql(f"SELECT printf('STARTUP-%04d', row_number() OVER (ORDER BY page_id, pos)) AS \"entityId\", href FROM ({LINKS})"),
)
def rk1_directory(i):
    """Numbered by ranges of the order, as beyond the size of one task."""
    links = with_position(pages.company_links(i.directory), one_task_rows=0)
    return links.select(entity_id(F.col("position")).alias("entityId"), "href")


PATH = "regexp_replace(split_part(href, '?', 1), '/+$', '')"
STARTUPS = (
    f"SELECT 'https://www.ycombinator.com' || {PATH} AS source_url, name AS \"entityName\" FROM ({LINKS}) "
    f"WHERE name <> '' AND {PATH} <> '/companies' AND lower(name) NOT IN ({NAVIGATION}) "
    f"QUALIFY row_number() OVER (PARTITION BY {PATH} ORDER BY page_id DESC, pos DESC) = 1"
)


@query("prj5_startups", sql(STARTUPS))
def prj5(i):
    found = pages.startups(pages.company_links(i.directory), NEWS_AS_OF)
    return found.select("source_url", "entityName")


PLAIN = "split_part(href, '?', 1)"


@query(
    "prj6_startups_plain",
    sql(
        f"SELECT 'https://www.ycombinator.com' || {PLAIN} AS source_url, name AS \"entityName\" FROM ({LINKS}) "
        f"WHERE name <> '' AND {PLAIN} <> '/companies/' "
        f"QUALIFY row_number() OVER (PARTITION BY {PLAIN} ORDER BY page_id DESC, pos DESC) = 1"
    ),
)
def prj6(i):
    found = pages.startups_plain(pages.company_links(i.directory), NEWS_AS_OF)
    return found.select("source_url", "entityName")


@query("dd4_last_startup_per_url", sql(f"SELECT source_url, \"entityName\", 'STARTUP' AS kind FROM ({STARTUPS})"))
def dd4(i):
    found = pages.startups(pages.company_links(i.directory), NEWS_AS_OF)
    return found.select("source_url", "entityName", F.col("recordType").alias("kind"))


@query(
    "flt5_navigation_links",
    sql(
        f"SELECT page_id, href, name FROM ({LINKS}) WHERE name <> '' AND {PATH} <> '/companies' "
        f"AND lower(name) NOT IN ({NAVIGATION})"
    ),
)
def flt5(i):
    links = pages.company_links(i.directory)
    return links.filter(pages.is_company_link()).select(F.col(f"{ORD}._page").alias("page_id"), "href", "name")


PRODUCT_TEXT = visible("html")
PRODUCTS = (
    f"SELECT s.source_url, s.\"entityName\" AS \"productName\", s.\"entityName\" AS \"startupName\", "
    f"substr(t, 1, 1000) AS \"productDescription\", {rule_sql('t', rules.PRICING)} AS \"pricingModel\" FROM "
    f"(SELECT url AS source_url, 'Company ' || page_id AS \"entityName\" FROM pages) s JOIN "
    f"(SELECT url, {PRODUCT_TEXT} AS t FROM pages) p ON s.source_url = p.url WHERE t <> ''"
)


def page_startups(i):
    return i.pages.select(
        ORD, F.col("url").alias("source_url"), F.concat(F.lit("Company "), "page_id").alias("entityName")
    )


@query("prj7_products", sql(PRODUCTS))
def prj7(i):
    return pages.products(page_startups(i), i.pages, NEWS_AS_OF, n=None).select(
        F.col("source.url").alias("source_url"), "content.*"
    )


@query("prj8_flat_products", sql(f"SELECT '1.0' AS \"schemaVersion\", 'Y Combinator' AS source_name, * FROM ({PRODUCTS})"))
def prj8(i):
    flat = tables.flat_product(pages.products(page_startups(i), i.pages, NEWS_AS_OF, n=None))
    return flat.drop("recordType", "collectedAt")


@query(
    "jn11_first_startup_pages",
    sql(
        "SELECT s.source_url, \"productName\" FROM (SELECT url AS source_url, 'Company ' || page_id AS \"productName\" "
        f"FROM pages ORDER BY page_id LIMIT 100) s JOIN (SELECT url, {PRODUCT_TEXT} AS t FROM pages) p "
        "ON s.source_url = p.url WHERE t <> ''"
    ),
)
def jn11(i):
    return pages.products(page_startups(i), i.pages, NEWS_AS_OF, n=100).select(
        F.col("source.url").alias("source_url"), "content.productName"
    )


@query("fn17_domain", sql(f"SELECT page_id AS id, {domain('url')} AS domain FROM pages"))
def fn17(i):
    return i.pages.select(F.col(ORD).alias("id"), urls.domain(F.col("url")).alias("domain"))


@query("flt7_official_sites", sql(f"SELECT page_id AS id, {official('url')} AS official FROM pages"))
def flt7(i):
    return i.pages.select(F.col(ORD).alias("id"), urls.is_official_site(F.col("url")).alias("official"))


# tables written and read back

def _csv(i, df, ddl, name):
    path = scratch_path(i.spark, name)
    tables.write_csv(df, path, ddl)
    return tables.read_csv(i.spark, path, ddl)


NEWS_DDL = "source_url string, title string, content string"


@query("src1_csv_scan", sql("SELECT source_url, title, content FROM news"))
def src1(i):
    return _csv(i, i.news, NEWS_DDL, "news").select(*schemas.columns(NEWS_DDL))


@query("src2_csv_scan_or_empty", sql("SELECT source_url, title, content FROM news"))
def src2(i):
    path = scratch_path(i.spark, "news")
    tables.write_csv(i.news, path, NEWS_DDL)
    found = tables.read_csv_or_empty(i.spark, path, NEWS_DDL)
    return found.unionByName(tables.read_csv_or_empty(i.spark, path + "-absent", NEWS_DDL)).drop(ORD)


@query(
    "snk1_csv_sink",
    sql('SELECT \'1.0\' AS "schemaVersion", source_url, "entityName", NULL AS "employeeCount" FROM startups'),
)
def snk1(i):
    rows = i.startups.withColumn("schemaVersion", F.lit(fixed.SCHEMA_VERSION))
    back = _csv(i, rows, schemas.STARTUPS, "startups")
    return back.select("schemaVersion", "source_url", "entityName", F.nullif("employeeCount", F.lit("")).alias("employeeCount"))


@query("snk2_json_sink", sql("SELECT paper_url, lang || '|' || source AS authors, source_url FROM papers WHERE lang <> 'de'".replace("source_url", "paper_url AS source_url")))
def snk2(i):
    path = scratch_path(i.spark, "papers")
    tables.write_json(papers.papers(i.paper_feeds, NEWS_AS_OF), path)
    back = tables.read_json(i.spark, path, schemas.PAPERS)
    return back.select("paper_url", F.array_join("authors", "|").alias("authors"), "source_url")


@query("snk3_json_and_csv", sql(f"SELECT * FROM ({PRODUCTS})"))
def snk3(i):
    path = scratch_path(i.spark, "products")
    nested = pages.products(page_startups(i), i.pages, NEWS_AS_OF, n=None)
    tables.write_json_and_csv(nested, path, schemas.PRODUCTS, tables.flat_product)
    flat = tables.read_csv(i.spark, f"{path}/csv", schemas.PRODUCTS).select(
        "source_url", "productName", "startupName", "productDescription",
        F.nullif("pricingModel", F.lit("")).alias("pricingModel"),
    )
    deep = tables.read_json(i.spark, f"{path}/json", schemas.PRODUCTS_NESTED)
    return flat.join(deep.select(F.col("source.url").alias("source_url")).distinct(), "source_url", "left_semi")


@query("snk4_write_unless_empty", sql("SELECT source_url FROM jobs WHERE source_url <> ''"))
def snk4(i):
    path = scratch_path(i.spark, "jobs")
    rows = i.jobs.filter(text.is_filled(F.col("source_url")))
    write = lambda df: tables.write_csv(df, path, "source_url string")
    tables.write_if_any(rows.filter("source_url = 'nowhere'"), write)
    tables.write_if_any(rows, write)
    return tables.read_csv(i.spark, path, "source_url string", ordered=False)
