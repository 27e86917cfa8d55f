"""Streaming forms, run over what has arrived and read back."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.operators import entities
from entitymart.operators.ordering import ORD
from entitymart.session import scratch_path
from entitymart.sources import jobs
from entitymart.sources.tables import as_instants
from entitymart.streaming import intake
from workload.company import ALL, LINK
from workload.inputs import JOBS_AS_OF, NEWS_AS_OF, Inputs
from workload.records import FRESH_NEWS, ITEM_TEXT, ITEM_TITLE
from workload.registry import query
from workload.sqlkit import FRESH_JOB, URL_1, sql


class Arriving(Inputs):
    """The same derived inputs, with every table read as a stream of files."""

    def table(self, name):
        schema = as_instants(self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").schema)
        reader = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.sf_dir)


@query(
    "st1_continuous_intake",
    sql(f"SELECT DISTINCT source_url FROM jobs WHERE source_url <> '' AND {FRESH_JOB}"),
)
def st1(i):
    stream = Arriving(i.spark, i.sf_dir).jobs
    fresh = intake.fresh_unique(stream, "date", JOBS_AS_OF)
    path = scratch_path(i.spark, "intake")
    intake.append_to(fresh.select("source_url", "title"), f"{path}/table", f"{path}/state").awaitTermination()
    return i.spark.read.parquet(f"{path}/table").select("source_url")


def landed(df: DataFrame, path: str, triggers: int = 3) -> DataFrame:
    """The rows as several files that a stream takes a third at a time, in no order of the rows.

    There is a file for each core and trigger, two a trigger at least, so a batch keeps the cluster busy.
    """
    each = max(2, df.sparkSession.sparkContext.defaultParallelism)
    df.repartition(triggers * each, F.xxhash64(ORD, F.lit("landed"))).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", each).parquet(path)


def last_of(stream: DataFrame, path: str, order: list[str]) -> DataFrame:
    intake.keep_latest(stream, f"{path}/table", f"{path}/state", order=order).awaitTermination()
    return intake.latest(stream.sparkSession, f"{path}/table")


@query(
    "st1_last_job_per_url",
    sql(
        f"SELECT title, company, source_url, source_name FROM (SELECT 0 AS s, _ord, title, company, {URL_1} AS source_url, "
        f"'Remote OK' AS source_name FROM jobs WHERE {FRESH_JOB} AND source_url <> '' UNION ALL "
        f"SELECT 1, _ord, title, company, source_url, 'Jobicy' FROM jobs WHERE {FRESH_JOB} AND source_url <> '') "
        "QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY s DESC, _ord DESC) = 1"
    ),
)
def st1_jobs(i):
    path = scratch_path(i.spark, "last-jobs")
    boards = [landed(i.board_1, f"{path}/board-1"), landed(i.board_2, f"{path}/board-2")]
    arriving = [jobs.board_1_jobs(boards[0], JOBS_AS_OF), jobs.board_2_jobs(boards[1], JOBS_AS_OF)]
    return last_of(jobs.union_sources(arriving), path, ["_source", ORD]).select("title", "company", "source_url", "source_name")


@query(
    "st1_last_news_per_url",
    sql(
        f"SELECT source_url, {ITEM_TITLE} AS title, {ITEM_TEXT} AS content FROM news WHERE {FRESH_NEWS} AND {ITEM_TITLE} <> '' "
        "QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY _ord DESC) = 1"
    ),
)
def st1_news(i):
    path = scratch_path(i.spark, "last-news")
    arriving = intake.fresh_news(landed(i.rss, f"{path}/feeds"), NEWS_AS_OF)
    return last_of(arriving, path, [ORD]).select("source_url", "title", "content")


@query("st2_continuous_linking", sql(f"SELECT {ALL} FROM job_links"))
def st2(i):
    stream = Arriving(i.spark, i.sf_dir).jobs
    path = scratch_path(i.spark, "linking")
    companies = entities.exact_names(entities.canonical_entities(i.startups))
    intake.link_stream(
        stream, "company", companies, "JOB", "HAS_JOB", JOBS_AS_OF, f"{path}/table", f"{path}/state"
    ).awaitTermination()
    return i.spark.read.parquet(f"{path}/table").select(LINK)
