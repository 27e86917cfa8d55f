import glob

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, rows
from entitymart.streaming import intake
from workload import streams
from workload.inputs import Inputs
from workload.registry import QUERIES, SQL

ORACLE = [
    "ag1_products_per_company", "jn2_jobs_to_entities", "jn3_news_mentions", "dd1_unique_relationships",
    "dd3_last_news_per_url", "dq4_quality_report", "prj1_board_1_jobs", "src6_rss_items", "org1_organization_sources",
    "en4_failed", "st1_continuous_intake", "st1_last_job_per_url", "st1_last_news_per_url", "src6_rss_items_at_any_depth",
    "fn4_nested_article_text", "fn5_week_dates_and_short_years",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cur.fetchall())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["entityId", "entityName", "productCount"]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


LAZY = [
    "jn1_products_to_entities", "jn3_paper_mentions", "ag1_mapping_analytics", "dd2_last_job_per_url", "dd6_first_model",
    "prj4_news_records", "prj15_enriched_models", "jn7_repository_stars", "org1_organization_sources", "jn4_pending", "dq4_quality_report",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_nested_loops_and_no_python(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for word in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval"):
        assert word not in text


def test_duplicates_shrink_before_the_shuffle(spark, sf):
    text = plan(entry.queries()["dd3_last_news_per_url"](spark, sf))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_counts_of_linked_rows_only_hash(spark, sf):
    text = plan(entry.queries()["ag1_products_per_company"](spark, sf))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_freshness_reaches_the_scan(spark, sf):
    text = plan(entry.queries()["flt1_fresh_jobs"](spark, sf))
    assert "GreaterThanOrEqual(o_orderdate" in text and "o_comment" not in text


def test_inputs_hold_the_hard_cases(spark, sf):
    i = Inputs(spark, sf)
    assert i.startups.filter("trim(entityName) = ''").count() > 0
    assert i.jobs.count() > i.jobs.select("source_url").distinct().count()


def test_a_stream_of_landed_files_keeps_all_cores_busy(spark, tmp_path):
    """As many files a trigger as there are cores, three triggers, every row once."""
    rows = spark.range(500).select(F.col("id").alias("_ord"), F.lit("x").alias("payload"))
    stream = streams.landed(rows, f"{tmp_path}/in")
    cores = spark.sparkContext.defaultParallelism
    assert len(glob.glob(f"{tmp_path}/in/*.parquet")) >= 3 * cores - 2
    intake.append_to(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert len(glob.glob(f"{tmp_path}/state/commits/[0-9]*")) == 3
    assert sorted(r["_ord"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(500))
