"""One fixed schema per dataset, as DDL; readers never infer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, order and types of every dataset.
STARTUPS = """
    schemaVersion string, recordType string, source_name string, source_url string,
    entityName string, employeeCount bigint, collectedAt timestamp
"""
PRODUCTS = """
    schemaVersion string, recordType string, source_name string, source_url string,
    productName string, startupName string, productDescription string, pricingModel string,
    collectedAt timestamp
"""
PRODUCTS_NESTED = """
    schemaVersion string, recordType string, source struct<name: string, url: string>,
    content struct<productName: string, startupName: string, productDescription: string,
                   pricingModel: string>,
    collectedAt timestamp
"""
PAPERS = """
    schemaVersion string, recordType string, source_name string, source_url string,
    title string, authors array<string>, paper_url string, github_url string,
    github_stars bigint, published_date string, updated_date string, collectedAt timestamp
"""
PAPERS_CSV = """
    schemaVersion string, recordType string, source_name string, source_url string,
    title string, authors string, paper_url string, github_url string,
    github_stars bigint, published_date string, collectedAt timestamp
"""
PAPERS_SEARCHED = """
    schemaVersion string, recordType string, title string, authors string, paper_url string,
    github_url string, github_stars bigint, published_date string, updated_date string,
    source string, collected_at timestamp
"""
NEWS = """
    schemaVersion string, recordType string, source_name string, source_url string,
    title string, publishedAt timestamp, content string, collectedAt timestamp
"""
JOBS = """
    schemaVersion string, recordType string, company string, date timestamp, is_remote boolean,
    role_family string, title string, source_name string, source_url string,
    collectedAt timestamp
"""
JOBS_DETAILED = """
    schemaVersion string, recordType string, source_name string, source_url string,
    company string, title string, date timestamp, is_remote boolean, role_family string,
    category string, job_type string, candidate_required_location string,
    collectedAt timestamp
"""
MODELS = """
    model_name string, organization string, source_url string, downloads bigint, likes bigint,
    pipeline_tag string, library_name string
"""
MODELS_ENRICHED = """
    model_name string, organization string, source_url string, official_website string,
    logo_url string, description string, downloads bigint, likes bigint, pipeline_tag string,
    library_name string
"""
PROGRESS = "source_url string, description string"
FAILED = "model_name string, organization string, source_url string"
ORGANIZATION_COUNTS = """
    organization string, model_count bigint, official_website string, logo_url string
"""
ORGANIZATION_SOURCES = """
    organization string, official_website string, logo_url string, verification_status string,
    source_type string
"""
RELATIONSHIPS = """
    entityId string, entityName string, entityType string, recordType string,
    relationshipType string, source_url string, confidence double, mappedAt timestamp
"""
ANALYTICS = """
    entityId string, entityName string, productCount bigint, jobCount bigint,
    researchMentionCount bigint, newsMentionCount bigint, totalRelationships bigint
"""


def columns(ddl: str) -> list[str]:
    """Column names of a schema, in order."""
    return T.StructType.fromDDL(ddl).names


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project to a schema; columns the input lacks become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(ddl)
        ]
    )
