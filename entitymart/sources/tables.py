"""CSV, JSON and Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitymart.functions.text import json_list
from entitymart.operators.ordering import ORD, with_file_order
from entitymart.schemas import columns, conform
from entitymart.session import materialise

# Quotes are doubled, quoted values may hold line ends, spaces are data.
CSV_READ = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "enforceSchema": False}
# Time stamps as ISO text with microseconds and offset, as they were collected.
STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"}
CSV_WRITE = {
    **STAMP,
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(spark: SparkSession, path: str, ddl: str, ordered: bool = True) -> DataFrame:
    """CSV table of a known schema, every value a string; a missing path raises.

    Quoted line ends make a file indivisible, so a large table is many files,
    which ``write_csv`` produces.
    """
    text = ", ".join(f"`{c}` string" for c in columns(ddl))
    df = spark.read.schema(text).options(**CSV_READ).csv(path)
    return with_file_order(df) if ordered else df


def read_csv_or_empty(spark: SparkSession, path: str, ddl: str, ordered: bool = True) -> DataFrame:
    """As ``read_csv``; a missing path gives an empty table."""
    try:
        return read_csv(spark, path, ddl, ordered)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        order = f", {ORD} struct<file: string, block: bigint, row: bigint>" if ordered else ""
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns(ddl)) + order)


def write_csv(df: DataFrame, path: str, ddl: str) -> None:
    """CSV table in the schema's column order, replacing the path; string arrays as JSON text."""
    lists = [c for c, t in df.dtypes if t == "array<string>"]
    conform(df.withColumns({c: json_list(F.col(c)) for c in lists}), ddl).write.mode("overwrite").options(**CSV_WRITE).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, nested values kept, nulls written out."""
    df.drop(ORD).write.mode("overwrite").options(**STAMP, ignoreNullFields=False).json(path)


def read_json(spark: SparkSession, path: str, ddl: str, ordered: bool = True) -> DataFrame:
    df = spark.read.schema(ddl).options(**STAMP).json(path)
    return with_file_order(df) if ordered else df


def write_json_and_csv(df: DataFrame, path: str, ddl: str, flat: DataFrame | None = None) -> None:
    """The nested records as JSON and the flat rows as CSV from one evaluation,
    which is kept in the shared folder."""
    kept = materialise(df, "records")
    write_json(kept, f"{path}/json")
    write_csv(flat(kept) if flat else kept, f"{path}/csv", ddl)


def write_if_any(df: DataFrame, write) -> bool:
    """Call ``write(df)`` unless the table is empty; tells whether it wrote."""
    if df.isEmpty():
        return False
    write(df)
    return True


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table, read where it lies, with time stamps as instants."""
    return spark.read.schema(as_instants(spark.read.parquet(path).schema)).parquet(path)


def as_instants(schema: T.StructType) -> T.StructType:
    """The schema with zone-less time stamps read as UTC instants, so that a
    comparison with an instant needs no cast and reaches the scan."""
    kind = lambda t: T.TimestampType() if isinstance(t, T.TimestampNTZType) else t
    return T.StructType([T.StructField(f.name, kind(f.dataType), f.nullable) for f in schema])


def flat_product(df: DataFrame) -> DataFrame:
    """Nested product records as flat rows."""
    return df.select(
        "schemaVersion",
        "recordType",
        F.col("source.name").alias("source_name"),
        F.col("source.url").alias("source_url"),
        "content.*",
        "collectedAt",
    )


def flat_job(df: DataFrame) -> DataFrame:
    """Nested job records as flat rows."""
    return df.select(
        "schemaVersion",
        "recordType",
        "source_name",
        "source_url",
        "content.company",
        "content.title",
        "content.date",
        "content.is_remote",
        "content.role_family",
        "content.category",
        "content.job_type",
        "content.candidate_required_location",
        "collectedAt",
    )


def flat_paper(df: DataFrame) -> DataFrame:
    """Papers with the author array as JSON text, items parted by comma and space."""
    return df.withColumn("authors", json_list(F.col("authors"))).drop("updated_date")
