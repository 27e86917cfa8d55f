"""Input order as data.

Spark rows have no order. Operators that keep the first or last row, or number
rows, read it from the column ``_ord``: a unique long that grows with arrival
order, the struct that ``with_file_order`` adds to a file scan, or a struct
made of such values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitymart.session import materialise

ORD = "_ord"
ONE_TASK_ROWS = 200_000


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_ord`` to a file scan: file, block in the file, row in the block.

    The running id only grows inside a task, and one block is read by one task,
    so the triple is the same however blocks are packed into tasks.
    """
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ORD),
    )


def with_position(df: DataFrame, name: str = "position", one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Dense 1-based row number by ``_ord``, whatever its type.

    The rows are counted first. Up to ``one_task_rows`` they are numbered in one
    task. Beyond that they are dealt by ranges of ``_ord`` and kept in the shared
    folder with the number of their range; rows are counted per range and
    numbered inside it, and only the counts, one per range, are summed up as a whole.
    """
    if df.select(ORD).limit(one_task_rows + 1).count() <= one_task_rows:
        return df.withColumn(name, F.row_number().over(W.orderBy(ORD)).cast("bigint"))
    dealt = materialise(df.repartitionByRange(ORD).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    in_range = F.row_number().over(W.partitionBy("_range").orderBy(ORD))
    numbered = dealt.withColumn("_row", in_range).join(starts, "_range")
    return numbered.withColumn(name, F.col("_start") + F.col("_row")).drop("_range", "_row", "_start")


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in input order."""
    return df.orderBy(ORD).limit(n)
