"""Continuous forms of intake and linking.

``fresh_unique`` keeps the first arrival of a url within the window, with bounded state.
``keep_latest`` keeps the last record of a key by the records' own order, whatever order
they arrive in, so its table equals what the batch form keeps.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from entitymart.functions.dates import is_fresh
from entitymart.functions.text import is_filled
from entitymart.operators.dedup import keep_one
from entitymart.operators.entities import Names, link_by_name
from entitymart.operators.ordering import ORD
from entitymart.sources import feeds


def fresh_unique(stream: DataFrame, time: str, as_of: datetime | None = None, key: str = "source_url") -> DataFrame:
    """Fresh records, one per url, with state bounded by the watermark.

    Without ``as_of`` freshness is judged at each micro-batch's own time, so a
    query may run on; a fixed time is for replays and tests.

    The window's upper bound is applied before the watermark, so a record dated
    in the future cannot move the watermark past good ones.
    """
    fresh = stream.filter(is_filled(stream[key]) & is_fresh(stream[time], as_of))
    return fresh.withWatermark(time, "24 hours").dropDuplicatesWithinWatermark([key])


def append_to(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append arriving records to a Parquet table, exactly once.

    ``trigger`` is Spark's, ``processingTime="1 minute"`` say; without it all
    that has arrived is processed and the query ends.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def keep_latest(
    stream: DataFrame, path: str, checkpoint: str, key: str = "source_url", order: list[str] | None = None, **trigger
) -> StreamingQuery:
    """Keep the last record of each key by ``order``, whose values differ within a key; blank keys are dropped.

    The state holds one record a key (use the RocksDB state store where keys are many) and is
    combined map-side, so a hot key sends one record a task. A batch writes the keys that
    it changed to a folder under its id and replaces that folder when it runs again, so a
    restart neither loses nor doubles a record. ``latest`` reads the table.
    """
    values = [c for c in stream.columns if c != key]
    last = F.max_by(F.struct(*values), F.struct(*(order or [ORD])))
    kept = stream.filter(is_filled(stream[key])).groupBy(key).agg(last.alias("_last")).select(key, "_last.*")

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        kept.writeStream.foreachBatch(put)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest(spark: SparkSession, path: str, key: str = "source_url") -> DataFrame:
    """The records that ``keep_latest`` keeps by now: of each key those of its last batch."""
    return keep_one(spark.read.parquet(path), [key], "last", order=["batch"]).drop("batch")


def fresh_news(stream: DataFrame, as_of: datetime | None = None, articles: DataFrame | None = None) -> DataFrame:
    """News records of a stream of landed feeds, several items a payload; the content is the
    page's ``article`` by ``url`` where a table of articles is given and has it, else the description.
    """
    items = feeds.fresh_items(feeds.feed_items(stream, as_of), as_of)
    if articles is None:
        return feeds.records(items.withColumn("article", F.lit(None).cast("string")), as_of)
    return feeds.records(items.join(articles.select("url", "article"), "url", "left"), as_of)


def link_stream(
    stream: DataFrame,
    name: str,
    names: Names,
    record_type: str,
    relationship_type: str,
    as_of: datetime,
    path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Link each arriving batch to the entity table and keep it under its batch id.

    A batch that is run again after a failure replaces its own folder, so the
    table holds every link once.
    """

    def link(batch: DataFrame, batch_id: int) -> None:
        linked = link_by_name(batch, name, names, record_type, relationship_type, as_of)
        linked.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(link)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
