"""Sources mixed to target weights by seeded Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import Scratch


def rates(documents: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """(mix_source, mix_rate): mean repetitions that give each source its share of all text bytes.

    ``weights`` has ``source`` and ``weight``, a source once; a source it lacks, or weighs
    null or below zero, gets none. Without ``weights`` all sources weigh the same. A null
    source counts as the source ''. Sizes are bytes plus one, so empty texts can be drawn.
    """
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long") + 1
    sizes = documents.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_source")).agg(F.sum(size).alias("mix_size"))
    if weights is None:
        weighed = sizes.withColumn("mix_weight", F.lit(1.0))
    else:
        named = weights.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_source"), F.col("weight").cast("double").alias("mix_weight"))
        weighed = sizes.join(named, "mix_source", "left").withColumn("mix_weight", F.greatest(F.coalesce("mix_weight", F.lit(0.0)), F.lit(0.0)))
    weighed = Scratch(documents.sparkSession, "sources").keep(weighed, "weighed")
    all_size, all_weight = weighed.agg(F.sum("mix_size"), F.sum("mix_weight")).first()
    if not all_weight:
        return weighed.select("mix_source", F.lit(0.0).alias("mix_rate"))
    rate = F.col("mix_weight") / F.lit(all_weight) * F.lit(all_size) / F.col("mix_size")
    return weighed.select("mix_source", rate.alias("mix_rate"))


def cumulative(rate: Column) -> Column:
    """Poisson distribution function at 0, 1, ... far beyond the mean; terms are kept as logarithms."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct((-rate).alias("l"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def add(acc: Column, k: Column) -> Column:
        log = acc["l"] + F.ln(rate / k)
        c = acc["c"] + F.exp(log)
        return F.struct(log.alias("l"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), most), start, add, lambda acc: acc["all"])).otherwise(F.array(F.lit(1.0)))


def uniform(seed: int, doc_id: Column) -> Column:
    """A number in (0, 1) from a hash of seed and id; a null id hashes as empty."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def mix(documents: DataFrame, weights: DataFrame | None = None, seed: int = 11) -> DataFrame:
    """Each document as often as its draw says, all copies in one global random order.

    Adds ``mix_copy`` (from 1), ``mix_rate`` and ``mix_key``, by which the result is sorted
    (replaced if they are there); all other columns stay. The draw inverts the Poisson distribution of the source's rate
    at a hash of the id, so it does not depend on partitions or reruns; rows that repeat an
    id draw alike. Null texts count as empty, null sources as ''. An empty table gives no
    rows. One row a source is broadcast only if Spark finds it small; else the join splits
    busy sources.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    drawn = scratch.keep(rates(documents, weights).withColumn("mix_steps", cumulative(F.col("mix_rate"))), "rates")
    added = ["mix_copy", "mix_rate", "mix_key"]
    names = documents.drop(*added).columns
    # Own names for the columns that travel along, so that none clashes with the operator's.
    given = [f"mix_given_{k}" for k in range(len(names))]
    doc_id, source = F.col(given[names.index("doc_id")]), F.col(given[names.index("source")])
    rows = documents.drop(*added).toDF(*given)
    rows = rows.withColumn("mix_source", F.coalesce(source.cast("string"), F.lit(""))).withColumn("mix_u", uniform(seed, doc_id))
    rows = rows.join(drawn, "mix_source").withColumn("mix_n", F.size(F.filter("mix_steps", lambda c: c < F.col("mix_u"))))
    copies = rows.where("mix_n > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_n"))))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}/order"), F.coalesce(doc_id.cast("string"), F.lit("")), F.col("mix_copy").cast("string")).cast("binary"))
    ordered = copies.withColumn("mix_key", key).select(*given, *added).orderBy("mix_key")
    return ordered.toDF(*names, *added)
