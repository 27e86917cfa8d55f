"""Keep one row per key under an explicit order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entitymart.functions.text import blank_if_null, is_filled
from entitymart.operators.ordering import ORD


def keep_one(
    df: DataFrame,
    keys: dict[str, Column] | list[str],
    which: str,
    blank: str = "drop",
    order: list[str] | None = None,
    best: list[Column] | None = None,
) -> DataFrame:
    """First or last row per key.

    ``keys`` are columns, or named expressions; null and ``""`` are one key.
    ``blank="drop"`` drops rows with a blank key, ``"keep"`` treats blank as a
    value. ``best`` ranks before the input order. The rank filter lets Spark
    keep one row per key in each map task, so a hot key never reaches the
    shuffle as a whole.
    """
    named = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
    tmp = {f"_key_{i}": c for i, c in enumerate(named.values())}
    keyed = df.withColumns({n: blank_if_null(c.cast("string")) for n, c in tmp.items()})
    if blank == "drop":
        keyed = keyed.filter(reduce(lambda a, b: a & b, [is_filled(F.col(n)) for n in tmp]))
    side = F.asc if which == "first" else F.desc
    ranked = (best or []) + [side(o) for o in (order or [ORD])]
    window = W.partitionBy(*tmp).orderBy(*ranked)
    return keyed.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank", *tmp)


def relationships(df: DataFrame) -> DataFrame:
    """Last relationship per entity, record type and url; blank urls stay."""
    return keep_one(df, ["entityId", "recordType", "source_url"], "last", blank="keep")


def by_source_url(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Last row per url: jobs, news and startups."""
    return keep_one(df, ["source_url"], "last", order=order)


def jobs_by_lower_url(df: DataFrame) -> DataFrame:
    """First job per url, letter case ignored."""
    return keep_one(df, {"url": F.lower("source_url")}, "first")


def models(df: DataFrame) -> DataFrame:
    """First model per organisation and name, letter case ignored; no organisation is one too."""
    return keep_one(
        df,
        {"organization": F.lower("organization"), "model_name": F.lower("model_name")},
        "first",
        blank="keep",
    )


def papers(df: DataFrame) -> DataFrame:
    """First paper per url."""
    return keep_one(df, ["paper_url"], "first")
