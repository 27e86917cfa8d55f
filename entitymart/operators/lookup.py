"""Equi-joins of a large table to a lookup table, safe for size and skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def total_bytes(df: DataFrame) -> Column:
    """Aggregate: upper estimate of the rows' size, from the values themselves."""
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif not isinstance(f.dataType, T.NumericType):
            width = width + F.length(F.to_json(F.struct(f.name)))
        width = width + F.lit(16)
    return F.coalesce(F.sum(width), F.lit(0))


def fits_broadcast(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> bool:
    return df.agg(total_bytes(df)).first()[0] <= limit


def salted(df: DataFrame, spread: list[str], salts: int = SALTS) -> DataFrame:
    """Add a salt that depends on the row alone, so a rerun task repeats it."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))


def replicated(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """One copy of each row per salt."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "inner",
    limit: int = MAX_BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Join ``facts`` to a lookup of names, one row per key, whose keys are skewed in the facts.

    For lookups that grow with the facts a plain join is right: adaptive execution
    broadcasts what turns out small and splits hot partitions, and nothing is copied.

    The lookup's size is counted first. Within ``limit`` it is broadcast and the
    facts are not shuffled. Beyond it both sides shuffle on key and salt, so a
    key with a large share of the facts is spread over ``SALTS`` tasks; ``spread``
    names fact columns that differ between rows of one key. ``small`` passes on
    the outcome of a check made before.
    """
    if fits_broadcast(lookup, limit) if small is None else small:
        return facts.join(F.broadcast(lookup), on, how)
    joined = salted(facts, spread).join(replicated(lookup), [*on, "_salt"], how)
    return joined.drop("_salt")
