"""Scratch tables, connected components and vectorised text hashing for the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.session import scratch_path

U64 = np.uint64


class Scratch:
    """Tables of one run, in one folder of the shared folder that the cluster names.

    A table cuts lineage: a lost executor costs a read, not the work before it.
    ``drop`` removes a table that later steps no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def buckets(spark: SparkSession, per_partition: int = 4) -> int:
    """Groups that a keyed Python step deals its work into; follows the session's shuffle width."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node with an edge ``a``-``b``.

    Alternates large-star and small-star steps until the edges are stars. Minima are
    combined before the shuffle and the joins on a busy node are splittable, so a node
    with a third of all edges does not land in one task. Roots themselves are not listed.
    """
    a, b = F.col("a"), F.col("b")
    e = scratch.keep(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), f"{name}0")
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    before, turn = mark(e), 0
    while before[0]:
        both = e.select(a.alias("u"), b.alias("v")).unionByName(e.select(b.alias("u"), a.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        led = large.join(least, "a")
        small = led.select("a", F.col("m").alias("b")).unionByName(led.where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")))
        e = scratch.keep(small.distinct(), f"{name}{turn + 1}")
        scratch.drop(f"{name}{turn}")
        after, turn = mark(e), turn + 1
        if after == before:
            break
        before = after
    return e.select(a.alias("node"), b.alias("root"))


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` with the sets of ``i`` and ``j`` united; a set is named by its smallest index."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, up := label[label]):
            label = up


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and the n + 1 bounds; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def runs(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text stands alone."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


#: Bytes between words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], U64)


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased) of the texts, and its text's index."""
    inside = ~SPACE[raw]
    if not inside.any():
        return np.zeros(0, U64), np.zeros(0, np.int64)
    ends_here, starts_here = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    starts_here[bounds[:-1][bounds[:-1] < len(raw)]] = True
    ends_here[bounds[1:][bounds[1:] > 0] - 1] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | starts_here))
    length = np.flatnonzero(inside & (~after | ends_here)) + 1 - start
    return hashed(LOWER[raw], start, length), np.searchsorted(bounds, start, "right") - 1


def hashed(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eight = np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))
    value = length.astype(U64) * U64(0x9E3779B97F4A7C15)
    live, k = np.flatnonzero(length > 0), 0
    while len(live):
        part = eight[start[live] + 8 * k] & _KEPT[np.minimum(length[live] - 8 * k, 8)]
        value[live] = mixed(value[live] * U64(0xD6E8FEB86659FD93) + part)
        k += 1
        live = live[length[live] > 8 * k]
    return value


def packed(bucket: np.ndarray, records: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
    """The records of each bucket as one run of bytes."""
    order = np.argsort(bucket.astype(np.uint16) if n <= 65536 else bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(n + 1))
    records = records[order]
    for k in np.flatnonzero(np.diff(at)):
        yield int(k), records[at[k] : at[k + 1]].tobytes()
