"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entitymart.llm.common import Scratch

#: Cells of the ring; a virtual node stands at the end of a cell.
CELLS = 1 << 16
#: Rows that one exploded array makes.
CHUNK = 8192


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of each virtual node clockwise; a node's arc ends with its cell. One node stands in a cell."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for k in range(virtual_nodes):
            cell = int.from_bytes(hashlib.sha256(f"{shard}/{k}".encode()).digest()[:2], "big") % CELLS
            taken.setdefault(cell, shard)
    return sorted(taken.items())


def assigned(arcs: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first, end, shard, slot): which ranks of each arc's keys stand in which shard, and from which slot.

    A shard's load is bounded by an even share of all keys. Each arc fills its own shard
    first; what overflows goes on clockwise to the next shard that has room.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, out, over = [0] * shards, [], []

    def put(arc: int, first: int, end: int, shard: int) -> int:
        take = min(end - first, room[shard] - used[shard])
        if take:
            out.append((arc, first, first + take, shard, used[shard]))
            used[shard] += take
        return first + take

    for arc, (_, shard) in enumerate(arcs):
        first = put(arc, 0, counts.get(arc, 0), shard)
        if first < counts.get(arc, 0):
            over.append((arc, first, counts[arc]))
    for arc, first, end in over:
        at = arc
        while first < end:
            at = (at + 1) % len(arcs)
            first = put(arc, first, end, arcs[at][1])
    return out


def shard(documents: DataFrame, shards: int = 8, virtual_nodes: int = 64) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): the law is ``rows``.

    A row's key is its id, size and checksum, so a null id or text is a key like any other
    (no text: size 1, checksum 0) and rows that repeat whole are counted, ranked as one and
    spread again. Load bounds are an even share, so counts differ by at most one. Only one
    count for each arc (``shards`` x ``virtual_nodes`` at most) reaches the driver; the
    table of ranges that comes back has at most as many rows again and is broadcast.
    An empty table gives no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "ring")
    arcs = ring(shards, virtual_nodes)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keys = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    groups = keys.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    at = F.xxhash64("doc_id", "size", "text_crc32")
    groups = scratch.keep(groups.select("*", at.alias("at"), F.shiftrightunsigned(at, 48).cast("int").alias("cell")), "groups")

    # The arc of a cell: the first virtual node at or after it, round the ring.
    ends = F.array(*[F.lit(c) for c, _ in arcs])
    arc = F.size(F.filter(ends, lambda e: e < F.col("cell"))) % len(arcs)
    cells = groups.groupBy("cell").agg(F.sum("n").alias("cell_n")).withColumn("arc", arc)
    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = scratch.keep(cells.select("cell", "arc", "cell_n", F.coalesce(F.sum("cell_n").over(before), F.lit(0)).alias("cell_first")), "cells")
    counts = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("cell_n").alias("n")).collect()}
    ranges = spark.createDataFrame(assigned(arcs, counts, shards), "arc int, first long, end long, shard int, slot long")

    inside = Window.partitionBy("cell").orderBy("at", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = groups.withColumn("inner_first", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(cells.select("cell", "arc", "cell_first")), "cell")
    ranked = ranked.withColumn("rank", F.col("cell_first") + F.col("inner_first"))
    placed = ranked.join(F.broadcast(ranges), "arc").where((F.col("rank") < F.col("end")) & (F.col("rank") + F.col("n") > F.col("first")))
    low, high = F.greatest("rank", "first"), F.least(F.col("rank") + F.col("n"), "end")
    placed = placed.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + low - F.col("first")).alias("slot"), (high - low).alias("n"))
    chunked = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    last = F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1
    rows = chunked.withColumn("copy", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot") + F.col("copy")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
