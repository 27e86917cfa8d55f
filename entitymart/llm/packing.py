"""Documents cut into pieces and packed into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import Scratch
from entitymart.llm.tokens import Encoder

#: Pieces that one task packs.
PART_ROWS = 60_000
END = np.array([1], "<u4").tobytes()


def pieces(documents: DataFrame, path: str, limit: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): ids and an end mark, cut only where longer than ``limit``.

    A null text is empty and gives one piece, the end mark. Rows that repeat are cut each.
    """

    def cut(batches):
        encoder = Encoder.of(path)
        for batch in batches:
            doc, out, row = batch.column(0), [[], [], [], [], []], 0
            for found, bounds in encoder.runs(batch.column(1)):
                raw = found.tobytes()
                for first, last in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
                    ids = raw[first:last] + END
                    for k in range(0, len(ids), 4 * limit):
                        part = ids[k : k + 4 * limit]
                        for values, value in zip(out, (row, k // (4 * limit), k // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            values.append(value)
                    row += 1
            columns = [doc.take(pa.array(out[0], pa.int64())), *(pa.array(v, t) for v, t in zip(out[1:], (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, limit: int) -> int:
    """No packing of these lengths has fewer bins.

    The largest of the bounds from dual feasible functions: for each threshold, lengths
    above ``limit`` less it count as whole bins and those below it as nothing; and the
    rounding family that keeps multiples of ``limit`` / (k + 1) and rounds others down to k-ths.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=limit + 1).astype(np.int64)
    sizes = np.arange(limit + 1, dtype=np.int64)
    upto_n, upto_t = np.cumsum(counts), np.cumsum(counts * sizes)
    low = np.arange(1, limit // 2 + 1)
    whole = len(lengths) - upto_n[limit - low]
    between = upto_t[limit - low] - upto_t[low - 1]
    best = max(-(-int(upto_t[-1]) // limit), int(np.max(whole + -(-between // limit), initial=0)))
    for k in range(1, 20):
        # in units of 1 / (k * limit), so that the bound stays exact
        exact = sizes * (k + 1) % limit == 0
        value = np.where(exact, sizes * k, sizes * (k + 1) // limit * limit)
        best = max(best, -(-int((counts * value).sum()) // (k * limit)))
    return best


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each length, and what is left in each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r: some bin has room r
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = limit, len(left)
            left.append(limit)
        bins[i], offsets[i] = bin_, limit - room
        left[bin_] = room - size
        if left[bin_]:
            open_bins[left[bin_]].append(bin_)
            rooms |= 1 << left[bin_]
    return bins, offsets, np.array(left, np.int64)


_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, bin long, offset long, given_up boolean"


def _pack_part(limit: int):
    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets, left = best_fit(lengths, limit)
        gap = len(left) - lower_bound(lengths, limit)
        # A certified part gives up its emptiest bin, one with a gap those that may close it.
        n = min(len(left), 2 * gap + 1) if gap else int(left.max(initial=0) > 0)
        given = np.zeros(len(left), bool)
        given[np.argsort(-left, kind="stable")[:n]] = True
        given &= left > 0
        columns = [table.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "part")]
        columns += [pa.array(bins), pa.array(offsets), pa.array(given[bins])]
        return pa.table(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "bin", "offset", "given_up"])

    return pack


def pack(documents: DataFrame, path: str, limit: int = 4096, part_rows: int = PART_ROWS) -> DataFrame:
    """Every piece of ``documents`` with its ``sequence_id`` and ``offset``.

    Pieces are dealt evenly over parts, whatever their document; each part is packed by
    best-fit decreasing and certified against its lower bound. Parts with a gap, and the
    emptiest bin of each other, give up bins; their pieces are pooled over fewer parts and
    packed again, until one part holds the pool or the pool hardly shrinks. No part has more than about ``part_rows``
    pieces. An empty table gives no rows; a null text is one piece of the end mark alone.
    """
    scratch, done, turn, before = Scratch(documents.sparkSession, "packing"), [], 0, None
    pool = scratch.keep(pieces(documents, path, limit), "pieces")
    names = pool.columns
    while True:
        n = pool.count()
        parts = max(1, -(-n // part_rows))
        dealt = pool.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(parts)).cast("int"))
        packed = scratch.keep(dealt.groupBy("part").applyInArrow(_pack_part(limit), _PACKED), f"packed{turn}")
        last = parts == 1 or (before is not None and n > 0.8 * before)
        kept = packed if last else packed.where(~F.col("given_up"))
        number = F.lit(turn << 56) + F.shiftleft(F.col("part").cast("long"), 32) + F.col("bin")
        done.append(kept.select(*names, number.alias("sequence_id"), "offset"))
        if last:
            break
        pool, turn, before = packed.where("given_up").select(*names), turn + 1, n
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result
