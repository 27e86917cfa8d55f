"""Which hashed items are common in a whole table: counters of a bounded number of buckets.

A bucket counts every item that falls into it, so an item is never taken for rarer than it
is; it may be taken for more common. Operators use that to order or to leave out work in
a way that cannot change their results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from entitymart.llm.common import U64, mixed

#: Most buckets, however large the table: a broadcast holds a bit of each for every limit (32 MB).
MOST_BITS = 28
SLICE_BITS = 18
#: Rows that a filter copies at once.
FILTERED = 1000


class Common:
    """For each limit a bit a bucket: whether the bucket counted at least that many items."""

    def __init__(self, bits: int, maps: np.ndarray):
        self.bits, self.maps = bits, maps

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """How many of the limits each item's bucket reaches; none of them is above what the item reaches by itself."""
        at = (hashes >> U64(64 - self.bits)).astype(np.int64)
        out = np.zeros(len(hashes), np.uint8)
        for bitmap in self.maps:
            out += (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return out


def gaps(ids: np.ndarray) -> bytes:
    """Sorted numbers by their distances, one byte each; 255 adds to the distance that follows."""
    far = np.diff(ids, prepend=0)
    long = far // 255
    out = np.full(int(long.sum()) + len(ids), 255, np.uint8)
    out[np.cumsum(long + 1) - 1] = far % 255
    return out.tobytes()


def numbers(blob: bytes) -> np.ndarray:
    """What ``gaps`` wrote."""
    steps = np.frombuffer(blob, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def common(rows: DataFrame, items: Callable[[pa.RecordBatch], Iterator[np.ndarray]], n_items: int, limits: tuple[int, ...], load: float) -> Common:
    """Counts the 64-bit hashes that ``items`` takes from the batches of ``rows``.

    There is about one bucket for ``load`` items, at most 2 ** MOST_BITS; ``n_items`` is an
    estimate that only sets this number. A task sends the buckets that it met as gaps,
    one byte an item or less; counters are summed by slices of buckets.
    """
    bits = min(MOST_BITS, max(SLICE_BITS, round(math.log2(max(1.0, n_items / load)))))
    width, slices = 1 << SLICE_BITS, 1 << (bits - SLICE_BITS)
    most = max(limits)

    def met(batches):
        for batch in batches:
            for hashes in items(batch):
                ids = np.sort((hashes >> U64(64 - bits)).astype(np.int64))
                # More than the largest limit of one bucket says no more than the limit.
                ids = np.concatenate([ids[:most], ids[most:][ids[most:] != ids[:-most]]])
                at = np.searchsorted(ids, np.arange(slices + 1) * width)
                parts = [k for k in range(slices) if at[k] < at[k + 1]]
                blobs = [gaps(ids[at[k] : at[k + 1]] - k * width) for k in parts]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["slice", "met"])

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(width, np.int64)
        for part in parts:
            number = part["slice"].iloc[0]
            for blob in part["met"]:
                counts += np.bincount(numbers(blob), minlength=width)
        bits_of = [np.packbits(counts >= limit, bitorder="little").tobytes() for limit in limits]
        yield pd.DataFrame({"slice": [number], "bits": [b"".join(bits_of)]})

    found = rows.mapInArrow(met, "slice int, met binary").groupBy("slice").applyInPandas(add, "slice int, bits binary").collect()
    maps = np.zeros((len(limits), slices, width // 8), np.uint8)
    for row in found:
        maps[:, row["slice"]] = np.frombuffer(row["bits"], np.uint8).reshape(len(limits), width // 8)
    return Common(bits, maps.reshape(len(limits), -1))


def members(table: DataFrame, column: str) -> Broadcast:
    """A broadcast sketch that holds every 64-bit value of a column, and few others while it has room."""

    def items(batch):
        yield _hashes(batch.column(0))

    found = common(table.select(column).where(f"{column} is not null"), items, table.count(), (1,), 1 / 16)
    return table.sparkSession.sparkContext.broadcast(found)


def _hashes(column: pa.Array) -> np.ndarray:
    return mixed(np.ascontiguousarray(column.to_numpy(zero_copy_only=False).astype(np.int64)).view(U64))


def marked(rows: DataFrame, column: str, sketch: Broadcast, held: bool) -> DataFrame:
    """The rows whose value of ``column``, which is never null, the sketch holds, or those for which it surely does not.

    What a join can match is told from what it cannot without a shuffle.
    """
    place = rows.columns.index(column)

    def keep(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, FILTERED):
                batch = whole.slice(first, FILTERED)
                yield batch.filter(pa.array((sketch.value.level(_hashes(batch.column(place))) > 0) == held))

    return rows.mapInArrow(keep, rows.schema)
