"""Bytes that repeat an earlier passage, found by column-wise sorting of text fragments."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import U64, Scratch, buckets, mixed, packed, texts_of

#: Bytes of the run whose hash anchors a window.
GRAM = 32
#: Fragments cut at once.
SLICE = 1 << 16
#: Bytes of text hashed at once.
CHUNK = 2 << 20
SEEN = np.dtype([("hash", "<u4"), ("text", "<i8"), ("at", "<u4")])
PLACE = np.dtype([("text", "<i8"), ("at", "<u4")])


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place; doubling, so five passes."""
    h, width = raw.astype(U64) + U64(1), 1
    while width < GRAM:
        h = h[:-width] * U64(pow(0xD6E8FEB86659FD93, width, 1 << 64)) + h[width:]
        width *= 2
    return mixed(h)


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, its hash, and the first and last window that it stands for.

    The anchor of a window of ``length`` bytes is the leftmost of the runs in it with the
    smallest hash, so equal windows have equal anchors at equal places. Every window has one
    anchor, and the windows of an anchor follow each other.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none.astype(U64), none, none
    h = gram_hashes(raw)
    span = length - GRAM + 1  # runs in a window
    low, width = h, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(h) - span + 1], low[span - width :])
    start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    end = np.r_[start[1:], len(low)]
    found: list[tuple] = []
    around = np.arange(span)
    while len(start):
        at = start + h[start[:, None] + around].argmin(axis=1)
        last = np.minimum(at, end - 1)
        found.append((at, start, last))
        more = at + 1 < end  # the same smallest hash again: periodic text
        start, end = at[more] + 1, end[more]
    at, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], h[at[order]], first[order], last[order]


def _pieces(raw: np.ndarray, length: int):
    """Overlapping pieces of one text and how many of their first windows count; together every window once."""
    for first in range(0, max(1, len(raw) - length + 1), CHUNK):
        yield first, raw[first : first + CHUNK + length - 1]


def _seen(n: int, length: int):
    """Arrow step: hash, text and place of every anchor, by bucket of the hash."""

    def step(batches):
        for batch in batches:
            raw, bounds = texts_of(batch.column(1))
            texts, records, hashes = batch.column(0).to_numpy(), [], []
            once = np.zeros(len(texts), bool)  # equal texts of a batch are hashed once
            once[np.unique(texts, return_index=True)[1]] = True
            for row in np.flatnonzero(once & (np.diff(bounds) >= length)).tolist():
                for first, piece in _pieces(raw[bounds[row] : bounds[row + 1]], length):
                    at, h, _, _ = anchors(piece, length)
                    record = np.empty(len(at), SEEN)
                    record["hash"], record["text"], record["at"] = h & U64(0xFFFFFFFF), texts[row], at + first
                    records.append(record)
                    hashes.append(h)
            if records:
                blobs = list(packed(((np.concatenate(hashes) >> U64(32)) % U64(n)).astype(np.int64), np.concatenate(records), n))
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["bucket", "blob"])

    return step


def _repeated(n: int):
    """Places of anchors whose hash occurs at two places of the texts, by bucket of the text."""

    def repeated(table: pa.Table) -> pa.Table:
        seen = np.frombuffer(b"".join(table.column("blob").to_pylist()), SEEN)
        order = np.lexsort((seen["at"], seen["text"], seen["hash"]))
        seen = seen[order]
        new_hash = np.r_[True, seen["hash"][1:] != seen["hash"][:-1]]
        new = new_hash | np.r_[True, (seen["text"][1:] != seen["text"][:-1]) | (seen["at"][1:] != seen["at"][:-1])]
        seen, new_hash = seen[new], new_hash[new]
        group = np.cumsum(new_hash) - 1
        again = seen[np.bincount(group)[group] > 1]
        place = np.empty(len(again), PLACE)
        place["text"], place["at"] = again["text"], again["at"]
        blobs = list(packed(place["text"] % n, place, n))
        return pa.table([pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["bucket", "blob"])

    return repeated


def _by_text(table: pa.Table) -> pa.Table:
    place = np.frombuffer(b"".join(table.column("blob").to_pylist()), PLACE)
    place = place[np.lexsort((place["at"], place["text"]))]
    text = place["text"]
    start = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
    blobs = [x.astype("<u4").tobytes() for x in np.split(place["at"], start[1:])] if len(text) else []
    return pa.table([pa.array(text[start].astype(np.int64)), pa.array(blobs, pa.binary())], ["text_hash", "places"])


def _fragments(n: int, length: int):
    """Arrow step: the bytes that the windows of each repeated anchor cover, by bucket of the anchor's hash."""
    reach = length - GRAM  # a window starts at most so far before its anchor
    width = reach + length
    record = np.dtype([("doc", "<i8"), ("text", "<i8"), ("at", "<u4"), ("first", "<u4"), ("last", "<u4"), ("bytes", "u1", (width,))])

    def step(batches):
        for batch in batches:
            raw, bounds = texts_of(batch.column(2))
            docs, texts, places = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            found, hashes = [], []

            def flush():
                if found:
                    hashed = np.concatenate(hashes)
                    blobs = list(packed(((hashed >> U64(32)) % U64(n)).astype(np.int64), np.concatenate(found), n))
                    found.clear()
                    hashes.clear()
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blobs], pa.int32()), pa.array([x for _, x in blobs], pa.binary())], ["bucket", "blob"])

            size = 0
            for row in range(batch.num_rows):
                wanted = np.frombuffer(places[row].as_py(), "<u4").astype(np.int64)
                text = raw[bounds[row] : bounds[row + 1]]
                for start, piece in _pieces(text, length):
                    at, h, first, last = anchors(piece, length)
                    hit = np.isin(at + start, wanted)
                    at, h, first, last = at[hit] + start, h[hit], first[hit] + start, last[hit] + start
                    if not len(at):
                        continue
                    padded = np.zeros(len(piece) + 2 * reach + length, np.uint8)
                    padded[reach : reach + len(piece)] = piece
                    around = np.lib.stride_tricks.sliding_window_view(padded, width)
                    # A periodic text has an anchor at each place: fragments are cut a slice at a time.
                    for low in range(0, len(at), SLICE):
                        a, f, e = at[low : low + SLICE], first[low : low + SLICE], last[low : low + SLICE]
                        out = np.empty(len(a), record)
                        out["doc"], out["text"], out["at"], out["first"], out["last"] = docs[row], texts[row], a, f, e
                        out["bytes"] = around[a - start]
                        # Bytes outside the anchor's windows say nothing here; blank ones pack well.
                        column = np.arange(width, dtype=np.int32)[None, :]
                        out["bytes"][(column < (f - a + reach)[:, None]) | (column >= (e + length - a + reach)[:, None])] = 0
                        found.append(out)
                        hashes.append(h[low : low + SLICE])
                        size += out.nbytes
                        if size > 32 << 20:
                            yield from flush()
                            size = 0
            yield from flush()

    return step, record


def sorted_columns(fragments: np.ndarray):
    """Column after column: the order of the fragments by what they hold up to it, and common stretches.

    One symbol of each fragment is taken in each round. The order by reversed prefixes is
    kept by a stable sort on the new symbol, which places the fragments as in a positional
    Burrows-Wheeler transform; ``since[k]`` is the first column from which fragment k of the
    order equals the one before it up to the round's column.
    """
    n, width = fragments.shape
    columns = np.ascontiguousarray(fragments.T)
    order, since = np.arange(n), np.zeros(n, np.int64)
    for column in range(width):
        symbol = columns[column][order]
        move = np.argsort(symbol, kind="stable")
        # Between two neighbours of the new order lie rows with other symbols: the latest start of all of them.
        same = np.r_[False, symbol[move][1:] == symbol[move][:-1]]
        fresh = np.full(n, column + 1, np.int64)
        close = same & np.r_[False, move[1:] == move[:-1] + 1]
        fresh[close] = since[move[close]]
        far = np.flatnonzero(same & ~close)
        if len(far):
            ends = np.stack([move[far - 1] + 1, move[far] + 1], 1).ravel()
            fresh[far] = np.maximum.reduceat(np.r_[since, 0], ends)[::2]
        order, since = order[move], fresh
        yield column, order, since


def repeated_windows(fragment: np.ndarray, length: int) -> np.ndarray:
    """Row by row, which of its windows (by place before the anchor) repeat an earlier one.

    ``fragment`` is sorted by document, text and place, so of equal windows the first row's
    is the earliest; equal rows are one and the same place.
    """
    reach = length - GRAM
    n = len(fragment)
    out = np.zeros((n, reach + 1), bool)
    at = fragment["at"].astype(np.int64)
    first, last = fragment["first"].astype(np.int64) - at + reach, fragment["last"].astype(np.int64) - at + reach
    for column, order, since in sorted_columns(fragment["bytes"]):
        window = column + 1 - length
        if window < 0:
            continue
        held = (first[order] <= window) & (window <= last[order])
        if held.sum() < 2:
            continue
        group = np.cumsum(since > window)  # equal from the window's start on
        rows, group = order[held], group[held]
        least = np.full(group[-1] + 1, n)
        np.minimum.at(least, group, rows)
        out[rows, window] = rows > least[group]
    return out


def _remove(record: np.dtype, length: int):
    def remove(table: pa.Table) -> pa.Table:
        blobs = table.column("blob").to_pylist()
        fragment = np.frombuffer(b"".join(blobs), record)
        key = ("first", "at", "text", "doc")
        fragment = fragment[np.lexsort([fragment[k] for k in key])]
        fragment = fragment[np.r_[True, np.any([fragment[k][1:] != fragment[k][:-1] for k in key], axis=0)]]
        gone = repeated_windows(fragment, length)
        edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1]
        reach = length - GRAM
        at = fragment["at"].astype(np.int64)[row] - reach
        columns = [fragment["doc"][row], fragment["text"][row], at + low, at + high - 1 + length]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], ["doc_id", "text_hash", "low", "high"])

    return remove


def _cut(batches):
    """Arrow step: bytes and runs removed from each text, and a digest of the rest."""
    for batch in batches:
        raw, bounds = texts_of(batch.column(2))
        removed, spans, digests = [], [], []
        for row in range(batch.num_rows):
            text, ranges = raw[bounds[row] : bounds[row + 1]], batch.column(3)[row].as_py()
            edges = np.zeros(len(text) + 1, np.int64)
            for r in ranges:
                edges[r["low"]] += 1
                edges[r["high"]] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()))
            digests.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
        columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_removed", "n_spans", "kept_sha256"])


def removals(documents: DataFrame, scratch: Scratch, length: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with digest; texts that may repeat something; and the byte ranges to remove from them.

    Windows of ``length`` bytes are found again by anchors: first only hashes and places of
    anchors are dealt by hash, then the bytes around the anchors that occur twice. Equal
    texts count once in both. In a bucket the fragments stand aligned at their anchors and
    are sorted column by column.
    """
    spark = documents.sparkSession
    n = buckets(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    digest = scratch.keep(rows.select("doc_id", "known", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "digest")
    firsts = digest.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"))

    seen = rows.select("text_hash", "text").mapInArrow(_seen(n, length), "bucket int, blob binary")
    again = seen.groupBy("bucket").applyInArrow(_repeated(n), "bucket int, blob binary")
    places = again.groupBy("bucket").applyInArrow(_by_text, "text_hash long, places binary")
    asked = scratch.keep(places.join(firsts, "text_hash").select(F.col("text_hash").alias("p_hash"), "first_id", "places"), "asked")

    hold = rows.join(asked, (rows["text_hash"] == asked["p_hash"]) & (rows["doc_id"] == asked["first_id"]))
    hold = scratch.keep(hold.select("doc_id", "text_hash", "text", "places"), "texts")
    step, record = _fragments(n, length)
    fragments = hold.mapInArrow(step, "bucket int, blob binary")
    ranges = fragments.groupBy("bucket").applyInArrow(_remove(record, length), "doc_id long, text_hash long, low long, high long")
    return digest, hold, scratch.keep(ranges, "ranges")


def remove_repeats(documents: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): each byte covered by a string of ``length`` bytes that also starts earlier goes.

    Earlier is a smaller doc_id, or an earlier start in the same document. Texts are UTF-8
    bytes, a null text is empty; matches never cross documents; strings are judged on the
    input. A null id is smaller than all others. Rows with the same id are told apart by a
    hash of their text; rows that repeat id and text are one document and share its result.
    A later copy of a whole text is removed whole if it has ``length`` bytes. An empty table
    gives no rows. Equality of windows is decided on the bytes themselves; equality of whole
    texts, which only skips work, by a 64-bit hash.
    """
    scratch = Scratch(documents.sparkSession, "repeats")
    digest, hold, ranges = removals(documents, scratch, length)
    listed = ranges.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    texts = hold.select("doc_id", "text_hash", "text").dropDuplicates(["doc_id", "text_hash"])
    cut = texts.join(listed, ["doc_id", "text_hash"]).mapInArrow(_cut, "doc_id long, text_hash long, n_removed long, n_spans long, kept_sha256 string")
    cut = scratch.keep(cut, "cut")
    firsts = digest.groupBy("text_hash").agg(F.min("doc_id").alias("first_id"))
    whole = (F.col("doc_id") > F.col("first_id")) & (F.col("n_bytes") >= length)
    rows = digest.join(firsts, "text_hash").join(cut, ["doc_id", "text_hash"], "left")
    return rows.select(
        F.when(F.col("known"), F.col("doc_id")).alias("doc_id"),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
