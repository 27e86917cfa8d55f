"""Encoded lengths and their exact histogram."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entitymart.llm.common import U64, Scratch, hashed, texts_of
from entitymart.llm.common import runs as text_runs

#: Bytes of neighbouring texts whose words are looked up together.
CHUNK = 4 << 20
#: Words, and parts of words, that a worker remembers.
REMEMBERED, PARTS = 1_000_000, 200_000


class Encoder:
    """Ids of a text by a tokenizer file, little-endian unsigned 32-bit, no special tokens added.

    A tokenizer that drops white space and marks word ends never joins what blanks
    separate, so a blank-separated word has the same ids in every text. Such words are
    remembered under their 64-bit hashes, and so are their parts; only new parts reach
    the library. Other tokenizers, and words beyond Latin-1, are encoded by it as they are.
    """

    _shared: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder for each file and worker process."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.parts = Tokenizer.from_file(path), {}
        # The memory of words, in the order of their hashes; the first is no word.
        self.name, self.pool, self.turn = np.zeros(1, U64), np.zeros(0, "<u4"), 0
        self.start, self.size, self.used = (np.zeros(1, np.int64) for _ in range(3))
        vocabulary = self.whole.get_vocab()
        self.by_word = getattr(self.whole.model, "end_of_word_suffix", None) == "</w>"
        if self.by_word:
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            letters = "a-zß-öø-ÿ"
            self.plain = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
            self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^{letters}0-9]+").findall

    def _encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learned(self, new: list[str]) -> list[bytes]:
        """Ids of words that the memory does not hold."""
        parts = [self.split(w.lower()) if self.plain(w) and "<|" not in w else None for w in new]
        unseen = list({p for ps in parts if ps for p in ps}.difference(self.parts))
        if unseen:
            ids = np.array(self.bare.encode(" ".join(unseen), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(unseen):
                raise ValueError("the tokenizer does not mark the end of each word")
            raw, start = ids.tobytes(), 0
            for part, end in zip(unseen, ends.tolist(), strict=True):
                self.parts[part] = raw[start:end]
                start = end
        return [self._encode(w) if ps is None else b"".join([self.parts[p] for p in ps]) for w, ps in zip(new, parts, strict=True)]

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Rows of the memory that hold the distinct words; new ones are learned first."""
        raw, bounds = texts_of(distinct)
        name = hashed(raw, bounds[:-1], np.diff(bounds))
        at = np.searchsorted(self.name, name)
        known = self.name[np.minimum(at, len(self.name) - 1)] == name
        if not known.all():
            new, which = np.unique(name[~known], return_index=True)
            found = self._learned(distinct.take(pa.array(np.flatnonzero(~known)[which])).to_pylist())
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            into = np.searchsorted(self.name, new)
            self.start = np.insert(self.start, into, len(self.pool) + np.cumsum(size) - size)
            self.name, self.size, self.used = np.insert(self.name, into, new), np.insert(self.size, into, size), np.insert(self.used, into, 0)
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(found), "<u4")])
            at = np.searchsorted(self.name, name)
        self.turn += 1
        self.used[at] = self.turn
        return at

    def _forget(self) -> None:
        """Half of the words go once there are more than REMEMBERED, the longest unused first."""
        if len(self.name) > REMEMBERED:
            kept = np.sort(np.argsort(self.used, kind="stable")[len(self.used) // 2 :])
            size = self.size[kept]
            start = np.cumsum(size) - size
            self.pool = self.pool[np.repeat(self.start[kept] - start, size) + np.arange(size.sum())]
            self.name, self.size, self.used, self.start = self.name[kept], size, self.used[kept], start
        if len(self.parts) > PARTS:
            self.parts = {}

    def runs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of neighbouring texts: their ids end to end, and the n + 1 bounds; null is empty.

        A run's words become numbers of its distinct words; only those are looked up,
        and ids are laid out by taking each number's ids from one array.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        for first, last in text_runs(bounds - bounds[0], CHUNK):
            part = texts.slice(first, last - first)
            if not self.by_word:
                found = [self._encode(t) for t in part.to_pylist()]
                yield np.frombuffer(b"".join(found), "<u4"), np.cumsum([0, *map(len, found)]) // 4
                continue
            split = pc.split_pattern(pc.replace_substring(part, "\n", " "), " ")
            words = split.flatten().dictionary_encode()
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)])
            word = self._places(words.dictionary)[words.indices.to_numpy()]
            sizes = self.size[word]
            upto = np.concatenate([[0], np.cumsum(sizes)])
            places = np.repeat(self.start[word] - upto[:-1], sizes)
            places += np.arange(len(places))
            yield self.pool[places], upto[ends]
            self._forget()

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        return np.concatenate([np.zeros(0, np.int64), *[np.diff(bounds) for _, bounds in self.runs(texts)]])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        for ids, bounds in self.runs(pa.array(texts, pa.large_string())):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield ids[a:b].tobytes()


def encoded_lengths(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """One row ``n_tokens`` for each row of ``documents``; null text has none."""

    def count(batches):
        encoder = Encoder.of(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(encoder.lengths(batch.column(0)))], ["n_tokens"])

    return documents.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame, width: int = 1024) -> DataFrame:
    """For each encoded length that occurs: what every context limit needs, without another pass.

    ``limit`` (the length), ``n_docs`` with it, ``docs_at_least`` and ``tokens_at_least``
    (that long or longer), ``truncated_total`` (tokens left when texts are cut to the
    limit), ``total_tokens``, and ``share_within`` (of documents that fit). Suffix sums run
    inside ranges of ``width`` lengths and then over the ranges, so no task sees all
    lengths. An empty table gives no rows.
    """
    counts = lengths.groupBy(F.col("n_tokens").alias("limit")).agg(F.count("*").alias("n_docs"))
    # Read twice below; the encoding behind it runs once.
    counts = Scratch(lengths.sparkSession, "histogram").keep(counts.withColumn("range", F.floor(F.col("limit") / width)), "counts")
    ranges = counts.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum(F.col("limit") * F.col("n_docs")).alias("t"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    over_all = Window.partitionBy(F.lit(0)).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(over_all).alias("d_all"),
        F.sum("t").over(over_all).alias("total_tokens"),
    )
    here = Window.partitionBy("range").orderBy(F.desc("limit")).rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.join(ranges, "range").select(
        "limit",
        "n_docs",
        (F.sum("n_docs").over(here) + F.col("d_above")).alias("docs_at_least"),
        (F.sum(F.col("limit") * F.col("n_docs")).over(here) + F.col("t_above")).alias("tokens_at_least"),
        "total_tokens",
        "d_all",
    )
    return rows.select(
        "limit",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("limit") * F.col("docs_at_least")).alias("truncated_total"),
        "total_tokens",
        ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("share_within"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, n_truncated, truncated_total) for any context limits, from the histogram alone."""
    rows = histogram.select("limit", "n_docs")
    return rows.agg(
        *[F.sum(F.when(F.col("limit") > m, F.col("n_docs")).otherwise(0)).alias(f"n{i}") for i, m in enumerate(limits)],
        *[F.sum(F.least("limit", F.lit(m)) * F.col("n_docs")).alias(f"t{i}") for i, m in enumerate(limits)],
    ).select(
        F.inline(
            F.array(*[F.struct(F.lit(m).cast("long").alias("limit"), F.coalesce(f"n{i}", F.lit(0)).alias("n_truncated"), F.coalesce(f"t{i}", F.lit(0)).alias("truncated_total")) for i, m in enumerate(limits)])
        )
    )


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The smallest length within which at least ``share`` of the documents fit."""
    return histogram.where(F.col("share_within") >= share).agg(F.min("limit").alias("limit"))
