"""Language of a text: known words first, shorter and shorter character runs for the others."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitymart.llm.common import Scratch

LETTERS = re.compile(r"[^\W\d_]+").findall
#: Longest character run; a word is framed by blanks before it is cut.
LONGEST = 5
#: Words whose scores a worker remembers.
REMEMBERED = 300_000
#: Words taken for known in every text, so that a short one is not judged by a few words.
GIVEN = 3
#: Texts scored together, in characters.
CHUNK = 1 << 20
#: Rows whose texts are read from a batch together.
ROWS = 256


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    framed = f" {word} "
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


@dataclass
class Model:
    """Log frequencies by language: of words (size 0) and of character runs of each size."""

    languages: list[str]
    rows: dict[int, dict[str, int]]
    scores: np.ndarray
    #: Which languages each entry was seen in: those where its log frequency is above that of an unseen one.
    own: np.ndarray | None = None

    def of_word(self, word: str) -> np.ndarray:
        """Scores of one word: its own if known, else the mean over the longest known character runs."""
        row = self.rows[0].get(word)
        if row is not None:
            return self.scores[row]
        for n in range(LONGEST, 0, -1):
            known = self.rows[n]
            found = [known[g] for g in grams(word, n) if g in known]
            if found:
                return self.scores[found].mean(axis=0)
        return np.zeros(len(self.languages))


def fit(documents: DataFrame, rows_per_language: int = 1000, entries: int = 400_000) -> Model:
    """Learn from at most ``rows_per_language`` labelled, not held-out documents of each language.

    The documents with the smallest id hashes are taken, with their whole texts; at most
    ``entries`` words and character runs are kept, the same number for each language and
    size, most frequent first. Both bounds are independent of the input's size, so the model
    may pass through the driver. Null labels and null ids are not learned from; an empty or
    unlabelled table gives a model without languages.
    """
    scratch = Scratch(documents.sparkSession, "language")
    labelled = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = labelled.select(F.col("doc_id").alias("s_id"), F.col("lang").cast("string").alias("s_lang")).distinct()
    # The smallest hashes of each of many parts of a language first, so that no task ranks a language whole.
    ids = ids.withColumn("order", F.xxhash64("s_id")).withColumn("share", F.pmod(F.xxhash64("s_id", F.lit(1)), F.lit(256)))
    for keys in (["s_lang", "share"], ["s_lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("order", "s_id"))
        ids = ids.withColumn("place", place).where(F.col("place") <= rows_per_language).drop("place")
    ids = scratch.keep(ids.select("s_id", "s_lang"), "sample")
    rows = labelled.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.join(ids, (rows.doc_id == ids.s_id) & (rows.lang == ids.s_lang), "left_semi").select("lang", "text")

    def table(found: Counter):
        keys = list(found)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array([found[k] for k in keys], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "size", "gram", "n"])

    def count_words(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, times in Counter(LETTERS((text or "").lower())).items():
                    found[lang, 0, word] += times
            yield table(found)

    def count_runs(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, word, times in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for n in range(1, LONGEST + 1):
                    for gram in grams(word, n):
                        found[lang, n, gram] += times
            yield table(found)

    kind, total = "lang string, size int, gram string, n long", F.sum("n").alias("n")
    words = scratch.keep(rows.mapInArrow(count_words, kind).groupBy("lang", "size", "gram").agg(total), "words")
    cut = words.select("lang", "gram", "n").mapInArrow(count_runs, kind).groupBy("lang", "size", "gram").agg(total)
    counts = scratch.keep(words.unionByName(cut), "counts")
    totals = {(r["lang"], r["size"]): r["n"] for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    languages = sorted({lang for lang, _ in totals})
    each = max(1, entries // max(1, len(totals)))
    by_count = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= each).select("lang", "size", "gram", "n").collect()
    index = {lang: k for k, lang in enumerate(languages)}
    rows_of: dict[int, dict[str, int]] = {n: {} for n in range(LONGEST + 1)}
    for r in top:
        rows_of[r["size"]].setdefault(r["gram"], len(rows_of[r["size"]]))
    scores, unseen, first = [], [], 0
    for n in range(LONGEST + 1):
        seen = np.zeros((len(rows_of[n]), len(languages)))
        for r in top:
            if r["size"] == n:
                seen[rows_of[n][r["gram"]], index[r["lang"]]] = r["n"]
        all_ = np.array([totals.get((lang, n), 0) for lang in languages], float)
        scores.append(np.log((seen + 0.5) / (all_ + 0.5 * max(1, len(seen)))))
        unseen.append(np.broadcast_to(np.log(0.5 / (all_ + 0.5 * max(1, len(seen)))), scores[-1].shape))
        rows_of[n] = {gram: first + k for gram, k in rows_of[n].items()}
        first += len(seen)
    return Model(languages, rows_of, np.concatenate(scores), np.concatenate(scores) > np.concatenate(unseen)) if languages else Model(languages, rows_of, np.zeros((0, 0)))


def scored(model: Model, texts: list[str], known: dict[str, int], table: list[np.ndarray], own: np.ndarray | None = None) -> tuple[list[str], list[float], list[float]]:
    """Language and score of each text, and the share of its words that are the language's own;
    ``known`` and ``table`` remember words between calls, ``own`` says which words each language has."""
    languages, scores, shares = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return languages, scores, shares
    split = [LETTERS(t.lower()) for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
        table.clear()
    for word in set().union(*split).difference(known):
        known[word] = len(table)
        table.append(model.of_word(word))
    values, look = np.array(table), known.__getitem__
    for k, found in enumerate(split):
        if found:
            sums = values[np.fromiter(map(look, found), np.int64, len(found))].sum(axis=0)
            best = int(sums.argmax())
            languages[k], scores[k] = model.languages[best], float(1 / np.exp(np.minimum(sums - sums[best], 0)).sum())
            if own is not None:
                words = model.rows[0]
                own_words = sum(1 for w in found if (row := words.get(w)) is not None and own[row, best])
                shares[k] = min(1.0, (own_words + GIVEN) / len(found))
    return languages, scores, shares


def identify(documents: DataFrame, model: Model, known: str | None = None) -> DataFrame:
    """All columns of ``documents`` plus ``lid_lang`` and ``lid_score`` (replaced if they are there).

    ``known`` names one more column: the share of the text's words that are known words of the
    predicted language, with ``GIVEN`` words given to every text. Unlike the score it does not
    tend to 1 as texts get longer.

    Only the text is looked at, and all of it: ``und`` and 0 if it is null, empty or has no
    letter, or if the model knows no language. The score is the share of the best language
    among all, from the sums over the words. Every row is judged alone, so rows that repeat
    get the same result; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    more = [known] if known else []
    documents = documents.drop("lid_lang", "lid_score", *more)
    schema = T.StructType([*documents.schema.fields, T.StructField("lid_lang", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in ("lid_score", *more))])
    place, names = schema.names.index("text"), schema.names

    def predict(batches):
        own = shared.value.own if more and shared.value.languages else None
        known: dict[str, int] = {}
        table: list[np.ndarray] = []
        for batch in batches:
            languages: list[str] = []
            scores: list[float] = []
            shares: list[float] = []
            # only a part of a batch's texts is held as Python text at a time
            for start in range(0, len(batch), ROWS):
                texts = [t or "" for t in batch.column(place).slice(start, ROWS).to_pylist()]
                first = 0
                while first < len(texts):
                    last, size = first, 0
                    while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK):
                        size += len(texts[last])
                        last += 1
                    found = scored(shared.value, texts[first:last], known, table, own)
                    for all_, part in zip((languages, scores, shares), found, strict=True):
                        all_ += part
                    first = last
            new = [pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new[: 2 + len(more)]], names)

    return documents.mapInArrow(predict, schema)
