"""Company names found as whole phrases in texts.

A normalised name is a run of whole words of the normalised text exactly when it
equals one of the text's n-grams, so the search is an equi-join on phrases. Its
cost follows the number of words, not records times names.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.text import json_list, match_words, mention_text, record_url, settled
from entitymart.operators.entities import Names, finish_links, mention_names
from entitymart.operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join, total_bytes
from entitymart.operators.ordering import ORD

#: Most bits of a bitmap of names' starts; it has 32 for each name up to that.
MOST_BITS = 1 << 20
#: Words that a run has; only one that starts like a longer name gets more.
RUN_WORDS = 8


def words(text: Column) -> Column:
    return F.split(text, " ")


def start_hash(words: Column, place: Column, k: int) -> Column:
    """Hash of the ``k`` words from a place on (0 is the first)."""
    return F.xxhash64(*[F.get(words, place + i) for i in range(k)])


def first_words(run: Column, k: int) -> Column:
    return F.substring_index(run, " ", k)


def phrases(run: Column, sizes: list[int]) -> Column:
    """The runs of ``k`` words that a window starts with, for each ``k``."""
    return F.array_distinct(F.array(*[first_words(run, k) for k in sizes]))


@dataclass(frozen=True)
class MentionNames(Names):
    """Names to search for, with the numbers of words they have.

    ``starts`` holds a hash of the words each name starts with, if those hashes fit a
    broadcast. ``marks`` is a bitmap of the same hashes, at most ``MOST_BITS`` whatever the names,
    ``firsts`` one of the first words alone, and ``heads`` one of the first ``RUN_WORDS`` words of longer names.
    """

    sizes: list[int]
    starts: DataFrame | None
    marks: list[int]
    firsts: list[int]
    heads: list[int]

    def start(self, text: Column) -> Column:
        """Hash of as many first words as the shortest name has."""
        return start_hash(words(text), F.lit(0), self.sizes[0])

    def runs(self, texts: DataFrame) -> DataFrame:
        """A row with ``_run`` for each word of ``_words`` at which a name may start: as many words as the longest name.

        Each word is a row only inside the generated code that hashes it and looks it up in the
        bitmaps; strings are made where those let a start through. A run has ``RUN_WORDS``
        words unless they may be the head of a longer name, so a few long names cost the others nothing.
        """
        shortest, longest = self.sizes[0], self.sizes[-1]
        kept = [c for c in texts.columns if c != "_words"]
        w, i = F.col("_words"), F.col("_place")
        places = texts.select(*kept, "_words", F.posexplode("_words").alias("_place", "_word"))
        places = places.filter(is_marked(F.xxhash64("_word"), self.firsts) & (i <= F.size(w) - shortest))
        if shortest > 1:
            places = places.filter(is_marked(start_hash(w, i, shortest), self.marks))
        length = F.lit(longest)
        if longest > RUN_WORDS:
            length = F.when(is_marked(start_hash(w, i, RUN_WORDS), self.heads), longest).otherwise(RUN_WORDS)
        # a generated column: what is joined and compared later does not make it again
        return places.select(*kept, settled(F.array_join(F.slice(w, i + 1, length), " ")).alias("_run"))


def is_marked(value: Column, marks: list[int]) -> Column:
    """Whether a hash's bit is set in a bitmap of 64-bit words."""
    at = F.pmod(value, F.lit(64 * len(marks)))
    # one folded literal instead of thousands
    bits = F.get(F.from_json(F.lit(json.dumps(marks)), "array<bigint>"), F.shiftright(at, 6).cast("int"))
    return F.getbit(bits, F.pmod(at, F.lit(64)).cast("int")) == 1


def bitmap(hashes: DataFrame, n: int) -> list[int]:
    """The bits of a column of hashes, 32 for each of ``n`` up to ``MOST_BITS``, as 64-bit words."""
    bits = min(MOST_BITS, max(64, 1 << (32 * n - 1).bit_length())) if n else 64
    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    out = [0] * (bits // 64)
    for row in hashes.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        out[row["word"]] = row["bits"]
    return out


def searched_names(entities: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> MentionNames:
    """The names that texts are searched for, with their size checked."""
    lookup = mention_names(entities).select(
        "normalizedName", "entityId", "entityName", "entityType", "position"
    )
    n_words = F.size(words(F.col("normalizedName")))
    size, found, n = lookup.agg(total_bytes(lookup), F.collect_set(n_words), F.count("*")).first()
    names = MentionNames(lookup, size <= limit, sorted(found) or [1], None, [0], [0], [0])
    name = words(F.col("normalizedName"))
    starts = lookup.select(names.start(F.col("normalizedName")).alias("_start")).distinct()
    firsts = bitmap(lookup.select(start_hash(name, F.lit(0), 1).alias("_first")), n)
    heads = [0]
    if names.sizes[-1] > RUN_WORDS:
        heads = bitmap(lookup.filter(n_words > RUN_WORDS).select(start_hash(name, F.lit(0), RUN_WORDS).alias("_head")), n)
    # names that fit have starts that fit
    few = size <= limit or fits_broadcast(starts, limit)
    marks = bitmap(starts, n) if names.sizes[0] > 1 else firsts
    return replace(names, starts=starts if few else None, marks=marks, firsts=firsts, heads=heads)


def longest_mentions(texts: DataFrame, names: MentionNames) -> DataFrame:
    """The longest name in each text, the earliest entity among equals.

    ``texts`` has ``_ord`` (unique), ``text`` and further columns, which are
    kept. Only runs of words whose start is in the names' bitmap become rows. Those that do
    not start like any name after all are dropped by a semi-join with hashes of the names'
    starts, in the task that reads the text as long as the hashes fit a broadcast; the
    others are compared for each name size. While the names fit too, only hits are
    shuffled; beyond that what passed travels, salted, with the record's order and kept
    columns; the order need not be stable between runs.
    """
    lookup, sizes = names.lookup, names.sizes
    carried = [c for c in texts.columns if c not in (ORD, "text")]
    # the words are a generated column, so that they are made once per record
    cut = texts.select(ORD, *carried, settled(match_words(F.col("text"))).alias("_words"))
    runs = names.runs(cut)
    if names.starts is not None:
        runs = runs.withColumn("_start", names.start(F.col("_run"))).join(F.broadcast(names.starts), "_start", "left_semi")
    grams = runs.select(ORD, *carried, F.explode(phrases(F.col("_run"), sizes)).alias("normalizedName"))
    hits = lookup_join(grams, lookup, ["normalizedName"], [ORD], small=names.small)
    rank = F.struct(F.length("normalizedName").alias("len"), (-F.col("position")).alias("pos"))
    kept = [c for c in hits.columns if c != ORD]
    return hits.groupBy(ORD).agg(F.max_by(F.struct(*kept), rank).alias("_hit")).select(ORD, "_hit.*")


def link_mentions(
    records: DataFrame,
    fields: list[str],
    names: MentionNames,
    record_type: str,
    relationship_type: str,
    as_of: datetime,
    paper_url: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """At most one relationship per record, from the text of ``fields``; a string
    array is read as the JSON text that a flat table holds."""
    url = record_url(F.col("source_url"), F.col(paper_url) if paper_url else None)
    lists = {f for f, t in records.dtypes if t == "array<string>"}
    read = [json_list(F.col(f)) if f in lists else F.col(f) for f in fields]
    texts = records.select(ORD, url.alias("source_url"), mention_text(*read).alias("text"))
    hits = longest_mentions(texts, names)
    return finish_links(hits, record_type, relationship_type, fixed.MENTION, as_of, unique)


def link_papers(papers: DataFrame, names: MentionNames, as_of: datetime, unique: bool = False) -> DataFrame:
    """Mentions in title and authors; a paper without source url is known by its paper url."""
    return link_mentions(
        papers, ["title", "authors"], names, "RESEARCH_PAPER", fixed.MENTIONED_IN_RESEARCH, as_of,
        paper_url="paper_url", unique=unique,
    )


def link_news(news: DataFrame, names: MentionNames, as_of: datetime, unique: bool = False) -> DataFrame:
    """Mentions in title and content."""
    return link_mentions(
        news, ["title", "content"], names, "NEWS", fixed.MENTIONED_IN_NEWS, as_of, unique=unique
    )
