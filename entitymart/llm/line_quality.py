"""Quality rules: counts inside a text, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import Scratch

#: Words are what these separate.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 5


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """Words inside windows that the text holds twice or more, from an array of words."""

    def of_windows(h: Column) -> Column:
        at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            places = F.sort_array(F.transform(same, lambda x: x["i"]))
            return bound(places, of_places)

        def of_places(p: Column) -> Column:
            reach = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
            return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bound(at, of_sorted))

    def of_hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return bound(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])), of_windows)

    return F.when(F.size(found) < window, F.lit(0)).otherwise(bound(F.transform(found, lambda w: F.xxhash64(w)), of_hashes))


def measured(text: Column) -> Column:
    """Struct of the counts inside one text; a null text counts as empty.

    Windows are compared by 64-bit hashes inside one text.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda l: l.rlike(WORD))
    return bound(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            bound(lines, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )


def line_entries(text: Column) -> Column:
    """(hash, words) of each line with a word; a line is compared in lower case with single blanks."""
    lines = F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n"), lambda l: l.rlike(WORD))

    def entry(line: Column) -> Column:
        plain = F.lower(F.trim(F.regexp_replace(line, BLANKS, " ")))
        return bound(plain, lambda p: F.struct(F.xxhash64(p).alias("line"), F.size(F.split(p, " ")).alias("line_words")))

    return F.transform(lines, entry)


def judge(documents: DataFrame, least_documents: int = 10, share: float = 0.02, least_left: float = 0.5, many: int | None = 1000) -> DataFrame:
    """One row per document with the counts, what its host's common lines take, and ``kept``.

    A line is common when more than ``least_documents`` distinct documents of its host
    (``source``) have it, and more than ``share`` of them; one in more than ``many`` distinct
    documents of its host is common at every size of the host. Common lines are removed; a
    document that has less than ``least_left`` of its words or under 10 words left is
    depleted. ``base_failed`` documents are never kept. A null text is empty, a null source
    is a host of its own, rows that repeat id, host and text get the same result, a null id
    counts as one document. An empty table gives no rows.
    """
    scratch = Scratch(documents.sparkSession, "lines")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.col("text").cast("string").alias("text"),
    )
    row = F.xxhash64("host", "text").alias("row")
    document = F.coalesce("doc_id", F.lit(-1))

    lines = rows.select(document.alias("document"), "host", F.explode(F.array_distinct(F.transform(line_entries(F.col("text")), lambda e: e["line"]))).alias("line"))
    seen = lines.groupBy("host", "line", "document").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n_documents")).where(F.col("n_documents") > least_documents)
    hosts = rows.select("host", document.alias("document")).distinct().groupBy("host").agg(F.count("*").alias("host_documents"))
    often = F.col("n_documents") > share * F.col("host_documents")
    if many is not None:
        often = often | (F.col("n_documents") > many)
    common = seen.join(hosts, "host").where(often).select("host", "line")
    common = scratch.keep(common, "common")

    # Entries of rows that repeat fall together before words are summed.
    entries = rows.select("doc_id", row, "host", F.posexplode(line_entries(F.col("text"))).alias("place", "e"))
    entries = entries.select("doc_id", "row", "host", "place", F.col("e.line").alias("line"), F.col("e.line_words").alias("line_words"))
    taken = entries.join(common, ["host", "line"], "left_semi").groupBy(document.alias("document"), "row", "place").agg(F.max("line_words").alias("w"))
    taken = taken.groupBy("document", "row").agg(F.sum("w").alias("n_common_words"), F.count("*").alias("n_common_lines"))

    base = rows.select("doc_id", document.alias("document"), row, measured(F.col("text")).alias("m")).select("doc_id", "document", "row", "m.*")
    taken = scratch.keep(taken, "taken")
    n = F.col("n_words")
    left = n - F.col("n_common_words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    joined = base.join(taken, ["document", "row"], "left").fillna(0, ["n_common_words", "n_common_lines"])
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (left >= 10) & (left >= least_left * n)).alias("kept"),
        F.col("n_common_lines").cast("long").alias("n_common_lines"),
        F.col("n_common_words").cast("long").alias("n_common_words"),
    )
