"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitymart.llm import jaccard, language, mixing, packing, secret_scan, sketch
from entitymart.llm.common import Scratch

#: Share of a text's words that the language's own vocabulary must hold. The least share seen was
#: 0.5 in 2,499 held-out labelled documents and 0.25 in 51,282 others (a text of four words);
#: texts of languages that were not learned had 0 to 0.13.
LEAST_KNOWN = 0.15
#: Columns that the stages read or change; all others only travel along.
OWN = ["doc_id", "text", "lang", "source", "n_chars"]


def aside(docs: DataFrame) -> DataFrame:
    """The stages' own columns, and all others in one, so that no name can clash with an operator's."""
    others = [c for c in docs.columns if c not in OWN]
    return docs.select(*OWN, F.struct(*others).alias("others")) if others else docs


def back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in their order, from rows made of ``aside(docs)``."""
    return rows.select(*[F.col(c) if c in OWN else F.col("others")[c].alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` becomes the prediction.

    A document goes if it has no letters (null and empty texts too), or if less than
    ``LEAST_KNOWN`` of its words are known words of the predicted language, a share that does
    not grow with the text's length; a text of up to 20 words has too few to tell and stays. Ties go to the first language by name. Rows that repeat
    are judged alike, long texts are read whole, and an empty table gives no rows.
    """
    rows = aside(docs)
    found = language.identify(rows, language.fit(rows), known="lid_known")
    kept = found.where((F.col("lid_lang") != "und") & (F.col("lid_known") >= LEAST_KNOWN))
    return back(kept.withColumn("lang", F.col("lid_lang").cast(docs.schema["lang"].dataType)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingle sets with Jaccard >= 0.8: that with the smallest id.

    One row of a group stays, whatever ids its rows have: null ids come after all others, of
    rows with one id the smallest hash of the text stays, then of the other columns; of rows
    that are equal in all of these, one. Documents without words (null, empty, blank) have
    no group and all stay. Long texts are compared whole; an empty table gives no rows.
    """
    scratch, rows = Scratch(spark, "dedup"), aside(docs)
    found = jaccard.near_duplicates(docs, 5, 80).where("n_shingles > 0").select("group_id", "doc_id", "text_hash")
    found = scratch.keep(found.groupBy("group_id", "doc_id", "text_hash").agg(F.count("*").alias("n")), "found")
    # Groups of one row stay as they are; for others the first (id, text) is named, and of its rows one is taken.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "n"))
    groups = found.groupBy("group_id").agg(first.alias("f"), F.sum("n").alias("rows")).where("rows > 1")
    groups = scratch.keep(groups.select("group_id", F.col("f.doc_id").alias("one_id"), F.col("f.text_hash").alias("one_hash"), F.col("f.n").alias("one_n")), "groups")
    fates = found.join(groups, "group_id").withColumn("one", F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash")))
    fates = fates.where("not one or one_n > 1").select(F.col("doc_id").alias("fate_id"), F.col("text_hash").alias("fate_hash"), "one")
    fates = scratch.keep(fates, "fates")
    rows = rows.withColumn("row_hash", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("fate_id")) & (F.col("row_hash") == F.col("fate_hash"))
    # Only rows that a sketch of the fates' hashes lets through are shuffled.
    some, one = fates, fates.where("one")
    may_go, may_thin = sketch.members(some, "fate_hash"), sketch.members(one, "fate_hash")
    untouched = sketch.marked(rows, "row_hash", may_go, False)
    stayed = sketch.marked(rows, "row_hash", may_go, True).join(some, same, "left_anti")
    order = Window.partitionBy("doc_id", "row_hash").orderBy(F.xxhash64("lang", "source", "n_chars"))
    thinned = sketch.marked(rows, "row_hash", may_thin, True).join(one, same, "left_semi")
    thinned = thinned.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
    return back(untouched.unionByName(stayed).unionByName(thinned), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each secret in its text replaced by a mark, and ``n_chars`` brought up to date.

    Texts without secrets keep their ``n_chars``; null and empty texts stay. Spans that touch
    are one secret. Rows that repeat change alike, long texts are read whole, and an empty
    table gives no rows.
    """
    found = secret_scan.scan(aside(docs), redact=True)
    changed = F.col("sec_spans") != ""
    chars = F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return back(found.withColumn("n_chars", chars), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that all sources weigh the same, each copy a row, in one random order.

    A null source is one like others; a null or empty text weighs one byte. Rows with one id
    draw alike, also null ids; a tie in the order is left to the copies' numbers. Long texts
    weigh by their bytes; an empty table gives no rows.
    """
    return back(mixing.mix(aside(docs)), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences.

    A null or empty text is one piece of the end mark; a longer text than a sequence is cut,
    and nothing of it is lost. Rows that repeat are packed each, pieces of equal length in
    any order; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
