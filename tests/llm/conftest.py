import pytest
from pyspark.sql import functions as F

#: Extra columns whose names the operators use inside.
CLASHING = ["host", "row", "document", "id", "known", "node", "n", "bucket", "tile", "root", "rank", "at", "cell", "arc", "mix_source", "places", "sha", "part", "bin", "mix_rate", "mix_n", "lid_lang", "sec_spans", "sec_hex", "others", "dropped_id"]


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text, lang, source) rows, with clashing extra columns."""

    def make(rows):
        df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return df.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING)])

    return make


@pytest.fixture
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


LONG = " ".join(f"word{k * k % 977}x{k % 31}" for k in range(20_000))


@pytest.fixture
def messy(documents):
    """Nulls everywhere, empty and very long texts, ties, repeated rows."""
    base = "the quick brown fox jumps over the lazy dog while seven wise men watch the river run to the sea"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base + " again", "en", "b"),
        (4, None, "en", "a"),
        (5, "", None, None),
        (None, base, None, None),
        (None, None, None, None),
        (6, LONG, "en", "b"),
        (7, LONG + " end", "en", "b"),
        (8, " \n\t ", "en", "a"),
        (9, "1234 5678 !!", "en", "a"),
        (10, "un deux\nun deux\nun deux", "fr", "c"),
        (-5, "z" * 5000, "en", "c"),
        (11, "nul\x00byte été ﬁn 日本語 " * 9, "fr", "c"),
    ]
    return documents(rows)
