"""Fill-in-the-middle against plain patterns, its chunks, and exact restoring."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitymart.llm import infill
from tests.llm.conftest import LONG


def expected(doc_id, text, seed=1):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def got(df):
    return [(r["doc_id"], r["fim_units"], r["fim_form"], r["fim_prefix_chars"], r["fim_middle_chars"], r["fim_text"]) for r in df.collect()]


HARD = [
    "é" * 9000 + "abc" * 5000,
    "a" * 50_000,
    "a<S" * 3000 + ">",
    "x <M> y",
    "<P",
    "<" * 700,
    "S>" * 700,
    "日本語abc" * 2000,
    "\x00\r\n" * 900,
    "😀a" * 1500,
    "ab1" * 4000,
    "a",
    "é",
]


def test_rearranging_equals_patterns(corpus, messy, documents):
    hard = documents([(k * 1000 + j, t, "en", "s") for k, t in enumerate(HARD) for j in range(12)])
    for df in (corpus, messy, hard):
        out = infill.rearrange(df)
        rows = df.select("doc_id", "text").collect()
        assert sorted(got(out), key=str) == sorted((expected(r["doc_id"], r["text"]) for r in rows), key=str)
        assert out.columns[: len(df.columns)] == df.columns
        back = out.withColumn("back", infill.restored(F.col("fim_form"), F.col("fim_text")))
        assert back.where("not (back <=> coalesce(text, ''))").count() == 0
    assert {r[2] for r in got(infill.rearrange(hard))} == {"plain", "psm", "spm"}


def test_empty_tables_repeats_and_clashing_names(messy):
    assert infill.rearrange(messy.limit(0)).collect() == []
    twice = infill.rearrange(infill.rearrange(messy))
    assert sorted(got(twice), key=str) == sorted(got(infill.rearrange(messy)), key=str)


def test_marks_and_shares_are_parameters(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two <P> three").alias("text"))
    out = infill.rearrange(df, seed=9, plain=40, spm=50, marks=("[a]", "[b]", "[c]"))
    n = {r["fim_form"]: r["count"] for r in out.groupBy("fim_form").count().collect()}
    assert abs(n["plain"] - 1200) < 120 and abs(n["psm"] - n["spm"]) < 180
    back = infill.restored(F.col("fim_form"), F.col("fim_text"), ("[a]", "[b]", "[c]"))
    assert out.where(back != F.col("text")).count() == 0


@pytest.mark.parametrize("most", [0, 3000, 1 << 30])
def test_chunks_and_memory_change_nothing(most):
    memo = infill.Memo(most)
    for text in [*HARD, LONG, "", "é" * 400 + "Ab"]:
        for shift in ("", "q", "é1 "):
            raw = (shift + text).encode()
            bytes_, units = np.frombuffer(raw, np.uint8), re.findall("[A-Za-z]+|[^A-Za-z]", shift + text)
            cuts = infill.edges(bytes_, infill.candidates(bytes_).tolist(), 0, len(raw))
            assert all(b - a <= infill.MOST for a, b in zip(cuts, cuts[1:])) and b"".join(raw[a:b] for a, b in zip(cuts, cuts[1:])) == raw
            assert all((raw[c] & 0xC0) != 0x80 for c in cuts if c < len(raw))
            counted = infill.Counted(bytes_, raw, cuts, memo)
            assert counted.n == len(units)
            for k in {0, 1, len(units) // 3, len(units) // 2, len(units) - 1, len(units)} - {-1}:
                before = "".join(units[:k])
                assert counted.place(k) == (len(before.encode()), len(before))


def test_shared_passages_are_counted_once():
    memo, rng = infill.Memo(), np.random.default_rng(3)
    words = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 10**6, n))
    shared = words(4000)
    for text in (words(50) + shared, words(73) + shared + words(20)):
        raw = text.encode()
        bytes_ = np.frombuffer(raw, np.uint8)
        cuts = infill.edges(bytes_, infill.candidates(bytes_).tolist(), 0, len(raw))
        before = memo.hits
        infill.Counted(bytes_, raw, cuts, memo)
    assert memo.hits - before > 0.8 * len(cuts)
