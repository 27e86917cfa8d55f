"""The pipeline's stages, each on its own input, and the queries' registration."""

import hashlib
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import rows as plain
from entitymart.llm import secret_scan
from tests.llm.test_pairs import roots, shingle_sets


def expected_mix(rows, seed=11):
    """How often each row is drawn: all sources weigh the same, one Poisson draw at a hash of the id."""
    size = Counter()
    for r in rows:
        size[r["source"] or ""] += len((r["text"] or "").encode()) + 1
    out = Counter()
    for r in rows:
        rate = sum(size.values()) / len(size) / size[r["source"] or ""]
        name = "" if r["doc_id"] is None else r["doc_id"]
        u = (int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, log, below = 0, -rate, math.exp(-rate)
        while below < u and k < rate + 12 * math.sqrt(rate) + 20:
            k += 1
            log += math.log(rate / k)
            below += math.exp(log)
        if k:
            out[str(r)] += k
    return out


def test_every_operator_has_a_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and len(names) == 13
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op1_embedding_near_duplicates", "op4_quality_rules", "op5_source_mixing", "op7_shingle_jaccard", "op11_phrase_collocations", "op12_fill_in_middle", "op13_warc_archive"])
def test_query_equals_sql(spark, sf, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = entry.queries()[name](spark, sf)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.columns, df.collect()) == plain(columns, cur.fetchall())


def one_of_each(rows):
    """Ids that stay: the smallest of each group of five-word sets, null after all others, and all without words."""
    sets = shingle_sets([r["text"] for r in rows], 5)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    groups = {}
    for r, s, k in zip(rows, sets, roots(len(rows), links), strict=True):
        groups.setdefault(k if s else ("empty", len(groups)), []).append(r["doc_id"])
    return [min(ids, key=lambda x: (x is None, x or 0)) for ids in groups.values()]


def test_stages_keep_columns_and_take_effect(spark, sf, messy):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), messy):
        names = docs.columns
        stages = dict(corpus_pipeline.STAGES)
        kept = stages["language"](spark, docs, sf)
        assert kept.columns == names and kept.where("text is null or trim(text) = ''").count() == 0
        deduped = stages["near_duplicates"](spark, docs, sf)
        assert deduped.columns == names
        assert sorted((r["doc_id"] for r in deduped.collect()), key=str) == sorted(one_of_each(docs.select("doc_id", "text").collect()), key=str)
        redacted = stages["secrets"](spark, docs, sf)
        assert redacted.columns == names and redacted.count() == docs.count()
        before = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
        for r in redacted.where("doc_id is not null").collect():
            found = secret_scan.spans(before[r["doc_id"]])
            assert (r["text"] == before[r["doc_id"]]) == (not found)
            assert r["text"] is None or r["n_chars"] == len(r["text"]) or not found
        for c in docs.drop(*corpus_pipeline.OWN).columns:
            values = docs.select(c).distinct().collect()
            assert all(stage.select(c).distinct().collect() == values for stage in (kept, deduped, redacted))
        mixed = stages["mixing"](spark, docs, sf)
        assert mixed.columns == names
        assert Counter(map(str, mixed.collect())) == expected_mix(docs.collect())
        for stage in stages.values():
            assert stage(spark, docs.limit(0), sf).collect() == []


def test_one_document_of_each_group_stays(spark, sf, documents):
    words = lambda name, n=100: " ".join(f"{name}{k}" for k in range(n))
    rows = [
        (1, words("a")), (2, words("a") + " " + words("tail", 20)), (3, words("a", 83)),
        (4, words("b")), (5, words("b") + " " + words("tail", 30)),
        (6, words("c")), (6, words("c")), (6, words("c") + " more"),
        (None, words("d")), (None, words("d")), (None, words("d") + " more"),
        (7, ""), (7, ""), (None, None), (8, words("e")), (8, words("f")),
        (9, words("g")), (None, words("g")), (None, words("g") + " more"),
    ]
    docs = documents([(*r, "en", "s") for r in rows])
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf).collect()
    groups = sorted((str(r["doc_id"]), "-" if r["text"] is None else r["text"][:1]) for r in kept)
    assert groups == sorted([("1", "a"), ("4", "b"), ("5", "b"), ("6", "c"), ("None", "d"), ("7", ""), ("7", ""), ("None", "-"), ("8", "e"), ("8", "f"), ("9", "g")])


def test_texts_of_no_learned_language_go_however_long(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = ["zkqx wvbn plrt mmkd ghtz " * n for n in (8, 50, 3000)] + ["kolme miestä lähti kaupunkiin ostamaan vaatteita mutta sade yllätti heidät " * 90]
    more = spark.createDataFrame([(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(odd)], docs.schema)
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs.unionByName(more), sf)
    assert kept.where("doc_id >= 1000000").count() == 0
    letters = docs.where("text rlike '[A-Za-z]'")
    assert kept.count() == letters.count()


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.where(F.col("length") > 4096).count() == 0 and got.count() > 100
