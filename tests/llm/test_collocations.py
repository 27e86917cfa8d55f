"""Phrases against plain counting, and automata against dictionaries."""

import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from entitymart.llm import collocations, sketch
from entitymart.llm.collocations import LONGEST, Automaton


def expected(rows, least=30, share=80, top=2000):
    out = []
    by_lang = {}
    for lang, text in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text)
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split("[.,;:!?\x0a-\x0d]", low):
                w = re.findall("[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i : i + k]) for k in range(1, LONGEST + 1) for i in range(len(w) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                dropped.update(q for i in range(len(p) - k + 1) if (q := p[i : i + k]) in candidates and 100 * a >= share * candidates[q])
        found = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bits", [18, 4])
def test_phrases_equal_plain_counting(corpus, monkeypatch, bits):
    monkeypatch.setattr(sketch, "SLICE_BITS", bits)
    monkeypatch.setattr(sketch, "MOST_BITS", max(bits, 4))
    monkeypatch.setattr(collocations, "SHARD", 60_000)
    monkeypatch.setattr(collocations, "RANGE", 60_000)
    rows = [(r["lang"], r["text"]) for r in corpus.select("lang", "text").collect()]
    assert got(collocations.mine(corpus)) == expected(rows)
    assert got(collocations.mine(corpus, 5, 60, None)) == expected(rows, 5, 60, 10**9) and len(expected(rows, 5)) > 500


def test_messy_tables_ties_and_hot_words(spark, messy, documents):
    base = "New York is, in New York; a b a b a b\ta b\nnew york! x " * 3
    rows = [(k, base, ["en", None, "und", ""][k % 4], "s") for k in range(40)]
    rows += [(100 + k, "é日 本 " * 40 + "Z" * 3000, "en", "s") for k in range(30)]
    rows += [(200, "go " * 5000, "hot", "s"), (201, "!?.,", "hot", "s"), (202, None, "en", None), (203, "", None, None)]
    hard = documents(rows)
    assert got(collocations.mine(hard)) == expected([(r[2], r[1]) for r in rows])
    few = [(r["lang"], r["text"]) for r in messy.collect()]
    assert got(collocations.mine(messy, least=2)) == expected(few, least=2)
    assert got(collocations.mine(hard, 5, 50, 3)) == expected([(r[2], r[1]) for r in rows], 5, 50, 3)
    assert collocations.mine(messy.limit(0)).collect() == []


def grams_of(phrases):
    vocabulary = sorted({w for p in phrases for w in p})
    place = {w: k for k, w in enumerate(vocabulary)}
    rows = np.array([[place[w] for w in p] + [-1] * (LONGEST - len(p)) for p in phrases], np.int64).reshape(-1, LONGEST)
    return vocabulary, rows


@pytest.mark.parametrize("seed", range(6))
def test_automata_equal_dictionaries(seed):
    rng = np.random.default_rng(seed)
    letters = [b"a", b"b", "é".encode(), b"d"]
    want, parts = Counter(), []
    for _ in range(3):
        phrases = [tuple(rng.choice(letters, rng.integers(1, LONGEST + 1)).tolist()) for _ in range(int(rng.integers(0, 60)))]
        want.update(p[:k] for p in phrases for k in range(1, len(p) + 1))
        vocabulary, rows = grams_of(phrases)
        parts.append(Automaton.from_bytes(Automaton.of(vocabulary, *collocations.summed(rows, np.ones(len(rows), np.int64))).to_bytes()))
    whole = Automaton.union(parts)
    name = lambda a, row: tuple(a.vocabulary[k] for k in row if k >= 0)
    grams, weight = whole.paths()
    assert {name(whole, r): w for r, w in zip(grams.tolist(), weight.tolist(), strict=True)} == want
    assert grams.tolist() == sorted(grams.tolist())
    every = [p for k in range(1, LONGEST + 1) for p in product(range(len(whole.vocabulary)), repeat=k)]
    rows = np.array([list(p) + [-1] * (LONGEST - len(p)) for p in every], np.int64).reshape(-1, LONGEST)
    assert whole.weights(rows).tolist() == [want[name(whole, r)] for r in rows.tolist()]
    few = whole.pruned(4)
    grams, weight = few.paths()
    assert {name(few, r): w for r, w in zip(grams.tolist(), weight.tolist(), strict=True)} == {p: w for p, w in want.items() if w >= 4}
    assert len(few.vocabulary) == len({w for p, c in want.items() if c >= 4 for w in p})


def test_equal_states_are_one():
    phrases = [(x, b"m", y) for x in (b"a", b"b", b"c") for y in (b"y", b"z")]
    vocabulary, rows = grams_of(phrases)
    automaton = Automaton.of(vocabulary, *collocations.summed(rows, np.ones(len(rows), np.int64)))
    assert [len(a) for a in automaton.arcs] == [3, 1, 2, 0]


def test_sketch_never_takes_common_items_for_rare(spark):
    rng = np.random.default_rng(0)
    items = np.concatenate([np.repeat(rng.integers(0, 2**63, 50), 40), rng.integers(0, 2**63, 20_000)]).astype(np.uint64)
    df = spark.createDataFrame([(int(x) - 2**63,) for x in rng.permutation(items)], "x long").repartition(7)
    take = lambda batch: iter([(batch.column(0).to_numpy().astype(np.int64) + np.int64(-(2**63))).view(np.uint64)])
    found = sketch.common(df, take, len(items), (10, 40), 1)
    assert (found.level(np.unique(items[:2000])) == 2).all()
    assert (found.level(items[2000:]) > 0).mean() < 0.01
    ids = np.sort(rng.integers(0, 5000, 300))
    assert sketch.numbers(sketch.gaps(ids)).tolist() == ids.tolist() and sketch.gaps(ids[:0]) == b""
