"""Operators that compare documents or vectors with each other, against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitymart.llm import embedding_dedup, jaccard, repeats
from entitymart.llm.common import Scratch, components
from tests.llm.conftest import LONG


def roots(n, links):
    up = list(range(n))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(k) for k in range(n)]


def shingle_sets(texts, width=4):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        out.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def expected_groups(rows, percent=85):
    sets = shingle_sets([r["text"] for r in rows])
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    least = {}
    for r, k in zip(rows, root, strict=True):
        if r["doc_id"] is not None:
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    return sorted(((r["doc_id"], len(s), least.get(k) if s else r["doc_id"]) for r, s, k in zip(rows, sets, root, strict=True)), key=str)


def got_groups(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(chain, Scratch(spark, "t"), "c").collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, 101: 100}


def test_jaccard_equals_brute_force(corpus):
    rows = corpus.select("doc_id", "text").collect()
    assert got_groups(jaccard.near_duplicates(corpus)) == expected_groups(rows)


def edits(seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for size in (3, 4, 5, 7, 9, 12, 20, 40, 90, 300):
        words = [f"w{k}" for k in rng.integers(0, 5000, size)]
        for copy in range(12):
            changed = list(words)
            for k in rng.integers(0, size, rng.integers(0, max(2, size // 8))):
                changed[k] = f"c{copy}"
            rows.append((len(rows), " ".join(changed + words[: copy % 3]), "en", "s"))
    return rows


@pytest.mark.parametrize("tile", [10**9, 200])
def test_jaccard_near_the_threshold_and_in_cut_groups(documents, tile):
    df = documents(edits())
    assert got_groups(jaccard.near_duplicates(df, 4, 85, tile)) == expected_groups(df.collect())


@pytest.mark.parametrize("tile", [10**9, 200])
def test_jaccard_counts_every_link(documents, messy, tile):
    for df in (documents(edits()), messy):
        rows, want = df.collect(), []
        sets = shingle_sets([r["text"] for r in rows])
        for k, r in enumerate(rows):
            n = sum(1 for j in range(len(rows)) if j != k and sets[k] and sets[j] and 100 * len(sets[k] & sets[j]) >= 85 * len(sets[k] | sets[j]))
            want.append((r["doc_id"], len(sets[k]), n))
        got = [(r["doc_id"], r["n_shingles"], r["n_links"]) for r in jaccard.near_duplicates(df, 4, 85, tile).collect()]
        assert sorted(got, key=str) == sorted(want, key=str) and max(n for *_, n in want) > 2


@pytest.mark.parametrize("tile", [10**9, 200])
def test_jaccard_by_five_words_and_80_percent(documents, messy, corpus, tile):
    for df in (documents(edits(9)), messy, corpus):
        rows = df.select("doc_id", "text").collect()
        sets = shingle_sets([r["text"] for r in rows], 5)
        links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        count = np.bincount(np.array(links, int).ravel(), minlength=len(rows))
        root, least = roots(len(rows), links), {}
        for r, k in zip(rows, root, strict=True):
            if r["doc_id"] is not None:
                least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
        want = [(r["doc_id"], len(s), least.get(k) if s else r["doc_id"], int(c)) for r, s, k, c in zip(rows, sets, root, count, strict=True)]
        got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard.near_duplicates(df, 5, 80, tile).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("percent", [80, 85, 50])
def test_prefixes_never_miss_a_linked_pair(percent):
    rng = np.random.default_rng(1)
    level = lambda x: ((x >> np.uint64(7)) % np.uint64(5) // np.uint64(2)).astype(np.uint8)
    met = 0
    for n in (2, 3, 4, 6, 7, 13, 14, 50, 333, 2000):
        for _ in range(40):
            x = rng.integers(0, 2**63, n).astype(np.uint64)
            d = int((100 - percent) / (100 + percent) * 2 * n)
            y = np.concatenate([x[d // 2 :], rng.integers(0, 2**63, d - d // 2).astype(np.uint64)])
            x, y = np.unique(x), np.unique(y)
            common = len(np.intersect1d(x, y))
            if 100 * common >= percent * (len(x) + len(y) - common) and len(x) > 1:
                met += 1
                # What both have, no sketch takes for unshared.
                shared = [np.where(np.isin(a, b), np.maximum(level(a), 1), level(a)) for a, b in ((x, y), (y, x))]
                assert np.intersect1d(jaccard.prefix(x, shared[0], percent), jaccard.prefix(y, shared[1], percent)).size
    assert met > 100


def test_bit_counts_leave_no_linked_pair_out():
    rng = np.random.default_rng(4)
    for percent in (80, 85):
        sets = []
        for n in (2, 5, 60, 127, 128, 130, 700):
            base = rng.integers(0, 2**63, n).astype(np.uint64)
            sets += [np.unique(np.concatenate([base[int(rng.integers(0, max(1, n // 10))) :], rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 12)))).astype(np.uint64)])) for _ in range(12)]
        sets = [s for s in sets if len(s)]
        order = rng.permutation(len(sets))
        sets = [sets[k] for k in order]
        maps = [jaccard.bitmaps([s], jaccard.bits_of(len(s)))[0].tobytes() for s in sets]
        sizes = np.array([len(s) for s in sets])
        for side in (np.full(len(sets), 2), rng.integers(0, 2, len(sets))):
            label = jaccard.alike(maps, sizes, side, percent)
            linked = 0
            for i in range(len(sets)):
                for j in range(i):
                    common = len(np.intersect1d(sets[i], sets[j]))
                    if (side[i] == 2 or side[i] != side[j]) and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                        linked += 1
                        assert label[i] == label[j]
            assert linked > 20 and len(set(label.tolist())) > 4


def test_stock_phrases_bring_nothing_together(spark, documents):
    """A phrase in all documents and passages in many: groups hold true links only, and few rows are compared."""
    rng = np.random.default_rng(2)
    stock = " ".join(f"stock{k}" for k in range(50))
    passages = [" ".join(f"p{j}w{k}" for k in range(50)) for j in range(40)]
    rows, true = [], 0
    for k in range(1500):
        words = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(60, 300)))]
        picked = [passages[int(j)] for j in rng.integers(0, 40, 2)]
        rows.append((len(rows), " ".join([*words[:30], stock, *picked, *words[30:]]), "en", "s"))
        if k % 50 == 0:
            rows += [(len(rows) + i, rows[-1][1] + f" tail{i}", "en", "s") for i in range(2)]
            true += 3
    df = documents(rows)
    text = F.col("text")
    plain = df.select(F.col("doc_id").alias("id"), F.lit(True).alias("known"), text.alias("text"), F.xxhash64(text).alias("hash"))
    scratch = Scratch(spark, "stock")
    sets, found, members = jaccard.candidates(plain, scratch, 5, 80)
    assert members.count() == true and members.groupBy("root").count().agg(F.max("count")).first()[0] == 3
    assert spark.read.parquet(f"{scratch.root}/shared").count() < 3 * len(rows)
    out = jaccard.near_duplicates(df, 5, 80)
    assert out.where("n_links > 0").count() == true and out.where("n_links > 2").count() == 0


def test_jaccard_of_messy_and_empty_tables(messy):
    assert got_groups(jaccard.near_duplicates(messy)) == expected_groups(messy.collect())
    assert jaccard.near_duplicates(messy.limit(0)).collect() == []


def expected_links(rows, least=0.93):
    def sound(r):
        v = r["embedding"]
        return r["label"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if sound(a) and sound(b) and a["label"] == b["label"] and len(a["embedding"]) == len(b["embedding"]):
                x, y = np.array(a["embedding"], float), np.array(b["embedding"], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links.append((i, j))
    n = np.zeros(len(rows), int)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    root, low = roots(len(rows), links), {}
    for r, k in zip(rows, root, strict=True):
        if r["vec_id"] is not None:
            low[k] = min(low.get(k, r["vec_id"]), r["vec_id"])
    return sorted(((r["vec_id"], int(c), low.get(k)) for r, c, k in zip(rows, n, root, strict=True)), key=str)


def got_links(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("tile", [4096, 16])
def test_vectors_equal_brute_force(spark, sf, tile):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert got_links(embedding_dedup.near_duplicates(df, 0.93, tile)) == expected_links(df.collect())


@pytest.mark.parametrize("tile", [4096, 8])
def test_vectors_near_the_threshold(spark, tile):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 24))
    rows = [(k, (base[k % 6] + rng.normal(size=24) * 0.27).tolist(), k % 2, "x", 1.0) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string, v double")
    assert got_links(embedding_dedup.near_duplicates(df, 0.93, tile)) == expected_links(df.collect())


def test_vectors_messy_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [2.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None),
        (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [nan, 1.0], 0), (10, [inf, 1.0], 0), (11, [None, 1.0], 0), (12, [1.0, 0.0, 0.0], 0),
        (None, [1.0, 0.01], 0), (None, [0.0, 1.0], 0), (13, [-1.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert got_links(embedding_dedup.near_duplicates(df)) == expected_links(df.collect())
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_vectors_of_any_size_link(spark):
    rows = [(k, "a", [x, 2 * x, -x]) for k, x in enumerate([1e-200, 1.0, 1e200, 1e-320, -1e150, 5e-324])] + [(9, "a", [2e200, -1e200, 0.0])]
    got = got_links(embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")))
    assert got == [(0, 4, 0), (1, 4, 0), (2, 4, 0), (3, 4, 0), (4, 0, 4), (5, 4, 0), (9, 0, 9)]


def test_bounds_leave_no_pair_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 40))
    x[100:200] = x[:100] + rng.normal(size=(100, 40)) * 0.35
    norms = np.linalg.norm(x, axis=1)
    unit = x / norms[:, None]
    one = (x, norms, unit @ np.linalg.eigh(unit.T @ unit)[1][:, ::-1])
    got = {(int(i), int(j)) for a, b in embedding_dedup.pairs_within(one, one, 0.93, True) for i, j in zip(a, b, strict=True)}
    full = unit @ unit.T
    assert got == {(i, j) for i in range(300) for j in range(i + 1, 300) if full[i, j] >= 0.93} and got


def expected_cuts(rows, length=100):
    """Rows with one id and text are one document; null ids come first, equal ids are told apart by the text's hash."""
    docs = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["h"], r["text"] or "") for r in rows})
    seen, out = set(), {}
    for known, doc, h, text in docs:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out[known, doc, h] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((r["doc_id"], *out[r["doc_id"] is not None, r["doc_id"] or 0, r["h"]]) for r in rows), key=str)


def got_cuts(df, length=100):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(df, length).collect()), key=str)


def hashed(df):
    return df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()


def test_repeats_equal_brute_force(corpus):
    assert got_cuts(corpus) == expected_cuts(hashed(corpus))


def test_repeats_at_every_length_and_in_periodic_text(documents):
    rng = np.random.default_rng(2)
    passage = "".join(rng.choice(list("abcdefgh é\n"), 400))
    rows = []
    for k in range(40):
        noise = "".join(rng.choice(list("qrstuvwxyz "), 120))
        rows.append((k * 3 % 41, noise + passage[k : k + 85 + k] + noise[::-1] + "ab" * (40 + k) + "-" * (90 + k % 20), "en", "s"))
    df = documents(rows)
    assert got_cuts(df) == expected_cuts(hashed(df))


def test_repeats_of_messy_and_empty_tables(messy):
    assert got_cuts(messy) == expected_cuts(hashed(messy))
    assert repeats.remove_repeats(messy.limit(0)).collect() == []


def test_repeats_across_the_pieces_of_one_text(documents, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    raw = np.frombuffer(LONG.encode(), np.uint8)
    whole = repeats.anchors(raw, 100)
    windows = {}
    for first, piece in repeats._pieces(raw, 100):
        for at, h, low, high in zip(*repeats.anchors(piece, 100), strict=True):
            for p in range(low, high + 1):
                windows[first + p] = (first + at, h)
    assert windows == {p: (at, h) for at, h, low, high in zip(*whole, strict=True) for p in range(low, high + 1)}
    assert sorted(windows) == list(range(len(raw) - 99))
