"""Phrases that occur more often than their parts suggest, counted in weighted automata.

An automaton reads the words of a phrase and weighs each arc with the number of times that
the words up to it occur. Shards build theirs from their sorted n-grams; automata of one
range of prefixes are united by summing weights; and the counts of a phrase's parts are
read by composing the phrases with the automata that hold the parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entitymart.llm.common import LOWER, U64, Scratch, buckets, hashed, mixed, runs, texts_of
from entitymart.llm.sketch import common

#: Words of the longest phrase.
LONGEST = 4
#: Bytes of texts whose n-grams a shard counts, and for which there is one range of prefixes.
SHARD, RANGE = 4 << 20, 32 << 20
#: Bytes of an average word with its blank: sets the sketch's size only.
WORD_BYTES = 6
BREAK, BLANK = np.zeros(256, bool), np.zeros(256, bool)
BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
BLANK[[0x20, 0x09]] = True
_STEP = U64(0x9FB21C651E98DF25)
#: Kinds of rows: counts of all words; automata of single words and of longer phrases; phrases asked for of each; answers.
WORDS, SINGLE, LONG, ANSWER = 0, 1, 2, 3
ASK = 10
ASK_SINGLE, ASK_LONG = ASK + SINGLE, ASK + LONG


# Words -------------------------------------------------------------------------------------


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, text and piece of each word; words of one piece follow each other unbroken."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    cut = BREAK[raw]
    inside = ~(cut | BLANK[raw])
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    firsts = bounds[:-1][bounds[:-1] < len(raw)]
    opens[firsts] = inside[firsts]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    closes[lasts] = inside[lasts]
    start = np.flatnonzero(opens)
    text = np.searchsorted(bounds, start, "right") - 1
    return start, np.flatnonzero(closes) + 1 - start, text, np.cumsum(cut)[start] + text


def _salts(names) -> np.ndarray:
    """A hash of each language, so that a word has another name in each."""
    raw = [str(n).encode() for n in names]
    size = np.array([len(r) for r in raw], np.int64)
    return mixed(hashed(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size) ^ _STEP)


def _read(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Lower-case bytes of runs of texts with their words, the words' hashes, and hashes of their languages."""
    names, which = np.unique(np.array(["und" if x is None else x for x in batch.column("lang").to_pylist()], str), return_inverse=True)
    raw, bounds = texts_of(batch.column("text"))
    salt = _salts(names)
    for first, last in runs(bounds, SHARD):
        part = LOWER[raw[bounds[first] : bounds[last]]]
        start, length, text, piece = words(part, bounds[first : last + 1] - bounds[first])
        lang = which[first:last][text]
        yield part, start, length, piece, lang, mixed(hashed(part, start, length) ^ salt[lang]), names


def _pairs(name: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Hash of each word and the next; those across pieces are left as 0."""
    out = np.zeros(len(name), U64)
    if len(name) > 1:
        out[:-1] = np.where(piece[1:] == piece[:-1], mixed(name[:-1] * _STEP + name[1:]), U64(0))
    return out


# Automata ----------------------------------------------------------------------------------


@dataclass
class Automaton:
    """Acyclic; its start has an arc for each word that a phrase starts with, and so on.

    ``arcs[d]`` are the arcs of depth d, sorted by state and word: (state, word, weight,
    target). Target 0 is the state without arcs; others number the states of depth d + 1
    from 1. Equal states, with the same words, weights and targets, are one.
    """

    vocabulary: list[bytes]
    arcs: list[np.ndarray]

    @classmethod
    def of(cls, vocabulary: list[bytes], grams: np.ndarray, counts: np.ndarray) -> Automaton:
        """From sorted rows of word numbers (-1 past the end of a phrase) and how often each row occurs.

        Every prefix of a row gets the row's count too. Going up from the longest phrases,
        the arcs of a prefix are closed once the sorted rows leave it, and a state that is
        already there is used again.
        """
        arcs: list[np.ndarray] = []
        width = grams.shape[1]
        fresh = np.ones((width, len(grams)), bool)  # row starts a new prefix of d + 1 words
        if len(grams):
            differ = grams[1:] != grams[:-1]
            fresh[:, 1:] = np.logical_or.accumulate(differ, axis=1).T
        sums = np.concatenate([[0], np.cumsum(counts)])
        target = np.zeros(len(grams), np.int64)  # state that the row's prefix of d + 1 words leads to
        for d in range(width - 1, -1, -1):
            first = np.flatnonzero(fresh[d])
            last = np.append(first[1:], len(grams))
            there = grams[first, d] >= 0
            first, last = first[there], last[there]
            above = np.flatnonzero(fresh[d - 1]) if d else np.zeros(min(1, len(grams)), np.int64)
            owner = np.searchsorted(above, first, "right") - 1
            arc = np.stack([owner, grams[first, d], sums[last] - sums[first], target[first]], 1)
            state, arc = _register(arc, len(above))
            arcs.append(arc)
            target = np.zeros(len(grams), np.int64)
            target[above] = state
        return cls(vocabulary, arcs[::-1])

    def paths(self, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Every phrase as a row of word numbers, with its weight, where that is ``least`` or more; sorted."""
        rows, found, counts = np.full((1, len(self.arcs)), -1), [], []
        state = np.ones(1, np.int64)
        for d, arc in enumerate(self.arcs):
            low, high = np.searchsorted(arc[:, 0], state), np.searchsorted(arc[:, 0], state, "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows = np.repeat(rows, n, axis=0)
            rows[:, d] = arc[at, 1]
            keep = arc[at, 2] >= least
            rows, at = rows[keep], at[keep]
            found.append(rows)
            counts.append(arc[at, 2])
            on = arc[at, 3] > 0
            rows, state = rows[on], arc[at, 3][on]
        grams, weight = np.concatenate(found), np.concatenate(counts)
        order = np.lexsort(grams.T[::-1])
        return grams[order], weight[order]

    def weights(self, grams: np.ndarray) -> np.ndarray:
        """Composition with a set of phrases: the weight of each, 0 where the automaton does not read it."""
        state, weight = np.ones(len(grams), np.int64), np.zeros(len(grams), np.int64)
        live = np.flatnonzero(grams[:, 0] >= 0)
        many = np.int64(len(self.vocabulary) + 1)
        for d, arc in enumerate(self.arcs):
            live = live[(grams[live, d] >= 0) if d else slice(None)]
            if not len(live):
                break
            key, want = arc[:, 0] * many + arc[:, 1], state[live] * many + grams[live, d]
            at = np.minimum(np.searchsorted(key, want), max(0, len(key) - 1))
            met = key[at] == want if len(key) else np.zeros(len(want), bool)
            weight[live] = np.where(met, arc[at, 2] if len(key) else 0, 0)
            state[live] = np.where(met, arc[at, 3] if len(key) else 0, 0)
            # A phrase that goes on needs a state to go on from; without one it weighs nothing.
            live = live[met] if len(key) else live[:0]
        return weight

    def to_bytes(self) -> bytes:
        """Words joined by blanks, which none holds, and the columns of the arcs as the narrowest numbers, compressed."""
        text, columns = b" ".join(self.vocabulary), []
        for arc in self.arcs:
            for column in (np.diff(arc[:, 0], prepend=0), arc[:, 1], arc[:, 2], arc[:, 3]):
                kind = next(t for t in ("<u1", "<u2", "<u4", "<i8") if column.max(initial=0) < 1 << (63 if t == "<i8" else 8 * int(t[2])))
                columns.append((int(kind[2]), column.astype(kind).tobytes()))
        sizes = [x for width, raw in columns for x in (width, len(raw) // width)]
        top = np.array([len(self.vocabulary), len(self.arcs), *sizes], "<i8").tobytes()
        raw = top + b"".join(x for _, x in columns) + text
        return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, "zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Automaton:
        raw = pa.decompress(blob[8:], int(np.frombuffer(blob, "<i8", 1)[0]), "zstd", asbytes=True)
        n_words, depth = np.frombuffer(raw, "<i8", 2).tolist()
        sizes, at, arcs = np.frombuffer(raw, "<i8", 8 * depth, 16).reshape(depth, 4, 2).tolist(), 16 + 64 * depth, []
        for columns in sizes:
            arc = np.empty((columns[0][1], 4), np.int64)
            for k, (width, n) in enumerate(columns):
                arc[:, k] = np.frombuffer(raw, f"<i{width}" if width == 8 else f"<u{width}", n, at)
                at += width * n
            arc[:, 0] = np.cumsum(arc[:, 0])
            arcs.append(arc)
        return cls(raw[at:].split(b" ") if n_words else [], arcs)

    @classmethod
    def union(cls, automata: list[Automaton], least: int = 1) -> Automaton:
        """Reads what any of them reads, with the sum of the weights; phrases below ``least`` are left out."""
        vocabulary = sorted(set().union(*[a.vocabulary for a in automata]))
        place = {w: k for k, w in enumerate(vocabulary)}
        parts, weights = [], []
        for a in automata:
            grams, weight = a.ends()
            to = np.append(np.fromiter((place[w] for w in a.vocabulary), np.int64, len(a.vocabulary)), -1)
            parts.append(to[grams])
            weights.append(weight)
        width = max((p.shape[1] for p in parts), default=LONGEST)
        grams, counts = summed(np.concatenate(parts) if parts else np.zeros((0, width), np.int64), np.concatenate(weights) if weights else np.zeros(0, np.int64))
        out = cls.of(vocabulary, grams, counts)
        return out.pruned(least) if least > 1 else out

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Phrases with the times that they occur without going on: what ``of`` builds the automaton from."""
        grams, weight = self.paths()
        size = (grams >= 0).sum(1)
        # In sorted order a phrase is followed by those that it starts; what they weigh is not its own.
        own = weight.copy()
        for d in range(1, grams.shape[1]):
            longer = np.flatnonzero(size == d + 1)
            upto = np.flatnonzero(size == d)
            np.subtract.at(own, upto[np.searchsorted(upto, longer) - 1], weight[longer])
        return grams[own > 0], own[own > 0]

    def pruned(self, least: int) -> Automaton:
        """Only phrases that weigh ``least`` or more, with the words they need; weights stay."""
        grams, weight = self.paths(least)
        used = np.unique(grams[grams >= 0])
        to = np.full(len(self.vocabulary) + 1, -1)
        to[used] = np.arange(len(used))
        size, own = (grams >= 0).sum(1), weight.copy()
        for d in range(1, grams.shape[1]):
            longer, upto = np.flatnonzero(size == d + 1), np.flatnonzero(size == d)
            np.subtract.at(own, upto[np.searchsorted(upto, longer) - 1], weight[longer])
        return Automaton.of([self.vocabulary[k] for k in used.tolist()], to[grams], own)


def _register(arc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """State of each of ``n`` owners of arcs, equal ones once, and the arcs of the states kept. 0: no arcs."""
    state = np.zeros(n, np.int64)
    if not len(arc):
        return state, arc
    first = np.flatnonzero(np.r_[True, arc[1:, 0] != arc[:-1, 0]])
    size = np.diff(np.append(first, len(arc)))
    one = mixed(arc[:, 1].astype(U64) * U64(0x9E3779B97F4A7C15) + mixed(arc[:, 2].astype(U64) * _STEP + arc[:, 3].astype(U64)))
    name = mixed(np.add.reduceat(one, first) + size.astype(U64))
    _, kept, which = np.unique(name, return_index=True, return_inverse=True)
    # Equal names stand for equal arcs; that is checked, and a state that differs stays by itself.
    twin = kept[which]
    same = size[twin] == size
    at = np.repeat(first[twin] - first, size) + np.arange(len(arc))
    rows = np.repeat(same, size)
    equal = np.ones(len(arc), bool)
    equal[rows] = (arc[at[rows], 1:] == arc[rows, 1:]).all(axis=1)
    same &= np.logical_and.reduceat(equal, first)
    twin = np.where(same, twin, np.arange(len(first)))
    alone, number = np.unique(twin, return_inverse=True)
    state[arc[first, 0]] = number + 1
    keep = np.zeros(len(first), bool)
    keep[alone] = True
    out = arc[np.repeat(keep, size)]
    out[:, 0] = np.repeat(np.arange(1, len(alone) + 1), size[keep])
    return state, out


def summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows and the sums of their counts."""
    if not len(grams):
        return grams, counts
    base = int(grams.max()) + 2
    if base**3 < 1 << 63:
        # three numbers to a key
        keys = [((grams[:, k : k + 3] + 1) * base ** np.arange(min(3, grams.shape[1] - k))[::-1]).sum(1) for k in range(0, grams.shape[1], 3)]
    else:
        keys = list(grams.T)
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for key in keys:
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    first = np.flatnonzero(fresh)
    return grams[order[first]], np.add.reduceat(counts[order], first)


# Counting ----------------------------------------------------------------------------------


def _home(first: np.ndarray, second: np.ndarray, longer: np.ndarray, n: int) -> np.ndarray:
    """Range of prefixes that counts a phrase: by one word for a single one, else by its first two words."""
    return (np.where(longer, mixed(first * _STEP + second), first) % U64(n)).astype(np.int64)


def _counted(n: int, sketch):
    """Arrow step: automata of the n-grams of runs of texts by language and range of prefixes."""

    def step(batches):
        frequent = sketch.value
        for batch in batches:
            for part, start, length, piece, lang, name, names in _read(batch):
                rows = [(WORDS, str(names[k]), int(c) % n, int(c), None) for k, c in zip(*np.unique(lang, return_counts=True), strict=True)]
                on = frequent.level(name) > 0
                pair = _pairs(name, piece)
                goes = (pair != 0) & (frequent.level(pair) > 0)
                goes[:-1] &= on[:-1] & on[1:]
                # Words of the longest phrase at each place whose words and pairs may all be frequent.
                size = np.zeros(len(name), np.int64)
                for _ in range(LONGEST):
                    follows = np.append(size[1:], 0)
                    size = np.where(on, np.where(goes, np.minimum(1 + follows, LONGEST), 1), 0)
                distinct, at, number = np.unique(name, return_index=True, return_inverse=True)
                single = np.full((len(distinct), LONGEST), -1)
                single[:, 0] = np.arange(len(distinct))
                here = np.flatnonzero(on[at])
                at_long = np.flatnonzero(size > 1)
                long = np.full((len(at_long), LONGEST), -1)
                for k in range(LONGEST):
                    there = size[at_long] > k
                    long[there, k] = number[at_long[there] + k]
                for kind, (gram, counts) in ((SINGLE, (single[here], np.bincount(number, minlength=len(distinct))[here])), (LONG, summed(long, np.ones(len(long), np.int64)))):
                    rows += [(kind, *r) for r in _automata(gram, counts, lang[at], names, distinct, part, start[at], length[at], n)]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "lang", "range", "n", "automaton"])

    return step


def _automata(grams, counts, lang, names, distinct, part, start, length, n) -> list[tuple]:
    """(language, range, phrases, automaton) of distinct rows of word numbers; words are cut from ``part`` for each automaton."""
    if not len(grams):
        return []
    home = _home(distinct[grams[:, 0]], distinct[grams[:, 1]], grams[:, 1] >= 0, n)
    key = lang[grams[:, 0]] * n + home
    order = np.argsort(key, kind="stable")
    out = []
    for rows in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        used = np.unique(grams[rows])
        used = used[used >= 0]
        text = [part[a : a + k].tobytes() for a, k in zip(start[used].tolist(), length[used].tolist(), strict=True)]
        rank = np.array(sorted(range(len(text)), key=text.__getitem__))
        to = np.full(len(distinct) + 1, -1)
        to[used[rank]] = np.arange(len(used))
        automaton = Automaton.of([text[k] for k in rank], *summed(to[grams[rows]], counts[rows]))
        out.append((str(names[lang[grams[rows[0], 0]]]), int(home[rows[0]]), len(rows), automaton.to_bytes()))
    return out


def _united(least: int):
    """Grouped step: one automaton of each language and kind in a range, without phrases below ``least``, and sums of words."""

    def unite(table: pa.Table) -> pa.Table:
        parts: dict = {}
        for kind, lang, n, blob in zip(*(table.column(c).to_pylist() for c in ("kind", "lang", "n", "automaton")), strict=True):
            parts.setdefault((kind, lang), []).append(n if kind == WORDS else blob)
        where, out = table.column("range")[0].as_py() if len(table) else 0, []
        for (kind, lang), blobs in parts.items():
            if kind == WORDS:
                out.append((kind, lang, where, None, np.array([sum(blobs)], ">i8").tobytes()))
                continue
            whole = Automaton.union([Automaton.from_bytes(b) for b in blobs], least)
            if len(whole.arcs[0]):
                out.append((kind, lang, where, whole.to_bytes(), None))
        return _rows(out)

    return unite


_TABLE = "kind int, lang string, range int, automaton binary, weights binary"


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["kind", "lang", "range", "automaton", "weights"])


def _phrases(automaton: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of two words and more, with their counts."""
    grams, weight = automaton.paths()
    long = (grams >= 0).sum(1) > 1
    return grams[long], weight[long]


def _cuts(grams: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each k: k, the rows of more than k words, their first k words, and the rest."""
    size = (grams >= 0).sum(1)
    for k in range(1, LONGEST):
        rows = np.flatnonzero(size > k)
        first, rest = np.full((len(rows), LONGEST), -1), np.full((len(rows), LONGEST), -1)
        first[:, :k] = grams[rows, :k]
        rest[:, : LONGEST - k] = grams[rows, k:]
        yield k, rows, first, rest


def _asked(n: int):
    """Arrow step: the parts of each automaton's phrases, by the range that counts them. A part is asked for once."""

    def step(batches):
        for batch in batches:
            out = []
            for lang, home, blob in zip(*(batch.column(c).to_pylist() for c in ("lang", "range", "automaton")), strict=True):
                whole = Automaton.from_bytes(blob)
                grams, _ = _phrases(whole)
                if not len(grams):
                    continue
                parts = [x for _, _, first, rest in _cuts(grams) for x in (first, rest)]
                parts, ones = summed(np.concatenate(parts), np.ones(sum(map(len, parts)), np.int64))
                size = np.array([len(w) for w in whole.vocabulary], np.int64)
                name = mixed(hashed(np.frombuffer(b"".join(whole.vocabulary), np.uint8), np.cumsum(size) - size, size) ^ _salts([lang])[0])
                long = parts[:, 1] >= 0
                to = _home(name[parts[:, 0]], name[parts[:, 1]], long, n)
                key = to * 2 + long
                for rows in np.split(np.argsort(key, kind="stable"), np.flatnonzero(np.diff(np.sort(key))) + 1):
                    mine = Automaton(whole.vocabulary, Automaton.of(whole.vocabulary, parts[rows], ones[rows]).arcs).pruned(1)
                    out.append((ASK_LONG if long[rows[0]] else ASK_SINGLE, lang, int(to[rows[0]]), mine.to_bytes(), np.array([home], "<i8").tobytes()))
            yield from _rows(out).to_batches()

    return step


def _answered(table: pa.Table) -> pa.Table:
    """Grouped step: asked phrases composed with the automata of the range."""
    held, asked, out = {}, [], []
    for kind, lang, blob, more in zip(*(table.column(c).to_pylist() for c in ("kind", "lang", "automaton", "weights")), strict=True):
        if kind in (SINGLE, LONG):
            whole = Automaton.from_bytes(blob)
            held[kind, lang] = whole, {w: k for k, w in enumerate(whole.vocabulary)}
        else:
            asked.append((kind, lang, blob, more))
    for kind, lang, blob, more in asked:
        ask = Automaton.from_bytes(blob)
        grams, _ = ask.ends()
        weight = np.zeros(len(grams), np.int64)
        if (kind - ASK, lang) in held:
            whole, place = held[kind - ASK, lang]
            to = np.array([*[place.get(w, len(place)) for w in ask.vocabulary], -1], np.int64)
            weight = whole.weights(to[grams])
        out.append((ANSWER, lang, int(np.frombuffer(more, "<i8")[0]), blob, weight.tobytes()))
    return _rows(out)


_PARTS = "lang string, phrase binary, n_words int, cut int, a long, l long, r long"


def _composed(table: pa.Table) -> pa.Table:
    """Grouped step: each phrase of a range with the counts of its parts at every cut."""
    out: list[list] = [[] for _ in range(7)]
    rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "lang", "automaton", "weights")), strict=True))
    for kind, lang, blob, _ in rows:
        if kind != LONG:
            continue
        whole = Automaton.from_bytes(blob)
        grams, weight = _phrases(whole)
        if not len(grams):
            continue
        place = {w: k for k, w in enumerate(whole.vocabulary)}
        known, counts = [], []
        for other, where, parts, weights in rows:
            if other == ANSWER and where == lang:
                ask = Automaton.from_bytes(parts)
                to = np.array([*[place[w] for w in ask.vocabulary], -1], np.int64)
                known.append(to[ask.ends()[0]])
                counts.append(np.frombuffer(weights, np.int64))
        known, counts = summed(np.concatenate(known), np.concatenate(counts))
        words_of = [[whole.vocabulary[k] for k in row if k >= 0] for row in grams.tolist()]
        for k, at, first, rest in _cuts(grams):
            both = np.concatenate([known, first, rest])
            _, number = np.unique(both, axis=0, return_inverse=True)
            count = np.zeros(number.max() + 1, np.int64)
            count[number[: len(known)]] = counts
            left, right = count[number[len(known) : len(known) + len(first)]], count[number[len(known) + len(first) :]]
            for x, values in zip(out, ([lang] * len(at), [b" ".join(words_of[i]) for i in at.tolist()], [len(words_of[i]) for i in at.tolist()], [k] * len(at), weight[at].tolist(), left.tolist(), right.tolist()), strict=True):
                x += values
    kinds = (pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], [f.split()[0] for f in _PARTS.split(", ")])


def part_counts(documents: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, cut, a, l, r) of every phrase of 2 to LONGEST words that occurs ``least`` times or more, and (lang, n) of all words.

    ``a`` counts the phrase, ``l`` its first ``cut`` words and ``r`` the rest, all with overlaps.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "collocations")
    rows = documents.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, min(buckets(spark), total // RANGE + 1))

    def items(batch):
        for *_, piece, _, name, _ in _read(batch):
            pair = _pairs(name, piece)
            yield np.concatenate([name, pair[pair != 0]])

    sketch = spark.sparkContext.broadcast(common(rows, items, 2 * total // WORD_BYTES, (least,), 8))
    counted = rows.mapInArrow(_counted(n, sketch), "kind int, lang string, range int, n long, automaton binary")
    automata = scratch.keep(counted.groupBy("range").applyInArrow(_united(least), _TABLE), "automata")
    long = automata.where(F.col("kind") == LONG)
    asked = long.mapInArrow(_asked(n), _TABLE)
    answers = scratch.keep(automata.where(F.col("kind") != WORDS).unionByName(asked).groupBy("range").applyInArrow(_answered, _TABLE), "answers")
    parts = scratch.keep(long.unionByName(answers).groupBy("range").applyInArrow(_composed, _PARTS), "parts")
    scratch.drop("answers")
    n = F.conv(F.hex("weights"), 16, 10).cast("long")
    n_words = automata.where(F.col("kind") == WORDS).groupBy("lang").agg(F.sum(n).alias("n"))
    return parts, n_words


def mine(documents: DataFrame, least: int = 30, share: int = 80, top: int | None = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that bind best.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces, those into words at
    spaces and tabs. A candidate of 2 to LONGEST words occurs ``least`` times or more; cut after its
    first words it scores 2000000 * a / (l + r), rounded down, and the lowest cut counts, the
    shortest of equal ones. Candidates inside a longer one that occurs ``share`` per cent as often
    are dropped. ``rank`` orders by score, then count, then the phrase's bytes; ``top`` is the
    length of the report, None for all. A null language is ``und``; a null or empty text and an empty table
    have no phrases; rows that repeat count each; other columns are not read.

    A sketch of bounded size leaves out n-grams with a word or pair that is rare for certain;
    where it is full it leaves out less, and the results are the same.
    """
    parts, n_words = part_counts(documents, least)
    wide = "decimal(38,0)"
    score = F.expr(f"cast(2000000 as {wide}) * cast(a as {wide}) div (cast(l as {wide}) + cast(r as {wide}))")
    cut = F.struct(score.alias("score"), "cut", "l", "r")
    scored = parts.groupBy("lang", "phrase", "n_words", "a").agg(F.min(cut).alias("best"))
    words_ = F.split(F.col("phrase").cast("string"), " ")
    longer = parts.where("cut = 1 and n_words > 2").select("lang", "a", words_.alias("w"))
    spans = [(i, k) for k in range(2, LONGEST) for i in range(1, LONGEST - k + 2)]
    inner = F.filter(F.array(*[F.when(F.size("w") >= i + k - 1, F.when(F.size("w") > k, F.array_join(F.slice("w", i, k), " "))) for i, k in spans]), lambda x: x.isNotNull())
    inner = longer.select("lang", "a", F.explode(inner).alias("inside")).groupBy("lang", "inside").agg(F.max("a").alias("most"))
    kept = scored.withColumn("inside", F.col("phrase").cast("string")).join(inner, ["lang", "inside"], "left")
    kept = kept.where(F.col("most").isNull() | (F.lit(100) * F.col("most").cast(wide) < F.lit(share) * F.col("a").cast(wide)))
    kept = kept.select("lang", F.col("inside").alias("phrase"), "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").cast("long").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(n_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
