"""Fill-in-the-middle: documents rearranged around a hole whose ends are counted in units.

A unit is a run of the letters A-Z, or one other code point. Texts are cut where their
own content says so, so that passages which documents share fall into equal chunks; a
chunk's counts are remembered by its content, and a place given in units is found from
the sums of the chunks, by reading one chunk only.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import U64, mixed, runs, texts_of

#: Bytes of texts cut at once.
RUN = 8 << 20
#: Bytes that the rolling hash sees, and the least, usual and largest bytes of a chunk.
WINDOW, LEAST, USUAL, MOST = 32, 256, 1024, 8192
#: Bytes of chunks that a worker remembers.
REMEMBERED = 48 << 20
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
LEAD = (np.arange(256) & 0xC0) != 0x80
_CLASS = bytes(ord("a") if LETTER[b] else ord(".") for b in range(256))
_REST = bytes(b for b in range(256) if not LEAD[b])
_BYTE = mixed(np.arange(1, 257, dtype=U64))
_BASE = 0x9E3779B97F4A7C15


def candidates(raw: np.ndarray) -> np.ndarray:
    """Places where the rolling hash of the next WINDOW bytes allows a cut, between code points.

    The hash is a polynomial over the window, summed in doubling steps.
    """
    value, width, power = _BYTE[raw], 1, _BASE
    while width < WINDOW:
        value = value[: max(0, len(value) - width)] * U64(power) + value[width:]
        width, power = 2 * width, power * power % 2**64
    return np.flatnonzero((mixed(value) < U64(2**64 // USUAL)) & LEAD[raw[: len(value)]])


def edges(raw: np.ndarray, places: list[int], start: int, end: int) -> list[int]:
    """Starts of the chunks of one text, and its end. ``places`` are sorted; a chunk has
    LEAST to MOST bytes but for the last, so periodic texts are cut too."""
    out, last = [start], bisect_right(places, end - WINDOW)
    while end - out[-1] > LEAST:
        k = bisect_left(places, out[-1] + LEAST, 0, last)
        cut = min(places[k] if k < last else end, out[-1] + MOST)
        while cut < end and not LEAD[raw[cut]]:
            cut -= 1
        if cut >= end:
            break
        out.append(cut)
    return [*out, end] if end > start else out


class Memo:
    """Summaries of chunks by content: units, code points, and whether they start and end with a letter."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.size, self.hits, self.now, self.before = most, 0, 0, {}, {}

    def __call__(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.now.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.before.get(chunk)
        if found is None:
            kinds = chunk.translate(_CLASS, _REST)
            starts = kinds.startswith(b"a")
            found = (kinds.count(b".") + kinds.count(b".a") + starts, len(kinds), starts, kinds.endswith(b"a"))
        else:
            self.hits += 1
        self.size += len(chunk)
        if self.size > self.most:
            self.now, self.before, self.size = {}, self.now, len(chunk)
        self.now[chunk] = found
        return found


class Counted:
    """A text by its chunks: how many units it has, and where the k-th starts."""

    def __init__(self, raw: np.ndarray, text: bytes, cuts: list[int], memo: Memo):
        self.raw, self.cuts = raw, cuts
        base, self.units, self.chars, self.goes_on, letter = cuts[0], [0], [0], [], False
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            units, chars, starts, ends = memo(text[a - base : b - base])
            # A run of letters across the edge is one unit, counted where it starts.
            self.goes_on.append(letter and starts)
            self.units.append(self.units[-1] + units - self.goes_on[-1])
            self.chars.append(self.chars[-1] + chars)
            letter = ends
        self.n = self.units[-1]

    def place(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) before a unit; all of the text for ``n``."""
        if unit >= self.n:
            return self.cuts[-1] - self.cuts[0], self.chars[-1]
        k = bisect_right(self.units, unit) - 1
        part = self.raw[self.cuts[k] : self.cuts[k + 1]]
        letter, lead = LETTER[part], LEAD[part]
        starts = lead.copy()
        starts[1:] &= ~(letter[1:] & letter[:-1])
        at = int(np.flatnonzero(starts)[unit - self.units[k] + self.goes_on[k]])
        return self.cuts[k] + at - self.cuts[0], self.chars[k] + int(lead[:at].sum())


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the hash of the id; a null id counts as no digits."""
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(name[k : k + 8], 16) for k in range(0, 32, 8)]


_FOUND = "fim_units long, fim_form string, fim_prefix_chars long, fim_middle_chars long, fim_text string"


def _rearranged(seed: int, plain: int, spm: int, marks: tuple[str, str, str]):
    p, s, m = (x.encode() for x in marks)

    def step(batches):
        memo = Memo()
        for batch in batches:
            raw, bounds = texts_of(batch.column("fim_in"))
            ids = batch.column("fim_id").to_pylist()
            for first, last in runs(bounds, RUN):
                part, rows = raw[bounds[first] : bounds[last]], []
                places = candidates(part).tolist()
                for k in range(first, last):
                    start, end = int(bounds[k] - bounds[first]), int(bounds[k + 1] - bounds[first])
                    text, (h1, h2, h3, h4) = part[start:end].tobytes(), draws(ids[k], seed)
                    counted = Counted(part, text, edges(part, places, start, end), memo)
                    if not text or p in text or s in text or m in text or h3 % 100 >= 100 - plain:
                        rows.append((counted.n, "plain", None, None, text))
                        continue
                    low, high = sorted((h1 % (counted.n + 1), h2 % (counted.n + 1)))
                    (a, before), (b, upto) = counted.place(low), counted.place(high)
                    if h4 % 100 < spm:
                        form, out = "spm", b"".join((s, text[b:], p, text[:a], m, text[a:b]))
                    else:
                        form, out = "psm", b"".join((p, text[:a], s, text[b:], m, text[a:b]))
                    rows.append((counted.n, form, before, upto - before, out))
                kept = [batch.column(c).slice(first, last - first) for c in batch.schema.names[:-2]]
                new = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
                new[4] = new[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays([*kept, *new], [*batch.schema.names[:-2], *(f.split()[0] for f in _FOUND.split(", "))])

    return step


def rearrange(documents: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Every document with ``fim_text``, its ``fim_form`` (plain, psm or spm), ``fim_units``, and the code points of prefix and middle.

    Prefix and middle end after the smaller and the larger of two draws from the hash of
    the id, in units. ``plain`` and ``spm`` are per cent of the documents, and of those that
    are not plain. A text that is null or empty, or that holds a mark, stays as it is (null
    becomes empty), its lengths null. A null id draws as no digits; rows that repeat
    get the same result; an empty table gives no rows. All other columns stay; columns
    named like the new ones are replaced. Nothing is shuffled, and a task holds one run of
    texts and the chunks that it remembers.
    """
    new = [f.split()[0] for f in _FOUND.split(", ")]
    kept = documents.select([documents[c] for c in documents.columns if c not in (*new, "fim_id", "fim_in")])
    rows = documents.select(*[documents[c] for c in kept.columns], F.col("doc_id").cast("long").alias("fim_id"), F.col("text").cast("string").alias("fim_in"))
    schema = kept.schema
    for part in _FOUND.split(", "):
        schema = schema.add(*part.split())
    return rows.mapInArrow(_rearranged(seed, plain, spm, marks), schema)


def restored(form: Column, text: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``rearrange`` took apart. It holds no mark, so each mark stands where it is first found."""
    p, s, m = marks
    psm, spm = (_between(text, a, b, m) for a, b in ((p, s), (s, p)))
    # psm: prefix, suffix, middle; spm: suffix, prefix, middle
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(text)
    )


def _between(text: Column, one: str, two: str, three: str) -> tuple[Column, Column, Column]:
    at2, at3 = F.locate(two, text, 1), F.locate(three, text, 1)
    start = len(one) + 1
    return (
        F.substr(text, F.lit(start), at2 - F.lit(start)),
        F.substr(text, at2 + F.lit(len(two)), at3 - at2 - F.lit(len(two))),
        F.substr(text, at3 + F.lit(len(three))),
    )
