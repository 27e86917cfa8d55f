"""Documents whose sets of word shingles are alike: an exact Jaccard join and its components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import U64, Scratch, buckets, components, mixed, packed, runs, texts_of, word_hashes
from entitymart.llm.sketch import Common, common, marked, members

#: Bytes of text hashed at once.
CHUNK = 4 << 20
#: Shingles of all documents, or bytes of bitmaps, that one tile holds.
TILE_SHINGLES, TILE_BYTES = 4_000_000, 16 << 20
#: Shingles that a task sends to the sketch at once.
SKETCHED = 1 << 20
#: Bytes of an average word with its blank: sets the sketch's size only.
WORD_BYTES = 6
#: Sets from which a shingle counts as shared, and as frequent.
SHARED, FREQUENT = 2, 512
PART = np.dtype([("key", "<u4"), ("node", "<i8"), ("n", "<i4")])
DOCUMENT = np.dtype([("id", "<i8"), ("known", "u1"), ("node", "<i8"), ("n", "<i8"), ("hash", "<i8")])


def shingles(raw: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text with fewer words is one shingle."""
    hashes, text = word_hashes(raw, bounds)
    first = np.searchsorted(text, np.arange(len(bounds)))
    rolled = np.zeros(len(hashes), U64)
    for k in range(width):
        rolled[: len(hashes) - k] = rolled[: len(hashes) - k] * U64(0x9FB21C651E98DF25) + hashes[k:]
    rolled = mixed(rolled)
    out = []
    for start, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if end - start >= width:
            out.append(np.unique(rolled[start : end - width + 1]))
        elif end > start:
            whole = U64(end - start)
            for h in hashes[start:end]:
                whole = mixed(np.array([whole ^ h], U64))[0]
            out.append(np.array([whole], U64))
        else:
            out.append(np.zeros(0, U64))
    return out


def set_name(found: np.ndarray) -> int:
    """Equal sets have one name; a signed 64-bit number."""
    return int(mixed(np.array([mixed(found ^ U64(0x5851F42D4C957F2D)).sum() + U64(len(found))], U64)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, column: int, width: int):
    """Row, shingles and name of each text of a batch."""
    raw, bounds = texts_of(batch.column(column))
    for first, last in runs(bounds, CHUNK):
        part = bounds[first : last + 1]
        for row, found in enumerate(shingles(raw[part[0] : part[-1]], part - part[0], width), first):
            yield row, found, set_name(found) if len(found) else 0


def prefix_length(n: int, percent: int) -> int:
    """Of two linked sets with n shingles or more in one, any n less this many and one are in both:
    in every order, their first common shingle is among the first so many of each."""
    return n + percent * n // -100 + 1


def prefix(found: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The shingles by which a set meets those it may be linked with.

    All sets are ordered alike, rare shingles first and then by hash, so linked sets share
    one of their first ``prefix_length``. Those that no other set has are left out.
    """
    order = np.argsort(level, kind="stable")[: prefix_length(len(found), percent)]
    return found[order][level[order] > 0]


def _signed(n: int, percent: int, width: int, sketch):
    """Arrow step: the shingles by which sets meet, and one record per document, by bucket."""

    def step(batches):
        counted: Common = sketch.value
        for batch in batches:
            keys, nodes, documents, signed = [], [], np.zeros(batch.num_rows, DOCUMENT), set()
            documents["id"], documents["known"] = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            documents["hash"] = batch.column(3).to_numpy()
            for row, found, name in _sets(batch, 2, width):
                if len(found):
                    documents["node"][row], documents["n"][row] = name, len(found)
                # One shingle is linked with an equal set only; equal sets of a batch sign once.
                if len(found) > 1 and name not in signed:
                    signed.add(name)
                    met = prefix(found, counted.level(found), percent)
                    if len(met):
                        keys.append(met)
                        nodes.append((name, len(found), len(met)))
            rows = []
            if keys:
                key = mixed(np.concatenate(keys) ^ U64(0x632BE59BD9B4E019))
                records, times = np.empty(len(key), PART), [k for *_, k in nodes]
                records["key"] = key & U64(0xFFFFFFFF)
                records["node"] = np.repeat(np.array([x for x, *_ in nodes], np.int64), times)
                records["n"] = np.repeat(np.array([x for _, x, _ in nodes], np.int32), times)
                rows += [(b, blob, None) for b, blob in packed(((key >> U64(32)) % U64(n)).astype(np.int64), records, n)]
            rows += [(b, None, blob) for b, blob in packed(np.arange(len(documents)) * 31 % n, documents, n)]
            columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "parts", "documents"])

    return step


_MET = "kind int, a long, b long, n long, hash long"


def _shared(parts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the groups of sets that share a shingle, and the records of their sets.

    A gap between neighbouring sizes that nothing links across parts a group, and a set
    alone is none. Groups of the same sets have one name and are listed once.
    """
    parts = parts[np.lexsort((parts["node"], parts["n"], parts["key"]))]
    key, node, size = (np.ascontiguousarray(parts[c]) for c in ("key", "node", "n"))
    fresh = np.ones(len(parts), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    parts, key, node, size = parts[fresh], key[fresh], node[fresh], size[fresh].astype(np.int64)
    if not len(parts):
        return np.zeros(0, np.int64), parts
    opens = np.ones(len(parts), bool)
    opens[1:] = (key[1:] != key[:-1]) | (size[1:] * percent > size[:-1] * 100)
    first = np.flatnonzero(opens)
    name = np.add.reduceat(mixed(node.view(U64)), first)
    once = np.zeros(len(first), bool)
    once[np.unique(name, return_index=True)[1]] = True
    once &= np.diff(np.append(first, len(parts))) > 1
    group = np.cumsum(opens) - 1
    kept = once[group]
    return mixed(name)[group[kept]].view(np.int64), parts[kept]


def _meet(percent: int):
    """Grouped step: the documents of a bucket, and the groups of its sets that share a shingle."""

    def meet(table: pa.Table) -> pa.Table:
        blobs = lambda c, t: np.frombuffer(b"".join(x for x in table.column(c).to_pylist() if x is not None), t)
        documents = blobs("documents", DOCUMENT)
        names, met = _shared(blobs("parts", PART), percent)
        kind = np.concatenate([np.zeros(len(met), np.int32), np.where(documents["known"], 1, 2).astype(np.int32)])
        columns = [
            kind,
            np.concatenate([names, documents["id"]]),
            np.concatenate([met["node"], documents["node"]]),
            np.concatenate([met["n"].astype(np.int64), documents["n"]]),
            np.concatenate([np.zeros(len(met), np.int64), documents["hash"]]),
        ]
        return pa.table([pa.array(c) for c in columns], ["kind", "a", "b", "n", "hash"])

    return meet


def bits_of(n: int) -> int:
    """Bits of a set's bitmap: more than it has shingles, within bounds."""
    return 1 << max(7, min(16, int(n).bit_length()))


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Bit k of a set: whether an odd number of its shingles hash to k. Sets differ at least where bits do."""
    out = np.zeros((len(sets), bits // 64), U64)
    for row, found in enumerate(sets):
        place = (mixed(found + U64(0x2545F4914F6CDD1D)) & U64(bits - 1)).astype(np.int64)
        out[row] = np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).view(U64)
    return out


def alike(maps: list[bytes], sizes: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Smallest index of each component of the sets that sizes and bit counts let be linked.

    ``side`` 0 and 1: only pairs across sides count; 2: all. Pairs already in one component are
    not tested, so a group of near copies takes one turn. Bitmaps of several widths are
    folded to the narrower one, by which sets still differ at least where the bits do.
    """
    widths, label = np.array([len(m) for m in maps]), np.arange(len(maps))
    for width in np.unique(widths):
        here = np.flatnonzero((widths == width) | (widths == 2 * width))
        here = here[np.argsort(sizes[here], kind="stable")]
        bits = np.zeros((len(here), width // 8), U64)
        for row, k in enumerate(here.tolist()):
            whole = np.frombuffer(maps[k], U64)
            bits[row] = whole if widths[k] == width else whole[: width // 8] ^ whole[width // 8 :]
        size, where, label_here = sizes[here], side[here], label[here]
        for x in np.flatnonzero(widths[here] == width).tolist():
            near = np.arange(x + 1, int(np.searchsorted(size, size[x] * 100 // percent, "right")))
            near = near[label_here[near] != label_here[x]]
            if where[x] != 2:
                near = near[where[near] != where[x]]
            if not len(near):
                continue
            both = size[near] + size[x]
            differ = np.bitwise_count(bits[near] ^ bits[x]).sum(axis=1, dtype=np.int64)
            # |x n y| <= (|x| + |y| - differing bits) / 2
            met = near[(100 + percent) * (both - differ) >= 2 * percent * both]
            if len(met):
                named = np.append(label_here[met], label_here[x])
                label = _renamed(label, named)
                label_here = label[here]
    return label


def _renamed(label: np.ndarray, names: np.ndarray) -> np.ndarray:
    to = np.arange(len(label))
    to[names] = names.min()
    return to[label]


def _alike(percent: int):
    """Grouped step: edges of a forest of the sets of each tile that may be linked."""

    def step(table: pa.Table) -> pa.Table:
        tile, node, side, size = (table.column(c).to_numpy() for c in ("tile", "node", "side", "n"))
        maps, out = table.column("bits"), []
        order = np.lexsort((node, tile))
        for rows in np.split(order, np.flatnonzero(np.diff(tile[order])) + 1) if len(order) else []:
            root = alike([maps[int(k)].as_py() for k in rows], size[rows], side[rows], percent)
            tied = root != np.arange(len(rows))
            out.append(np.stack([node[rows][root[tied]], node[rows][tied]], 1))
        edges = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.table([pa.array(edges[:, k].copy()) for k in range(2)], ["a", "b"])

    return step


def linked(sets: list[np.ndarray], side: np.ndarray, weight: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest index of each component of the exact links among ``sets``, and the weight that each set is linked with.

    ``side`` 0 and 1: only links across sides count; 2: with every set. Every pair is tested:
    sizes and bit counts bound the overlap from above, and what passes is counted exactly.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    sets, sizes, side, weight = [sets[k] for k in order], sizes[order], side[order], weight[order]
    bits = 1 << max(7, min(14, int(sizes.max(initial=1)).bit_length()))
    maps = bitmaps(sets, bits)
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    at, mark = np.concatenate([[0], np.cumsum(sizes)]), np.zeros(len(values), np.int32)
    label, links = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    for x in range(len(sets) - 1):
        high = int(np.searchsorted(sizes, sizes[x] * 100 // percent, "right"))
        near = np.arange(x + 1, high)
        if side[x] != 2:
            near = near[side[near] != side[x]]
        differ = np.bitwise_count(maps[near] ^ maps[x]).sum(axis=1, dtype=np.int64)
        both = sizes[near] + sizes[x]
        # |x n y| <= (|x| + |y| - differing bits) / 2
        near = near[(100 + percent) * (both - differ) >= 2 * percent * both]
        if not len(near):
            continue
        mark[ids[at[x] : at[x + 1]]] = 1
        for part in np.split(near, np.flatnonzero(np.diff((np.cumsum(sizes[near]) - sizes[near]) // CHUNK)) + 1):
            starts = np.cumsum(sizes[part]) - sizes[part]
            places = np.repeat(at[part] - starts, sizes[part]) + np.arange(starts[-1] + sizes[part[-1]])
            common = np.add.reduceat(mark[ids[places]], starts, dtype=np.int64)
            met = part[100 * common >= percent * (sizes[part] + sizes[x] - common)]
            links[x] += weight[met].sum()
            links[met] += weight[x]
            if (label[met] != label[x]).any():
                to, names = np.arange(len(sets)), np.append(label[met], label[x])
                to[names] = names.min()
                label = to[label]
        mark[ids[at[x] : at[x + 1]]] = 0
    out, counts = np.empty(len(sets), np.int64), np.empty(len(sets), np.int64)
    name = np.full(len(sets), len(sets))
    np.minimum.at(name, label, order)
    out[order], counts[order] = name[label], links
    return out, counts


def _verify(percent: int):
    def verify(table: pa.Table) -> pa.Table:
        tile, node, side, weight = (table.column(c).to_numpy() for c in ("tile", "node", "side", "copies"))
        blobs, out = table.column("found"), []
        order = np.lexsort((node, tile))
        order = order[np.r_[True, (tile[order][1:] != tile[order][:-1]) | (node[order][1:] != node[order][:-1])][: len(order)]]
        for rows in np.split(order, np.flatnonzero(np.diff(tile[order])) + 1):
            name, links = linked([np.frombuffer(blobs[int(k)].as_py(), U64) for k in rows], side[rows], weight[rows], percent)
            tied = links > 0
            out.append(np.stack([node[rows][name[tied]], node[rows][tied], links[tied]], 1))
        edges = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return pa.table([pa.array(edges[:, k].copy()) for k in range(3)], ["a", "b", "links"])

    return verify


def _arrays(width: int):
    """Arrow step: shingles and bitmaps of the rows whose set is the one asked for."""

    def step(batches):
        for batch in batches:
            wanted = batch.column(0).to_numpy()
            rows = [(k, s, bitmaps([s], bits_of(len(s)))[0]) for k, s, name in _sets(batch, 1, width) if len(s) and name == wanted[k]]
            at = pa.array([k for k, *_ in rows], pa.int64())
            columns = [batch.column(0).take(at), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (1, 2)), batch.column(2).take(at), batch.column(3).take(at)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "found", "bits", "copies", "n"])

    return step


def _tiles(sets: DataFrame, scratch: Scratch, name: str, percent: int, most: int, n: int) -> DataFrame:
    """Tiles of (group, node, n, load): a group whole, or cut where its loads exceed ``most``.

    A cut is a fine band of sizes and, where that is full, a part of it by hash; every two
    cuts of one group whose sizes can link make a tile. Adds tile, bucket and side.
    """
    fine = F.floor(F.ln("n") / F.lit(float(np.log(1.05)))).cast("int")
    sets = sets.withColumn("fine", fine)
    loads = sets.groupBy("group", "fine").agg(F.sum("load").alias("load"))
    big = loads.groupBy("group").agg(F.sum("load").alias("all")).where(F.col("all") > most).select("group")
    cuts = F.ceil(F.col("load") / max(1, most // 8)).cast("int")
    big = scratch.keep(loads.join(big, "group").select("group", "fine", cuts.alias("cuts")), name)
    whole = sets.join(big.select("group").distinct(), "group", "left_anti")
    whole = whole.select("node", "n", F.col("group").alias("tile"), F.pmod(F.xxhash64("group"), F.lit(n)).cast("long").alias("bucket"), F.lit(2).alias("side"))
    cut = sets.join(big, ["group", "fine"]).withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    other = big.select("group", F.col("fine").alias("o_fine"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("o_cut"))
    reach = int(np.ceil(np.log(100 / percent) / np.log(1.05))) + 1
    pairs = cut.join(other, "group").where(F.abs(F.col("fine") - F.col("o_fine")) <= reach)
    mine, theirs = F.struct(F.col("fine").alias("f"), F.col("cut").alias("c")), F.struct(F.col("o_fine").alias("f"), F.col("o_cut").alias("c"))
    tile = F.xxhash64("group", F.least(mine, theirs), F.greatest(mine, theirs))
    side = F.when(mine == theirs, 2).when(mine < theirs, 0).otherwise(1)
    return whole.unionByName(pairs.select("node", "n", tile.alias("tile"), tile.alias("bucket"), side.alias("side")))


def candidates(rows: DataFrame, scratch: Scratch, width: int, percent: int, tile_bytes: int = TILE_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of rows (id, known, text, hash), the shingles and bitmaps of those that may be linked, and their groups.

    (id, known, node, n, hash) of every row; (node, found, bits, copies, n) of sets that share a rare
    shingle; (node, root) of sets that sizes and bit counts let be linked, also through others.
    """
    spark, n = rows.sparkSession, buckets(rows.sparkSession)

    def items(batch):
        seen, held, size = set(), [], 0
        for _, found, name in _sets(batch, 2, width):
            if len(found) > 1 and name not in seen:
                seen.add(name)
                held.append(found)
                size += len(found)
            if size > SKETCHED:
                yield np.concatenate(held)
                held, size = [], 0
        if held:
            yield np.concatenate(held)

    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sketch = spark.sparkContext.broadcast(common(rows, items, total // WORD_BYTES, (SHARED, FREQUENT), 1))
    signed = rows.mapInArrow(_signed(n, percent, width, sketch), "bucket int, parts binary, documents binary")
    met = scratch.keep(signed.groupBy("bucket").applyInArrow(_meet(percent), _MET), "met")
    sets = met.where("kind > 0").select(F.col("a").alias("id"), (F.col("kind") == 1).alias("known"), F.col("b").alias("node"), "n", "hash")
    groups = met.where("kind = 0").select(F.col("a").alias("group"), F.col("b").alias("node"), "n").distinct()
    groups = scratch.keep(groups, "shared")

    # One document of each set that meets others brings the shingles. The asked ones grow
    # with the corpus, so both sides are shuffled at every size, but only texts that a sketch
    # of the asked ones' hashes lets through.
    first = F.min(F.struct((~F.col("known")).alias("nameless"), "id", "hash"))
    asked = sets.join(groups.select("node").distinct(), "node", "left_semi").groupBy("node").agg(first.alias("f"), F.min("n").alias("n"), F.count("*").alias("copies"))
    asked = asked.select("node", F.col("f.id").alias("id"), (~F.col("f.nameless")).alias("known"), F.col("f.hash").alias("hash"), "n", "copies")
    asked = scratch.keep(asked, "asked")
    texts = marked(rows, "hash", members(asked, "hash"), True)
    found = texts.join(asked.drop("hash").hint("merge"), ["id", "known"]).select("node", "text", "copies", "n")
    found = scratch.keep(found.mapInArrow(_arrays(width), "node long, found binary, bits binary, copies long, n long"), "found")

    load = F.length("bits").cast("long")
    bits = found.select("node", "bits")
    sized = groups.join(found.select("node", load.alias("load")).distinct(), "node")
    tiles = _tiles(sized, scratch, "cut_groups", percent, tile_bytes, n).join(bits.dropDuplicates(["node"]), "node")
    edges = scratch.keep(tiles.groupBy("bucket").applyInArrow(_alike(percent), "a long, b long"), "alike")
    roots = components(edges, scratch, "group")
    return sets, found, scratch.keep(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "members")


def near_duplicates(documents: DataFrame, width: int = 4, percent: int = 85, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, group_id, text_hash): groups of documents linked by Jaccard >= ``percent`` / 100.

    Equal sets are one node. Nodes meet where they share one of their rarest shingles, so
    stock phrases bring nothing together; a sketch of bounded size tells rare from
    frequent, and where it is full more nodes meet, with the same results. What meets is
    tested with bitmaps, in tiles of sizes that can link: bit counts bound the overlap from
    above. Only nodes that pass, also through others, form a candidate group. Its sorted
    arrays are compared exactly, every two that sizes and bits do not rule out; a group with
    more than ``tile_shingles`` shingles is cut into tiles of neighbouring sizes, and every two tiles that
    can hold a link are compared. What leaves a tile is a forest and the number of rows that
    each set is linked with. ``n_links`` counts the other rows that a row is linked with,
    among them the rows with an equal set. ``group_id`` names a group also where all its ids
    are null, and is null without shingles; ``text_hash`` tells rows with one id apart.

    Words are separated by space and tab to carriage return; A-Z is lower-cased. A null,
    empty or blank text has no shingles and is alone with its id. A null id can be linked
    but names no component: it is null only if all ids of the component are. Rows that
    repeat get the same result; an empty table gives no rows. Shingles are compared by
    64-bit hashes.
    """
    spark = documents.sparkSession
    scratch, n = Scratch(spark, "jaccard"), buckets(spark)
    text = F.col("text").cast("string")
    known = F.col("doc_id").isNotNull()
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("id"), known.alias("known"), text.alias("text"), F.xxhash64(text).alias("hash"))
    sets, found, members = candidates(rows, scratch, width, percent)
    arrays = found.dropDuplicates(["node"]).join(members, "node")
    tiles = _tiles(arrays.select(F.col("root").alias("group"), "node", "n", F.col("n").alias("load")), scratch, "cut_tiles", percent, tile_shingles, n)
    tiles = tiles.drop("n").join(arrays.select("node", "found", "copies"), "node")
    links = tiles.groupBy("bucket").applyInArrow(_verify(percent), "a long, b long, links long")
    links = scratch.keep(links, "links")
    roots = components(links.select("a", "b"), scratch, "linked")

    # Links with equal sets and with others; nodes without any are left out.
    equal = sets.where("n > 0").groupBy("node").agg((F.count("*") - 1).alias("links")).where("links > 0")
    counts = equal.unionByName(links.select(F.col("b").alias("node"), "links")).groupBy("node").agg(F.sum("links").alias("n_links"))
    rooted = sets.join(scratch.keep(counts.join(roots, "node", "left"), "roots"), "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    rooted = scratch.keep(rooted.withColumn("doc_id", F.when(F.col("known"), F.col("id"))), "rooted")
    names = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    full = rooted.where("n > 0").join(names, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", F.col("root").alias("group_id"), F.col("hash").alias("text_hash"))
    empty = rooted.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "n_links", F.lit(None).cast("long").alias("group_id"), F.col("hash").alias("text_hash"))
    return full.unionByName(empty)
