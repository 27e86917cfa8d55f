"""Near-duplicate vectors of a label: every pair is bounded, few are computed to the end."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import Scratch, components, joined

#: Vectors of one tile; a task holds two tiles.
TILE = 4096
#: Rows of a tile compared at once, and leading dimensions added in a step.
BLOCK, STEP = 256, 8
#: Room for rounding in the bounds; links themselves are decided by the cosine of the vectors as given.
SLACK = 1e-6


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows of ordinary size: one whose squares would vanish or overflow is divided by its largest component."""
    with np.errstate(over="ignore", under="ignore"):
        norm = np.linalg.norm(x, axis=1, keepdims=True)
    odd = ~((norm > 1e-140) & (norm < 1e140))
    return np.where(odd, x / np.abs(x).max(axis=1, keepdims=True), x) if odd.any() else x


def _moments(batches):
    """Arrow step: sums of products of unit vectors, by dimension count."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        by: dict[int, list[np.ndarray]] = {}
        for v in batch.column(0).to_pylist():
            by.setdefault(len(v), []).append(v)
        for d, rows in by.items():
            x = scaled(np.array(rows, np.float64))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sums[d] = sums.get(d, 0) + x.T @ x
    for d, s in sums.items():
        columns = [pa.array(np.full(d * d, d), pa.int32()), pa.array(np.arange(d * d), pa.int32()), pa.array(s.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["d", "place", "s"])


def rotations(classes: DataFrame, most: int = 1024) -> dict[int, np.ndarray]:
    """Principal axes, strongest first, for each dimension count up to ``most``; d x d numbers each.

    They only order the dimensions, so any rotation gives the same links.
    """
    sums = classes.where(F.size("v") <= most).select("v").mapInArrow(_moments, "d int, place int, s double").groupBy("d", "place").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["d"], np.zeros((r["d"], r["d"])))[divmod(r["place"], r["d"])] = r["s"]
    return {d: np.linalg.eigh(s)[1][:, ::-1].copy() for d, s in out.items()}


def _unit(table: pa.Table, axes: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as given, their norms, and unit vectors along the principal axes."""
    flat = table.column("v").combine_chunks()
    given = scaled(np.asarray(flat.flatten(), np.float64).reshape(len(table), -1))
    norms = np.linalg.norm(given, axis=1)
    unit = given / norms[:, None]
    return given, norms, unit @ axes[given.shape[1]] if given.shape[1] in axes else unit


def pairs_within(a: tuple, b: tuple, least: float, same: bool):
    """Blocks of index pairs (i, j) with cosine >= ``least``; i < j where both tiles are the same.

    Leading dimensions are added first. What the others can add is at most the product of
    the norms of the suffixes, so a pair is left as soon as that cannot reach ``least``.
    """
    (ga, na, ua), (gb, nb, ub) = a, b
    d = ua.shape[1]
    suffix = lambda u: np.sqrt(np.maximum(np.cumsum((u**2)[:, ::-1], axis=1)[:, ::-1], 0))
    sa, sb = np.c_[suffix(ua), np.zeros(len(ua))], np.c_[suffix(ub), np.zeros(len(ub))]
    for first in range(0, len(ua), BLOCK):
        rows = slice(first, min(first + BLOCK, len(ua)))
        at = min(STEP, d)
        part = ua[rows, :at] @ ub[:, :at].T
        near = part + sa[rows, at, None] * sb[None, :, at] >= least - SLACK
        # While many are left whole blocks are cheapest; then the pairs one by one.
        while at < d and near.mean() > 0.02:
            to = min(at + STEP, d)
            part += ua[rows, at:to] @ ub[:, at:to].T
            at = to
            near = part + sa[rows, at, None] * sb[None, :, at] >= least - SLACK
        i, j = np.nonzero(near)
        sums, i = part[i, j], i + first
        if same:
            sums, i, j = sums[i < j], i[i < j], j[i < j]
        while at < d and len(i):
            to = min(at + STEP, d)
            sums = sums + np.einsum("ij,ij->i", ua[i, at:to], ub[j, at:to])
            at = to
            left = sums + sa[i, at] * sb[j, at] >= least - SLACK
            sums, i, j = sums[left], i[left], j[left]
        for k in range(0, len(i), 1 << 16):
            p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            cosine = np.einsum("ij,ij->i", ga[p], gb[q]) / (na[p] * nb[q])
            yield p[cosine >= least], q[cosine >= least]


def _compare(axes, least: float):
    def compare(table: pa.Table) -> pa.Table:
        nodes, weights, side = (table.column(c).to_numpy() for c in ("node", "n", "side"))
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(two)
        a = _unit(table.take(pa.array(one)), axes)
        b = a if same else _unit(table.take(pa.array(two)), axes)
        at_b = one if same else two
        links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for i, j in pairs_within(a, b, least, same):
            p, q = one[i], at_b[j]
            np.add.at(links, p, weights[q])
            np.add.at(links, q, weights[p])
            label = joined(label, p, q)
        tied = links > 0
        return pa.table([pa.array(nodes[tied]), pa.array(nodes[label[tied]]), pa.array(links[tied])], ["node", "to", "links"])

    return compare


def near_duplicates(embeddings: DataFrame, least: float = 0.93, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept, n_copies): vectors of one label linked by cosine >= ``least``.

    Equal vectors of a label are one node that counts for all its copies. A label's nodes
    are dealt into tiles by their place along the first principal axis, and two tiles meet
    in a task unless their ranges on that axis are too far apart for any link; each tile
    emits link counts and a forest, never pairs.

    A vector links with nothing if it or its label is null, if it is zero, or if a component
    is null or not finite; vectors of unequal lengths do not link. A null vec_id can be
    linked but names no component, and is not ``kept`` unless it stands alone. Rows that
    repeat are copies of each other. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "embeddings")
    v = F.col("embedding").cast("array<double>")
    sound = F.coalesce(
        F.col("label").isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("e"), sound.alias("sound"), v.alias("v"))
    rows = rows.select("vec_id", "label", "sound", "v", F.xxhash64("label", "v").alias("h1"), F.hash("v", "label").alias("h2"))
    classes = rows.where("sound").groupBy("h1", "h2").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    node = F.coalesce("least_id", -F.abs(F.col("h1") / 2).cast("long") - 1)
    classes = scratch.keep(classes.withColumn("node", node), "classes")
    axes = rotations(classes)
    shared = spark.sparkContext.broadcast(axes)

    def lead(batches):
        """Place of each unit vector along the first axis."""
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for k, x in enumerate(batch.column(3).to_pylist()):
                x = scaled(np.array([x]))[0]
                axis = shared.value[len(x)][:, 0] if len(x) in shared.value else np.eye(1, len(x))[0]
                out[k] = x @ axis / np.linalg.norm(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], ["node", "n", "label", "v", "place"])

    placed = classes.select("node", "n", "label", "v").mapInArrow(lead, "node long, n long, label string, v array<double>, place double")
    # Tiles of about equal size: fine cells along the axis, cut by hash where one is full.
    # The unit chord of a link is at most sqrt(2 - 2 * least), and so is its length on the axis.
    cell = F.floor(F.col("place") * 64).cast("int")
    placed = scratch.keep(placed.select("*", F.size("v").alias("d"), cell.alias("cell")), "placed")
    cells = placed.groupBy("label", "d", "cell").agg(F.count("*").alias("c"))
    lines = cells.groupBy("label", "d").agg(F.sum("c").alias("all"))
    # A label that fits one tile is one; else cells are joined up to the tile size or cut.
    cells = cells.join(lines, ["label", "d"])
    before = F.sum("c").over(_upto("label", "d"))
    run = F.when(F.col("all") <= tile, F.lit(0)).otherwise(F.floor(F.coalesce(before, F.lit(0)) / tile)).cast("int")
    cells = cells.withColumn("run", run)
    tiles = cells.groupBy("label", "d", "run").agg(F.sum("c").alias("c"), F.min("cell").alias("low"), F.max("cell").alias("high"))
    tiles = scratch.keep(tiles.withColumn("cuts", F.ceil(F.col("c") / (2 * tile)).cast("int")), "tiles")
    reach = int(np.ceil(np.sqrt(max(0.0, 2 - 2 * least)) * 64)) + 1

    mine = placed.join(cells.select("label", "d", "cell", "run"), ["label", "d", "cell"]).join(tiles, ["label", "d", "run"])
    mine = mine.withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    others = tiles.select("label", "d", F.col("run").alias("o_run"), F.col("low").alias("o_low"), F.col("high").alias("o_high"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("o_cut"))
    met = mine.join(others, ["label", "d"]).where((F.col("low") - F.col("o_high") <= reach) & (F.col("o_low") - F.col("high") <= reach))
    me, you = F.struct(F.col("run").alias("r"), F.col("cut").alias("c")), F.struct(F.col("o_run").alias("r"), F.col("o_cut").alias("c"))
    task = F.struct("label", "d", F.least(me, you).alias("one"), F.greatest(me, you).alias("two"))
    met = met.select(task.alias("task"), F.when(me <= you, 0).otherwise(1).alias("side"), "node", "n", "v")
    compared = scratch.keep(met.groupBy("task").applyInArrow(_compare(shared.value, least), "node long, to long, links long"), "compared")

    roots = components(compared.select(F.col("node").alias("a"), F.col("to").alias("b")), scratch, "linked")
    counts = compared.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("h1", "h2", "node", "n", "least_id").join(counts, "node", "left").join(scratch.keep(roots, "roots"), "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least_id").alias("component"))
    named = scratch.keep(named.join(names, "root").select("h1", "h2", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component"), "named")
    sound_rows = rows.where("sound").select("vec_id", "h1", "h2").join(named, ["h1", "h2"])
    sound_rows = sound_rows.select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"), F.col("n").alias("n_copies"))
    lone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0)
    return sound_rows.unionByName(lone).select("vec_id", "n_links", "component_id", kept.alias("kept"), "n_copies")


def _upto(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
