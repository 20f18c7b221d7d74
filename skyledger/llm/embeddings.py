"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import components, stored
from skyledger.llm.simhash import forest

LEAST_COSINE = 0.9

# Subspaces, and the seed of the rotation before they are cut out.
BLOCKS = 4
SEED = 7

# Members of a cell, vectors of the sample that chooses the cells of a block, and most
# cuts on the way to one. The sample only places cells; every vector is in one of each
# block, and a cell that outgrows its share is dealt into several.
CELL_MEMBERS = 16_384
SAMPLE = 4_096
MOST_CUTS = 9

# Sides of the tiles in which two cells meet, and pairs verified together.
TILE = (1024, 4096)
PAIRS_AT_ONCE = 50_000

# Slack for single precision when candidates are chosen, none is lost to rounding.
SLACK = 1e-5


def rotation(size: int) -> np.ndarray:
    turned, upper = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return turned * np.sign(np.diag(upper))


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


@dataclass
class Cells:
    """Cells of each block: cuts in the order of a heap, and which cells may meet."""

    size: int
    cuts: list[np.ndarray]
    depth: int
    shares: list[np.ndarray] | None = None
    meets: list[list[np.ndarray]] | None = None

    def blocks(self) -> list[slice]:
        edges = np.linspace(0, self.size, min(BLOCKS, self.size) + 1).astype(int)
        return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]

    def budgets(self) -> list[float]:
        """Of the squared distance at the least cosine, each block's share by its size."""
        whole = 2 - 2 * LEAST_COSINE
        return [whole * (b.stop - b.start) / self.size + 1e-9 for b in self.blocks()]

    def leaf(self, block: int, values: np.ndarray) -> np.ndarray:
        at = np.zeros(len(values), np.int64)
        cuts = self.cuts[block]
        for _ in range(self.depth):
            axis, cut = cuts[at, 0].astype(np.int64), cuts[at, 1]
            at = 2 * at + 1 + (values[np.arange(len(values)), axis] > cut)
        return at - (2**self.depth - 1)


def _placed(sample: np.ndarray, members: int) -> Cells:
    """Cells for ``members`` vectors: cuts at medians of the sample's widest axes."""
    size = sample.shape[1]
    depth = min(MOST_CUTS, max(0, int(np.ceil(np.log2(max(1, members) / CELL_MEMBERS)))))
    cells = Cells(size, [], depth)
    turned = _unit(sample) @ rotation(size)
    for block in cells.blocks():
        values = turned[:, block]
        cuts = np.zeros((2**depth - 1, 2))
        parts = {0: values}
        for at in range(len(cuts)):
            part = parts.pop(at)
            axis = int(part.var(axis=0).argmax()) if len(part) > 1 else 0
            cut = float(np.median(part[:, axis])) if len(part) else 0.0
            cuts[at] = axis, cut
            above = part[:, axis] > cut
            parts[2 * at + 1], parts[2 * at + 2] = part[~above], part[above]
        cells.cuts.append(cuts)
    return cells


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _box_rows(cells: Cells):
    """Members and extent of each cell, as far as a batch tells."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = _unit(_matrix(batch.column("embedding"))) @ rotation(cells.size)
            for block, part in enumerate(cells.blocks()):
                leaf = cells.leaf(block, turned[:, part])
                for one in np.unique(leaf):
                    own = turned[leaf == one, part]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": pa.array([block] * own.shape[1], pa.int32()),
                            "leaf": pa.array([one] * own.shape[1], pa.int64()),
                            "axis": pa.array(range(own.shape[1]), pa.int32()),
                            "n": pa.array([len(own)] * own.shape[1], pa.int64()),
                            "low": own.min(axis=0),
                            "high": own.max(axis=0),
                        }
                    )

    return rows


def _meeting(cells: Cells, boxes: list) -> Cells:
    """Adds shares and the pairs of cells whose boxes are within the block's budget."""
    leaves = 2**cells.depth
    cells.shares, cells.meets = [], []
    for block, (part, budget) in enumerate(zip(cells.blocks(), cells.budgets())):
        width = part.stop - part.start
        low = np.full((leaves, width), np.inf)
        high = np.full((leaves, width), -np.inf)
        members = np.zeros(leaves, np.int64)
        for row in boxes:
            if row["block"] == block:
                low[row["leaf"], row["axis"]] = row["low"]
                high[row["leaf"], row["axis"]] = row["high"]
                members[row["leaf"]] = row["n"]
        shares = -(-members // CELL_MEMBERS)
        cells.shares.append(shares)
        meets = []
        for leaf in range(leaves):
            gap = np.maximum(0, np.maximum(low - high[leaf], low[leaf] - high))
            near = (np.where(np.isfinite(gap), gap, 9.0) ** 2).sum(axis=1) <= budget + SLACK
            meets.append(np.flatnonzero(near & (members > 0)))
        cells.meets.append(meets)
    return cells


def _unit_rows(cells: Cells):
    """Each vector once for every unit, a pair of cells of one block that may meet."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [np.concatenate([[0], np.cumsum(s)]) for s in cells.shares]
        # Cells of a block are numbered through; partners of a leaf as cell numbers.
        partners = [
            [
                np.concatenate([np.arange(first[j], first[j + 1]) for j in meet])
                if len(meet)
                else np.zeros(0, np.int64)
                for meet in cells.meets[block]
            ]
            for block, first in enumerate(firsts)
        ]
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                turned = _unit(_matrix(batch.column("embedding"))) @ rotation(cells.size)
                share = batch.column("share").to_numpy()
                for block, part in enumerate(cells.blocks()):
                    leaf = cells.leaf(block, turned[:, part])
                    own = firsts[block][leaf] + share % np.maximum(1, cells.shares[block][leaf])
                    count = np.array([len(partners[block][k]) for k in leaf])
                    row = np.repeat(np.arange(len(leaf)), count)
                    other = np.concatenate([partners[block][k] for k in leaf])
                    mine = own[row]
                    low, high = np.minimum(mine, other), np.maximum(mine, other)
                    taken = batch.select(["node", "n", "embedding"]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((block << 60) | (low << 30) | high),
                            pa.array(
                                np.where(mine == other, 0, np.where(mine == low, 1, 2)),
                                pa.int32(),
                            ),
                            *taken.columns,
                        ],
                        names=["unit", "side", "node", "n", "embedding"],
                    )

    return rows


def _tile_pairs(one: np.ndarray, two: np.ndarray, budget: float) -> tuple[np.ndarray, ...]:
    """Index pairs whose squared distance in a block may be within its budget."""
    a, b = one.astype(np.float32), two.astype(np.float32)
    half = np.float32(0.5)
    a = np.column_stack([a, np.ones(len(a), np.float32), -half * (a * a).sum(1)])
    b = np.column_stack([b, -half * (b * b).sum(1), np.ones(len(b), np.float32)])
    return np.nonzero(a @ b.T >= np.float32(-(budget + SLACK) / 2))


def _met(cells: Cells):
    """Links of one unit: how many each vector has, and some that span them."""

    def rows(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        unit = table.column("unit")[0].as_py()
        block = unit >> 60
        node = table.column("node").to_numpy()
        copies = table.column("n").to_numpy()
        side = table.column("side").to_numpy()
        unit_vectors = _unit(_matrix(table.column("embedding").combine_chunks()))
        turned = unit_vectors @ rotation(cells.size)
        parts, budgets = cells.blocks(), cells.budgets()
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        alone = bool((side == 0).all())
        links = np.zeros(len(node), np.int64)
        label = np.arange(len(node))
        for p in range(0, len(left), TILE[0]):
            for q in range(0, len(right), TILE[1]):
                i, j = left[p : p + TILE[0]], right[q : q + TILE[1]]
                if alone and i[0] > j[-1]:
                    continue
                own = parts[block]
                a, b = _tile_pairs(turned[i][:, own], turned[j][:, own], budgets[block])
                i, j = i[a], j[b]
                if alone:
                    once = i < j
                    i, j = i[once], j[once]
                for k in range(0, len(i), PAIRS_AT_ONCE):
                    x, y = i[k : k + PAIRS_AT_ONCE], j[k : k + PAIRS_AT_ONCE]
                    apart = (turned[x] - turned[y]) ** 2
                    within = np.column_stack(
                        [apart[:, s].sum(axis=1) <= t for s, t in zip(parts, budgets)]
                    )
                    # A pair is found by the first block that admits it, once.
                    found = within.any(axis=1) & (within.argmax(axis=1) == block)
                    cosine = (unit_vectors[x] * unit_vectors[y]).sum(axis=1)
                    found &= cosine >= LEAST_COSINE
                    x, y = x[found], y[found]
                    np.add.at(links, x, copies[y])
                    np.add.at(links, y, copies[x])
                    tree = np.flatnonzero(label != np.arange(len(label)))
                    label = forest(
                        len(label), np.append(x, label[tree]), np.append(y, tree)
                    )
        some = np.flatnonzero(links)
        tree = np.flatnonzero(label != np.arange(len(label)))
        return pa.table(
            {
                "a": np.append(node[some], node[label[tree]]),
                "b": np.append(node[some], node[tree]),
                "links": np.append(links[some], np.zeros(len(tree), np.int64)),
            }
        )

    return rows


def _linked(classes: DataFrame, size: int) -> DataFrame | None:
    """(a, b, links) of the distinct vectors of one size: counts where a is b, else a
    link of a spanning forest."""
    own = classes.filter(F.size("embedding") == size)
    members = own.count()
    sample = own.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding")
    sample = _matrix(sample.toArrow().column("embedding").combine_chunks())
    cells = _placed(sample, members)
    boxes = (
        own.select("embedding")
        .mapInArrow(
            _box_rows(cells),
            "block int, leaf long, axis int, n long, low double, high double",
        )
        .groupBy("block", "leaf", "axis")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    cells = _meeting(cells, boxes)
    vector = classes.schema["embedding"].dataType.simpleString()
    unit = f"unit long, side int, node long, n long, embedding {vector}"
    share = F.shiftrightunsigned(F.xxhash64("node", F.lit("share")), 1)
    return (
        own.select("node", "n", "embedding", share.alias("share"))
        .mapInArrow(_unit_rows(cells), unit)
        .groupBy("unit")
        .applyInArrow(_met(cells), "a long, b long, links long")
    )


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors``.

    Two vectors link at a cosine of ``LEAST_COSINE`` and more, in double precision;
    components are taken as they are, floats or doubles.
    Unit vectors are rotated and cut into ``BLOCKS`` subspaces; a pair within the
    squared distance of that cosine is, in some block, within the block's proportional
    share. Each block is therefore joined by itself: its cells meet where their boxes
    come within the share, candidates are the pairs within it there, and each is
    verified in full. No link is missed. How many cells meet depends on how far the
    vectors spread in a block; for vectors without any structure most do.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable, ``kept`` tells that it is the row's own. Equal vectors count as
    linked and are compared as one. Vectors of different sizes never link, nor do null,
    empty or zero ones or those with null or non-finite components, nor rows without a
    vec_id; all of them are returned with no links. An empty table gives an empty
    result; other columns are ignored.
    """
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall(
            "embedding",
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
        )
        & F.exists("embedding", lambda x: x != 0)
    )
    single = vectors.schema["embedding"].dataType.elementType == T.FloatType()
    values = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = stored(
        vectors.select(
            "vec_id",
            F.when(usable, F.xxhash64(values)).alias("first"),
            F.when(usable, F.xxhash64(F.lit("second"), values)).alias("second"),
            F.when(usable, values).alias("embedding"),
        ),
        "vectors",
    )
    classes = stored(
        rows.filter(F.col("first").isNotNull())
        .groupBy("first", "second")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.count(F.lit(1)).alias("n"),
            F.min("embedding").alias("embedding"),
        )
        .withColumn("node", F.xxhash64("first", "second")),
        "distinct-vectors",
    )
    sizes = [
        row[0] for row in classes.select(F.size("embedding")).distinct().collect()
    ]
    found = None
    for size in sorted(sizes):
        links = _linked(classes, size)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return vectors.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    found = stored(found, "vector-links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    labels = components(found.filter(F.col("a") != F.col("b")).select("a", "b"))
    rooted = classes.drop("embedding").join(
        labels.withColumnRenamed("id", "node"), "node", "left"
    )
    roots = (
        rooted.filter(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min("first_id").alias("root_id"))
    )
    per_class = (
        rooted.join(roots, "component", "left")
        .join(counts, "node", "left")
        .select(
            "first",
            "second",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root_id", "first_id").alias("root_id"),
        )
    )
    component = F.coalesce("root_id", "vec_id")
    return (
        rows.drop("embedding")
        .join(per_class, ["first", "second"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
        )
    )
