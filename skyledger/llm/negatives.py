"""Hard-negative mining: scores in a secondary-sort shuffle, streamed by anchor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

POSITIVES = 5
NEGATIVES = 3

# A negative's score is between these hundredths of its positive's.
LOWEST, HIGHEST = 50, 95

# Components are multiplied by this and rounded down, so that scores are integers.
SCALE = 256

# Sides of the tiles in which anchors meet rows.
TILE_ROWS = 1_024
TILE_ANCHORS = 4_096
ANCHORS_AT_ONCE = 512

# Integers up to here are exact as doubles; scores beyond 64 bits stop at the ends.
EXACT = 2**53
END = 2**63 - 1

ROW = "vec_id long, row long, label long, vector array<double>"
FOUND = "anchor_id long, anchor_row long, vec_id long, row long, score long"
MINED = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, row, label, vector, dim), distinct, of the rows that take part."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return (
        rows.select(
            F.col("vec_id").cast("long"),
            F.col("label").cast("long"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .filter(finite)
        .distinct()
        .select(
            "vec_id",
            F.xxhash64("vec_id", "label", "vector").alias("row"),
            "label",
            "vector",
            F.size("vector").alias("dim"),
        )
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * flat), -(2.0**62), 2.0**62)


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, as doubles where these hold them."""
    if not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)))
    most = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0)
    if most * anchors.shape[1] < EXACT:
        return anchors @ rows.T
    whole = [[int(x) for x in row] for row in rows]
    out = np.zeros((len(anchors), len(rows)), np.int64)
    for at, anchor in enumerate(anchors):
        own = [int(x) for x in anchor]
        sums = (sum(x * y for x, y in zip(own, row)) for row in whole)
        out[at] = [min(max(s, -END), END) for s in sums]
    return out


def _first(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Places of the ``most`` highest allowed scores of each row, equal ones in order."""
    low = -np.inf if scores.dtype == np.float64 else -END - 1
    masked = np.where(allowed, scores, low)
    width = masked.shape[1]
    if width > most:
        least = np.partition(masked, width - most, axis=1)[:, width - most]
        allowed = allowed & (masked >= least[:, None])
    anchor, row = np.nonzero(allowed)
    order = np.lexsort((row, -masked[anchor, row], anchor))
    anchor, row = anchor[order], row[order]
    nth = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    return anchor[nth < most], row[nth < most]


def _tile(rows: pa.Table, anchors: pa.Table, choose) -> pa.Table:
    """(anchor, row, score) of the pairs that ``choose`` takes from a tile."""
    rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    ids, own = (rows.column(c).to_numpy() for c in ("vec_id", "row"))
    labels = rows.column("label").to_numpy()
    matrix = _matrix(rows.column("vector"))
    parts = []
    for begin in range(0, anchors.num_rows, ANCHORS_AT_ONCE):
        part = anchors.slice(begin, ANCHORS_AT_ONCE)
        scores = _scores(_matrix(part.column("vector")), matrix)
        a_ids, a_own = (part.column(c).to_numpy() for c in ("vec_id", "row"))
        same = part.column("label").to_numpy()[:, None] == labels
        other = (a_ids[:, None] != ids) | (a_own[:, None] != own)
        anchor, row = choose(part, scores, same, other)
        parts.append(
            pa.table(
                {
                    "anchor_id": pa.array(a_ids[anchor], pa.int64()),
                    "anchor_row": pa.array(a_own[anchor], pa.int64()),
                    "vec_id": pa.array(ids[row], pa.int64()),
                    "row": pa.array(own[row], pa.int64()),
                    "score": pa.array(scores[anchor, row].astype(np.int64), pa.int64()),
                }
            )
        )
    return pa.concat_tables(parts)


def _tile_positives(most: int):
    def choose(part, scores, same, other):
        return _first(scores, same & other, most)

    return lambda rows, anchors: _tile(rows, anchors, choose)


def window(positive_score: int) -> tuple[int, int]:
    """Least and greatest score of a negative, in integers."""
    return -(-LOWEST * positive_score // 100), HIGHEST * positive_score // 100


def _tile_negatives(most: int):
    def choose(part, scores, same, other):
        windows = part.column("windows").to_pylist()
        pairs = []
        for nth in range(max(map(len, windows), default=0)):
            ends = [window(w[nth]) if nth < len(w) else (1, 0) for w in windows]
            low, high = (np.array(side, scores.dtype)[:, None] for side in zip(*ends))
            anchor, row = _first(scores, ~same & (scores >= low) & (scores <= high), most)
            pairs.append(anchor * scores.shape[1] + row)
        found = np.unique(np.concatenate(pairs or [np.zeros(0, np.int64)]).astype(np.int64))
        return np.divmod(found, max(1, scores.shape[1]))

    return lambda rows, anchors: _tile(rows, anchors, choose)


def _tiles(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], function) -> DataFrame:
    """``function`` over every tile of rows and anchors of one length.

    Rows are copied once for each tile of anchors and anchors once for each tile of
    rows, so a task holds one tile of each however many there are.
    """
    rows_in, anchors_in = sizes
    place = F.xxhash64("vec_id", "row")
    row_tile = F.pmod(place, F.lit(rows_in)).alias("row_tile")
    anchor_tile = F.pmod(place, F.lit(anchors_in)).alias("anchor_tile")

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)

    keys = ["dim", "row_tile", "anchor_tile"]
    left = rows.select("*", row_tile, every(anchors_in, "anchor_tile")).groupBy(*keys)
    # Under columns of its own, as both sides come from one table.
    right = anchors.toDF(*anchors.columns).select(
        "*", anchor_tile, every(rows_in, "row_tile")
    )
    right = right.groupBy(*keys)

    def meet(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _NONE
        return function(rows, anchors)

    return left.cogroup(right).applyInArrow(meet, FOUND)


_NONE = pa.table({name: pa.array([], pa.int64()) for name in FOUND.replace(" long", "").split(", ")})


def _streamed(positives: int, negatives: int):
    """Reads (anchor, descending score, positives first, id): a positive opens a window,
    a negative goes to the windows that hold it. Only the windows of one anchor are kept."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, out = None, [], []
        for batch in batches:
            for own in zip(*(batch.column(k).to_pylist() for k in range(6))):
                anchor_id, anchor_row, score, negative, vec_id, _ = own
                if (anchor_id, anchor_row) != anchor:
                    anchor, opened = (anchor_id, anchor_row), []
                if not negative:
                    if len(opened) < positives:
                        opened.append([*window(score), 0, vec_id, score])
                    continue
                for place in opened:
                    if place[0] <= score <= place[1] and place[2] < negatives:
                        place[2] += 1
                        out.append((anchor_id, place[3], place[2], vec_id, place[4], score))
            if out:
                yield _mined(out)
                out = []

    return rows


def _mined(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [field.split()[0] for field in MINED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names
    )


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and embedding; ``is_anchor`` is a condition on vec_id. A
    score is the integer inner product of the components times 256, rounded down. The
    positives of an anchor are its highest-scoring other rows of the same label; for
    each, the result has the first rows of other labels that score between half and 95
    hundredths of it, ranked from 1, equal scores by smaller vec_id.

    Anchors meet all rows in tiles. Of a tile's pairs only those are shuffled that are
    among its anchor's first positives there or, once these are merged, among the first
    negatives in one of the anchor's windows there; no other pair can be in the result.
    They are shuffled by anchor and sorted within partitions by descending score,
    positives first, and id, and one pass over each partition opens and fills windows.

    Rows without vec_id, label or vector, or with a null or non-finite component, take no
    part. Rows alike in all three count once; different rows under one vec_id are rows,
    and anchors, of their own. Vectors of different lengths do not meet. Scores beyond 64
    bits stop at their ends. Anchors without positives, or positives without negatives,
    have no rows, so an empty table gives an empty result.
    """
    rows = stored(usable(rows), "negatives-rows")
    anchors = rows.filter(is_anchor)
    counts = rows.agg(
        F.count(F.lit(1)), F.count_if(is_anchor)
    ).first()
    sizes = tuple(
        max(1, -(-n // tile)) for n, tile in zip(counts, (TILE_ROWS, TILE_ANCHORS))
    )
    found = _tiles(rows, anchors, sizes, _tile_positives(positives))
    anchor = ["anchor_id", "anchor_row"]
    order = Window.partitionBy(*anchor).orderBy(F.col("score").desc(), "vec_id", "row")
    nearest = stored(
        found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives),
        "negatives-positives",
    )
    windows = nearest.groupBy(*anchor).agg(F.collect_list("score").alias("windows"))
    same = (F.col("anchor_id") == F.col("vec_id")) & (F.col("anchor_row") == F.col("row"))
    asking = anchors.join(windows, same).drop(*anchor)
    met = _tiles(rows, asking, sizes, _tile_negatives(negatives))
    key = [*anchor, "score", "negative", "vec_id", "row"]
    stream = nearest.withColumn("negative", F.lit(0)).select(*key).unionByName(
        met.withColumn("negative", F.lit(1)).select(*key)
    )
    return (
        stream.repartition(*anchor)
        .sortWithinPartitions(*anchor, F.col("score").desc(), "negative", "vec_id", "row")
        .mapInArrow(_streamed(positives, negatives), MINED)
    )
