"""Mixing sources to target weights by a hypergeometric splitting tree."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_REPEATS = 2

# Output shards (a power of two), and hexadecimal digits of a document's hash that tell its
# block: a source has up to 65,536. The sampler of the quotas wants fewer than a billion
# blocks in all, so at most 7,600 sources that are all taken twice.
SHARDS = 64
BLOCK_DIGITS = 4
SEED = 20_241


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """``sizes`` (source, source_size, a row per source) with its ``target``.

    Sources in order of code points, null last, weigh ``weights`` in turn and share
    ``budget`` times all words. A target stops at ``repeats`` times its source, and what
    is left over is shared by weight again: the result is a water level, found from the
    sources in order of the level at which each is full.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    listed = F.array(*map(F.lit, weights))
    filled = sizes.withColumn(
        "weight", F.element_at(listed, (place - 1) % len(weights) + 1)
    ).withColumn("most", F.col("source_size") * repeats)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) * budget - F.coalesce(
        F.sum("most").over(before), F.lit(0)
    )
    share = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0)
    )
    level = filled.withColumn("level", rest / share)
    open_level = F.when(F.col("most") / F.col("weight") > F.col("level"), F.col("level"))
    # Once a source is not full, the level stays the same for all that follow it.
    water = F.first(open_level, ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.coalesce(
        F.least(F.col("most").cast("double"), water * F.col("weight")),
        F.col("most").cast("double"),
    )
    return level.withColumn("target", target).drop("weight", "most", "level")


def _halved(seed: int, level: int):
    """Splits the quotas of one node of the tree between its two children."""

    def split(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("of", ignore_index=True)
        quota = node["quota"].to_numpy(np.int64)
        number = int(node["node"].iloc[0])
        draw = np.random.default_rng([seed, level, number])
        left = draw.multivariate_hypergeometric(quota, quota.sum() // 2)
        parts = [(2 * number, left), (2 * number + 1, quota - left)]
        return pd.concat(
            [node[["of"]].assign(node=n, quota=q) for n, q in parts],
            ignore_index=True,
        )

    return split


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(of, ends): the running block quotas of the shards, in order, per source.

    The root of the tree holds every source's blocks. Each node draws, without putting
    back, which half of its blocks go to its left child (multivariate hypergeometric,
    seeded by the node), so quotas are exact at every level and shards equally large.
    """
    tree = quotas.select("of", F.lit(0).cast("long").alias("node"), "quota")
    for level in range(shards.bit_length() - 1):
        tree = tree.groupBy("node").applyInPandas(
            _halved(seed, level), "of string, node long, quota long"
        )
    by_shard = F.array_sort(F.collect_list(F.struct("node", "quota")))
    ends = F.transform(
        F.sequence(F.lit(1), F.size("shards")),
        lambda k: F.aggregate(
            F.slice("shards", F.lit(1), k),
            F.lit(0).cast("long"),
            lambda total, shard: total + shard["quota"],
        ),
    )
    return (
        tree.groupBy("of")
        .agg(by_shard.alias("shards"))
        .select("of", ends.alias("ends"))
    )


def blocks_drawn(
    rows: DataFrame,
    weights: Sequence[int],
    budget: float,
    repeats: int,
    shards: int,
    seed: int,
) -> DataFrame:
    """A row for each block (of, block): its source's sizes, and its draws.

    ``rows`` has of, source, block and size. In every pass a source's blocks are drawn in
    an order of their own (MD5 of block, pass, seed and source) without putting back,
    until the words drawn reach the source's target. ``draws`` has pass, begins (the words
    drawn before the block, in earlier passes too) and shard. The number of blocks drawn
    is the source's quota; the tree deals it to the shards, and consecutive draws go to
    the shards in turn, so shards hold disjoint sets of blocks of a pass.
    """
    blocks = rows.groupBy("of", "block").agg(
        F.first("source").alias("source"), F.sum("size").alias("words_in")
    )
    sizes = blocks.groupBy("of").agg(
        F.first("source").alias("source"),
        F.sum("words_in").alias("source_size"),
        F.count(F.lit(1)).alias("n_blocks"),
    )
    targets = source_targets(sizes, weights, budget, repeats)
    targets = targets.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    drawn = blocks.drop("source").join(targets.drop("source"), "of")
    draws = []
    for k in range(repeats):
        key = F.md5(F.concat_ws("/", "block", F.lit(str(k)), F.lit(str(seed)), "of"))
        order = Window.partitionBy("of").orderBy(key, "block")
        before = F.sum("words_in").over(order.rowsBetween(Window.unboundedPreceding, -1))
        draws.append(
            F.struct(
                F.lit(k).alias("pass"),
                (F.coalesce(before, F.lit(0)) + F.col("source_size") * k).alias("begins"),
                (F.row_number().over(order) - 1 + F.col("n_blocks") * k).alias("draw"),
            )
        )
    drawn = drawn.withColumn("draws", F.array(*draws)).withColumn(
        "draws", F.filter("draws", lambda d: d["begins"] < F.col("words"))
    )
    drawn = stored(drawn, "mix-blocks")
    quotas = drawn.groupBy("of").agg(F.sum(F.size("draws")).cast("long").alias("quota"))
    dealt = F.transform(
        "draws",
        lambda d: F.struct(
            d["pass"].alias("pass"),
            d["begins"].alias("begins"),
            F.size(F.filter("ends", lambda end: end <= d["draw"])).alias("shard"),
        ),
    )
    return drawn.join(shard_quotas(quotas, shards, seed), "of").select(
        "of", "block", "source_size", "target", "words", dealt.alias("draws")
    )


def plan(
    docs: DataFrame,
    *carried: str,
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = MOST_REPEATS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc, size, source_size, target, pieces), a row for each row of ``docs``.

    ``doc`` is a struct of the ``carried`` columns. A document's block, of its source, is
    told by a hash of its doc_id and text. The blocks that the shards draw decide what the
    mix takes: all documents of a drawn block, of the block in which the source's target
    (rounded) is reached those that stand before it, in order of their hashes, and of the
    last of these its first words. ``pieces`` tells what is taken of a document: pass,
    shard, order in the shard and number of words. All draws are seeded: another seed
    takes other documents, and reruns agree.

    A null text has no words and is never taken, nor is a blank one. Documents without a
    source are a source of their own. Rows alike in doc_id, source and text are
    interchangeable. An empty table gives an empty result. No task gathers a source:
    windows are over a source's blocks, a bounded number, and a block's documents.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in carried)).alias("doc"),
        F.col("source"),
        # Never null, so that plain joins find it.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("of"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat(name, F.lit("/"), text).cast("binary")).alias("turn"),
    ).withColumn("block", F.substring("turn", 1, BLOCK_DIGITS))
    drawn = blocks_drawn(rows, weights, budget, repeats, shards, seed)
    order = Window.partitionBy("of", "block").orderBy("turn", "size")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # The only shuffle of the documents serves both the window and the join.
    placed = (
        rows.drop("source")
        .withColumn("within", F.coalesce(before, F.lit(0)))
        # Tells rows that repeat apart, so that they are not all put in one place.
        .withColumn("nth", F.row_number().over(order))
        .join(drawn, ["of", "block"])
    )
    pieces = F.transform(
        "draws",
        lambda d: F.struct(
            d["pass"].alias("pass"),
            d["shard"].alias("shard"),
            F.xxhash64("turn", "nth", d["pass"], F.lit(seed)).alias("order"),
            F.least(F.col("size"), F.col("words") - d["begins"] - F.col("within")).alias("words"),
        ),
    )
    pieces = F.filter(pieces, lambda p: p["words"] > 0)
    return placed.select("doc", "size", "source_size", "target", pieces.alias("pieces"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents in the columns of ``docs``, each as often as it is taken, in
    mixed order: shard by shard, and shuffled within each.

    The order is that of the result's partitions and of the rows within them, which a
    write keeps in the names of its files. Documents are whole: one that the end of its
    source's target cuts is taken if that is nearer to the target than leaving it out.
    Documents without a word are not in the mix; for nulls, repeated rows and empty
    tables see ``plan``. ``mixed_shards`` has the shards.
    """
    taken, columns = _taken(docs, settings)
    order = ["piece.shard", "piece.order"]
    return (
        taken.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    )


def mixed_shards(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as mixed, with ``mix_shard`` and ``mix_order``, its order in the shard,
    in place of columns of these names; see ``mix`` for what is taken."""
    taken, columns = _taken(docs.drop("mix_shard", "mix_order"), settings)
    return taken.select(
        *columns,
        F.col("piece.shard").alias("mix_shard"),
        F.col("piece.order").alias("mix_order"),
    )


def _taken(docs: DataFrame, settings: dict) -> tuple[DataFrame, list[Column]]:
    """A row for each document that is taken, and the columns of ``docs`` in terms of it."""
    taken = plan(docs, *docs.columns, **settings).select(
        "doc", "size", F.explode("pieces").alias("piece")
    ).filter(F.col("piece.words") * 2 >= F.col("size"))
    return taken, [F.col(f"doc.`{name}`").alias(name) for name in docs.columns]


def write_shards(docs: DataFrame, path: str, **settings) -> None:
    """The mix as Parquet, a folder for each shard, rows in their shuffled order.

    A shard's files are in the order of their names. An empty mix writes no folder; for
    what is taken see ``mix``.
    """
    (
        mixed_shards(docs, **settings)
        .repartitionByRange("mix_shard", "mix_order")
        .sortWithinPartitions("mix_shard", "mix_order")
        .write.partitionBy("mix_shard")
        .parquet(path)
    )
