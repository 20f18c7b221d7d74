"""A Bloom filter of a table's keys, to drop rows before they are shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blocks of 256 bits, one of four words of 64 each; a broadcast row for each block at most,
# which bounds the filter to about 10 MB whatever the number of keys.
BLOCKS = 131_072
WORDS = 4


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS)).cast("int")


def _bits(key: Column) -> list[Column]:
    """A bit of each word of the key's block."""
    spread = F.xxhash64(F.lit("bits"), key)
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.pmod(F.shiftright(spread, 6 * k), F.lit(64)).cast("int"),
        )
        for k in range(WORDS)
    ]


def bloom_filter(keys: DataFrame, key: str) -> DataFrame:
    """(block, word_0, ...): the bits of every key, at most ``BLOCKS`` rows."""
    words = [bits.alias(f"word_{k}") for k, bits in enumerate(_bits(F.col(key)))]
    return (
        keys.filter(F.col(key).isNotNull())
        .select(_block(F.col(key)).alias("block"), *words)
        .groupBy("block")
        .agg(*(F.bit_or(f"word_{k}").alias(f"word_{k}") for k in range(WORDS)))
    )


def possibly_in(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` less most of those whose ``column`` is no ``key`` of ``keys``.

    Every row that has a partner stays, and a few others: a join has to follow. More
    keys than the filter was made for let more of the others through.
    """
    held = [
        (F.col(f"word_{k}").bitwiseAND(bits)) == bits
        for k, bits in enumerate(_bits(F.col(column)))
    ]
    here = F.col("block") == _block(F.col(column))
    same = reduce(lambda a, b: a & b, held, here)
    return rows.join(F.broadcast(bloom_filter(keys, key)), same, "left_semi")
