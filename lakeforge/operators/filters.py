"""A Bloom filter as a small table: thins out a large side before an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 26  # 8 MB of bits in 2^20 rows: what is broadcast, at most, whatever the input


def bloom(rows: DataFrame, key: Column, bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(filter, bits) of the keys of ``rows``: one row for each 64 slots that some key hits.

    At most 2^(bits - 6) rows of 16 bytes; with fewer keys than that, as many rows as keys.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    words = rows.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word"))
    return words.agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_bits")), bits


def may_hold(df: DataFrame, key: Column, words: DataFrame, bits: int) -> DataFrame:
    """Rows whose key the filter may hold; a row that it drops surely has none of its keys."""
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    hit = (F.shiftright(slot, 6) == F.col("_word")) & (F.getbit("_bits", slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return df.join(F.broadcast(words), hit, "left_semi")
