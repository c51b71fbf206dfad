"""A runtime Bloom filter out of aggregates: rows whose key can't be in a small set leave before anything is shuffled.

The set's keys are hashed to the bits of 64-bit words, one word a row, and the words are broadcast: at most ``MOST_BITS / 64``
rows of two longs (32 MB), however many keys there are. A row looks its word up and tests its bit, inside generated code. Keys
of the set always pass; others pass by chance, so an exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key (a share of about 1/16 of other rows passes), and the most bits there are.
BITS_A_KEY, MOST_BITS = 16, 1 << 27


def bits_for(keys: int) -> int:
    return min(MOST_BITS, 1 << max(6, (max(keys, 1) * BITS_A_KEY - 1).bit_length()))


def _place(columns: list, bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def key_words(keys: DataFrame, columns: list, count: int) -> DataFrame:
    """_word, _mask: the filter of ``keys``, of which there are about ``count``."""
    place = _place(columns, bits_for(count))
    return (keys.select(F.shiftright(place, 6).alias("_word"), F.expr("1L").alias("_one"), place.alias("_place"))
                .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(_one, CAST(_place & 63 AS INT))")).alias("_mask")))


def may_be_in(rows: DataFrame, columns: list, words: DataFrame, count: int) -> DataFrame:
    """The rows that may have one of the keys that ``words`` was made of (with the same ``count``)."""
    place = _place(columns, bits_for(count))
    placed = rows.withColumn("_place", place).withColumn("_word", F.shiftright("_place", 6))
    return (placed.join(F.broadcast(words), "_word").filter(F.expr("getbit(_mask, CAST(_place & 63 AS INT)) = 1"))
                  .drop("_word", "_place", "_mask"))
