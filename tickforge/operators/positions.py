"""Positions in an order of any size, and pages by them.

Rows are range-partitioned and sorted by the order and written so: a row's place in its partition is known to the task that
sorts it. Only the partitions' counts, one number each, are added up (on the driver) to where each partition begins. Files hold
consecutive positions, so a page reads the files that overlap it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: Bits of monotonically_increasing_id that number a partition's rows.
ROW_BITS = 33


def positioned(df: DataFrame, *order) -> DataFrame:
    """The rows with ``position`` (from 1) in the given order, which must be total for positions to be repeatable."""
    columns = df.columns
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = staged(placed, "positions").withColumn("_part", F.shiftright("_id", ROW_BITS))
    before, begins = 0, []
    for part, n in sorted(tuple(r) for r in placed.groupBy("_part").count().collect()):
        begins.append((part, before))
        before += n
    begin = F.broadcast(df.sparkSession.createDataFrame(begins, "_part long, _before long"))
    row = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(begin, "_part").select(*columns, (F.col("_before") + row + 1).alias("position"))


def page(stored: DataFrame, after: int, size: int) -> DataFrame:
    """The rows after a position, of a result that was stored with its positions."""
    return stored.filter((F.col("position") > after) & (F.col("position") <= after + size))
