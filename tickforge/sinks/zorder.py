"""Tables in Z-order: rows near in several columns lie near in the files, so a filter on any of them skips most row groups.

Each column is cut into 256 ranges of about equal numbers of rows (approximate quantiles, one pass), so outliers and skewed
columns don't coarsen the rest; the ranges' eight bits are interleaved. Files are ranges of the interleaved number, and a
number that holds many rows (a hot symbol's hour) is split over files by a hash of the row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import conf_override

BITS = 8
#: Accuracy of the quantiles: a range may be off by this share of the rows.
ACCURACY = 2000
#: Bytes of a text that tell its place in the order.
PREFIX = 6


def _number(df: DataFrame, column: str) -> Column:
    """A double in the column's order: of texts, their first bytes."""
    kind = dict(df.dtypes)[column]
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, PREFIX)), 2 * PREFIX, "0"), 16, 10).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    return F.col(column).cast("double")


def _place(number: Column, bounds: list[float]) -> Column:
    """How many bounds the number reaches: a search by halves. Nulls come first."""
    steps, list_of = (F.array(*[F.lit(v) for v in values]) for values in (
        [1 << b for b in reversed(range(BITS))], [float(b) for b in bounds]))
    reached = F.aggregate(steps, F.lit(0), lambda at, step: F.when(number >= F.get(list_of, at + step - 1), at + step).otherwise(at))
    return F.when(number.isNull(), F.lit(0)).otherwise(reached)


def with_z(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``_z``, the interleaved ranges of up to seven columns, a long."""
    shares = [(i + 1) / (1 << BITS) for i in range((1 << BITS) - 1)]
    cuts = df.select(*[_number(df, c).alias(c) for c in columns]).agg(
        *[F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns]).first()
    known = [c for c in columns if cuts[c] is not None]
    # Each place is a column of its own before its bits are taken, so that it is worked out once.
    placed = df.withColumns({f"_place{j}": _place(_number(df, c), cuts[c]) for j, c in enumerate(known)})
    z = F.lit(0).cast("long")
    for j in range(len(known)):
        for b in range(BITS):
            z = z + F.shiftleft(F.shiftright(f"_place{j}", b).bitwiseAND(F.lit(1)).cast("long"), b * len(known) + j)
    return placed.withColumn("_z", z).drop(*[f"_place{j}" for j in range(len(known))])


def write_zordered(df: DataFrame, path: str, columns: list[str], rows_per_file: int = 5_000_000, mode: str = "errorifexists") -> None:
    """``df`` as parquet files of about ``rows_per_file`` rows, in Z-order of the columns."""
    files = max(1, math.ceil(df.count() / rows_per_file))
    placed = with_z(df, columns).withColumn("_tie", F.xxhash64(*df.columns))
    # Times as 64-bit integers: the older 96-bit form has no extremes to skip by.
    with conf_override(df.sparkSession, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}):
        (placed.repartitionByRange(files, "_z", "_tie").sortWithinPartitions("_z", *columns).drop("_z", "_tie")
               .write.mode(mode).parquet(path))
