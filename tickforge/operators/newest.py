"""The newest trades of a stored fact, read from as few of its date partitions as hold them.

The trade date is the UTC date of the trade's time, so every trade of a later date is newer than every one of an earlier date:
dates are counted from the newest on, in steps that double, until they hold as many rows as are asked for. No earlier
partition's newest instant can enter then, and the top-k reads the chosen ones alone. Trades without a date come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import _fs
from .reports import recent_trades

NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def stored_dates(spark: SparkSession, path: str) -> list[str | None]:
    """The table's trade dates by its folders, newest first, None (no date) last: no file is opened."""
    fs, folder = _fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    values = [n.split("=", 1)[1] for n in names if n.startswith("trade_date=")]
    dates: list[str | None] = sorted((v for v in values if v != NO_DATE), reverse=True)
    return dates + [None] * (NO_DATE in values)


def _among(dates: list[str | None]) -> Column:
    days = F.col("trade_date").isin([F.lit(d).cast("date") for d in dates if d is not None])
    return days | F.col("trade_date").isNull() if None in dates else days


def recent_trades_stored(spark: SparkSession, path: str, limit: int = 50, symbol: str | None = None, schema=None) -> DataFrame:
    """``recent_trades`` over a fact stored by trade_date (optionally of one symbol)."""
    fact = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    wanted = fact if not symbol or symbol == "All" else fact.filter(F.col("symbol") == symbol)
    left, chosen, step, held = stored_dates(spark, path), [], 1, 0
    while left and held < limit:
        now, left = left[:step], left[step:]
        held += wanted.filter(_among(now)).limit(limit).count()
        chosen, step = chosen + now, 2 * step
    return recent_trades(fact.filter(_among(chosen)) if chosen else fact.limit(0), symbol, limit)
