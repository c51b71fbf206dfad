"""Figures over the whole fact kept as mergeable states, one small set of rows per load.

Sums, counts and extremes add up. Distinct symbols and days are exact bitmaps, over numbers that a symbol gets when it is first
seen and over days since 1970: the bitmaps of all loads are or-ed, which counts a symbol of several loads once. A load reads
its own rows; the figures read the states; nothing is expanded per distinct column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_symbols(known: DataFrame | None, trades: DataFrame) -> DataFrame:
    """symbol, id: the known numbers, and the next free ones for new symbols (in symbol order; symbols are a dimension)."""
    seen = trades.select("symbol").filter(F.col("symbol").isNotNull()).distinct()
    if known is None:
        return seen.withColumn("id", F.row_number().over(Window.orderBy("symbol")).cast("long"))
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first().m
    new = seen.join(known, "symbol", "left_anti").withColumn("id", F.row_number().over(Window.orderBy("symbol")).cast("long") + last)
    return known.unionByName(new)


def load_state(trades: DataFrame, numbers: DataFrame) -> DataFrame:
    """The state of some trades: a row per date and 32,768 symbol numbers."""
    return trades.join(numbers, "symbol", "left").groupBy("trade_date", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ingested_at").alias("first_ingested"), F.max("ingested_at").alias("last_ingested"),
        F.sum("notional").alias("notional"), F.count("notional").alias("n_notional"),
        F.count_if(F.col("exchange") == "UNKNOWN").alias("unknown"),
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("symbols"))


def pipeline_stats_from_states(states: DataFrame) -> DataFrame:
    """``pipeline_stats`` from the states of all loads: their rows, plus a row per bitmap for the distinct counts."""
    day = F.unix_date("trade_date").cast("long")
    days = states.filter(F.col("trade_date").isNotNull()).groupBy(F.bitmap_bucket_number(day).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("bits")).select(F.bitmap_count("bits").alias("days"))
    symbols = states.groupBy("bucket").agg(F.bitmap_or_agg("symbols").alias("bits")).select(F.bitmap_count("bits").alias("symbols"))
    rows = (states.drop("symbols", "bucket", "trade_date").unionByName(days, allowMissingColumns=True)
                  .unionByName(symbols, allowMissingColumns=True))
    zero = F.lit(0).cast("long")
    return rows.agg(
        F.coalesce(F.sum("n"), zero).alias("total_trades"), F.coalesce(F.sum("days"), zero).alias("trading_days"),
        F.coalesce(F.sum("symbols"), zero).alias("symbols"), F.min("first_ingested").alias("first_ingested"),
        F.max("last_ingested").alias("last_ingested"), F.round(F.sum("notional"), 2).alias("total_notional"),
        F.round(F.sum("notional") / F.sum("n_notional"), 2).alias("avg_notional"), F.coalesce(F.sum("unknown"), zero).alias("null_exchange_count"))
