"""Staging views and analytics marts over the Gold star schema.

Design notes (scale):
* Aggregate first, join the dimensions after. The marts' group keys contain
  the join keys, so the dimension joins run on one row per (day, symbol) or
  per symbol instead of one per trade.
* Open / close come from the trades at a group's first and last instant alone
  (see ``_open_close``), which a runtime Bloom filter finds before the shuffle,
  so a symbol-day holding a third of all trades sends a few rows. A window
  sorted per (day, symbol) would put that whole group into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import MAJOR_BASES, date_parts, display_name, is_major, price_tier, time_price_key
from ..session import staged
from .membership import key_words, may_be_in


def stg_trades(fact: DataFrame) -> DataFrame:
    """Renames (timestamp -> traded_at, source -> data_source) and price_tier."""
    return fact.select(
        "trade_id", "symbol", "trade_date", "trade_hour",
        F.col("timestamp").alias("traded_at"), "ingested_at",
        "price", "quantity", "notional", "trade_type", "exchange",
        F.col("source").alias("data_source"),
        price_tier("price").alias("price_tier"),
    )


def stg_instruments(dim_instrument: DataFrame, majors: tuple = MAJOR_BASES) -> DataFrame:
    """Active instruments with display_name and is_major_coin."""
    return dim_instrument.filter(F.col("is_active") == F.lit(True)).select(
        "symbol", "base_currency", "quote_currency", "asset_class", "exchange", "is_active",
        display_name().alias("display_name"),
        is_major("base_currency", majors).alias("is_major_coin"),
    )


def _r2(c):
    return F.round(c, 2)


def exact_avg(c: str):
    """sum / count in decimal arithmetic (scale >= 12), not avg()'s scale+4
    result, so the later 2-place rounding is not a double rounding."""
    return F.sum(c) / F.count(c)


def _with_calendar(daily: DataFrame, dim_time: DataFrame | None) -> DataFrame:
    """Attach day_of_week / is_weekend: by joining the time dimension, or,
    when the dimension would be derived from these same trades (dim_time is
    None), by computing the same attributes on the aggregated rows, which
    saves a second pass over the trades."""
    if dim_time is None:
        parts = date_parts("trade_date")
        return daily.withColumns({"day_of_week": parts["day_of_week"], "is_weekend": parts["is_weekend"]})
    days = dim_time.select("trade_date", "day_of_week", "is_weekend")
    return daily.join(days, "trade_date", "inner")


def _open_close(trades: DataFrame, ends: DataFrame, groups: int) -> DataFrame:
    """First and last price of each (day, symbol) in (traded_at, trade_id) order.

    ``ends`` has the first and last instant of each of ``groups`` groups. Trades
    at other instants of their group leave by a runtime Bloom filter over (day,
    symbol, instant) before the join, so only boundary rows (and a few by
    chance) are shuffled, even where the ends are too many to broadcast. Ties
    are broken by the trade id, whose text keys need a sort aggregate; it sorts
    a row or two per group and task.
    """
    instants = ends.select("trade_date", "symbol", F.explode(F.array("_lo", "_hi")).alias("traded_at"))
    key = ["trade_date", "symbol", "traded_at"]
    near = may_be_in(trades.select(*key, "trade_id", "price"), key, key_words(instants, key, 2 * groups), 2 * groups)
    at = near.join(ends.select("trade_date", "symbol", "_lo", "_hi"), ["trade_date", "symbol"], "inner") \
             .filter((F.col("traded_at") == F.col("_lo")) | (F.col("traded_at") == F.col("_hi")))
    first = F.when(F.col("traded_at") == F.col("_lo"), F.col("trade_id"))
    last = F.when(F.col("traded_at") == F.col("_hi"), F.col("trade_id"))
    return at.groupBy("trade_date", "symbol").agg(
        _r2(F.min_by("price", first)).alias("open_price"),
        _r2(F.max_by("price", last)).alias("close_price"),
    )


def mart_daily_summary(trades: DataFrame, dim_time: DataFrame | None = None) -> DataFrame:
    """Daily OHLC per (trade_date, symbol): the mart at its intended grain.

    The measures are aggregated and staged first (a row per day and symbol), so
    the trades are read twice in all: once for them, once for open and close.
    """
    daily = trades.groupBy("trade_date", "symbol").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("quantity").alias("total_quantity"),
        _r2(F.sum("notional")).alias("total_notional_usd"),
        _r2(F.min("price")).alias("low_price"),
        _r2(F.max("price")).alias("high_price"),
        _r2(exact_avg("price")).alias("avg_price"),
        F.min("traded_at").alias("_lo"),
        F.max("traded_at").alias("_hi"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )
    daily = staged(daily, "daily")
    daily = daily.join(_open_close(trades, daily, daily.count()), ["trade_date", "symbol"], "left")
    return _with_calendar(daily, dim_time).select(
        "trade_date", "day_of_week", "is_weekend", "symbol", "trade_count", "total_quantity",
        "total_notional_usd", "low_price", "high_price", "avg_price", "open_price", "close_price",
        "first_ingested_at", "last_ingested_at",
    )


def mart_daily_summary_tick(trades: DataFrame, dim_time: DataFrame | None = None) -> DataFrame:
    """The daily mart as its SQL is written: grouped by (day, symbol, traded_at,
    price), so one row per distinct tick; open/close are the first / last price
    of the (day, symbol) in (traded_at, price) order; then DISTINCT.

    Open/close come from a per-(day, symbol) hash aggregate (ordering key
    packed into one decimal) joined back on its key, not from a window over
    the hot (day, symbol) partition. That reads the trades a second time, but
    shuffles a row per task, day and symbol only; taking them from the ticks
    would shuffle the ticks twice, as each side prunes its own columns.
    """
    ticks = trades.groupBy("trade_date", "symbol", "traded_at", "price").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("quantity").alias("total_quantity"),
        _r2(F.sum("notional")).alias("total_notional_usd"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )
    order = time_price_key("traded_at", "price")
    ends = trades.groupBy("trade_date", "symbol").agg(
        _r2(F.min_by("price", order)).alias("open_price"),
        _r2(F.max_by("price", order)).alias("close_price"),
    )
    return (_with_calendar(ticks.join(ends, ["trade_date", "symbol"], "inner"), dim_time)
                 .select("trade_date", "day_of_week", "is_weekend", "symbol", "trade_count",
                         "total_quantity", "total_notional_usd",
                         _r2("price").alias("low_price"), _r2("price").alias("high_price"),
                         _r2("price").alias("avg_price"), "open_price", "close_price",
                         "first_ingested_at", "last_ingested_at")
                 .distinct())


def mart_symbol_performance(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """Per-symbol totals, price range, sample stddev, trading days, ranks.

    The single COUNT(DISTINCT trade_date) is planned by Spark as a two-level
    aggregate over (symbol, trade_date) -> symbol, both with partial phases.
    The rank windows have no partition key, but only one row per symbol
    reaches them.
    """
    perf = trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_trades"),
        _r2(F.sum("notional")).alias("total_notional_usd"),
        _r2(exact_avg("notional")).alias("avg_notional_per_trade"),
        _r2(F.min("price")).alias("all_time_low"),
        _r2(F.max("price")).alias("all_time_high"),
        _r2(exact_avg("price")).alias("avg_price"),
        _r2(F.stddev_samp(F.col("price").cast("double"))).alias("price_stddev"),
        F.count_distinct("trade_date").alias("trading_days"),
        F.min("trade_date").alias("first_seen"),
        F.max("trade_date").alias("last_seen"),
        F.max("ingested_at").alias("last_updated"),
    )
    inst = instruments.select("symbol", "display_name", "asset_class", "is_major_coin")
    joined = perf.join(inst, "symbol", "inner")
    return joined.select(
        "symbol", "display_name", "asset_class", "is_major_coin", "total_trades",
        "total_notional_usd", "avg_notional_per_trade", "all_time_low", "all_time_high",
        "avg_price", "price_stddev", "trading_days", "first_seen", "last_seen", "last_updated",
        F.rank().over(Window.orderBy(F.desc("total_notional_usd"))).alias("volume_rank"),
        F.rank().over(Window.orderBy(F.desc("total_trades"))).alias("activity_rank"),
    )


# ---- incremental maintenance: per-(day, symbol) state and its roll-up ------------------

def daily_state(trades: DataFrame) -> DataFrame:
    """Mergeable per-(trade_date, symbol) state of the symbol mart.

    Sums, counts, extremes and the (n, mean, M2) triple of the price make the
    all-time figures derivable from this table alone, so a load only has to
    recompute the days it touched.
    """
    p = F.col("price").cast("double")
    return trades.groupBy("trade_date", "symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("notional").alias("sum_notional"),
        F.count("notional").alias("n_notional"),
        F.sum("price").alias("sum_price"),
        F.count("price").alias("n_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg(p).alias("mean_price"),
        (F.var_pop(p) * F.count(p)).alias("m2_price"),
        F.max("ingested_at").alias("max_ingested_at"),
    )


def mart_symbol_performance_from_state(state: DataFrame, instruments: DataFrame) -> DataFrame:
    """The symbol mart rolled up from ``daily_state`` (one row per day and
    symbol), merging the variance states with the parallel formula
    M2 = sum(M2_i) + sum(n_i * (mean_i - mean)^2)."""
    w = Window.partitionBy("symbol")
    n_all = F.sum("n_price").over(w)
    mean_all = F.sum(F.col("mean_price") * F.col("n_price")).over(w) / n_all
    s = state.withColumn("_dev", F.col("n_price") * F.pow(F.col("mean_price") - mean_all, 2))
    m2 = F.sum("m2_price") + F.sum("_dev")
    n = F.sum("n_price")
    perf = s.groupBy("symbol").agg(
        F.sum("n").alias("total_trades"),
        _r2(F.sum("sum_notional")).alias("total_notional_usd"),
        _r2(F.sum("sum_notional") / F.sum("n_notional")).alias("avg_notional_per_trade"),
        _r2(F.min("min_price")).alias("all_time_low"),
        _r2(F.max("max_price")).alias("all_time_high"),
        _r2(F.sum("sum_price") / F.sum("n_price")).alias("avg_price"),
        _r2(F.when(n > 1, F.sqrt(m2 / (n - 1)))).alias("price_stddev"),
        F.count("trade_date").alias("trading_days"),
        F.min("trade_date").alias("first_seen"),
        F.max("trade_date").alias("last_seen"),
        F.max("max_ingested_at").alias("last_updated"),
    )
    inst = instruments.select("symbol", "display_name", "asset_class", "is_major_coin")
    return perf.join(inst, "symbol", "inner").select(
        "symbol", "display_name", "asset_class", "is_major_coin", "total_trades",
        "total_notional_usd", "avg_notional_per_trade", "all_time_low", "all_time_high",
        "avg_price", "price_stddev", "trading_days", "first_seen", "last_seen", "last_updated",
        F.rank().over(Window.orderBy(F.desc("total_notional_usd"))).alias("volume_rank"),
        F.rank().over(Window.orderBy(F.desc("total_trades"))).alias("activity_rank"),
    )
