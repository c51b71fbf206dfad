"""Serving by SQL text: Gold tables and marts as temp views, queried with
named parameters.

A query is a view, the columns it serves, the conditions that apply and an
order. A condition is a predicate with one named parameter; those whose
parameter is absent are left out. Values reach Spark as parameters only, never
as text, so any input is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAILY_COLUMNS = ("trade_date", "day_of_week", "is_weekend", "symbol", "trade_count", "total_notional_usd",
                 "low_price", "high_price", "avg_price", "open_price", "close_price")
PERFORMANCE_COLUMNS = ("symbol", "display_name", "asset_class", "is_major_coin", "total_trades", "total_notional_usd",
                       "avg_notional_per_trade", "all_time_low", "all_time_high", "avg_price", "price_stddev",
                       "trading_days", "first_seen", "last_seen", "volume_rank")
RECENT_COLUMNS = ("symbol", "price", "quantity", "notional", "timestamp", "trade_date", "trade_hour", "source", "trade_id")
EVERY_SYMBOL = "All"


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Expose frames as session temp views under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def served(spark: SparkSession, view: str, columns: tuple[str, ...], conditions: list[tuple[str, str, object]] = (),
           order: str | None = None, limit: int | None = None, distinct: bool = False) -> DataFrame:
    """conditions: (predicate, parameter name, value or None)."""
    given = [(p, n, v) for p, n, v in conditions if v is not None]
    text = f"SELECT {'DISTINCT ' if distinct else ''}{', '.join(columns)} FROM {view}"
    if given:
        text += " WHERE " + " AND ".join(f"({p})" for p, _, _ in given)
    args = {n: v for _, n, v in given}
    if order:
        text += f" ORDER BY {order}"
    if limit is not None:
        text, args["row_limit"] = text + " LIMIT :row_limit", int(limit)
    return spark.sql(text, args=args)


def _symbol(symbol: str | None) -> tuple[str, str, object]:
    return "symbol = :symbol", "symbol", None if symbol in (None, "", EVERY_SYMBOL) else symbol


def daily_summary(spark: SparkSession, symbol: str | None = None, start_date: str | None = None,
                  end_date: str | None = None, view: str = "mart_daily_summary") -> DataFrame:
    """Distinct rows of the daily mart, oldest first; dates inclusive."""
    return served(spark, view, DAILY_COLUMNS, [
        _symbol(symbol), ("trade_date >= CAST(:start_date AS DATE)", "start_date", start_date or None),
        ("trade_date <= CAST(:end_date AS DATE)", "end_date", end_date or None)], "trade_date, symbol", distinct=True)


def symbol_performance(spark: SparkSession, symbol: str | None = None, view: str = "mart_symbol_performance") -> DataFrame:
    """Performance rows, best volume rank first."""
    return served(spark, view, PERFORMANCE_COLUMNS, [_symbol(symbol)], "volume_rank, symbol")


def recent_trades(spark: SparkSession, symbol: str | None = None, limit: int = 50, view: str = "fact_trades") -> DataFrame:
    """The newest ``limit`` trades."""
    return served(spark, view, RECENT_COLUMNS, [_symbol(symbol)], "timestamp DESC, trade_id DESC", limit)


def hourly_volume(spark: SparkSession, view: str = "fact_trades") -> DataFrame:
    """Trades and volume per hour and symbol, by hour."""
    return spark.sql(f"""SELECT trade_hour, symbol, count(*) AS trade_count, round(sum(notional), 2) AS total_notional
                         FROM {view} GROUP BY trade_hour, symbol ORDER BY trade_hour, symbol""")


def all_trades(spark: SparkSession, symbol: str | None = None, fact: str = "fact_trades",
               instruments: str = "dim_instrument") -> DataFrame:
    """Flat trade list with instrument attributes, newest first."""
    joined = f"{fact} JOIN (SELECT symbol AS traded, asset_class, base_currency, quote_currency FROM {instruments}) ON symbol = traded"
    return served(spark, joined, ("trade_id", "symbol", "price", "quantity", "notional", "trade_type", "exchange", "source",
                                  "timestamp", "trade_date", "trade_hour", "ingested_at", "asset_class", "base_currency",
                                  "quote_currency"), [_symbol(symbol)], "timestamp DESC, trade_id DESC")


def pipeline_stats(spark: SparkSession, view: str = "fact_trades") -> DataFrame:
    return spark.sql(f"""SELECT count(*) AS total_trades, count(DISTINCT trade_date) AS trading_days,
                                count(DISTINCT symbol) AS symbols, min(ingested_at) AS first_ingested,
                                max(ingested_at) AS last_ingested, round(sum(notional), 2) AS total_notional,
                                round(sum(notional) / count(notional), 2) AS avg_notional,
                                count_if(exchange = :unknown) AS null_exchange_count
                         FROM {view}""", args={"unknown": "UNKNOWN"})
