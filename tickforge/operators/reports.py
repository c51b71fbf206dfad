"""Serving queries and report tables: the data frames behind every dashboard
chart, KPI and exported table, as Spark plans (no client-side reductions).

Second-level reductions that a client would do on a fetched frame (re-summing
hours, averaging daily averages) are a second ``groupBy`` in the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import TS_DISPLAY, hour_label, money_text, volatility_tier

HOURS = list(range(24))


def _r2(c):
    return F.round(c, 2)


def _exact_avg(c: str):
    return F.sum(c) / F.count(c)


def pipeline_stats(fact: DataFrame) -> DataFrame:
    """Global figures over the fact table, in one aggregate."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.count_distinct("trade_date").alias("trading_days"),
        F.count_distinct("symbol").alias("symbols"),
        F.min("ingested_at").alias("first_ingested"),
        F.max("ingested_at").alias("last_ingested"),
        _r2(F.sum("notional")).alias("total_notional"),
        _r2(_exact_avg("notional")).alias("avg_notional"),
        F.count_if(F.col("exchange") == "UNKNOWN").alias("null_exchange_count"),
    )


def hourly_volume(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trade_hour", "symbol").agg(
        F.count(F.lit(1)).alias("trade_count"),
        _r2(F.sum("notional")).alias("total_notional"),
    )


def hourly_total(hourly: DataFrame) -> DataFrame:
    """Hours re-aggregated over symbols, with an 'HH:00' label."""
    return hourly.groupBy("trade_hour").agg(
        F.sum("trade_count").alias("trade_count"),
        F.sum("total_notional").alias("total_notional"),
    ).withColumn("hour_label", hour_label("trade_hour"))


def hourly_pivot(hourly: DataFrame, hours: list[int] = HOURS) -> DataFrame:
    """symbol x hour matrix of trade counts, missing cells 0.

    The hour list is fixed, so the pivot needs no extra job to discover values
    and the output schema is stable.
    """
    p = hourly.groupBy("symbol").pivot("trade_hour", hours).agg(F.sum("trade_count"))
    return p.select("symbol", *[F.coalesce(F.col(str(h)), F.lit(0).cast(p.schema[str(h)].dataType))
                                .alias(f"h{h:02d}") for h in hours])


def daily_filtered(daily: DataFrame, symbol: str | None = None,
                   start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """DISTINCT slice of the daily mart; 'All' or None means no symbol filter;
    both date ends are inclusive. On a table partitioned by trade_date the date
    predicate prunes partitions."""
    df = daily
    if symbol and symbol != "All":
        df = df.filter(F.col("symbol") == symbol)
    if start_date:
        df = df.filter(F.col("trade_date") >= F.lit(start_date).cast("date"))
    if end_date:
        df = df.filter(F.col("trade_date") <= F.lit(end_date).cast("date"))
    return df.select("trade_date", "day_of_week", "is_weekend", "symbol", "trade_count",
                     "total_notional_usd", "low_price", "high_price", "avg_price",
                     "open_price", "close_price").distinct()


def date_bounds(daily: DataFrame) -> DataFrame:
    return daily.agg(F.min("trade_date").alias("min_date"), F.max("trade_date").alias("max_date"))


def daily_volume_trend(daily: DataFrame) -> DataFrame:
    return daily.groupBy("trade_date", "symbol").agg(F.sum("total_notional_usd").alias("total_notional_usd"))


def report_daily(daily: DataFrame) -> DataFrame:
    """Report table: trades and volume summed, daily average price averaged."""
    return daily.groupBy("trade_date", "symbol").agg(
        F.sum("trade_count").alias("trade_count"),
        F.sum("total_notional_usd").alias("total_notional_usd"),
        _r2(_exact_avg("avg_price")).alias("avg_price"),
    )


def market_kpis(daily: DataFrame) -> DataFrame:
    """KPIs over a (filtered) daily slice: volume, trades, mean daily average
    price, days covered, and volume per trade with a zero guard."""
    k = daily.agg(
        F.sum("total_notional_usd").alias("total_volume"),
        F.sum("trade_count").alias("total_trades"),
        _r2(_exact_avg("avg_price")).alias("avg_price"),
        F.count_distinct("trade_date").alias("days_covered"),
    )
    return k.withColumn("volume_per_trade",
                        _r2(F.col("total_volume") / F.greatest(F.col("total_trades"), F.lit(1))))


def symbol_distribution(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("trade_count"),
                                        F.sum("notional").alias("total_notional"))


def recent_trades(fact: DataFrame, symbol: str | None = None, limit: int = 50) -> DataFrame:
    """Newest ``limit`` trades (optionally of one symbol): a top-k
    (TakeOrderedAndProject), never a full sort. trade_id breaks time ties."""
    df = fact if not symbol or symbol == "All" else fact.filter(F.col("symbol") == symbol)
    return (df.select("symbol", "price", "quantity", "notional", "timestamp", "trade_date",
                      "trade_hour", "source", "trade_id")
              .orderBy(F.desc("timestamp"), F.desc("trade_id")).limit(limit))


def trade_log(recent: DataFrame) -> DataFrame:
    """Display columns of the recent-trades table."""
    return recent.select(
        F.date_format("timestamp", TS_DISPLAY).alias("timestamp_utc"),
        F.col("symbol"),
        money_text("price", 4).alias("price"),
        F.col("quantity").cast("double").alias("qty"),
        money_text("notional", 2).alias("notional"),
    )


def market_log(recent: DataFrame) -> DataFrame:
    """Display columns of the market page's trade table, with the hour."""
    return recent.select(
        F.date_format("timestamp", TS_DISPLAY).alias("timestamp_utc"), F.col("symbol"),
        money_text("price", 4).alias("price"), F.col("quantity").cast("double").alias("qty"),
        money_text("notional", 2).alias("notional"), hour_label("trade_hour").alias("hour"))


def asset_log(recent: DataFrame) -> DataFrame:
    """Display columns of one asset's trade table (no symbol column)."""
    return recent.select(
        F.date_format("timestamp", TS_DISPLAY).alias("timestamp_utc"), money_text("price", 4).alias("price"),
        F.col("quantity").cast("double").alias("qty"), money_text("notional", 2).alias("notional"), F.col("source"))


def report_preview(recent: DataFrame) -> DataFrame:
    """Display columns of the report page's trade preview."""
    return recent.select(
        F.col("trade_id"), F.col("symbol"), money_text("price", 4).alias("price"),
        F.col("quantity").cast("double").alias("quantity"), money_text("notional", 2).alias("notional"),
        F.date_format("timestamp", TS_DISPLAY).alias("timestamp"))


def asset_profile(perf: DataFrame, symbol: str | None = None) -> DataFrame:
    """Per-asset card: mart row plus volatility tier and price range."""
    df = perf if not symbol else perf.filter(F.col("symbol") == symbol)
    return df.select(
        "symbol", "is_major_coin", "avg_price", "all_time_low", "all_time_high",
        "total_notional_usd", "total_trades", "avg_notional_per_trade", "trading_days",
        F.coalesce(F.col("price_stddev"), F.lit(0)).alias("price_stddev"),
        volatility_tier("price_stddev").alias("volatility"),
        (F.col("all_time_high") - F.col("all_time_low")).alias("price_range"),
    )


def portfolio_share(perf: DataFrame) -> DataFrame:
    """Each symbol's share of total volume. The unpartitioned window sees one
    row per symbol only."""
    grand = F.sum("total_notional_usd").over(Window.partitionBy())
    return perf.select("symbol", "total_notional_usd",
                       (F.col("total_notional_usd").cast("double") / grand.cast("double")).alias("share"))


# The labels of the report's summary rows are in the text below.
def report_summary(stats: DataFrame, dq: DataFrame) -> DataFrame:
    """(metric, value) rows of the report's summary table: the pipeline
    figures unpivoted, plus one row counting the passing quality checks."""
    figures = stats.select(F.expr(
        "stack(4, "
        "'Total Trades Processed', format_number(total_trades, 0), "
        "'Total Volume (USD)', concat('$', format_number(total_notional, 2)), "
        "'Trading Days Covered', cast(trading_days AS string), "
        "'Average Trade Value', concat('$', format_number(avg_notional, 2))"
        ") AS (metric, value)"))
    checks = dq.agg(F.concat(F.count_if("passed"), F.lit(" / "), F.count(F.lit(1)), F.lit(" Passing")).alias("value")) \
               .select(F.lit("Data Quality Tests").alias("metric"), "value")
    return figures.unionByName(checks)


def report_assets(perf: DataFrame) -> DataFrame:
    return perf.select(
        "symbol", F.col("total_trades").alias("trades"), "avg_price",
        F.col("all_time_low").alias("low"), F.col("all_time_high").alias("high"),
        F.col("total_notional_usd").alias("volume_usd"),
        volatility_tier("price_stddev").alias("volatility"),
    )


def all_trades(fact: DataFrame, instruments: DataFrame) -> DataFrame:
    """Flat trade list with instrument attributes. In no order: sort what is
    served, not the whole fact (see ``newest_first``)."""
    inst = instruments.select("symbol", "asset_class", "base_currency", "quote_currency")
    return (fact.join(inst, "symbol", "inner")
                .select("trade_id", "symbol", "price", "quantity", "notional", "trade_type",
                        "exchange", "source", "timestamp", "trade_date", "trade_hour",
                        "ingested_at", "asset_class", "base_currency", "quote_currency"))


def newest_first(trades: DataFrame) -> DataFrame:
    return trades.orderBy(F.desc("timestamp"), F.desc("trade_id"))


def silver_symbol_distribution(silver: DataFrame) -> DataFrame:
    """Silver read-back: count, average price, total notional per symbol.
    Money is summed as decimals, so totals are exact."""
    return silver.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trade_count"),
        _r2(F.sum(F.col("price").try_cast("decimal(18,8)")) / F.count(F.col("price").try_cast("decimal(18,8)"))).alias("avg_price"),
        F.sum(F.col("notional").try_cast("decimal(18,2)")).alias("total_notional"),
    )


def gold_symbol_distribution(fact: DataFrame, instruments: DataFrame) -> DataFrame:
    agg = fact.groupBy("symbol").agg(
        F.count("trade_id").alias("trade_count"),
        _r2(_exact_avg("price")).alias("avg_price"),
        _r2(F.sum("notional")).alias("total_notional"),
    )
    return agg.join(instruments.select("symbol", "asset_class"), "symbol", "inner") \
              .select("symbol", "asset_class", "trade_count", "avg_price", "total_notional")


def gold_date_coverage(fact: DataFrame, dates: DataFrame) -> DataFrame:
    agg = fact.groupBy("trade_date").agg(F.count("trade_id").alias("trade_count"))
    return agg.join(dates.select("trade_date", "day_of_week"), "trade_date", "inner") \
              .select("trade_date", "day_of_week", "trade_count")


def gold_total(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("total"))
