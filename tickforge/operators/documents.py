"""Nested per-symbol portfolio documents, built set-wise for all symbols at once
(no per-symbol query loop), and their flattening and replace-by-key merge.

Sizes: ``recent_trades`` is capped by design (the newest N per symbol, via a
window-group-limit that is applied on the map side before the shuffle);
``daily_breakdown`` holds one entry per trading day of the symbol, so it grows
with the calendar, not with the trade count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import TS_TEXT

DOC_VERSION = "1.0.0"
DOC_SOURCE = "tickforge"
DOC_PIPELINE = "gold_to_documents"


def recent_trades_per_symbol(fact: DataFrame, limit: int = 10) -> DataFrame:
    """Newest ``limit`` trades of every symbol (trade_id breaks time ties).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a hot symbol ships at most k rows per map partition.
    """
    w = Window.partitionBy("symbol").orderBy(F.desc("timestamp"), F.desc("trade_id"))
    return (fact.select("symbol", "trade_id", "price", "quantity", "notional", "trade_type",
                        "exchange", "timestamp", "ingested_at")
                .withColumn("recency_rank", F.row_number().over(w))
                .filter(F.col("recency_rank") <= limit))


def _performance(perf: DataFrame):
    d = lambda c: F.col(c).cast("double")
    return F.struct(
        F.col("total_trades").alias("total_trades"),
        d("total_notional_usd").alias("total_notional_usd"),
        d("avg_notional_per_trade").alias("avg_notional_per_trade"),
        d("all_time_low").alias("all_time_low"),
        d("all_time_high").alias("all_time_high"),
        d("avg_price").alias("avg_price"),
        d("price_stddev").alias("price_stddev"),
        F.col("trading_days").alias("trading_days"),
        F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"),
        F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"),
        F.col("volume_rank").alias("volume_rank"),
        F.col("activity_rank").alias("activity_rank"),
    )


def recent_arrays(recent: DataFrame) -> DataFrame:
    """symbol -> array of the recent trades, newest first."""
    item = F.struct(
        F.col("timestamp").alias("_ts"), F.col("trade_id").alias("_id"),
        F.col("trade_id"), F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("notional").cast("double").alias("notional"),
        F.col("trade_type"), F.col("exchange"),
        F.date_format("timestamp", TS_TEXT).alias("timestamp"),
    )
    arr = F.sort_array(F.collect_list(item), asc=False)
    shaped = F.transform(arr, lambda x: F.struct(
        x["trade_id"].alias("trade_id"), x["price"].alias("price"), x["quantity"].alias("quantity"),
        x["notional"].alias("notional"), x["trade_type"].alias("trade_type"),
        x["exchange"].alias("exchange"), x["timestamp"].alias("timestamp")))
    return recent.groupBy("symbol").agg(shaped.alias("recent_trades"))


def daily_arrays(daily: DataFrame) -> DataFrame:
    """symbol -> array of daily entries with a nested ohlc struct, newest day first."""
    d = lambda c: F.col(c).cast("double")
    item = F.struct(
        F.col("trade_date").alias("_d"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("date"),
        F.col("day_of_week"), F.col("is_weekend"), F.col("trade_count"),
        d("total_notional_usd").alias("total_notional_usd"),
        F.struct(d("open_price").alias("open"), d("high_price").alias("high"),
                 d("low_price").alias("low"), d("close_price").alias("close"),
                 d("avg_price").alias("avg")).alias("ohlc"),
    )
    arr = F.sort_array(F.collect_list(item), asc=False)
    shaped = F.transform(arr, lambda x: F.struct(
        x["date"].alias("date"), x["day_of_week"].alias("day_of_week"),
        x["is_weekend"].alias("is_weekend"), x["trade_count"].alias("trade_count"),
        x["total_notional_usd"].alias("total_notional_usd"), x["ohlc"].alias("ohlc")))
    return daily.groupBy("symbol").agg(shaped.alias("daily_breakdown"))


def portfolio_documents(perf: DataFrame, recent: DataFrame, daily: DataFrame,
                        last_updated=None) -> DataFrame:
    """One nested document per symbol of the performance mart.

    ``last_updated`` (a Column or string) stamps the metadata; by default it is
    the mart's own last update time, so rebuilding the same data gives the same
    documents.
    """
    stamp = (F.date_format("last_updated", TS_TEXT) if last_updated is None
             else (F.lit(last_updated) if isinstance(last_updated, str) else last_updated))
    base = perf.select(
        F.col("symbol").alias("_id"), "symbol", "display_name", "asset_class", "is_major_coin",
        _performance(perf).alias("performance"),
        F.struct(F.lit(DOC_SOURCE).alias("source"), F.lit(DOC_PIPELINE).alias("pipeline"),
                 stamp.alias("last_updated"), F.lit(DOC_VERSION).alias("version")).alias("metadata"),
    )
    empty = F.array()
    docs = (base.join(recent_arrays(recent), "symbol", "left")
                .join(daily_arrays(daily), "symbol", "left"))
    return docs.select(
        "_id", "symbol", "display_name", "asset_class", "is_major_coin", "performance",
        F.coalesce("recent_trades", empty.cast(docs.schema["recent_trades"].dataType)).alias("recent_trades"),
        F.coalesce("daily_breakdown", empty.cast(docs.schema["daily_breakdown"].dataType)).alias("daily_breakdown"),
        "metadata",
    )


def document_check(docs: DataFrame) -> DataFrame:
    """Read back nested fields and array sizes."""
    return docs.select(
        "_id", F.col("performance.total_trades").alias("total_trades"),
        F.col("performance.volume_rank").alias("volume_rank"),
        F.size("recent_trades").alias("recent_trades_count"),
        F.size("daily_breakdown").alias("daily_breakdown_count"),
    )


def flatten_performance(docs: DataFrame) -> DataFrame:
    """One row per document: its head fields, the performance sub-document's
    twelve fields and the metadata."""
    return docs.select("_id", "symbol", "display_name", "asset_class", "is_major_coin", "performance.*",
                       *[F.col(f"metadata.{c}").alias(f"metadata_{c}") for c in ("source", "pipeline", "last_updated", "version")])


def flatten_recent(docs: DataFrame) -> DataFrame:
    """Documents back to one row per embedded recent trade (position from 1)."""
    return docs.select("_id", F.posexplode("recent_trades").alias("pos", "t")) \
               .select(F.col("_id").alias("symbol"), (F.col("pos") + 1).alias("position"), "t.*")


def flatten_daily(docs: DataFrame) -> DataFrame:
    """Documents back to one row per embedded day, ohlc flattened."""
    return docs.select("_id", F.explode("daily_breakdown").alias("d")) \
               .select(F.col("_id").alias("symbol"), "d.date", "d.day_of_week", "d.is_weekend",
                       "d.trade_count", "d.total_notional_usd",
                       F.col("d.ohlc.open").alias("open"), F.col("d.ohlc.high").alias("high"),
                       F.col("d.ohlc.low").alias("low"), F.col("d.ohlc.close").alias("close"),
                       F.col("d.ohlc.avg").alias("avg"))


def upsert_documents(existing: DataFrame, incoming: DataFrame, key: str = "_id") -> DataFrame:
    """Replace-by-key: an incoming document replaces the stored one as a whole;
    stored documents without an incoming twin are kept. Adds ``_action``
    (inserted / updated / kept) so callers can count without a second pass."""
    cols = incoming.columns
    old = existing.select(F.col(key).alias("_k_old"), F.struct(*[F.col(c) for c in cols]).alias("_old"))
    new = incoming.select(F.col(key).alias("_k_new"), F.struct(*[F.col(c) for c in cols]).alias("_new"))
    j = old.join(new, old._k_old == new._k_new, "full_outer")
    action = (F.when(F.col("_k_old").isNull(), F.lit("inserted"))
               .when(F.col("_k_new").isNull(), F.lit("kept"))
               .otherwise(F.lit("updated")))
    doc = F.when(F.col("_k_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return j.select(doc.alias("_doc"), action.alias("_action")).select("_doc.*", "_action")
