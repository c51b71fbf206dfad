"""Documents, feeds and message codecs."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickforge.operators import documents as dc
from tickforge.plans import datasets as ds
from tickforge.schemas import FEED_B_SCHEMA
from tickforge.sources import feeds


def test_documents_flatten_back_to_marts(spark):
    docs = ds.portfolio_documents(spark, SF_SMALL)
    daily = ds.mart_daily_summary(spark, SF_SMALL)
    flat = dc.flatten_daily(docs)
    assert flat.count() == daily.count()
    # every embedded day equals its mart row
    j = flat.join(daily.select(F.col("symbol"), F.date_format("trade_date", "yyyy-MM-dd").alias("date"),
                               F.col("close_price").cast("double").alias("mclose")), ["symbol", "date"])
    assert j.filter(F.col("close") != F.col("mclose")).count() == 0
    # newest day first, at most 10 recent trades, newest first
    for r in docs.collect():
        dates = [d.date for d in r.daily_breakdown]
        assert dates == sorted(dates, reverse=True)
        ts = [t.timestamp for t in r.recent_trades]
        assert len(ts) <= 10 and ts == sorted(ts, reverse=True)
        assert r.performance.total_trades >= len(ts)


def test_document_to_json(spark):
    doc = ds.portfolio_documents(spark, SF_SMALL).select(F.to_json(F.struct("*")).alias("j")).first().j
    d = json.loads(doc)
    assert set(d) >= {"_id", "symbol", "performance", "recent_trades", "daily_breakdown", "metadata"}
    assert set(d["daily_breakdown"][0]["ohlc"]) == {"open", "high", "low", "close", "avg"}
    assert d["metadata"]["version"] == "1.0.0"


def test_upsert_replaces_whole_documents(spark):
    docs = ds.portfolio_documents(spark, SF_SMALL)
    old = docs.withColumn("display_name", F.lit("stale"))
    extra = docs.limit(1).withColumn("_id", F.lit("NEW/USD")).withColumn("symbol", F.lit("NEW/USD"))
    merged = dc.upsert_documents(old, docs.unionByName(extra))
    acts = {r._action: r["count"] for r in merged.groupBy("_action").count().collect()}
    assert acts == {"updated": docs.count(), "inserted": 1}
    assert merged.filter("display_name = 'stale'").count() == 0


def test_feed_b_status_malformed_and_missing_fields(spark):
    msgs = spark.createDataFrame([
        (1, '[{"ev":"status","status":"auth_success","message":"ok"},'
            '{"ev":"XT","i":"9","pair":"BTC-USD","p":2.5,"s":4,"x":"1","t":1710028799999}]', "2024-03-10 00:00:00"),
        (2, '[{"ev":"XT","pair":"ETH-USD","s":1,"t":0}]', "2024-03-10 00:00:01"),
        (3, '[{"ev":"XT", broken', "2024-03-10 00:00:02"),
    ], "message_id int, value string, arrived_at string")
    out = {r.trade_id: r for r in feeds.normalize_feed_b(msgs).collect()}
    assert set(out) == {"9", ""}
    assert out["9"].symbol == "BTC/USD" and out["9"].notional == 10.0 and out["9"].source == "feed_b"
    assert out[""].price == 0.0 and out[""].notional == 0.0
    bad = feeds.corrupt_messages(msgs, FEED_B_SCHEMA).collect()
    assert [r.message_id for r in bad] == [3]


def test_feed_union_fills_missing_columns(spark):
    from tickforge.sources import fixtures as fx

    u = feeds.feed_union(feeds.normalize_feed_a(fx.feed_a_messages(spark, SF_SMALL)),
                         feeds.normalize_feed_b(fx.feed_b_messages(spark, SF_SMALL)))
    assert u.columns == feeds.EVENT_COLUMNS + ["exchange_id"]
    assert u.filter("source = 'feed_b' AND (conditions IS NOT NULL OR exchange IS NOT NULL)").count() == 0
    assert u.filter("source = 'feed_a' AND exchange_id IS NOT NULL").count() == 0
    assert u.filter("symbol LIKE '%-%'").count() == 0


def test_json_keeps_microseconds(spark):
    f = ds.fact(spark, SF_SMALL)
    back = feeds.decode_messages(feeds.encode_messages(f), f.schema)
    assert back.exceptAll(f).count() == 0 and f.exceptAll(back).count() == 0


def test_keyed_files_keep_per_symbol_order(spark, tmp_dir):
    import os

    from pyspark.sql import Window

    from tickforge.sinks import writers

    path = os.path.join(tmp_dir, "keyed")
    writers.write_keyed_files(ds.fact(spark, SF_SMALL), path, fmt="parquet")
    back = (spark.read.parquet(path).withColumn("f", F.input_file_name())
                 .withColumn("pos", F.monotonically_increasing_id()))
    w = Window.partitionBy("symbol").orderBy("f", "pos")
    prev = back.withColumn("prev_ts", F.lag("timestamp").over(w))
    assert prev.filter("prev_ts > timestamp").count() == 0


def test_required_columns_checked_before_any_job(spark):
    import pytest

    from tickforge.schemas import MissingColumnsError, require_columns

    df = spark.range(1).withColumnRenamed("id", "trade_id")
    with pytest.raises(MissingColumnsError, match="symbol"):
        require_columns(df, ["trade_id", "symbol"], "silver")


def test_sql_serving_with_parameters(spark):
    from tickforge.plans import serving

    serving.register_views(spark, mart_daily_summary=ds.mart_daily_summary(spark, SF_SMALL))
    evil = "x' OR '1'='1"
    assert serving.daily_summary(spark, symbol=evil).count() == 0
    allrows = serving.daily_summary(spark, symbol="All").count()
    assert allrows == ds.mart_daily_summary(spark, SF_SMALL).count()


def test_documents_json_sink_round_trip(spark, tmp_dir):
    import os

    from tickforge.sinks import writers

    docs = ds.portfolio_documents(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "docs")
    writers.write_documents_json(docs, path)
    back = spark.read.schema(docs.schema).json(path)
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0


def test_feed_b_to_bronze_has_unknown_exchange_in_silver(spark):
    from tickforge.operators import silver
    from tickforge.sources import fixtures as fx

    b = feeds.to_bronze_text(feeds.normalize_feed_b(fx.feed_b_messages(spark, SF_SMALL)))
    good = silver.quality_good(silver.silver_prepared(b))
    assert good.count() > 0 and good.filter("exchange != 'UNKNOWN'").count() == 0
