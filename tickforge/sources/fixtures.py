"""Trade-shaped inputs derived by Spark from the given parquet tables.

* ``trades_from_events``  clean, Gold-shaped trades (one per event)
* ``bronze_from_events``  dirty all-string Bronze rows, with re-delivered copies
* ``wide_trades``         lineitem joined to part: prices across all three tiers
* ``feed_a_messages`` / ``feed_b_messages``  raw JSON messages of the two feeds

Everything is a lazy plan over the parquet scans: the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    # events.ts is stored without a zone (timestamp_ntz); pin it to UTC.
    return ev.selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value", "props")


def _quantity_text() -> Column:
    return F.get_json_object("props", "$.k")


def trades_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed trade per event, in the Gold fact layout."""
    return _events(spark, sf_dir).selectExpr(
        "CAST(event_id AS STRING) AS trade_id",
        "concat(upper(event_type), '/USD') AS symbol",
        "CAST(ts AS DATE) AS trade_date",
        "CAST(hour(ts) AS INT) AS trade_hour",
        "CAST(value AS DECIMAL(18,8)) AS price",
        "CAST(get_json_object(props, '$.k') AS DECIMAL(18,8)) AS quantity",
        "CAST(CAST(value AS DECIMAL(10,2)) * CAST(get_json_object(props, '$.k') AS DECIMAL(10,0))"
        " AS DECIMAL(18,2)) AS notional",
        "'CRYPTO' AS trade_type",
        "CASE WHEN user_id % 3 = 0 THEN 'UNKNOWN' ELSE concat('EX', CAST(user_id % 3 AS STRING)) END AS exchange",
        "CASE WHEN event_id % 10 = 7 THEN 'feed_b' ELSE 'feed_a' END AS source",
        "ts AS timestamp",
        "timestampadd(SECOND, event_id % 300, ts) AS ingested_at",
    )


def bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string Bronze rows: every event once, plus a re-delivered copy of some.

    Dirt is deterministic per event id: empty and overlong ids, empty symbols,
    NULL, negative, non-numeric and out-of-range prices, feed-B symbols ('-'),
    epoch-millisecond timestamps, and times that are out of range or no time.
    A few trades carry conditions.
    """
    ev = _events(spark, sf_dir)
    rows = ev.withColumn("n", F.lit(0)).unionByName(
        ev.filter(F.col("event_id") % 50 == 0).withColumn("n", F.lit(60)))
    iso = "concat(date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
    return rows.selectExpr(
        "CASE WHEN event_id % 103 = 0 THEN '' WHEN event_id % 233 = 0 THEN lpad(CAST(event_id AS STRING), 60, '0')"
        " ELSE CAST(event_id AS STRING) END AS trade_id",
        "CASE WHEN event_id % 101 = 0 THEN '' WHEN event_id % 10 = 7 THEN concat(upper(event_type), '-USD')"
        " ELSE concat(upper(event_type), '/USD') END AS symbol",
        "CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 89 = 0 THEN '-1.0'"
        " WHEN event_id % 83 = 0 THEN 'abc' WHEN event_id % 223 = 0 THEN '100000000000.0'"
        " ELSE CAST(value AS STRING) END AS price",
        "get_json_object(props, '$.k') AS quantity",
        "CAST(CAST(CAST(value AS DECIMAL(10,2)) * CAST(get_json_object(props, '$.k') AS DECIMAL(10,0))"
        " AS DECIMAL(18,2)) AS STRING) AS notional",
        "CASE WHEN user_id % 3 = 0 THEN CAST(NULL AS STRING) ELSE concat('EX', CAST(user_id % 3 AS STRING)) END"
        " AS exchange",
        "CASE WHEN event_id % 199 = 0 THEN 'OPTION' ELSE 'CRYPTO' END AS trade_type",
        "CASE WHEN event_id % 227 = 0 THEN '999999999999999999' WHEN event_id % 229 = 0 THEN 'not a time'"
        f" WHEN event_id % 10 = 7 THEN CAST(unix_millis(ts) AS STRING) ELSE {iso.format('ts')} END AS timestamp",
        f"{iso.format('timestampadd(SECOND, event_id % 300 + n, ts)')} AS ingested_at",
        "CASE WHEN event_id % 10 = 7 THEN 'feed_b' ELSE 'feed_a' END AS source",
        "CASE WHEN event_id % 37 = 0 THEN concat('I,', upper(substr(event_type, 1, 1))) END AS conditions",
    )


def wide_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part (brand = symbol), in the Gold fact layout.

    part is the small side of a key/foreign-key join; the planner broadcasts it
    only when its runtime size is under the broadcast threshold and otherwise
    uses a shuffle join, so no explicit hint is given.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_quantity", "l_extendedprice", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    return li.join(part, li.l_partkey == part.p_partkey, "inner").selectExpr(
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
        " CAST(l_suppkey AS STRING)) AS trade_id",
        "concat(p_brand, '/USD') AS symbol",
        "CAST(CAST(l_shipdate AS TIMESTAMP) AS DATE) AS trade_date",
        "CAST(hour(CAST(l_shipdate AS TIMESTAMP)) AS INT) AS trade_hour",
        "CAST(l_extendedprice AS DECIMAL(18,8)) AS price",
        "CAST(l_quantity AS DECIMAL(18,8)) AS quantity",
        "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS DECIMAL(18,2))"
        " AS notional",
        "'CRYPTO' AS trade_type",
        "concat('EX', CAST(l_suppkey % 3 AS STRING)) AS exchange",
        "'lineitem' AS source",
        "CAST(l_shipdate AS TIMESTAMP) AS timestamp",
        "CAST(l_shipdate AS TIMESTAMP) AS ingested_at",
    )


def feed_a_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed-A JSON objects (one per event of source feed_a), as ``value`` text.

    One in 37 is cut off, one in 41 quotes its price.
    """
    ev = _events(spark, sf_dir).filter(F.col("event_id") % 10 != 7)
    eid = F.col("event_id")
    qty = _quantity_text().cast("double")
    price = F.col("value")
    conditions = (F.when(eid % 4 == 0, F.lit(None).cast("array<string>"))
                   .when(eid % 4 == 1, F.array().cast("array<string>"))
                   .otherwise(F.array(F.lit("I"), F.upper(F.substring("event_type", 1, 1)))))
    msg = F.struct(
        F.when(eid % 103 == 0, F.lit("")).otherwise(eid.cast("string")).alias("trade_id"),
        F.concat(F.upper("event_type"), F.lit("/USD")).alias("symbol"),
        price.alias("price"),
        qty.alias("quantity"),
        (price * qty).alias("notional"),
        F.when(F.col("user_id") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("EX"), (F.col("user_id") % 3).cast("string"))).alias("exchange"),
        F.lit("CRYPTO").alias("trade_type"),
        F.concat(F.date_format("ts", ISO_MICROS), F.lit("+00:00")).alias("timestamp"),
        F.concat(F.date_format(F.timestamp_add("SECOND", eid % 300, F.col("ts")), ISO_MICROS),
                 F.lit("+00:00")).alias("ingested_at"),
        F.lit("feed_a").alias("source"),
        conditions.alias("conditions"),
    )
    text = F.to_json(msg)
    text = F.when(eid % 41 == 0, F.regexp_replace(text, r'"price":([^,]+),', '"price":"$1",')).otherwise(text)
    text = F.when(eid % 37 == 0, F.substring(text, 1, 40)).otherwise(text)
    return ev.select(eid.alias("message_id"), text.alias("value"))


def feed_b_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed-B messages (JSON arrays) for the feed_b events.

    One message in a hundred also carries a status object; one in 31 is
    malformed (garbage before the array), as a broken frame on the wire would
    be; one in 43 quotes its price.
    """
    ev = _events(spark, sf_dir).filter(F.col("event_id") % 10 == 7)
    eid = F.col("event_id")
    trade = F.struct(
        F.lit("XT").alias("ev"),
        F.when(eid % 103 == 0, F.lit("")).otherwise(eid.cast("string")).alias("i"),
        F.concat(F.upper("event_type"), F.lit("-USD")).alias("pair"),
        F.col("value").alias("p"),
        _quantity_text().cast("double").alias("s"),
        (F.col("user_id") % 3).cast("string").alias("x"),
        F.unix_millis("ts").alias("t"),
    )
    status = F.struct(F.lit("status").alias("ev"), F.lit("connected").alias("status"),
                      F.lit("heartbeat").alias("message"))
    text = F.when(eid % 100 == 7, F.concat(F.lit("["), F.to_json(status), F.lit(","), F.to_json(trade), F.lit("]"))) \
            .otherwise(F.concat(F.lit("["), F.to_json(trade), F.lit("]")))
    text = F.when(eid % 43 == 0, F.regexp_replace(text, r'"p":([^,]+),', '"p":"$1",')).otherwise(text)
    text = F.when(eid % 31 == 0, F.concat(F.lit("{broken "), text)).otherwise(text)
    arrived = F.timestamp_add("SECOND", eid % 300, F.col("ts"))
    return ev.select(eid.alias("message_id"), text.alias("value"), arrived.alias("arrived_at"))


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds on one topic: message_id, value, arrived_at."""
    a = feed_a_messages(spark, sf_dir).join(
        _events(spark, sf_dir).select(F.col("event_id").alias("message_id"),
                                      F.timestamp_add("SECOND", F.col("event_id") % 300, F.col("ts")).alias("arrived_at")),
        "message_id")
    return a.select("message_id", "value", "arrived_at").unionByName(feed_b_messages(spark, sf_dir))


# Instruments that the dimension is seeded with.
SEED_INSTRUMENTS = [
    ("BTC/USD", "BTC", "USD", "CRYPTO", "SEEDED"),
    ("CLICK/USD", "CLICK", "USD", "CRYPTO", "SEEDED"),
    ("ETH/USD", "ETH", "USD", "CRYPTO", "SEEDED"),
]
