"""Feed normalisation: two raw trade feeds -> one typed event contract.

Both feeds arrive as JSON text (a Kafka ``value`` or a line of a file), on one
topic or two: feed A sends objects, feed B arrays. Parsing is ``from_json`` with
an explicit schema; text that is not valid JSON is routed to a corrupt-message
frame instead of being dropped or half read. Numbers may be quoted.

Normalised contract (``EVENT_COLUMNS``): trade_id, symbol ('BASE/QUOTE'),
price, quantity, notional (double), exchange, trade_type, timestamp,
ingested_at (timestamp), source, conditions (comma-joined text or NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.silver import parse_event_time
from ..schemas import CORRUPT, FEED_A_SCHEMA, FEED_B_SCHEMA

EVENT_COLUMNS = ["trade_id", "symbol", "price", "quantity", "notional", "exchange",
                 "trade_type", "timestamp", "ingested_at", "source", "conditions"]

# The feed-B event type that carries a trade, and the feed labels.
FEED_B_TRADE_EVENT = "XT"
FEED_A_SOURCE = "feed_a"
FEED_B_SOURCE = "feed_b"


def _flatten_conditions(c: Column) -> Column:
    return F.nullif(F.array_join(c, ","), F.lit(""))


def normalize_feed_a(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Feed-A JSON objects -> contract. Missing id -> ''; notional recomputed
    as price * quantity when absent. Corrupt messages are left out (see
    ``corrupt_messages``)."""
    m = messages.select(_parsed(value_col, FEED_A_SCHEMA).alias("m")) \
                .filter(F.col("m").isNotNull() & F.col(f"m.{CORRUPT}").isNull())
    price, quantity = F.col("m.price").try_cast("double"), F.col("m.quantity").try_cast("double")
    return m.select(
        F.coalesce(F.col("m.trade_id"), F.lit("")).alias("trade_id"),
        F.col("m.symbol").alias("symbol"),
        price.alias("price"),
        quantity.alias("quantity"),
        F.coalesce(F.col("m.notional").try_cast("double"), price * quantity).alias("notional"),
        F.col("m.exchange").alias("exchange"),
        F.coalesce(F.col("m.trade_type"), F.lit("CRYPTO")).alias("trade_type"),
        parse_event_time(F.col("m.timestamp")).alias("timestamp"),
        parse_event_time(F.col("m.ingested_at")).alias("ingested_at"),
        F.coalesce(F.col("m.source"), F.lit(FEED_A_SOURCE)).alias("source"),
        _flatten_conditions(F.col("m.conditions")).alias("conditions"),
    )


def normalize_feed_b(messages: DataFrame, value_col: str = "value", arrived_col: str = "arrived_at") -> DataFrame:
    """Feed-B JSON arrays -> contract. Only ``ev = 'XT'`` items are trades
    (status items are skipped); short keys renamed; a missing price or size is
    0 (one that is no number is NULL) and a missing id ''; epoch-millisecond time -> timestamp; 'BASE-QUOTE'
    -> 'BASE/QUOTE'. The arrival time comes from the message envelope. As in
    the feed's own message contract, the venue is ``exchange_id`` (there is no
    ``exchange``) and there are no ``conditions``; ``feed_union`` fills the
    missing columns with NULL, so feed-B rows reach Silver with exchange
    'UNKNOWN'."""
    items = (messages.select(F.col(arrived_col).alias("_arrived"),
                             F.from_json(value_col, FEED_B_SCHEMA).alias("items"))
                     .filter(F.col("items").isNotNull())
                     .select("_arrived", F.explode("items").alias("it"))
                     .filter(F.col("it.ev") == FEED_B_TRADE_EVENT))
    p = F.coalesce(F.col("it.p"), F.lit("0")).try_cast("double")
    s = F.coalesce(F.col("it.s"), F.lit("0")).try_cast("double")
    t = parse_event_time(F.coalesce(F.col("it.t"), F.lit("0")))
    return items.select(
        F.coalesce(F.col("it.i"), F.lit("")).alias("trade_id"),
        F.regexp_replace(F.coalesce(F.col("it.pair"), F.lit("")), "-", "/").alias("symbol"),
        p.alias("price"), s.alias("quantity"), (p * s).alias("notional"),
        F.col("it.x").alias("exchange_id"),
        F.lit("CRYPTO").alias("trade_type"),
        t.alias("timestamp"),
        F.col("_arrived").cast("timestamp").alias("ingested_at"),
        F.lit(FEED_B_SOURCE).alias("source"),
    )


def _parsed(value_col: str, schema) -> Column:
    """The message as ``schema``; NULL, or for a struct a filled corrupt field, if it does not parse."""
    return F.from_json(value_col, schema, {"columnNameOfCorruptRecord": CORRUPT})


def corrupt_messages(messages: DataFrame, schema, value_col: str = "value") -> DataFrame:
    """Messages whose text does not parse under ``schema`` (kept whole, with a reason)."""
    bad = F.col("_parsed").isNull()
    if isinstance(schema, T.StructType):
        bad = bad | F.col(f"_parsed.{CORRUPT}").isNotNull()
    return (messages.withColumn("_parsed", _parsed(value_col, schema))
                    .filter(bad & F.col(value_col).isNotNull())
                    .drop("_parsed")
                    .withColumn("reason", F.lit("malformed_json")))


def split_topic(messages: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(feed A, feed B, neither) of a topic that both feeds share, by shape:
    feed A sends JSON objects, feed B arrays."""
    first = F.substring(F.ltrim(F.col(value_col)), 1, 1)
    return (messages.filter(first == "{"), messages.filter(first == "["),
            messages.filter(F.coalesce(~first.isin("{", "["), F.lit(True))).withColumn("reason", F.lit("unknown_shape")))


def normalize_topic(messages: DataFrame, value_col: str = "value", arrived_col: str = "arrived_at") -> DataFrame:
    """Both feeds of a shared topic -> contract."""
    a, b, _ = split_topic(messages, value_col)
    return feed_union(normalize_feed_a(a, value_col), normalize_feed_b(b, value_col, arrived_col))


def topic_rejects(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages of a shared topic that become no trade because they do not parse."""
    a, b, other = split_topic(messages, value_col)
    return (corrupt_messages(a, FEED_A_SCHEMA, value_col).unionByName(corrupt_messages(b, FEED_B_SCHEMA, value_col))
            .unionByName(other))


def feed_union(feed_a: DataFrame, feed_b: DataFrame) -> DataFrame:
    """Both normalised feeds as one frame: columns matched by name, a column
    only one feed has (conditions, exchange_id) is NULL for the other."""
    u = feed_a.unionByName(feed_b, allowMissingColumns=True)
    return u.select(*EVENT_COLUMNS, *[c for c in u.columns if c not in EVENT_COLUMNS])


def to_bronze_text(events: DataFrame) -> DataFrame:
    """Contract -> Bronze (every field as text, times ISO-8601 UTC). A field
    the feed does not carry (feed B: exchange, conditions) lands as NULL."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    have = set(events.columns)

    def text(c):
        if c not in have:
            return F.lit(None).cast("string")
        return F.date_format(c, iso) if c in ("timestamp", "ingested_at") else F.col(c).cast("string")

    return events.select(*[text(c).alias(c) for c in EVENT_COLUMNS])


# JSON message encoding keeps microseconds; Spark's default JSON timestamp
# format would cut event times to milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def encode_messages(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows -> (key, value) JSON messages, e.g. for a Kafka sink keyed by symbol."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value")
    if key_col:
        return df.select(F.col(key_col).cast("string").alias("key"), value)
    return df.select(value)


def decode_messages(messages: DataFrame, schema, value_col: str = "value") -> DataFrame:
    """JSON messages -> typed rows. Unparsable text gives no row (see
    ``corrupt_messages`` to route it)."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    m = F.from_json(value_col, whole, {**JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT})
    return (messages.select(m.alias("m")).filter(F.col("m").isNotNull() & F.col(f"m.{CORRUPT}").isNull())
                    .select(*[f"m.{f.name}" for f in schema.fields]))
