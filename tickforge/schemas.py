"""Explicit schemas for every layer: feeds, Bronze, Silver, Gold, documents.

Nothing in the engine reads with schema inference; every reader gets one of
these, and ``require_columns`` checks a frame's contract at plan time (no job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, D, TS, B = T.StringType(), T.DoubleType(), T.TimestampType(), T.BooleanType()
PRICE = T.DecimalType(18, 8)
MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# A message that does not parse is kept whole in this field.
CORRUPT = "_corrupt_record"

# Feed A event: JSON object, one per message. Numbers are read as text, as a
# feed may quote them, and cast afterwards.
FEED_A_SCHEMA = _struct(
    ("trade_id", S), ("symbol", S), ("price", S), ("quantity", S), ("notional", S),
    ("exchange", S), ("trade_type", S), ("timestamp", S), ("ingested_at", S),
    ("source", S), ("conditions", T.ArrayType(S)), (CORRUPT, S),
)

# Feed B message: a JSON array of short-keyed objects; only ev = 'XT' are trades.
FEED_B_ITEM = _struct(
    ("ev", S), ("status", S), ("message", S), ("i", S), ("pair", S),
    ("p", S), ("s", S), ("x", S), ("t", S),
)
FEED_B_SCHEMA = T.ArrayType(FEED_B_ITEM)

# Bronze: everything a string, as it lands from the topic.
BRONZE_COLUMNS = [
    "trade_id", "symbol", "price", "quantity", "notional", "exchange",
    "trade_type", "timestamp", "ingested_at", "source", "conditions",
]
BRONZE_SCHEMA = _struct(*[(c, S) for c in BRONZE_COLUMNS])
BRONZE_PARTITIONS = ["year", "month", "day", "hour"]

# Silver: typed, still double-valued (as the transform produces it).
SILVER_SCHEMA = _struct(
    ("trade_id", S), ("symbol", S), ("price", D), ("quantity", D), ("notional", D),
    ("exchange", S), ("trade_type", S), ("timestamp", TS), ("ingested_at", TS),
    ("source", S), ("conditions", S), ("trade_date", S), ("trade_hour", S),
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]
SILVER_PARTITIONS = ["trade_date", "trade_hour"]

# Gold star schema.
FACT_SCHEMA = _struct(
    ("trade_id", S), ("symbol", S), ("trade_date", T.DateType()), ("trade_hour", T.IntegerType()),
    ("price", PRICE), ("quantity", PRICE), ("notional", MONEY), ("trade_type", S),
    ("exchange", S), ("source", S), ("timestamp", TS), ("ingested_at", TS),
)
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]
# NOT NULL columns of the fact.
FACT_NOT_NULL = [c for c in FACT_COLUMNS if c != "exchange"]

DIM_INSTRUMENT_SCHEMA = _struct(
    ("symbol", S), ("base_currency", S), ("quote_currency", S), ("asset_class", S),
    ("exchange", S), ("is_active", B),
)
DIM_TIME_SCHEMA = _struct(
    ("trade_date", T.DateType()), ("year", T.IntegerType()), ("month", T.IntegerType()),
    ("day", T.IntegerType()), ("quarter", T.IntegerType()), ("day_of_week", S),
    ("day_of_week_num", T.IntegerType()), ("is_weekend", B), ("month_name", S),
)

# Declared column widths of the Gold DDL, checked by the type-bound quality check.
FIXED_VARCHAR_LIMITS = {
    "fact_trades": {"trade_id": 50, "symbol": 20, "trade_type": 20, "exchange": 50, "source": 50},
    "dim_instrument": {"symbol": 20, "base_currency": 10, "quote_currency": 10,
                       "asset_class": 20, "exchange": 50},
}


class MissingColumnsError(ValueError):
    """Raised when a frame lacks columns its consumer requires."""


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> DataFrame:
    """Fail before any job runs if ``df`` lacks one of ``columns``."""
    have = set(df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise MissingColumnsError(f"{what} is missing required columns: {missing}")
    return df
