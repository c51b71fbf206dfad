"""Column-level helpers: tiers, labels, date parts and display strings.

All are built-in expressions (JVM side, inside whole-stage codegen); none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier thresholds, tier names, majors list and display patterns.
LARGE_CAP_ABOVE = 50000
MID_CAP_ABOVE = 1000
PRICE_TIERS = ("large_cap", "mid_cap", "small_cap")
VOLATILITY_LOW_BELOW = 100
VOLATILITY_MEDIUM_BELOW = 500
VOLATILITY_TIERS = ("LOW", "MEDIUM", "HIGH")
MAJOR_BASES = ("BTC", "ETH")
ASSET_CLASSES = ("CRYPTO", "EQUITY", "FX")
TRADE_TYPES = ("CRYPTO", "EQUITY")
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_DISPLAY = "yyyy-MM-dd HH:mm:ss"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_tier(price: str | Column = "price",
               large_above: float = LARGE_CAP_ABOVE, mid_above: float = MID_CAP_ABOVE) -> Column:
    """large_cap / mid_cap / small_cap; a NULL price falls through to small_cap."""
    p = col(price)
    return (F.when(p > large_above, "large_cap")
             .when(p > mid_above, "mid_cap")
             .otherwise("small_cap"))


def volatility_tier(stddev: str | Column = "price_stddev",
                    low_below: float = VOLATILITY_LOW_BELOW,
                    medium_below: float = VOLATILITY_MEDIUM_BELOW) -> Column:
    """LOW / MEDIUM / HIGH over the price stddev; NULL (single trade) counts as 0."""
    s = F.coalesce(col(stddev).cast("double"), F.lit(0.0))
    return F.when(s < low_below, "LOW").when(s < medium_below, "MEDIUM").otherwise("HIGH")


def display_name(base: str | Column = "base_currency", quote: str | Column = "quote_currency") -> Column:
    """'BASE / QUOTE'; NULL in gives NULL out, as SQL ``||`` does."""
    return F.concat(col(base), F.lit(" / "), col(quote))


def is_major(base: str | Column = "base_currency", majors: tuple = MAJOR_BASES) -> Column:
    return F.coalesce(col(base).isin(list(majors)), F.lit(False))


def hour_label(hour: str | Column = "trade_hour") -> Column:
    """'HH:00' from an hour number."""
    return F.format_string("%02d:00", col(hour).cast("int"))


def ts_text(ts: str | Column, pattern: str = TS_TEXT) -> Column:
    """Timestamp as fixed-format text (UTC session zone)."""
    return F.date_format(col(ts), pattern)


def date_text(d: str | Column) -> Column:
    return F.date_format(col(d), "yyyy-MM-dd")


def money_text(x: str | Column, places: int = 4) -> Column:
    """'$1,234.5000' style display text."""
    return F.concat(F.lit("$"), F.format_number(col(x).cast("double"), places))


def to_double2(x: str | Column) -> Column:
    """Round a decimal half-up to 2 places, then hand it out as double."""
    return F.round(col(x), 2).cast("double")


def date_parts(d: str | Column = "trade_date") -> dict[str, Column]:
    """Calendar attributes of a date: the time-dimension columns."""
    c = col(d)
    iso =((F.dayofweek(c) + 5) % 7 + 1).cast("int")  # Sunday=1..Saturday=7 -> Monday=1..Sunday=7
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "quarter": F.quarter(c),
        "day_of_week": F.date_format(c, "EEEE"),
        "day_of_week_num": iso,
        "is_weekend": iso.isin(6, 7),
        "month_name": F.date_format(c, "MMMM"),
    }


_E20 = "CAST('100000000000000000000' AS DECIMAL(38,0))"
_E18 = "CAST('1000000000000000000' AS DECIMAL(38,0))"


def time_price_key(ts: str | Column = "traded_at", price: str | Column = "price") -> Column:
    """(event time, price) packed into one decimal(38,0) with the same order.

    key = micros * 1e20 + (price * 1e8 + 1e18), valid for decimal(18,8) prices
    (|price * 1e8| < 1e18) and any timestamp of years 1..9999. A fixed-width
    ordering key keeps min_by / max_by in a hash aggregate; a struct key would
    force a sort-based aggregate.
    """
    return (F.unix_micros(col(ts)).cast("decimal(38,0)") * F.expr(_E20)
            + (col(price).cast("decimal(18,8)") * 100000000).cast("decimal(38,0)") + F.expr(_E18))
