"""Corrections of the per-day state by signed deltas: a replaced or deleted trade is taken back, not recomputed from all.

A change is a pair of trade sets, ``gone`` and ``come`` (a replaced trade is in both, as it was and as it is). Sums and counts
change by the difference. An extreme only moves outwards when rows come; where a row that held an extreme goes, the group is
read again, alone, from the trades as they are after the change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["trade_date", "symbol"]
#: Sums that change by the difference (of an expression), and extremes (function, column).
SUMS = {"n": "1", "sum_notional": "notional", "n_notional": "IF(notional IS NULL, NULL, 1)", "sum_quantity": "quantity",
        "sum_price": "price", "n_price": "IF(price IS NULL, NULL, 1)"}
EXTREMES = {"min_price": ("min", "price"), "max_price": ("max", "price"), "first_ingested": ("min", "ingested_at"),
            "max_ingested_at": ("max", "ingested_at"), "first_traded": ("min", "traded_at"), "last_traded": ("max", "traded_at")}


def _extremes() -> list[Column]:
    return [getattr(F, how)(c).alias(name) for name, (how, c) in EXTREMES.items()]


def state_of(trades: DataFrame) -> DataFrame:
    """The state of each (trade_date, symbol): counts, exact sums and extremes."""
    sums = [F.coalesce(F.sum(F.expr(c)), F.lit(0)).alias(name) for name, c in SUMS.items()]
    return trades.groupBy(*KEY).agg(*sums, *_extremes())


def _same(left: str, right: str) -> Column:
    """Null-safe equality on the key: trades without a date have a group of their own."""
    return F.col(f"{left}.trade_date").eqNullSafe(F.col(f"{right}.trade_date")) & F.col(f"{left}.symbol").eqNullSafe(F.col(f"{right}.symbol"))


def changed_state(state: DataFrame, gone: DataFrame, come: DataFrame, trades_after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the state after the change, the keys of the groups that were read again).

    ``trades_after`` holds the trades after the change; only the groups read again are taken from it. Groups left without a
    trade go.
    """
    signed = gone.withColumn("_sign", F.lit(-1)).unionByName(come.withColumn("_sign", F.lit(1)))
    when = lambda sign, c: F.when(F.col("_sign") == sign, F.col(c))
    delta = signed.groupBy(*KEY).agg(
        *[F.coalesce(F.sum(F.expr(c) * F.col("_sign")), F.lit(0)).alias(f"d_{name}") for name, c in SUMS.items()],
        *[getattr(F, how)(when(1, c)).alias(f"come_{name}") for name, (how, c) in EXTREMES.items()],
        *[getattr(F, how)(when(-1, c)).alias(f"gone_{name}") for name, (how, c) in EXTREMES.items()])
    joined = state.alias("s").join(delta.alias("d"), _same("s", "d"), "full_outer")
    held = F.lit(False)
    for name, (how, _) in EXTREMES.items():
        old, left = F.col(f"s.{name}"), F.col(f"d.gone_{name}")
        held = held | F.coalesce(left <= old if how == "min" else left >= old, F.lit(False))
    merged = joined.select(
        *[F.coalesce(f"s.{k}", f"d.{k}").alias(k) for k in KEY],
        *[(F.coalesce(f"s.{name}", F.lit(0)) + F.coalesce(f"d.d_{name}", F.lit(0))).cast(state.schema[name].dataType).alias(name) for name in SUMS],
        *[(F.least if how == "min" else F.greatest)(f"s.{name}", f"d.come_{name}").alias(name) for name, (how, _) in EXTREMES.items()],
        held.alias("_again")).filter("n > 0")
    again = merged.filter("_again").select(*KEY)
    rows = trades_after.alias("t").join(again.alias("a"), _same("t", "a"), "left_semi")
    return merged.filter(~F.col("_again")).drop("_again").unionByName(state_of(rows).select(*state.columns)), again

