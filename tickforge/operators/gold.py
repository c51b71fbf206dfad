"""Silver -> Gold: the star schema (fact_trades, dim_instrument, dim_time), its
constraints, and set-based merges (insert-if-absent) in place of per-row inserts.

Rows that break a NOT NULL, width or range constraint of the fact, or whose
instrument or date is unknown, go to a reject table with the reasons; one bad
value never fails a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import date_parts
from ..schemas import (DIM_INSTRUMENT_SCHEMA, DIM_TIME_SCHEMA, FACT_COLUMNS, FACT_NOT_NULL, FIXED_VARCHAR_LIMITS,
                       MONEY, PRICE)


def to_fact(silver: DataFrame) -> DataFrame:
    """Silver (doubles, text partitions, timestamps) -> Gold fact types.

    Timestamps are already zone-aware (session zone UTC), so naive values need
    no separate localisation step. A value that does not fit its type becomes
    NULL (see ``split_fact`` for where such rows go).
    """
    return silver.select(*[c.alias(n) for n, c in _fact_casts().items()]).select(*FACT_COLUMNS)


def _fact_casts() -> dict:
    types = {"trade_date": "date", "trade_hour": "int", "price": PRICE, "quantity": PRICE, "notional": MONEY,
             "timestamp": "timestamp", "ingested_at": "timestamp"}
    return {c: F.col(c).try_cast(types[c]) if c in types else F.col(c).cast("string") for c in FACT_COLUMNS}


def fact_violations():
    """Comma-joined reasons why a Silver row breaks the fact's NOT NULL, width
    or range constraints; '' if it breaks none."""
    casts = _fact_casts()
    missing = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in FACT_NOT_NULL]
    unfit = [F.when(F.col(c).isNotNull() & casts[c].isNull(), F.lit(f"invalid_{c}")) for c in FACT_NOT_NULL]
    wide = [F.when(F.length(c) > n, F.lit(f"long_{c}")) for c, n in FIXED_VARCHAR_LIMITS["fact_trades"].items()]
    return F.concat_ws(",", *missing, *unfit, *wide)


def split_fact(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fact, rejects): rows that fit the fact's column constraints in Gold
    types, and the others as they are in Silver, with ``reason``."""
    reason = fact_violations()
    return to_fact(silver.filter(reason == "")), silver.filter(reason != "").withColumn("reason", reason)


def reject_rows(rejects: DataFrame) -> DataFrame:
    """Rejects in the reject table's layout: every field as text, the reason,
    and a key over all of them, so that a repeated load adds nothing."""
    text = rejects.select(*[F.col(c).cast("string").alias(c) for c in (*FACT_COLUMNS, "reason")])
    return text.withColumn("reject_id", F.sha2(F.to_json(F.struct(*text.columns)), 256))


def dim_time(trades: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """One row per distinct trade date with its calendar attributes (no row for
    a NULL date: the date is the key)."""
    dates = trades.select(F.col(date_col).cast("date").alias("trade_date")).filter(F.col("trade_date").isNotNull()).distinct()
    return dates.select("trade_date", *[c.alias(n) for n, c in date_parts("trade_date").items()]) \
                .select(*[F.col(f.name).cast(f.dataType) for f in DIM_TIME_SCHEMA.fields])


def dim_instrument(trades: DataFrame, asset_class: str = "CRYPTO") -> DataFrame:
    """One row per distinct symbol: base / quote split on '/', active by default.

    Exchange is the one exchange a symbol trades on, or NULL when it trades on
    several (the dimension keeps one value per symbol).
    """
    # The distinct pairs first: a hash aggregate, which an extreme of text would not be.
    per_symbol = trades.select("symbol", "exchange").distinct().groupBy("symbol").agg(
        F.count("exchange").alias("_kinds"), F.min("exchange").alias("_exchange"))
    parts = F.split(F.col("symbol"), "/", 2)
    return per_symbol.select(
        F.col("symbol"),
        F.get(parts, 0).alias("base_currency"),
        F.get(parts, 1).alias("quote_currency"),
        F.lit(asset_class).alias("asset_class"),
        F.when(F.col("_kinds") == 1, F.col("_exchange")).alias("exchange"),
        F.lit(True).alias("is_active"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in DIM_INSTRUMENT_SCHEMA.fields])


def seed_dim_instrument(spark, rows: list[tuple]) -> DataFrame:
    """Instrument rows given by the operator (symbol, base, quote, asset_class,
    exchange), active by default, in the dimension's schema."""
    df = spark.createDataFrame(rows, "symbol string, base_currency string, quote_currency string, "
                                     "asset_class string, exchange string")
    return df.withColumn("is_active", F.lit(True)) \
             .select(*[F.col(f.name).cast(f.dataType) for f in DIM_INSTRUMENT_SCHEMA.fields])


def valid_instruments(instruments: DataFrame) -> DataFrame:
    """Instrument rows that the dimension's constraints admit: symbol, base and
    quote currency and class present, every text within its width."""
    fits = [F.col(c).isNotNull() for c in ("symbol", "base_currency", "quote_currency", "asset_class")]
    fits += [F.coalesce(F.length(c) <= n, F.lit(True)) for c, n in FIXED_VARCHAR_LIMITS["dim_instrument"].items()]
    ok = fits[0]
    for f in fits[1:]:
        ok = ok & f
    return instruments.filter(ok)


def merge_dim_instrument(stored: DataFrame, trades: DataFrame, asset_class: str = "CRYPTO") -> DataFrame:
    """Stored (e.g. seeded) instruments plus the valid ones first seen in
    ``trades``; a stored row is never replaced (insert-if-absent on symbol)."""
    return stored.unionByName(insert_new(valid_instruments(dim_instrument(trades, asset_class)), stored, "symbol"))


def insert_new(batch: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``existing`` (ON CONFLICT DO
    NOTHING). A primary key is never NULL, so rows with a NULL key are left out.

    Driven by the batch: a semi-join first reduces the stored keys to those the
    batch has, which for a small batch (by the planner's size estimate) is a
    broadcast of its keys and no shuffle of the stored ones; the anti join then
    meets those few hits. The batch itself must have each key once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = batch.dropna(subset=keys)
    hits = existing.select(*keys).join(batch.select(*keys), on=keys, how="left_semi")
    return present.join(hits, on=keys, how="left_anti").select(*batch.columns)


def insert_new_in_partitions(batch: DataFrame, existing: DataFrame, key: str, partition_col: str,
                             values: list | None = None) -> DataFrame:
    """insert_new, reading only the stored partitions the batch touches.

    The batch's distinct partition values (trade dates, NULL included: bounded
    by the calendar, a handful per batch) become a literal predicate on the
    stored table, which prunes its partitions at planning time; the anti join
    then runs on (partition, key), NULL partitions matching each other. Exact
    when a key never moves between partitions, as for re-delivered trades,
    whose event time (and so trade_date) is part of the trade. Use
    ``insert_new`` when that does not hold.

    ``values`` may be given (any superset of the batch's partition values);
    otherwise they are collected from ``batch``, which runs it once.
    """
    if values is None:
        values = [r[0] for r in batch.select(partition_col).distinct().collect()]
    part = F.col(partition_col)
    scope = part.isin([v for v in values if v is not None])
    if None in values:
        scope = scope | part.isNull()
    scoped = existing.filter(scope).select(part.alias("_part"), F.col(key).alias("_key"))
    same = F.col(key).eqNullSafe(F.col("_key")) & part.cast("string").eqNullSafe(F.col("_part").cast("string"))
    return batch.join(scoped, same, "left_anti")


def enforce_foreign_keys(fact: DataFrame, instruments: DataFrame, dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, orphans): a fact row is kept when its symbol and date both exist.

    Orphans carry a ``reason`` naming the missing parent(s).
    """
    sym = instruments.select(F.col("symbol").alias("_sym")).distinct().withColumn("_has_sym", F.lit(True))
    day = dates.select(F.col("trade_date").alias("_day")).distinct().withColumn("_has_day", F.lit(True))
    tagged = (fact.join(sym, fact.symbol == sym._sym, "left")
                  .join(day, F.col("trade_date") == day._day, "left"))
    reason = F.concat_ws(",",
                         F.when(F.col("_has_sym").isNull(), F.lit("missing_instrument")),
                         F.when(F.col("_has_day").isNull(), F.lit("missing_date")))
    tagged = tagged.withColumn("reason", reason).drop("_sym", "_has_sym", "_day", "_has_day")
    kept = tagged.filter(F.col("reason") == "").drop("reason")
    orphans = tagged.filter(F.col("reason") != "")
    return kept, orphans
