"""Named frames of the medallion flow, built lazily from a table directory.

These are the shared inputs of the registered queries: each function returns a
plan (no action runs), so a query that uses several of them is still one
Catalyst plan with shared scans pruned to the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, marts, silver
from ..sources import fixtures


# ---- Bronze -> Silver over the dirty Bronze fixture --------------------------------

def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze_from_events(spark, sf_dir)


def silver_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_prepared(bronze(spark, sf_dir))


def silver_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quality_good(silver_prepared(spark, sf_dir))


def silver_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quality_split(silver_prepared(spark, sf_dir))[1]


def silver_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold fact rows loaded from the Bronze pipeline's Silver output: those
    that fit the fact's column constraints."""
    return gold.split_fact(silver_good(spark, sf_dir))[0]


def seeded_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded instruments plus the valid ones that the Bronze pipeline loads."""
    return gold.merge_dim_instrument(gold.seed_dim_instrument(spark, fixtures.SEED_INSTRUMENTS), silver_fact(spark, sf_dir))


def silver_loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fact, rejects) of a load: constraints on columns, then on keys against
    the merged instruments and the dates of the fact."""
    typed, bad = gold.split_fact(silver_good(spark, sf_dir))
    kept, orphans = gold.enforce_foreign_keys(typed, seeded_instruments(spark, sf_dir), gold.dim_time(silver_fact(spark, sf_dir)))
    return kept, gold.reject_rows(bad).unionByName(gold.reject_rows(orphans))


def raw_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze typed and derived, neither deduplicated nor filtered: what the
    quality checks are pointed at, as it holds violations of every kind."""
    return silver.add_derived_columns(silver.cast_types(bronze(spark, sf_dir)))


# ---- Gold star schema over the clean trade fixture --------------------------------

def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold fact: clean trades that pass the quality rules."""
    return silver.quality_good(fixtures.trades_from_events(spark, sf_dir))


def wide_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quality_good(fixtures.wide_trades(spark, sf_dir))


def dim_time(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return gold.dim_time(wide_fact(spark, sf_dir) if wide else fact(spark, sf_dir))


def dim_instrument(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return gold.dim_instrument(wide_fact(spark, sf_dir) if wide else fact(spark, sf_dir))


def stg_trades(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return marts.stg_trades(wide_fact(spark, sf_dir) if wide else fact(spark, sf_dir))


def stg_instruments(spark: SparkSession, sf_dir: str, wide: bool = False,
                    majors: tuple = ("CLICK", "VIEW")) -> DataFrame:
    """Majors default to two of the fixture's symbols so the flag is exercised."""
    return marts.stg_instruments(dim_instrument(spark, sf_dir, wide), majors)


def listed_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments of the wide trades; those without a trade on the newest trade date are inactive."""
    last = wide_fact(spark, sf_dir).groupBy("symbol").agg(F.max("trade_date").alias("last_date"))
    newest = wide_fact(spark, sf_dir).agg(F.max("trade_date").alias("newest"))
    listed = last.join(F.broadcast(newest), F.col("last_date") == F.col("newest"), "left_semi").select("symbol", F.lit(True).alias("listed"))
    return (dim_instrument(spark, sf_dir, wide=True).join(listed, "symbol", "left")
            .withColumn("is_active", F.coalesce("listed", F.lit(False))).drop("listed"))


def mart_daily_summary(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """The time dimension here is derived from these same trades, so its
    attributes are computed on the aggregated rows (no second pass)."""
    return marts.mart_daily_summary(stg_trades(spark, sf_dir, wide))


def mart_daily_summary_tick(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return marts.mart_daily_summary_tick(stg_trades(spark, sf_dir, wide))


def mart_symbol_performance(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return marts.mart_symbol_performance(stg_trades(spark, sf_dir, wide), stg_instruments(spark, sf_dir, wide))


# ---- Raw input against the reference dimensions --------------------------------------

def raw_checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(fact, dim_instrument, dim_time, silver) for the quality checks: the raw
    rows in Gold and in Silver types, and the reference dimensions built from
    the clean trades."""
    # Separate builds on purpose: one DataFrame object used in two branches of
    # a plan makes the analyzer re-instance the whole shared subtree.
    return (gold.to_fact(raw_silver(spark, sf_dir)), dim_instrument(spark, sf_dir), dim_time(spark, sf_dir),
            raw_silver(spark, sf_dir))


# ---- portfolio documents ---------------------------------------------------------

def portfolio_documents(spark: SparkSession, sf_dir: str, from_bronze: bool = False) -> DataFrame:
    """Documents over the clean Gold fact, or over the fact the Bronze pipeline
    loads (its dimensions then derived from that fact itself). Each branch
    builds its own fact frame (see ``raw_checked``)."""
    from ..operators import documents

    def f():
        return silver_fact(spark, sf_dir) if from_bronze else fact(spark, sf_dir)

    perf = marts.mart_symbol_performance(marts.stg_trades(f()),
                                         marts.stg_instruments(gold.dim_instrument(f()), ("CLICK", "VIEW")))
    daily = marts.mart_daily_summary(marts.stg_trades(f()))
    return documents.portfolio_documents(perf, documents.recent_trades_per_symbol(f()), daily)
