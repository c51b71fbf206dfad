"""Table-level data-quality checks: unique, not_null, relationships,
accepted_values and the bounds implied by the Gold column types.

Each check is a lazy one-row aggregate (check_name, failures, passed); the
summary is their union. Failures are counts, never collected rows, so a check
costs one scan of its table however many rows fail.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ASSET_CLASSES, TRADE_TYPES
from ..schemas import FIXED_VARCHAR_LIMITS, MONEY, PRICE


def _rows(frame: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """One aggregate over ``frame`` computing every check, unpivoted to rows."""
    agg = frame.agg(*[c.alias(f"c{i}") for i, (_, c) in enumerate(checks)])
    stack = ", ".join(f"'{n}', c{i}" for i, (n, _) in enumerate(checks))
    return agg.select(F.expr(f"stack({len(checks)}, {stack}) AS (check_name, failures)")) \
              .withColumn("failures", F.col("failures").cast("bigint")) \
              .withColumn("passed", F.col("failures") == 0)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Row count per key value (partial aggregation first, so a hot key costs
    one row per map partition); keys with n > 1 are the violations."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts


def dq_unique(fact: DataFrame, instruments: DataFrame, dates: DataFrame) -> DataFrame:
    targets = [("unique:fact_trades.trade_id", fact, "trade_id"),
               ("unique:dim_instrument.symbol", instruments, "symbol"),
               ("unique:dim_time.trade_date", dates, "trade_date")]
    return _union([_rows(duplicate_keys(df, k), [(name, F.count_if(F.col("n") > 1))])
                   for name, df, k in targets])


def dq_not_null(fact: DataFrame, instruments: DataFrame, dates: DataFrame) -> DataFrame:
    return _union([
        _rows(fact, [("not_null:fact_trades.trade_id", F.count_if(F.col("trade_id").isNull())),
                     ("not_null:fact_trades.symbol", F.count_if(F.col("symbol").isNull())),
                     ("not_null:fact_trades.price", F.count_if(F.col("price").isNull()))]),
        _rows(instruments, [("not_null:dim_instrument.symbol", F.count_if(F.col("symbol").isNull()))]),
        _rows(dates, [("not_null:dim_time.trade_date", F.count_if(F.col("trade_date").isNull()))]),
    ])


def dq_relationships(fact: DataFrame, instruments: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows whose parent key is missing. NULL keys are not orphans (as a
    foreign key treats them). The fact's keys are counted first, so one pass
    over the fact leaves a row per (symbol, date) for both joins."""
    keys = fact.groupBy("symbol", "trade_date").agg(F.count(F.lit(1)).alias("_n"))
    sym = instruments.select(F.col("symbol").alias("_sym")).distinct()
    day = dates.select(F.col("trade_date").alias("_day")).distinct()
    tagged = (keys.join(sym, F.col("symbol") == F.col("_sym"), "left")
                  .join(day, F.col("trade_date") == F.col("_day"), "left"))

    def orphans(key, parent):
        return F.coalesce(F.sum(F.when(F.col(key).isNotNull() & F.col(parent).isNull(), F.col("_n"))), F.lit(0))

    return _rows(tagged, [("relationships:fact_trades.symbol->dim_instrument", orphans("symbol", "_sym")),
                          ("relationships:fact_trades.trade_date->dim_time", orphans("trade_date", "_day"))])


def dq_accepted_values(fact: DataFrame, instruments: DataFrame,
                       asset_classes: tuple = ASSET_CLASSES, trade_types: tuple = TRADE_TYPES) -> DataFrame:
    return _union([
        _rows(instruments, [("accepted_values:dim_instrument.asset_class",
                             F.count_if(~F.col("asset_class").isin(list(asset_classes))))]),
        _rows(fact, [("accepted_values:fact_trades.trade_type",
                      F.count_if(~F.col("trade_type").isin(list(trade_types))))]),
    ])


def dq_type_bounds(silver: DataFrame, instruments: DataFrame) -> DataFrame:
    """Values that would not fit the Gold column types: text longer than its
    VARCHAR(n), amounts outside NUMERIC(18,8) / NUMERIC(18,2)."""
    def too_long(table):
        return [(f"length:{table}.{c}<={n}", F.count_if(F.length(c) > n))
                for c, n in FIXED_VARCHAR_LIMITS[table].items()]

    def no_fit(c, t):
        return F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())

    fact_checks = too_long("fact_trades") + [
        ("numeric:fact_trades.price(18,8)", no_fit("price", PRICE)),
        ("numeric:fact_trades.quantity(18,8)", no_fit("quantity", PRICE)),
        ("numeric:fact_trades.notional(18,2)", no_fit("notional", MONEY)),
    ]
    return _union([_rows(silver, fact_checks), _rows(instruments, too_long("dim_instrument"))])


def _keyed_checks(frame: DataFrame, key: str, unique_name: str, flags: list[tuple[str, Column]]) -> DataFrame:
    """Uniqueness of ``key`` plus any number of row-level checks, in one pass:
    rows -> per-key counts and flag sums (partial aggregation on the map
    side) -> one global row -> one output row per check."""
    per_key = frame.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c.cast("int")).alias(f"_f{i}") for i, (_, c) in enumerate(flags)])
    checks = [(unique_name, F.count_if(F.col("_n") > 1))] + \
             [(n, F.coalesce(F.sum(f"_f{i}"), F.lit(0))) for i, (n, _) in enumerate(flags)]
    return _rows(per_key, checks)


def _flag(c: Column) -> Column:
    """A check predicate as a definite 0/1 (NULL counts as not failing, as
    count_if does)."""
    return F.coalesce(c, F.lit(False))


def dq_summary(silver: DataFrame, instruments: DataFrame, dates: DataFrame,
               asset_classes: tuple = ASSET_CLASSES, trade_types: tuple = TRADE_TYPES) -> DataFrame:
    """Every check of the module, with one pass per table.

    The fact-side checks read the Silver rows the fact is loaded from (the
    fact columns are casts of them, so the fact itself is not read again):
    one join to the two key sets and one shuffle by trade_id serve
    uniqueness, not-null, relationships, accepted values and type bounds.
    """
    sym = instruments.select(F.col("symbol").alias("_sym")).distinct().withColumn("_has_sym", F.lit(True))
    day = dates.select(F.col("trade_date").alias("_day")).distinct().withColumn("_has_day", F.lit(True))
    rows = silver.withColumn("_date", F.col("trade_date").cast("date"))
    tagged = (rows.join(sym, rows.symbol == sym._sym, "left")
                  .join(day, F.col("_date") == day._day, "left"))

    def no_fit(c, t):
        return F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()

    fact_flags = [
        ("not_null:fact_trades.trade_id", F.col("trade_id").isNull()),
        ("not_null:fact_trades.symbol", F.col("symbol").isNull()),
        ("not_null:fact_trades.price", F.col("price").try_cast(PRICE).isNull()),
        ("relationships:fact_trades.symbol->dim_instrument", F.col("symbol").isNotNull() & F.col("_has_sym").isNull()),
        ("relationships:fact_trades.trade_date->dim_time", F.col("_date").isNotNull() & F.col("_has_day").isNull()),
        ("accepted_values:fact_trades.trade_type", ~F.col("trade_type").isin(list(trade_types))),
        *[(f"length:fact_trades.{c}<={n}", F.length(c) > n) for c, n in FIXED_VARCHAR_LIMITS["fact_trades"].items()],
        ("numeric:fact_trades.price(18,8)", no_fit("price", PRICE)),
        ("numeric:fact_trades.quantity(18,8)", no_fit("quantity", PRICE)),
        ("numeric:fact_trades.notional(18,2)", no_fit("notional", MONEY)),
    ]
    inst_flags = [
        ("not_null:dim_instrument.symbol", F.col("symbol").isNull()),
        ("accepted_values:dim_instrument.asset_class", ~F.col("asset_class").isin(list(asset_classes))),
        *[(f"length:dim_instrument.{c}<={n}", F.length(c) > n) for c, n in FIXED_VARCHAR_LIMITS["dim_instrument"].items()],
    ]
    date_flags = [("not_null:dim_time.trade_date", F.col("trade_date").isNull())]
    return _union([
        _keyed_checks(tagged, "trade_id", "unique:fact_trades.trade_id", [(n, _flag(c)) for n, c in fact_flags]),
        _keyed_checks(instruments, "symbol", "unique:dim_instrument.symbol", [(n, _flag(c)) for n, c in inst_flags]),
        _keyed_checks(dates, "trade_date", "unique:dim_time.trade_date", [(n, _flag(c)) for n, c in date_flags]),
    ])
