"""Gold and mart semantics on hand-made rows."""

import datetime as dt
from decimal import Decimal

from tickforge.operators import gold, marts, quality, reports
from tickforge.schemas import FACT_SCHEMA

D = Decimal


def fact(spark, rows):
    out = []
    for i, (sym, day, ts, price, qty) in enumerate(rows):
        t = dt.datetime.combine(day, ts)
        out.append((str(i), sym, day, t.hour, D(price), D(qty), (D(price) * D(qty)).quantize(D("0.01")),
                    "CRYPTO", "EX1", "feed_a", t, t))
    return spark.createDataFrame(out, FACT_SCHEMA)


SAT, SUN, MON = dt.date(2024, 3, 9), dt.date(2024, 3, 10), dt.date(2024, 3, 11)


def test_dim_time_weekdays(spark):
    f = fact(spark, [("A/USD", d, dt.time(1), "1", "1") for d in (SAT, SUN, MON)])
    got = {r.trade_date: (r.day_of_week, r.day_of_week_num, r.is_weekend, r.quarter, r.month_name)
           for r in gold.dim_time(f).collect()}
    assert got[SAT] == ("Saturday", 6, True, 1, "March")
    assert got[SUN] == ("Sunday", 7, True, 1, "March")
    assert got[MON] == ("Monday", 1, False, 1, "March")


def test_open_close_tie_break_on_trade_id(spark):
    t = dt.time(12)
    f = fact(spark, [("A/USD", MON, t, "10", "1"), ("A/USD", MON, t, "30", "1"), ("A/USD", MON, t, "20", "1")])
    m = marts.mart_daily_summary(marts.stg_trades(f), gold.dim_time(f)).collect()[0]
    # ids '0', '1', '2' all at the same time: open = id '0', close = id '2'
    assert (m.open_price, m.close_price) == (D("10.00"), D("20.00"))
    assert (m.low_price, m.high_price, m.avg_price, m.trade_count) == (D("10.00"), D("30.00"), D("20.00"), 3)


def test_tick_grain_mart_one_row_per_tick(spark):
    f = fact(spark, [("A/USD", MON, dt.time(1), "10", "1"), ("A/USD", MON, dt.time(2), "30", "1"),
                     ("A/USD", MON, dt.time(2), "30", "2")])
    rows = marts.mart_daily_summary_tick(marts.stg_trades(f), gold.dim_time(f)).collect()
    assert len(rows) == 2
    assert {(r.trade_count, r.low_price) for r in rows} == {(1, D("10.00")), (2, D("30.00"))}
    assert {(r.open_price, r.close_price) for r in rows} == {(D("10.00"), D("30.00"))}


def test_single_trade_stddev_null_and_rank_gaps(spark):
    f = fact(spark, [("A/USD", MON, dt.time(1), "5", "2"), ("B/USD", MON, dt.time(1), "10", "1"),
                     ("C/USD", MON, dt.time(1), "1", "1"), ("C/USD", SUN, dt.time(1), "3", "1")])
    inst = marts.stg_instruments(gold.dim_instrument(f), ("A",))
    perf = {r.symbol: r for r in marts.mart_symbol_performance(marts.stg_trades(f), inst).collect()}
    assert perf["A/USD"].price_stddev is None
    assert perf["A/USD"].volume_rank == perf["B/USD"].volume_rank == 1  # tie on 10.00
    assert perf["C/USD"].volume_rank == 3                               # gap after a tie
    assert perf["C/USD"].activity_rank == 1 and perf["A/USD"].activity_rank == 2
    assert perf["C/USD"].trading_days == 2 and perf["A/USD"].is_major_coin is True
    prof = {r.symbol: r.volatility for r in reports.asset_profile(marts.mart_symbol_performance(
        marts.stg_trades(f), inst)).collect()}
    assert prof["A/USD"] == "LOW"


def test_price_tiers(spark):
    f = fact(spark, [("A/USD", MON, dt.time(1), p, "1") for p in ("50000.01", "50000", "1000", "1000.01")])
    tiers = sorted(r.price_tier for r in marts.stg_trades(f).collect())
    assert tiers == ["large_cap", "mid_cap", "mid_cap", "small_cap"]


def test_missing_instrument_is_orphan_and_dropped_from_perf(spark):
    f = fact(spark, [("A/USD", MON, dt.time(1), "1", "1"), ("Z/USD", MON, dt.time(1), "1", "1")])
    inst = gold.dim_instrument(f.filter("symbol = 'A/USD'"))
    kept, orphans = gold.enforce_foreign_keys(f, inst, gold.dim_time(f))
    assert [r.symbol for r in kept.collect()] == ["A/USD"]
    assert [(r.symbol, r.reason) for r in orphans.collect()] == [("Z/USD", "missing_instrument")]
    perf = marts.mart_symbol_performance(marts.stg_trades(f), marts.stg_instruments(inst))
    assert [r.symbol for r in perf.collect()] == ["A/USD"]
    rel = {r.check_name: r.failures for r in quality.dq_relationships(f, inst, gold.dim_time(f)).collect()}
    assert rel["relationships:fact_trades.symbol->dim_instrument"] == 1


def test_long_symbol_fails_type_bound(spark):
    f = fact(spark, [("A_VERY_LONG_SYMBOL_NAME/USD", MON, dt.time(1), "1", "1")])
    checks = {r.check_name: r for r in quality.dq_type_bounds(f, gold.dim_instrument(f)).collect()}
    assert checks["length:fact_trades.symbol<=20"].failures == 1
    assert checks["length:dim_instrument.symbol<=20"].passed is False
    assert checks["length:dim_instrument.base_currency<=10"].failures == 1


def test_insert_new_is_idempotent(spark):
    f = fact(spark, [("A/USD", MON, dt.time(h), "1", "1") for h in range(3)])
    assert gold.insert_new(f, f, "trade_id").count() == 0
    assert gold.insert_new(f, f.filter("trade_id = '0'"), "trade_id").count() == 2


def test_hourly_pivot_fills_zero(spark):
    f = fact(spark, [("A/USD", MON, dt.time(3), "2", "1"), ("B/USD", MON, dt.time(5), "4", "1")])
    p = {r.symbol: r for r in reports.hourly_pivot(reports.hourly_volume(f)).collect()}
    assert p["A/USD"].h03 == 1 and p["A/USD"].h05 == 0 and p["B/USD"].h05 == 1
    assert len(p["A/USD"]) == 25


def test_partition_scoped_insert_matches_global(spark):
    f = fact(spark, [("A/USD", d, dt.time(h), "1", "1") for d in (SAT, SUN, MON) for h in range(2)])
    stored = f.filter("trade_date != DATE'2024-03-11' OR trade_id = '4'")
    a = gold.insert_new(f, stored, "trade_id")
    b = gold.insert_new_in_partitions(f, stored, "trade_id", "trade_date")
    assert sorted(r.trade_id for r in a.collect()) == sorted(r.trade_id for r in b.collect()) == ["5"]
    plan = gold.insert_new_in_partitions(f, stored, "trade_id", "trade_date")._jdf.queryExecution() \
               .optimizedPlan().toString()
    assert "IN (" in plan.upper() or "INSET" in plan.upper()


def test_seeded_instruments_merge(spark):
    f = fact(spark, [("A/USD", MON, dt.time(1), "1", "1"), ("B/USD", MON, dt.time(1), "1", "1")])
    seed = gold.seed_dim_instrument(spark, [("A/USD", "A", "USD", "CRYPTO", "SEEDED")])
    merged = {r.symbol: r for r in gold.merge_dim_instrument(seed, f).collect()}
    assert set(merged) == {"A/USD", "B/USD"}
    assert merged["A/USD"].exchange == "SEEDED" and merged["B/USD"].exchange == "EX1"
    assert merged["B/USD"].base_currency == "B" and merged["B/USD"].is_active is True


def test_symbol_mart_from_daily_state_equals_direct(spark):
    from conftest import SF_SMALL
    from tickforge.plans import datasets as ds

    for wide in (False, True):
        stg = ds.stg_trades(spark, SF_SMALL, wide)
        inst = ds.stg_instruments(spark, SF_SMALL, wide)
        direct = {r.symbol: r.asDict() for r in marts.mart_symbol_performance(stg, inst).collect()}
        rolled = {r.symbol: r.asDict() for r in
                  marts.mart_symbol_performance_from_state(marts.daily_state(stg), inst).collect()}
        assert direct.keys() == rolled.keys()
        for sym, a in direct.items():
            b = rolled[sym]
            for k in a:
                if k == "price_stddev" and a[k] is not None:
                    assert abs(a[k] - b[k]) <= D("0.01"), (sym, k)
                else:
                    assert a[k] == b[k], (sym, k, a[k], b[k])


def test_days_without_a_dimension_row_have_no_mart_row(spark):
    f = fact(spark, [("A/USD", d, dt.time(1), "1", "1") for d in (SAT, SUN, MON)])
    days = gold.dim_time(f).filter("trade_date <> DATE'2024-03-10'")
    assert {r.trade_date for r in marts.mart_daily_summary(marts.stg_trades(f), days).collect()} == {SAT, MON}
