"""Plan shape checks: no Python in the plans, pruning and pushdown reach the
scan, hot-key safe operators keep their partial phases."""

import pytest

from conftest import SF_SMALL
from tickforge.plans.catalog import QUERIES
from tickforge.session import work_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_python_udf_in_plan(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p, f"{name} uses {node}"


def test_scan_reads_only_needed_columns(spark):
    # lineitem has 11 columns; the wide trades read 7 of them
    p = plan(QUERIES["mart_daily_summary_wide"](spark, SF_SMALL))
    schema = [ln for ln in p.split("\n") if "lineitem" in ln][0]
    assert "l_discount" not in schema and "l_returnflag" not in schema and "l_extendedprice" in schema


def test_day_filter_prunes_partitions(spark):
    p = plan(QUERIES["bronze_scan_day"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p


def test_recent_per_symbol_limits_before_shuffle(spark):
    p = plan(QUERIES["recent_trades_per_symbol"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_daily_mart_has_no_window_and_partial_aggregate(spark):
    p = plan(QUERIES["mart_daily_summary"](spark, SF_SMALL))
    assert "Window " not in p
    assert "partial_min_by" in p and "partial_max_by" in p


def test_recent_trades_is_top_k(spark):
    p = plan(QUERIES["recent_trades"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_cluster_sizing():
    from tickforge.session import cluster_conf

    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert int(cluster_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16


@pytest.mark.parametrize("name,fn", [("silver_dedup", "partial_min_by"), ("mart_daily_summary", "partial_min_by"),
                                     ("mart_symbol_performance", "partial_count")])
def test_hot_keys_are_pre_aggregated_before_the_shuffle(spark, name, fn):
    # a key holding a third of all rows is reduced on every mapper first:
    # the partial aggregate sits below the first exchange on its key
    p = plan(QUERIES[name](spark, SF_SMALL))
    below = p.split("Exchange hashpartitioning")[1:]
    assert any(fn in part.split("Exchange")[0] for part in below), name


def test_quality_checks_reuse_the_dedup_partitioning(spark):
    # the per-trade_id checks group on the key the dedup already shuffled by,
    # so the plan holds a single exchange on trade_id
    p = plan(QUERIES["dq_summary"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning(trade_id") == 1



def _without_aqe(spark, build):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _marts(spark, wide=True):
    from tickforge.plans import datasets as ds

    return ds.stg_trades(spark, SF_SMALL, wide)


def test_daily_mart_measures_are_hash_aggregated(spark):
    """Nothing is sorted before the first exchange of the trades: the text tie-break runs on the boundary rows only."""
    from tickforge.operators import marts

    plans, real = [], marts.staged
    marts.staged = lambda df, name: plans.append(_without_aqe(spark, lambda: df)) or real(df, name)
    try:
        marts.mart_daily_summary(_marts(spark))
    finally:
        marts.staged = real
    measures = [ln for ln in plans[0].split("\n") if "partial_count" in ln and "partial_sum" in ln]
    assert measures and all("HashAggregate" in ln for ln in measures)


def test_daily_mart_reads_trades_twice_and_shuffles_boundary_rows_only(spark):
    """With broadcast joins off, the one exchange above the second read of the trades lies behind the runtime filter."""
    from tickforge.operators import marts
    from tickforge.session import conf_override

    spark.range(20_000).selectExpr(
        "CAST(id AS STRING) AS trade_id", "concat('S', id % 3) AS symbol", "DATE'2024-01-01' AS trade_date",
        "timestampadd(SECOND, CAST(id AS INT), TIMESTAMP'2024-01-01') AS traded_at", "current_timestamp() AS ingested_at",
        "CAST(id AS DECIMAL(18,8)) AS price", "CAST(1 AS DECIMAL(18,8)) AS quantity", "CAST(1 AS DECIMAL(18,2)) AS notional",
    ).write.mode("overwrite").parquet(path := work_dir(spark, "mart-trades"))
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        mart = marts.mart_daily_summary(spark.read.parquet(path))
        p = plan(mart)
        lines = p.split("\n")
        scans = [i for i, ln in enumerate(lines) if "FileScan" in ln and "traded_at" in ln]
        assert len(scans) == 1
        exchange = max(i for i in range(scans[0]) if "Exchange hashpartitioning" in lines[i])
        between = "".join(lines[exchange:scans[0]])
        assert "getbit" in between and "BroadcastHashJoin" in between, p
        assert [(r.symbol, float(r.open_price), float(r.close_price)) for r in mart.orderBy("symbol").collect()] == [
            ("S0", 0.0, 19998.0), ("S1", 1.0, 19999.0), ("S2", 2.0, 19997.0)]


def test_runtime_filter_keeps_every_key_and_few_others(spark):
    from tickforge.operators.membership import bits_for, key_words, may_be_in

    keys = spark.range(5000).selectExpr("id * 7 AS a", "CAST(id AS STRING) AS b")
    rows = spark.range(200_000).selectExpr("id AS a", "CAST(id DIV 7 AS STRING) AS b", "id AS _x")
    kept = may_be_in(rows, ["a", "b"], key_words(keys, ["a", "b"], 5000), 5000)
    assert kept.columns == rows.columns
    assert kept.join(keys, ["a", "b"], "left_semi").count() == 5000
    assert 5000 <= kept.count() < 5000 + 195_000 / 8
    assert bits_for(0) == 64 and bits_for(10**12) == 1 << 27


def test_tick_mart_open_close_is_hash_aggregated(spark):
    from tickforge.operators import marts

    p = _without_aqe(spark, lambda: marts.mart_daily_summary_tick(_marts(spark)))
    ends = [ln for ln in p.split("\n") if "partial_min_by" in ln or "partial_minby" in ln.lower()]
    assert ends and all("HashAggregate" in ln for ln in ends) and "Window" not in p


def test_instrument_dimension_is_hash_aggregated_first(spark):
    from tickforge.operators import gold

    p = _without_aqe(spark, lambda: gold.dim_instrument(_marts(spark)))
    lines = [ln for ln in p.split("\n") if "Aggregate" in ln]
    assert "HashAggregate(keys=[symbol" in lines[-1] and "exchange" in lines[-1], p


def test_merge_with_a_small_batch_shuffles_no_stored_keys(spark, tmp_dir):
    from tickforge.operators import gold

    spark.range(200000).selectExpr("CAST(id AS STRING) AS trade_id", "id AS x").write.parquet(f"{tmp_dir}/stored")
    spark.range(10).selectExpr("CAST(id * 50000 AS STRING) AS trade_id", "id AS x").write.parquet(f"{tmp_dir}/batch")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")  # the stored keys are larger, the batch is not
    try:
        new = gold.insert_new(spark.read.parquet(f"{tmp_dir}/batch"), spark.read.parquet(f"{tmp_dir}/stored"), "trade_id")
        lines = plan(new).split("\n")
        semi = next(i for i, ln in enumerate(lines) if "LeftSemi" in ln)
        assert "BroadcastHashJoin" in lines[semi] and "BuildRight" in lines[semi]
        below = lines[semi + 1:next(i for i, ln in enumerate(lines) if i > semi and "FileScan" in ln) + 1]
        assert not any("Exchange hashpartitioning" in ln for ln in below), below
        assert new.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_silver_load_deduplicates_once(spark, tmp_dir):
    """One staged plan feeds both sinks and the counts."""
    from tickforge.operators import silver
    from tickforge.plans import datasets as ds
    from tickforge.plans import pipeline as pl
    from tickforge.sinks import writers

    writers.write_bronze(ds.bronze(spark, SF_SMALL), f"{tmp_dir}/bronze")
    calls, real = [], silver.silver_prepared
    silver.silver_prepared = lambda *a, **k: calls.append(1) or real(*a, **k)
    try:
        pl.bronze_to_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/dead", run_id="a")
    finally:
        silver.silver_prepared = real
    assert len(calls) == 1
