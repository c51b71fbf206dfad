"""Newest trades, positions, load states and the document store: what they read and write, against plain results."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickforge.operators import load_states, newest, positions, reports
from tickforge.plans import datasets as ds
from tickforge.session import conf_override
from tickforge.sinks import writers
from tickforge.sinks.doc_store import DocumentStore


def _fact(spark, tmp_dir):
    """Thirty dates of trades, and some without one."""
    path = os.path.join(tmp_dir, "fact")
    rows = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS trade_id", "concat('S', CASE WHEN id < 40 THEN 9 ELSE id % 3 END) AS symbol", "CAST(id AS DECIMAL(18,8)) AS price",
        "CAST(1 AS DECIMAL(18,8)) AS quantity", "CAST(1 AS DECIMAL(18,2)) AS notional", "'feed_a' AS source",
        "CASE WHEN id % 500 <> 7 THEN timestampadd(SECOND, CAST(id * 864 AS INT), TIMESTAMP'2024-01-01') END AS timestamp") \
        .withColumns({"trade_date": F.to_date("timestamp"), "trade_hour": F.hour("timestamp")})
    writers.write_table(rows, path, ["trade_date"])
    return path, spark.read.parquet(path)


def _partitions_read(df):
    """Of the scan of a frame that was collected."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numPartitions").value() for m in metrics if m.contains("numPartitions"))


def test_newest_trades_read_the_newest_partition(spark, tmp_dir):
    path, fact = _fact(spark, tmp_dir)
    assert len(newest.stored_dates(spark, path)) == 31
    for limit, symbol, most in ((50, None, 1), (50, "S1", 3), (20, "S9", 31), (0, None, 0), (5000, None, 31)):
        with conf_override(spark, {"spark.sql.adaptive.enabled": "false"}):
            got = newest.recent_trades_stored(spark, path, limit, symbol)
            assert got.collect() == reports.recent_trades(fact, symbol, limit).collect()
            assert _partitions_read(got) <= most, (limit, symbol)
            if limit == 50:
                assert _partitions_read(got) > 0


def test_positions_equal_a_window_over_all_rows(spark, tmp_dir):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS k")  # a third in one key
    with conf_override(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}):
        got = positions.positioned(rows, F.desc("k"), "id")
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted(((r.k, r.id) for r in rows.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.k, r.id) for r in got.orderBy("position").collect()] == want
    assert {r.position for r in got.collect()} == set(range(1, 5001))
    assert [(r.k, r.id) for r in positions.page(got, 100, 10).orderBy("position").collect()] == want[100:110]
    assert positions.positioned(rows.limit(0), "id").count() == 0


def test_load_states_merge_to_the_figures_of_the_whole(spark, tmp_dir):
    fact = ds.fact(spark, SF_SMALL)
    path, numbers = os.path.join(tmp_dir, "states"), None
    for n in range(3):  # symbols and days that loads share, and a symbol of the last load alone
        rows = fact.filter(F.col("trade_id").cast("int") % 3 == n)
        rows = rows if n < 2 else rows.withColumn("symbol", F.when(F.col("trade_id").cast("int") % 2 == 0, F.lit("NEW/USD")).otherwise(F.col("symbol")))
        parts = rows if n == 0 else parts.unionByName(rows)  # noqa: F821
        numbers = spark.createDataFrame(
            load_states.number_symbols(numbers, rows).collect(), "symbol string, id long")
        load_states.load_state(rows, numbers).write.mode("append").parquet(path)
        stats = load_states.pipeline_stats_from_states(spark.read.parquet(path))
        assert stats.collect() == reports.pipeline_stats(parts).collect()
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert [r.id for r in numbers.orderBy("id").collect()] == list(range(1, numbers.count() + 1))
    empty = load_states.pipeline_stats_from_states(spark.read.parquet(path).limit(0)).first()
    assert (empty.total_trades, empty.trading_days, empty.symbols, empty.avg_notional) == (0, 0, 0, None)


def test_states_of_many_symbols_use_several_bitmaps(spark):
    trades = spark.range(70_000).selectExpr(
        "concat('S', id) AS symbol", "DATE'1969-12-30' + CAST(id % 5 AS INT) AS trade_date", "current_timestamp() AS ingested_at",
        "CAST(1 AS DECIMAL(18,2)) AS notional", "'UNKNOWN' AS exchange")
    state = load_states.load_state(trades, load_states.number_symbols(None, trades))
    got = load_states.pipeline_stats_from_states(state.unionByName(state)).first()
    assert (got.symbols, got.trading_days, got.total_trades, got.null_exchange_count) == (70_000, 5, 140_000, 140_000)


def _documents(spark, ids, value):
    return spark.createDataFrame([(f"d{i}", value, dt.date(2024, 1, 1)) for i in ids], "_id string, value long, day date")


def test_replacing_one_document_writes_one_bucket(spark, tmp_dir):
    store = DocumentStore(spark, os.path.join(tmp_dir, "docs"), buckets=16)
    assert store.read() is None and store.get(["d1"]) is None
    assert store.upsert(_documents(spark, range(1000), 1)) == {"inserted": 1000, "updated": 0, "buckets": 16}
    first = {f for f in store.read().inputFiles()}
    assert store.upsert(_documents(spark, [7], 2)) == {"inserted": 0, "updated": 1, "buckets": 1}
    second = {f for f in store.read().inputFiles()}
    assert len(second - first) == 1 and len(first - second) <= len(first) / 16 + 1
    assert store.upsert(_documents(spark, [7, 2000], 3))["inserted"] == 1
    assert store.upsert(_documents(spark, [], 3)) == {"inserted": 0, "updated": 0, "buckets": 0}
    again = DocumentStore(spark, os.path.join(tmp_dir, "docs"), buckets=999)  # keeps its own number of buckets
    got = {r["_id"]: r.value for r in again.read().collect()}
    assert got == {f"d{i}": 1 for i in range(1000)} | {"d7": 3, "d2000": 3}
    assert {r["_id"] for r in again.get(["d7", "nope"]).collect()} == {"d7"}
    assert again.drop_unused() and again.read().count() == 1001


def test_a_failed_upsert_leaves_the_live_version(spark, tmp_dir, monkeypatch):
    store = DocumentStore(spark, os.path.join(tmp_dir, "docs"), buckets=4)
    store.upsert(_documents(spark, range(20), 1))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(writers, "publish_version", broken)
    try:
        store.upsert(_documents(spark, range(30), 2))
    except RuntimeError:
        pass
    assert {r.value for r in store.read().collect()} == {1} and store.read().count() == 20
