"""End-to-end runs over files: Bronze -> Silver -> Gold -> marts -> documents,
re-runs, and the streaming form against the batch form."""

import datetime as dt
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickforge.plans import datasets as ds
from tickforge.plans import pipeline as pl
from tickforge.schemas import BRONZE_COLUMNS, SILVER_SCHEMA
from tickforge.sinks import writers
from tickforge.sinks.key_index import KeyIndex
from tickforge.sources import layers
from tickforge.streaming import pipeline as st
from tickforge.streaming.totals import FOLD_AT, EpochTotals


def test_bronze_round_trip_and_day_pruning(spark, tmp_dir):
    b = ds.bronze(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "bronze")
    writers.write_bronze(b, path)
    back = layers.read_bronze_records(spark, path)
    assert back.exceptAll(b).count() == 0 and b.exceptAll(back).count() == 0
    day = layers.read_bronze(spark, path, batch_date="2024-01-02")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024" in plan
    assert day.filter(~F.col("ingested_at").startswith("2024-01-02")).count() == 0
    empty = os.path.join(tmp_dir, "empty")
    writers.write_bronze(b.limit(0), empty)
    try:
        layers.read_bronze(spark, path, batch_date="1999-01-01", require_rows=True)
        raise AssertionError("expected EmptyInputError")
    except layers.EmptyInputError:
        pass


def test_full_pipeline_is_idempotent(spark, tmp_dir):
    bronze, silver, dead = (os.path.join(tmp_dir, n) for n in ("bronze", "silver", "dead"))
    writers.write_bronze(ds.bronze(spark, SF_SMALL), bronze)
    m1 = pl.bronze_to_silver(spark, bronze, silver, dead, run_id="r1")
    expected = ds.silver_good(spark, SF_SMALL).count()
    assert m1.rows_written == expected and m1.rows_dead_letter > 0 and m1.status == "PARTIAL"
    assert m1.rows_read == m1.rows_after_dedup + m1.duplicates_removed
    m2 = pl.bronze_to_silver(spark, bronze, silver, dead, run_id="r2")
    assert m2.rows_written == 0 and m2.rows_already_present == expected
    assert layers.read_silver(spark, silver).count() == expected
    m3 = pl.bronze_to_silver(spark, bronze, silver, dead, run_id="r3", key_scope="partition")
    assert m3.rows_written == 0 and m3.rows_already_present == expected

    gold_base, marts_base, docs = (os.path.join(tmp_dir, n) for n in ("gold", "marts", "docs"))
    c1 = pl.silver_to_gold(spark, silver, gold_base)
    c2 = pl.silver_to_gold(spark, silver, gold_base)
    loaded, rejected = c1["fact_trades"]["inserted"], c1["fact_rejects"]["inserted"]
    assert loaded > 0 and rejected > 0 and loaded + rejected == expected
    assert {v["inserted"] for v in c2.values()} == {0}
    assert c2["fact_trades"]["skipped"] == loaded and c2["fact_rejects"]["skipped"] == rejected
    fact, dates = spark.read.parquet(f"{gold_base}/fact_trades"), spark.read.parquet(f"{gold_base}/dim_time")
    assert fact.filter("trade_date IS NULL OR price IS NULL").count() == 0 and dates.filter("trade_date IS NULL").count() == 0
    pl.gold_to_marts(spark, gold_base, marts_base)
    daily_before = spark.read.parquet(f"{marts_base}/mart_daily_summary")
    perf_before = spark.read.parquet(f"{marts_base}/mart_symbol_performance").collect()
    n_daily = daily_before.count()
    some_day = str(daily_before.agg(F.min("trade_date")).first()[0])
    pl.gold_to_marts(spark, gold_base, marts_base, dates=[some_day])   # incremental refresh of one day
    assert spark.read.parquet(f"{marts_base}/mart_daily_summary").count() == n_daily
    assert sorted(spark.read.parquet(f"{marts_base}/mart_symbol_performance").collect()) == sorted(perf_before)
    r1 = pl.marts_to_documents(spark, gold_base, marts_base, docs, run_time="2024-02-01T00:00:00Z")
    r2 = pl.marts_to_documents(spark, gold_base, marts_base, docs, run_time="2024-02-02T00:00:00Z")
    assert r1["path"] != r2["path"] and writers.current_version(spark, docs) == r2["path"]
    assert r1["inserted"] > 0 and r1["updated"] == 0
    assert r2["inserted"] == 0 and r2["updated"] == r1["inserted"]
    live = writers.read_version(spark, docs)
    assert live.count() == spark.read.parquet(f"{marts_base}/mart_symbol_performance").count()
    assert live.filter("metadata.last_updated = '2024-02-02T00:00:00Z'").count() == live.count()


def test_stream_equals_batch(spark, tmp_dir):
    landing, silver, dead, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "silver", "dead", "ckpt"))
    st.land_by_arrival_day(ds.bronze(spark, SF_SMALL), landing)
    q = st.start_silver_stream(st.bronze_file_source(spark, landing, 8), silver, dead, ckpt)
    q.awaitTermination()
    totals = st.progress_totals(spark, ckpt)
    assert totals["input_rows"] == ds.bronze(spark, SF_SMALL).count() and totals["batches"] >= 2
    assert totals["dead_letter_rows"] > 0
    # which of two copies arrives first depends on the order of the files
    streamed = layers.read_silver(spark, silver).drop("ingested_at")
    batch = layers.read_silver(spark, _write_batch_silver(spark, tmp_dir)).drop("ingested_at")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def _bronze_rows(spark, rows):
    """Bronze rows from (trade_id, timestamp, ingested_at)."""
    full = [(i, "A/USD", "1.5", "2", "3.0", None, "CRYPTO", t, a, "feed_a", None) for i, t, a in rows]
    return spark.createDataFrame(full, ", ".join(f"`{c}` string" for c in BRONZE_COLUMNS))


def test_replayed_epochs_and_null_dates_add_nothing(spark, tmp_dir):
    rows = _bronze_rows(spark, [("1", "2024-01-01T10:00:00Z", "2024-01-01T10:00:01Z"), ("2", "not a time", "2024-01-01T10:00:02Z"),
                                ("3", "999999999999999999", "2024-01-01T10:00:03Z")])
    for scope in ("global", "partition", "index"):
        silver, dead, ckpt = (os.path.join(tmp_dir, f"{scope}-{n}") for n in ("silver", "dead", "ckpt"))
        run = st.silver_batch_writer(silver, dead, ckpt, key_scope=scope)
        for epoch in (0, 0, 1):
            run(rows, epoch)
        got = layers.read_silver(spark, silver)
        assert sorted(r.trade_id for r in got.collect()) == ["1", "2", "3"]
        assert st.progress_totals(spark, ckpt) == {"batches": 2, "input_rows": 6, "dead_letter_rows": 0, "stored_rows": 0}


def test_stream_dedup_keeps_late_first_arrivals(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "out", "ckpt"))
    times = ["12:00", "13:00", "13:01", "13:02", "12:10", "13:03"]
    for i, t in enumerate(times):  # one file each, in order of arrival at the landing folder
        _bronze_rows(spark, [(i_, "2024-01-01T09:00:00Z", f"2024-01-01T{t}:00Z") for i_ in (str(i), "0")]).coalesce(1) \
            .write.mode("append").json(landing)
    _bronze_rows(spark, [("null-time", None, None)]).write.mode("append").json(landing)
    q = st.dedup_stream(st.bronze_file_source(spark, landing, 1), out, ckpt)
    q.awaitTermination()
    assert sorted(r.trade_id for r in spark.read.parquet(out).collect()) == ["0", "1", "2", "3", "4", "5", "null-time"]
    assert st.progress_totals(spark, ckpt)["input_rows"] == 13


def _dedup_files(spark, tmp_dir, files):
    """Streams files of (id, event time, arrival), one an epoch; the ids stored, and what each epoch read of stored keys."""
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "out", "ckpt"))
    for rows in files:
        _bronze_rows(spark, rows).coalesce(1).write.mode("append").json(landing)
        time.sleep(0.01)
    lookups, real = [], KeyIndex.absent
    KeyIndex.absent = lambda self, batch: lookups.append(sorted(r[0] for r in batch.select("trade_id").collect())) or real(self, batch)
    try:
        q = st.dedup_stream(st.bronze_file_source(spark, landing, 1), out, ckpt, delay="1 hour")
        q.awaitTermination()
    finally:
        KeyIndex.absent = real
    return sorted(r.trade_id for r in spark.read.parquet(out).collect()), lookups, q, ckpt


def test_stream_dedup_state_is_bounded_and_on_time_rows_read_no_stored_key(spark, tmp_dir):
    day = "2024-01-01T{}:00Z".format
    on_time = [[(f"{h}-{i}", day(f"{h:02d}:30"), day(f"{h:02d}:31")) for i in range(5)]
               + [(f"{h - 1}-0", day(f"{h - 1:02d}:30"), day(f"{h:02d}:31"))] * (h > 0) for h in range(8)]
    ids, lookups, q, ckpt = _dedup_files(spark, tmp_dir, on_time)
    assert ids == sorted(f"{h}-{i}" for h in range(8) for i in range(5))
    assert lookups == [] and st.progress_totals(spark, ckpt)["late_rows"] == 0
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) <= 20  # three or four hours of five keys, of eight


def test_stream_dedup_finds_late_rows_by_the_index(spark, tmp_dir):
    day = "2024-01-01T{}:00Z".format
    files = [[("a", day("01:00"), day("01:01"))], [("b", day("08:00"), day("08:01"))], [("c", day("08:10"), day("08:11"))],
             # late: a copy that the state has forgotten, one in two copies that is new, one without a time, one ahead of its arrival
             [("a", day("01:00"), day("08:30")), ("d", day("02:00"), day("08:30")), ("d", day("02:00"), day("08:31")), ("e", None, day("08:30")),
              ("f", "2030-01-01T00:00:00Z", day("08:30")), ("b", day("08:00"), day("08:30"))],
             [("d", day("02:00"), day("08:40")), ("e", "not a time", day("08:41")), ("g", day("08:20"), day("08:41")), (None, day("08:20"), day("08:41"))]]
    ids, lookups, _, ckpt = _dedup_files(spark, tmp_dir, files)
    assert ids == list("abcdefg")
    assert lookups and all(k in "adef" for ks in lookups for k in ks)
    assert st.progress_totals(spark, ckpt)["stored_rows"] == 7


def test_dedup_epochs_that_fail_are_repeated_exactly(spark, tmp_dir):
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")

    def epoch_of(ids):
        """What an epoch gets whose keys the state has all let through."""
        rows = _bronze_rows(spark, [(str(i), "2024-01-01T09:00:00Z", "2024-01-01T09:00:01Z") for i in ids]).withColumn("_clock", st._clock())
        return rows.withColumn("_raw", F.lit(True)).unionByName(
            rows.select("trade_id", "_clock").withColumn("_raw", F.lit(False)), allowMissingColumns=True)

    rows = epoch_of(range(6))
    run = st.dedup_batch_writer(out, ckpt, "1 hour", buckets=4)
    run(rows, 0)
    run(rows, 0)  # complete: nothing again
    real, KeyIndex.done = KeyIndex.done, lambda self, tag: (_ for _ in ()).throw(RuntimeError("lost"))
    more = epoch_of(range(6, 9))
    try:
        with pytest.raises(RuntimeError):
            run(more, 1)
    finally:
        KeyIndex.done = real
    run(more, 1)
    assert sorted(r.trade_id for r in spark.read.parquet(out).collect()) == [str(i) for i in range(9)]


def test_totals_of_a_long_stream_are_complete_in_few_files(spark, tmp_dir):
    ckpt = os.path.join(tmp_dir, "ckpt")
    totals = EpochTotals(spark, ckpt)
    for epoch in range(200):  # notes as ``note`` leaves them, without a job each
        folder = f"{ckpt}-counts/epochs/{epoch:010d}"
        os.makedirs(folder)
        pq.write_table(pa.table({"epoch": [epoch], "input_rows": [3]}), f"{folder}/part.parquet")
        open(f"{folder}/_SUCCESS", "w").close()
        if epoch % FOLD_AT == FOLD_AT - 1:
            totals.fold(epoch - 1)
    totals.note(7, input_rows=4)  # replayed after it was folded
    got = st.progress_totals(spark, ckpt)
    files = sum(f.endswith(".parquet") for _, _, fs in os.walk(f"{ckpt}-counts") for f in fs)
    assert got == {"batches": 200, "input_rows": 601} and files < 2 * FOLD_AT


def test_landing_keeps_rows_without_arrival_time(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    st.land_by_arrival_day(_bronze_rows(spark, [("1", None, None), ("2", None, "junk"), ("3", None, "2024-01-01T00:00:00Z")]), landing)
    assert spark.read.option("recursiveFileLookup", "true").json(landing).count() == 3


def test_hot_partition_is_split_when_written(spark, tmp_dir):
    """One hot date becomes several files, which a repartition by date would not allow."""
    rows = spark.range(200000).selectExpr("CAST(id AS STRING) AS trade_id", "uuid() AS pad", "DATE'2024-01-01' AS trade_date")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        writers.write_table(rows.repartition(8), os.path.join(tmp_dir, "t"), ["trade_date"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(os.path.join(tmp_dir, "t", "trade_date=2024-01-01")) if f.endswith(".parquet")]
    assert len(files) > 1


def test_gold_load_rejects_bad_rows_and_keeps_seeds(spark, tmp_dir):
    silver, gold_base = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "gold")
    nan, inf = float("nan"), 1e11
    rows = [("1", "A/USD", 1.0, "2024-01-01"), ("2", "ZZZ", 1.0, "2024-01-01"), ("3", "A/USD", nan, "2024-01-01"),
            ("4", "A/USD", inf, "2024-01-01"), ("5", "A/USD", 1.0, None), ("6" * 60, "A/USD", 1.0, "2024-01-01"), ("7", "SEED", 1.0, "2024-01-01")]
    full = [(i, s, p, 1.0, 1.0, "EX", "CRYPTO", None if d is None else dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6), "feed_a",
             "NONE", d, None if d is None else "05") for i, s, p, d in rows]
    writers.write_silver(spark.createDataFrame(full, SILVER_SCHEMA), silver)
    seed = [("SEED", "SEED", "USD", "CRYPTO", None)]
    pl.silver_to_gold(spark, silver, gold_base, seed=seed)
    again = pl.silver_to_gold(spark, silver, gold_base, seed=seed)
    assert {v["inserted"] for v in again.values()} == {0}
    assert sorted(r.trade_id for r in spark.read.parquet(f"{gold_base}/fact_trades").collect()) == ["1", "7"]
    assert sorted(r.symbol for r in spark.read.parquet(f"{gold_base}/dim_instrument").collect()) == ["A/USD", "SEED"]
    reasons = {r.trade_id[:1]: r.reason for r in spark.read.parquet(f"{gold_base}/fact_rejects").collect()}
    assert reasons["2"] == "missing_instrument" and reasons["3"] == reasons["4"] == "invalid_price" and reasons["6"] == "long_trade_id"
    assert reasons["5"].startswith("null_trade_date")


def _write_batch_silver(spark, tmp_dir):
    path = os.path.join(tmp_dir, "batch-silver")
    writers.write_silver(ds.silver_good(spark, SF_SMALL), path)
    return path


def test_keyed_bronze_stream_sink(spark, tmp_dir):
    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    st.land_by_arrival_day(ds.bronze(spark, SF_SMALL), landing)
    q = st.write_bronze_stream(st.bronze_file_source(spark, landing, 16), out, ckpt)
    q.awaitTermination()
    assert layers.read_bronze(spark, out).count() == ds.bronze(spark, SF_SMALL).count()


def test_feed_stream_to_bronze(spark, tmp_dir):
    """Topic -> Bronze with a file stream standing in for the topic: raw feed-A
    messages are normalised and land in Bronze by arrival hour, exactly once."""
    from tickforge.sources import feeds
    from tickforge.sources import fixtures as fx

    landing, out, ckpt = (os.path.join(tmp_dir, n) for n in ("feed", "bronze", "ckpt"))
    msgs = fx.feed_a_messages(spark, SF_SMALL)
    good = feeds.normalize_feed_a(msgs).count()
    msgs.select("value").coalesce(2).write.text(landing)
    stream = st.events_as_bronze(feeds.normalize_feed_a(st.feed_file_source(spark, landing, 1)))
    q = st.write_bronze_stream(stream, out, ckpt)
    q.awaitTermination()
    landed = layers.read_bronze_records(spark, out)
    assert landed.count() == good < msgs.count()
    # restart on the same checkpoint: nothing is landed twice
    q = st.write_bronze_stream(st.events_as_bronze(feeds.normalize_feed_a(st.feed_file_source(spark, landing, 1))),
                               out, ckpt)
    q.awaitTermination()
    assert layers.read_bronze_records(spark, out).count() == good
    # and Bronze text goes through the Silver transform like any other Bronze
    from tickforge.operators import silver

    assert silver.quality_good(silver.silver_prepared(landed)).count() > 0


def test_bronze_stream_writes_few_files_in_few_epochs(spark, tmp_dir, monkeypatch):
    """An epoch takes as many topic files as there are cores, and writes one file an hour, whatever the number of its tasks."""
    from tickforge.plans import catalog

    cores = spark.sparkContext.defaultParallelism
    files = 2 * max(2, cores)
    messages = spark.range(40 * files).selectExpr(
        "id AS message_id", "timestampadd(HOUR, CAST(id % 3 AS INT), TIMESTAMP'2024-01-02 03:00:00') AS arrived_at").selectExpr(
        "message_id", "concat('[{\"ev\":\"XT\",\"i\":\"', message_id, '\",\"pair\":\"A-USD\",\"p\":1.0,\"s\":2.0,\"x\":\"1\",\"t\":1704164400000}]') AS value",
        "arrived_at").repartition(files)
    monkeypatch.setattr(catalog.fx, "topic_messages", lambda spark, sf: messages)
    paths, real = [], catalog.st.write_bronze_stream

    def noted(bronze, path, checkpoint, **kw):
        paths.extend([path, checkpoint])
        return real(bronze, path, checkpoint, **kw)

    monkeypatch.setattr(catalog.st, "write_bronze_stream", noted)
    rows = catalog.QUERIES["stream_bronze"](spark, SF_SMALL)
    assert sorted(int(r.trade_id) for r in rows.collect()) == list(range(40 * files))
    commits = [n for n in os.listdir(os.path.join(paths[1].removeprefix("file:"), "commits")) if n.isdigit()]
    assert len(commits) == 2
    written = [f for _, _, names in os.walk(paths[0].removeprefix("file:")) for f in names if f.endswith(".json")]
    assert len(written) == 2 * 3


def test_dead_letter_run_folder_is_never_overwritten(spark, tmp_dir):
    bad = ds.silver_dead_letter(spark, SF_SMALL)
    base = os.path.join(tmp_dir, "dead")
    path = writers.write_dead_letter(bad, base, "run1")
    back = spark.read.json(path)
    assert back.count() == bad.count() and "failed_rules" in back.columns
    with pytest.raises(Exception):
        writers.write_dead_letter(bad, base, "run1")


def test_materialize_view_and_table(spark, tmp_dir):
    f = ds.fact(spark, SF_SMALL)
    v = writers.materialize(spark, f, "fact_view")
    t = writers.materialize(spark, f, "fact_table", kind="table", path=os.path.join(tmp_dir, "fact_table"))
    assert spark.table("fact_view").count() == spark.table("fact_table").count() == f.count()
    assert "InMemoryFileIndex" in t._jdf.queryExecution().executedPlan().toString()
    assert v.count() == t.count()


def test_no_machine_local_folder_off_a_local_master():
    from types import SimpleNamespace

    from tickforge import session

    conf = SimpleNamespace(get=lambda k, d: d)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(session.NoSharedFolderError):
        session.checkpoint_base(SimpleNamespace(sparkContext=context))


def test_versions_are_only_ever_added(spark, tmp_dir):
    base = os.path.join(tmp_dir, "docs")
    assert writers.current_version(spark, base) is None
    paths = [writers.write_version(spark, spark.range(n), base) for n in (1, 2, 3)]
    assert writers.current_version(spark, base) == paths[-1] and writers.read_version(spark, base).count() == 3
    assert spark.read.parquet(paths[0]).count() == 1
