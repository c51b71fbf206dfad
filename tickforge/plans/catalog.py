"""Registry of named queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given parquet tables (or frames Spark derives from them)
and returns its result in the portable hand-off form.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import FAILED_RULES
from ..operators import deltas as dl
from ..operators import documents as dc
from ..operators import gold as gd
from ..operators import marts as mt
from ..operators import quality as dq
from ..operators import load_states as ls
from ..operators import newest as nw
from ..operators import positions as ps
from ..operators import reports as rp
from ..operators import silver as sv
from ..schemas import (BRONZE_PARTITIONS, BRONZE_SCHEMA, FACT_SCHEMA, FEED_A_SCHEMA, FEED_B_SCHEMA, SILVER_COLUMNS,
                       MissingColumnsError, require_columns)
from ..session import apply_engine_conf, staged, work_dir
from ..sinks import writers as wr
from ..sinks.compaction import CompactedFolder
from ..sinks.doc_store import DocumentStore
from ..sinks.key_index import KeyIndex, insert_indexed
from ..sinks.zorder import write_zordered
from ..sources import feeds as fd
from ..sources import fixtures as fx
from ..sources import layers as ly
from ..streaming import pipeline as st
from ..streaming.totals import EpochTotals
from . import datasets as ds
from . import serving as sv_sql
from .portable import portable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)  # UTC zone, AQE: results depend on the zone
            return portable(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return wrap


# ---- marts (A8, A9, A10, J3, J4, X1-X4) ----------------------------------------------

@register("mart_daily_summary")
def _mart_daily(spark, sf):
    return ds.mart_daily_summary(spark, sf)


@register("mart_daily_summary_wide")
def _mart_daily_wide(spark, sf):
    return ds.mart_daily_summary(spark, sf, wide=True)


@register("mart_daily_summary_tick")
def _mart_tick(spark, sf):
    return ds.mart_daily_summary_tick(spark, sf)


@register("mart_daily_summary_tick_wide")
def _mart_tick_wide(spark, sf):
    return ds.mart_daily_summary_tick(spark, sf, wide=True)


@register("mart_symbol_performance")
def _mart_perf(spark, sf):
    return ds.mart_symbol_performance(spark, sf)


@register("mart_symbol_performance_wide")
def _mart_perf_wide(spark, sf):
    return ds.mart_symbol_performance(spark, sf, wide=True)


# ---- Bronze -> Silver (P3-P6, A1, F1-F3) ---------------------------------------------


def _bronze_typed(spark, sf):
    return sv.cast_types(ds.bronze(spark, sf))


@register("silver_cast")
def _silver_cast(spark, sf):
    """Bronze text -> typed columns (try-casts; unparsable values are NULL)."""
    return _bronze_typed(spark, sf)


@register("silver_derived")
def _silver_derived(spark, sf):
    return sv.add_derived_columns(_bronze_typed(spark, sf))


@register("silver_dedup")
def _silver_dedup(spark, sf):
    """One row per trade_id: earliest arrival wins (deterministic)."""
    return sv.dedup_by_key(sv.add_derived_columns(_bronze_typed(spark, sf)))


@register("dedup_stats")
def _dedup_stats(spark, sf):
    kept = sv.dedup_by_key(sv.add_derived_columns(_bronze_typed(spark, sf)), copies_col="_copies")
    counts = kept.agg(F.sum("_copies").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))
    return counts.select("rows_in", "rows_out",
                         (F.col("rows_in") - F.col("rows_out")).alias("duplicates_removed"))


@register("silver_fill")
def _silver_fill(spark, sf):
    return sv.handle_nulls(sv.dedup_by_key(sv.add_derived_columns(_bronze_typed(spark, sf))))


@register("silver_round")
def _silver_round(spark, sf):
    """Everything before the quality split (cast, derive, dedup, fill, round)."""
    return ds.silver_prepared(spark, sf)


@register("quality_good")
def _quality_good(spark, sf):
    return ds.silver_good(spark, sf)


@register("quality_dead_letter")
def _quality_dead_letter(spark, sf):
    bad = ds.silver_dead_letter(spark, sf)
    return bad.withColumn(FAILED_RULES, F.array_join(FAILED_RULES, ","))


@register("quality_strict_bad")
def _quality_strict_bad(spark, sf):
    """As-written split: rows whose verdict is NULL are in neither side."""
    return sv.quality_split_strict(ds.silver_prepared(spark, sf))[1]


@register("quality_report")
def _quality_report(spark, sf):
    return sv.quality_report(ds.silver_prepared(spark, sf))


# ---- Gold star schema and merges (P7-P13, J1, J2, K4, K5, A3-A7, J5-J7) -------------


@register("dim_time")
def _dim_time(spark, sf):
    return ds.dim_time(spark, sf)


@register("dim_instrument")
def _dim_instrument(spark, sf):
    return ds.dim_instrument(spark, sf)


@register("fact_trades")
def _fact_trades(spark, sf):
    """Silver rows of the Bronze pipeline in Gold fact types."""
    return ds.silver_fact(spark, sf)


@register("stg_trades")
def _stg_trades(spark, sf):
    return ds.stg_trades(spark, sf, wide=True)


@register("stg_instruments")
def _stg_instruments(spark, sf):
    return ds.stg_instruments(spark, sf)


@register("stg_instruments_listed")
def _stg_instruments_listed(spark, sf):
    """Instruments that are still listed: the inactive ones go."""
    return mt.stg_instruments(ds.listed_instruments(spark, sf))


@register("fact_orphans")
def _fact_orphans(spark, sf):
    return gd.enforce_foreign_keys(ds.silver_fact(spark, sf), ds.dim_instrument(spark, sf), ds.dim_time(spark, sf))[1]


@register("dim_instrument_merged")
def _dim_instrument_merged(spark, sf):
    """Seeded instruments plus the valid ones first seen in the load."""
    return ds.seeded_instruments(spark, sf)


@register("fact_loaded")
def _fact_loaded(spark, sf):
    """Fact rows that meet the column constraints and whose parents exist."""
    return ds.silver_loaded(spark, sf)[0]


@register("fact_rejects")
def _fact_rejects(spark, sf):
    """Rows that the load rejects, with the reasons."""
    rejects = ds.silver_loaded(spark, sf)[1]
    return rejects.select("trade_id", "symbol", "trade_date", F.col("price").cast("double").alias("price"), "reason")


@register("fact_trades_new")
def _fact_trades_new(spark, sf):
    """Clean trades not yet in the fact loaded from Bronze (insert-if-absent)."""
    return gd.insert_new(ds.fact(spark, sf), ds.silver_fact(spark, sf), "trade_id")


@register("fact_trades_indexed")
def _fact_trades_indexed(spark, sf):
    """The same merge through a key index: the Bronze load is stored and
    indexed, then the clean trades are merged in; what that added."""
    path = work_dir(spark, "fact-indexed")
    wr.write_table(ds.silver_fact(spark, sf), path, ["trade_date"], bloom="trade_id")
    wr.write_table(ds.fact(spark, sf), f"{path}-batch")
    added = f"{path}-added"
    insert_indexed(spark.read.parquet(f"{path}-batch"), KeyIndex(spark, f"{path}-keys", buckets=16), spark.read.parquet(path),
                   lambda new: new.write.parquet(added))
    return spark.read.schema(FACT_SCHEMA).parquet(added)


@register("dim_time_new")
def _dim_time_new(spark, sf):
    """Dates of the lineitem trades missing from the event-trade date dimension."""
    return gd.insert_new(ds.dim_time(spark, sf, wide=True), ds.dim_time(spark, sf), "trade_date")


@register("gold_symbol_distribution")
def _gold_symbol_distribution(spark, sf):
    return rp.gold_symbol_distribution(ds.fact(spark, sf), ds.dim_instrument(spark, sf))


@register("gold_date_coverage")
def _gold_date_coverage(spark, sf):
    return rp.gold_date_coverage(ds.fact(spark, sf), ds.dim_time(spark, sf))


@register("gold_total")
def _gold_total(spark, sf):
    return rp.gold_total(ds.fact(spark, sf))


@register("all_trades")
def _all_trades(spark, sf):
    return rp.all_trades(ds.fact(spark, sf), ds.dim_instrument(spark, sf))


@register("silver_symbol_distribution")
def _silver_symbol_distribution(spark, sf):
    return rp.silver_symbol_distribution(ds.silver_good(spark, sf))


# ---- serving and report frames (A11-A20, A22, A23, L1, L4, F5, F6, F10, P14-P21) ---------

DAILY_FILTER = {"symbol": "CLICK/USD", "start_date": "2024-01-08", "end_date": "2024-01-21"}


def _daily_slice(spark, sf):
    return rp.daily_filtered(ds.mart_daily_summary(spark, sf), **DAILY_FILTER)


@register("pipeline_stats")
def _pipeline_stats(spark, sf):
    return rp.pipeline_stats(ds.fact(spark, sf))


@register("hourly_volume")
def _hourly_volume(spark, sf):
    return rp.hourly_volume(ds.fact(spark, sf))


@register("hourly_total")
def _hourly_total(spark, sf):
    return rp.hourly_total(rp.hourly_volume(ds.fact(spark, sf)))


@register("hourly_pivot")
def _hourly_pivot(spark, sf):
    return rp.hourly_pivot(rp.hourly_volume(ds.fact(spark, sf)))


@register("daily_filtered")
def _daily_filtered(spark, sf):
    return _daily_slice(spark, sf)


@register("date_bounds")
def _date_bounds(spark, sf):
    return rp.date_bounds(ds.mart_daily_summary(spark, sf))


@register("daily_volume_trend")
def _daily_volume_trend(spark, sf):
    return rp.daily_volume_trend(rp.daily_filtered(ds.mart_daily_summary(spark, sf)))


@register("report_daily")
def _report_daily(spark, sf):
    return rp.report_daily(rp.daily_filtered(ds.mart_daily_summary(spark, sf)))


@register("report_daily_tick")
def _report_daily_tick(spark, sf):
    """The report table over the tick-grain mart (as the written SQL feeds it)."""
    return rp.report_daily(rp.daily_filtered(ds.mart_daily_summary_tick(spark, sf)))


@register("market_kpis")
def _market_kpis(spark, sf):
    return rp.market_kpis(_daily_slice(spark, sf))


@register("symbol_distribution")
def _symbol_distribution(spark, sf):
    return rp.symbol_distribution(rp.all_trades(ds.fact(spark, sf), ds.dim_instrument(spark, sf)))


@register("recent_trades")
def _recent_trades(spark, sf):
    return rp.recent_trades(ds.fact(spark, sf), limit=50)


def _stored_fact(spark, sf):
    path = work_dir(spark, "stored-fact")
    wr.write_table(ds.fact(spark, sf), path, ["trade_date"])
    return path


@register("recent_trades_stored")
def _recent_trades_stored(spark, sf):
    """The newest trades of the stored fact, from its newest date partitions."""
    return nw.recent_trades_stored(spark, _stored_fact(spark, sf), 50, schema=FACT_SCHEMA)


@register("recent_trades_stored_symbol")
def _recent_trades_stored_symbol(spark, sf):
    return nw.recent_trades_stored(spark, _stored_fact(spark, sf), 200, "VIEW/USD", FACT_SCHEMA)


@register("pipeline_stats_states")
def _pipeline_stats_states(spark, sf):
    """The same figures from the states of two loads, one per feed, without
    reading a trade twice."""
    path, numbers = work_dir(spark, "load-states"), None
    for feed in ("feed_a", "feed_b"):
        rows = ds.fact(spark, sf).filter(F.col("source") == feed)
        numbers = staged(ls.number_symbols(numbers, rows), "symbol-numbers")
        ls.load_state(rows, numbers).write.mode("append").parquet(path)
    return ls.pipeline_stats_from_states(spark.read.parquet(path))


@register("fact_positioned")
def _fact_positioned(spark, sf):
    """Every trade with its position from newest to oldest."""
    rows = ds.fact(spark, sf).select("trade_id", "timestamp")
    return ps.positioned(rows, F.desc("timestamp"), F.desc("trade_id"))


@register("fact_page")
def _fact_page(spark, sf):
    """A page of the positioned trades (101 to 150), read from the files that hold it."""
    path = work_dir(spark, "positioned")
    ps.positioned(ds.fact(spark, sf).select("trade_id", "timestamp"), F.desc("timestamp"), F.desc("trade_id")).write.parquet(path)
    return ps.page(spark.read.parquet(path), 100, 50)


@register("trade_log")
def _trade_log(spark, sf):
    return rp.trade_log(rp.recent_trades(ds.fact(spark, sf), limit=10))


@register("asset_profile")
def _asset_profile(spark, sf):
    return rp.asset_profile(ds.mart_symbol_performance(spark, sf, wide=True))


@register("portfolio_share")
def _portfolio_share(spark, sf):
    return rp.portfolio_share(ds.mart_symbol_performance(spark, sf))


@register("report_assets")
def _report_assets(spark, sf):
    return rp.report_assets(ds.mart_symbol_performance(spark, sf, wide=True))


@register("market_log")
def _market_log(spark, sf):
    return rp.market_log(rp.recent_trades(ds.fact(spark, sf), limit=20))


@register("asset_log")
def _asset_log(spark, sf):
    return rp.asset_log(rp.recent_trades(ds.fact(spark, sf), symbol="CLICK/USD", limit=20))


@register("report_preview")
def _report_preview(spark, sf):
    return rp.report_preview(rp.recent_trades(ds.fact(spark, sf), limit=100))


@register("asset_profile_one")
def _asset_profile_one(spark, sf):
    """One symbol's card."""
    return rp.asset_profile(ds.mart_symbol_performance(spark, sf), symbol="CLICK/USD")


@register("daily_ordered")
def _daily_ordered(spark, sf):
    """The daily slice in its serving order, numbered."""
    return ps.positioned(_daily_slice(spark, sf), "trade_date", "symbol")


@register("performance_ordered")
def _performance_ordered(spark, sf):
    """The symbol mart in its serving order, numbered."""
    perf = ds.mart_symbol_performance(spark, sf, wide=True)
    return ps.positioned(perf, "volume_rank", "symbol").select("position", "symbol", "total_notional_usd", "volume_rank")


# ---- data-quality checks (Q1-Q7) ---------------------------------------------------

@register("dq_unique")
def _dq_unique(spark, sf):
    fact, inst, days, _ = ds.raw_checked(spark, sf)
    return dq.dq_unique(fact, inst, days)


@register("dq_not_null")
def _dq_not_null(spark, sf):
    fact, inst, days, _ = ds.raw_checked(spark, sf)
    return dq.dq_not_null(fact, inst, days)


@register("dq_relationships")
def _dq_relationships(spark, sf):
    fact, inst, days, _ = ds.raw_checked(spark, sf)
    return dq.dq_relationships(fact, inst, days)


@register("dq_accepted_values")
def _dq_accepted_values(spark, sf):
    fact, inst, _, _ = ds.raw_checked(spark, sf)
    return dq.dq_accepted_values(fact, inst)


@register("dq_type_bounds")
def _dq_type_bounds(spark, sf):
    _, inst, _, silver_rows = ds.raw_checked(spark, sf)
    return dq.dq_type_bounds(silver_rows, inst)


@register("dq_summary")
def _dq_summary(spark, sf):
    _, inst, days, silver_rows = ds.raw_checked(spark, sf)
    return dq.dq_summary(silver_rows, inst, days)


@register("report_summary")
def _report_summary(spark, sf):
    _, inst, days, silver_rows = ds.raw_checked(spark, sf)
    return rp.report_summary(rp.pipeline_stats(ds.fact(spark, sf)), dq.dq_summary(silver_rows, inst, days))


# ---- documents (L2, N1-N6, K6) ------------------------------------------------------


@register("recent_trades_per_symbol")
def _recent_trades_per_symbol(spark, sf):
    return dc.recent_trades_per_symbol(ds.fact(spark, sf), limit=10)


@register("portfolio_documents")
def _portfolio_documents(spark, sf):
    """Nested: checked through its flattened forms and read-back sizes."""
    return ds.portfolio_documents(spark, sf)


@register("portfolio_check")
def _portfolio_check(spark, sf):
    return dc.document_check(ds.portfolio_documents(spark, sf))


@register("portfolio_performance_flat")
def _portfolio_performance_flat(spark, sf):
    return dc.flatten_performance(ds.portfolio_documents(spark, sf))


@register("portfolio_recent_flat")
def _portfolio_recent_flat(spark, sf):
    return dc.flatten_recent(ds.portfolio_documents(spark, sf))


@register("portfolio_daily_flat")
def _portfolio_daily_flat(spark, sf):
    return dc.flatten_daily(ds.portfolio_documents(spark, sf))


@register("portfolio_upsert")
def _portfolio_upsert(spark, sf):
    """Documents from the clean fact replace those built from the Bronze load."""
    merged = dc.upsert_documents(ds.portfolio_documents(spark, sf, from_bronze=True),
                                 ds.portfolio_documents(spark, sf))
    return merged.select("_id", "_action", F.col("performance.total_trades").alias("total_trades"),
                         F.size("recent_trades").alias("recent_trades_count"),
                         F.size("daily_breakdown").alias("daily_breakdown_count"))


@register("portfolio_upsert_buckets")
def _portfolio_upsert_buckets(spark, sf):
    """The same upsert into a store in hash buckets, read back."""
    store = DocumentStore(spark, work_dir(spark, "documents"), buckets=16)
    store.upsert(ds.portfolio_documents(spark, sf, from_bronze=True))
    store.upsert(ds.portfolio_documents(spark, sf))
    return store.read().select("_id", F.col("performance.total_trades").alias("total_trades"),
                               F.size("recent_trades").alias("recent_trades_count"),
                               F.size("daily_breakdown").alias("daily_breakdown_count"))


# ---- feeds (P1, P2, P23, F8, F9, R6) -----------------------------------------------


@register("normalize_feed_a")
def _normalize_feed_a(spark, sf):
    return fd.normalize_feed_a(fx.feed_a_messages(spark, sf))


@register("normalize_feed_b")
def _normalize_feed_b(spark, sf):
    return fd.normalize_feed_b(fx.feed_b_messages(spark, sf))


@register("feed_corrupt")
def _feed_corrupt(spark, sf):
    bad = fd.corrupt_messages(fx.feed_b_messages(spark, sf), FEED_B_SCHEMA)
    return bad.select("message_id", "arrived_at", "reason")


@register("feed_a_corrupt")
def _feed_a_corrupt(spark, sf):
    return fd.corrupt_messages(fx.feed_a_messages(spark, sf), FEED_A_SCHEMA).select("message_id", "reason")


@register("topic_trades")
def _topic_trades(spark, sf):
    """Both feeds told apart on one topic and normalised."""
    return fd.normalize_topic(fx.topic_messages(spark, sf))


@register("topic_rejects")
def _topic_rejects(spark, sf):
    return fd.topic_rejects(fx.topic_messages(spark, sf)).select("message_id", "arrived_at", "reason")


@register("feed_union")
def _feed_union(spark, sf):
    return fd.feed_union(fd.normalize_feed_a(fx.feed_a_messages(spark, sf)),
                         fd.normalize_feed_b(fx.feed_b_messages(spark, sf)))


@register("json_roundtrip")
def _json_roundtrip(spark, sf):
    """Gold trades encoded as JSON messages and decoded again."""
    return fd.decode_messages(fd.encode_messages(ds.fact(spark, sf)), FACT_SCHEMA)


@register("keyed_messages")
def _keyed_messages(spark, sf):
    """Trades as (key = symbol, value = JSON) messages, decoded back with the key."""
    msgs = fd.encode_messages(ds.fact(spark, sf), key_col="symbol")
    return msgs.select(F.col("key"), F.from_json("value", FACT_SCHEMA, fd.JSON_OPTIONS).alias("m")) \
               .select("key", "m.*")


# ---- stored layers: write, then read back (K1-K3, K7-K9, R1-R5) ---------------------


def _bronze_written(spark, sf):
    path = work_dir(spark, "bronze")
    wr.write_bronze(ds.bronze(spark, sf), path)
    return path


@register("bronze_scan")
def _bronze_scan(spark, sf):
    """Bronze written by arrival hour as JSON lines, read back with its schema."""
    return ly.read_bronze(spark, _bronze_written(spark, sf))


BATCH_DATE = "2024-01-15"


@register("bronze_scan_day")
def _bronze_scan_day(spark, sf):
    """One arrival day of Bronze, selected by partition pruning."""
    return ly.read_bronze(spark, _bronze_written(spark, sf), batch_date=BATCH_DATE)


@register("bronze_required")
def _bronze_required(spark, sf):
    """The newest day of Bronze and the day after, read with rows required: the empty one fails by name (R3)."""
    path = _bronze_written(spark, sf)
    newest = ly.read_bronze(spark, path).agg(F.max(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int")))).first()[0]
    out = []
    for day in (newest, newest + timedelta(days=1)):
        try:
            out.append((str(day), ly.read_bronze(spark, path, str(day), require_rows=True).count(), None))
        except ly.EmptyInputError as e:
            out.append((str(day), 0, type(e).__name__))
    return spark.createDataFrame(out, "batch_date string, batch_rows long, error string")


@register("silver_required")
def _silver_required(spark, sf):
    """Silver whole and without its price, held against the columns that its readers require (R5)."""
    good, out = ds.silver_good(spark, sf), []
    for missing in ("", "price"):
        try:
            out.append((missing, None, require_columns(good.drop(missing), SILVER_COLUMNS, "silver").count()))
        except MissingColumnsError as e:
            out.append((missing, type(e).__name__, 0))
    return spark.createDataFrame(out, "missing string, error string, n_rows long")


@register("silver_scan")
def _silver_scan(spark, sf):
    path = work_dir(spark, "silver")
    wr.write_silver(ds.silver_good(spark, sf), path)
    return ly.read_silver(spark, path)


@register("dead_letter_scan")
def _dead_letter_scan(spark, sf):
    """Dead letter written as JSON lines under its run folder, read back."""
    bad = ds.silver_dead_letter(spark, sf)
    path = wr.write_dead_letter(bad, work_dir(spark, "dead-letter"), "run")
    back = spark.read.schema(bad.schema).option("timestampFormat", wr.ISO_UTC).json(path)
    return back.withColumn(FAILED_RULES, F.array_join(FAILED_RULES, ","))


@register("materialized")
def _materialized(spark, sf):
    """Trades per symbol of a staged view and of a written table."""
    view = wr.materialize(spark, ds.stg_trades(spark, sf), "staged_view")
    table = wr.materialize(spark, ds.stg_trades(spark, sf), "staged_table", kind="table", path=work_dir(spark, "table"))
    both = [d.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades")).withColumn("kind", F.lit(k))
            for k, d in (("view", view), ("table", table))]
    return both[0].unionByName(both[1])


EXPORT_SYMBOL = "VIEW/USD"


@register("export_trades")
def _export_trades(spark, sf):
    """CSV export of one symbol's trades, read back with the written schema."""
    rows = rp.all_trades(ds.fact(spark, sf), ds.dim_instrument(spark, sf)) \
             .filter(F.col("symbol") == EXPORT_SYMBOL)
    path = work_dir(spark, "export")
    wr.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True) \
                .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


@register("run_metrics")
def _run_metrics(spark, sf):
    from .pipeline import metrics_frame
    return metrics_frame(ds.bronze(spark, sf))


# ---- streaming results read back as batch frames (S1-S3, S5) ------------------------


def _landed_bronze(spark, sf):
    landing = work_dir(spark, "landing")
    st.land_by_arrival_day(ds.bronze(spark, sf), landing)
    return landing


@register("stream_bronze")
def _stream_bronze(spark, sf):
    """Topic records of both feeds streamed into Bronze, read back."""
    landing, out, ckpt = (work_dir(spark, n) for n in ("topic", "stream-bronze", "stream-bronze-ckpt"))
    fx.topic_messages(spark, sf).select("value", "arrived_at").write.parquet(landing)
    # A trigger takes as many files as the cluster reads at once.
    files = max(2, spark.sparkContext.defaultParallelism)
    q = st.write_bronze_stream(st.topic_to_bronze(st.topic_file_source(spark, landing, files)), out, ckpt)
    q.awaitTermination()
    return ly.read_bronze_records(spark, out)


@register("stream_silver")
def _stream_silver(spark, sf):
    """Bronze files streamed through the Silver transform (foreachBatch and
    key merge); the stored Silver read back. Without the arrival time: which
    of two copies comes first depends on the order of the files."""
    landing = _landed_bronze(spark, sf)
    silver_path, dead, ckpt = (work_dir(spark, n) for n in ("stream-silver", "stream-dead", "stream-ckpt"))
    q = st.start_silver_stream(st.bronze_file_source(spark, landing, 16), silver_path, dead, ckpt)
    q.awaitTermination()
    return ly.read_silver(spark, silver_path).drop("ingested_at")


@register("stream_dedup")
def _stream_dedup(spark, sf):
    """Trade ids left by streaming dedup: each of the input's once, however late."""
    landing = _landed_bronze(spark, sf)
    out, ckpt = work_dir(spark, "stream-dedup"), work_dir(spark, "stream-dedup-ckpt")
    q = st.dedup_stream(st.bronze_file_source(spark, landing, 16), out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out).select("trade_id")


@register("stream_totals")
def _stream_totals(spark, sf):
    """Totals of a counted stream: rows read, and rows stored once each."""
    landing = _landed_bronze(spark, sf)
    silver_path, dead, ckpt = (work_dir(spark, n) for n in ("totals-silver", "totals-dead", "totals-ckpt"))
    q = st.start_silver_stream(st.bronze_file_source(spark, landing, 16), silver_path, dead, ckpt)
    q.awaitTermination()
    return EpochTotals(spark, ckpt).epochs().agg(F.sum("input_rows").alias("input_rows"), F.sum("stored_rows").alias("stored_rows"))


# ---- serving by parameterised SQL over views (R8), exports (K9), keyed files (S4) ----


def _views(spark, sf):
    sv_sql.register_views(spark, fact_trades=ds.fact(spark, sf),
                          mart_daily_summary=ds.mart_daily_summary(spark, sf),
                          mart_symbol_performance=ds.mart_symbol_performance(spark, sf))


@register("daily_summary_sql")
def _daily_summary_sql(spark, sf):
    _views(spark, sf)
    return sv_sql.daily_summary(spark, **DAILY_FILTER)


@register("pipeline_stats_sql")
def _pipeline_stats_sql(spark, sf):
    _views(spark, sf)
    return sv_sql.pipeline_stats(spark)


@register("symbol_performance_sql")
def _symbol_performance_sql(spark, sf):
    _views(spark, sf)
    return sv_sql.symbol_performance(spark)


@register("recent_trades_sql")
def _recent_trades_sql(spark, sf):
    _views(spark, sf)
    return sv_sql.recent_trades(spark, symbol="CLICK/USD", limit=25)


@register("hourly_volume_sql")
def _hourly_volume_sql(spark, sf):
    _views(spark, sf)
    return sv_sql.hourly_volume(spark)


@register("all_trades_sql")
def _all_trades_sql(spark, sf):
    _views(spark, sf)
    sv_sql.register_views(spark, dim_instrument=ds.dim_instrument(spark, sf))
    return sv_sql.all_trades(spark, symbol="VIEW/USD")


@register("export_performance")
def _export_performance(spark, sf):
    """Performance mart exported as CSV and read back with its schema."""
    perf = ds.mart_symbol_performance(spark, sf, wide=True)
    path = work_dir(spark, "export-perf")
    wr.write_csv(perf, path)
    return spark.read.schema(perf.schema).option("header", True) \
                .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


@register("keyed_files")
def _keyed_files(spark, sf):
    """Trades written as files ordered per symbol, read back with their place:
    per symbol the trades, and how often one comes before an earlier one."""
    path = work_dir(spark, "keyed")
    wr.write_keyed_files(ds.fact(spark, sf), path, fmt="parquet")
    return wr.order_violations(spark.read.parquet(path))


@register("zorder_scan")
def _zorder_scan(spark, sf):
    """Trades of one symbol in some hours, from a fact written in Z-order of (symbol, timestamp)."""
    path = work_dir(spark, "zorder")
    write_zordered(ds.fact(spark, sf), path, ["symbol", "timestamp"], rows_per_file=2000)
    return spark.read.parquet(path).filter(
        "symbol = 'CLICK/USD' AND timestamp >= TIMESTAMP'2024-01-10 06:00:00' AND timestamp < TIMESTAMP'2024-01-11 18:00:00'")


@register("bronze_compacted")
def _bronze_compacted(spark, sf):
    """Bronze in two appends, the first compacted before the second; read back."""
    path = work_dir(spark, "bronze-small")
    first = F.abs(F.xxhash64("trade_id", "ingested_at")) % 2 == 0
    wr.write_bronze(ds.bronze(spark, sf).filter(first), path)
    folder = CompactedFolder(spark, path, BRONZE_SCHEMA, list(BRONZE_PARTITIONS), options={"timestampFormat": wr.ISO_UTC})
    folder.compact(8 << 20)
    wr.write_bronze(ds.bronze(spark, sf).filter(~first), path)
    folder.compact(8 << 20)
    return folder.read()


# ---- incremental mart maintenance (A10 from a per-day state table) ------------------


@register("mart_symbol_performance_rollup")
def _mart_perf_rollup(spark, sf):
    """The symbol mart rolled up from the per-(day, symbol) state table."""
    return mt.mart_symbol_performance_from_state(mt.daily_state(ds.stg_trades(spark, sf, wide=True)),
                                                 ds.stg_instruments(spark, sf, wide=True))


@register("mart_daily_state")
def _mart_daily_state(spark, sf):
    """The state table, its variance state as mean and variance to fixed places."""
    state = mt.daily_state(ds.stg_trades(spark, sf))
    return state.select("trade_date", "symbol", "n", "sum_notional", "n_notional", "sum_price", "n_price", "min_price", "max_price",
                        F.round("mean_price", 6).alias("mean_price"),
                        F.round(F.col("m2_price") / F.col("n_price"), 3).alias("var_price"), "max_ingested_at")


@register("mart_daily_corrected")
def _mart_daily_corrected(spark, sf):
    """The per-day state after corrections: a load in which every tenth price
    was wrong and every seventh trade missing is corrected by signed deltas."""
    trades = ds.stg_trades(spark, sf)
    number = F.col("trade_id").cast("long")
    wrong = trades.withColumn("price", F.when(number % 10 == 0, F.col("price") + 1000).otherwise(F.col("price")).cast(trades.schema["price"].dataType))
    state = staged(dl.state_of(wrong.filter(number % 7 != 0)), "state")
    gone = wrong.filter((number % 10 == 0) & (number % 7 != 0))
    come = trades.filter((number % 10 == 0) | (number % 7 == 0))
    return dl.changed_state(state, gone, come, trades)[0]


@register("mart_daily_joined")
def _mart_daily_joined(spark, sf):
    """The daily mart joined to the time dimension (a day without a row there
    would have no mart row either)."""
    return mt.mart_daily_summary(ds.stg_trades(spark, sf), ds.dim_time(spark, sf))
