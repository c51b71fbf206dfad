"""End-to-end runs of the medallion flow, one action per sink.

A run reads its input once: what two sinks share is staged in the session's
shared folder, and metrics are gathered with ``DataFrame.observe`` during the
writes or counted on the staged rows.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import passes_all, with_failed_rules
from ..operators import documents, gold, marts, silver
from ..sinks import writers
from ..sinks.doc_store import DocumentStore
from ..sinks.key_index import KeyIndex, insert_indexed
from ..session import OBSERVED_WRITE_CONF, conf_override, path_exists, remove_path, work_dir
from ..sources import layers
from ..streaming.pipeline import silver_key_index


@dataclass
class RunMetrics:
    rows_read: int = 0
    rows_after_dedup: int = 0
    duplicates_removed: int = 0
    rows_written: int = 0
    rows_already_present: int = 0
    rows_dead_letter: int = 0
    status: str = "SUCCESS"

    def as_dict(self) -> dict:
        return asdict(self)


def metrics_frame(bronze: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """The run metrics as a one-row frame, computed without writing: one
    aggregate over the deduplicated rows, each carrying its copy count."""
    ok = passes_all(rules)
    split = silver.silver_prepared(bronze, copies_col="_copies").agg(
        F.sum("_copies").alias("rows_read"),
        F.count(F.lit(1)).alias("rows_after_dedup"),
        F.count_if(ok).alias("rows_written"),
        F.count_if(~ok).alias("rows_dead_letter"))
    return split.select(
        "rows_read", "rows_after_dedup",
        (F.col("rows_read") - F.col("rows_after_dedup")).alias("duplicates_removed"),
        "rows_written", "rows_dead_letter",
        F.when(F.col("rows_dead_letter") > 0, F.lit("PARTIAL")).otherwise(F.lit("SUCCESS")).alias("status"))


def bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str, dead_letter_base: str,
                     batch_date: str | None = None, run_id: str | None = None,
                     rules: dict[str, str] | None = None, key_scope: str = "global") -> RunMetrics:
    """Read Bronze (optionally one day), clean, split, and write Silver and the
    dead letter. Re-running adds no Silver row: keys already in Silver are
    skipped (``gold.insert_new``). ``key_scope="partition"`` compares against
    the trade dates the batch touches only (partition-pruned; see
    ``gold.insert_new_in_partitions``), ``"index"`` looks them up in a key
    index kept next to Silver (see ``sinks.key_index``).

    Bronze is read and deduplicated once: the prepared rows are staged in the
    shared folder with the verdict beside them, and both sinks, the dates and
    the counts read them there.
    """
    obs_read = Observation("read")
    bronze = layers.read_bronze_records(spark, bronze_path, batch_date).observe(obs_read, F.count(F.lit(1)).alias("n"))
    stage = work_dir(spark, "prepared")
    m = RunMetrics()
    try:
        with conf_override(spark, OBSERVED_WRITE_CONF):
            silver.silver_prepared(bronze).withColumn("_ok", passes_all(rules)).write.parquet(stage)
        prepared = spark.read.parquet(stage)
        counted = prepared.agg(F.count(F.lit(1)), F.count_if("_ok")).first()
        good = prepared.filter("_ok").drop("_ok")
        stored = layers.read_silver(spark, silver_path) if path_exists(spark, silver_path) else None
        if key_scope == "index":
            index = KeyIndex(spark, silver_key_index(silver_path))
            written = insert_indexed(good, index, stored, lambda new: writers.write_silver(new, silver_path))
        else:
            if stored is not None:
                good = (gold.insert_new_in_partitions(good, stored, "trade_id", "trade_date")
                        if key_scope == "partition" else gold.insert_new(good, stored, "trade_id"))
            obs_good = Observation("good")
            with conf_override(spark, OBSERVED_WRITE_CONF):
                writers.write_silver(good.observe(obs_good, F.count(F.lit(1)).alias("n")), silver_path)
            written = int(obs_good.get["n"])
        bad = with_failed_rules(prepared.filter("NOT _ok").drop("_ok"), rules)
        run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
        writers.write_dead_letter(bad, dead_letter_base, run_id)
    finally:
        remove_path(spark, stage)

    m.rows_read = int(obs_read.get["n"])
    m.rows_after_dedup = int(counted[0])
    m.duplicates_removed = m.rows_read - m.rows_after_dedup
    m.rows_written = written
    m.rows_already_present = int(counted[1]) - m.rows_written
    m.rows_dead_letter = m.rows_after_dedup - int(counted[1])
    m.status = "PARTIAL" if m.rows_dead_letter else "SUCCESS"
    return m


def silver_to_gold(spark: SparkSession, silver_path: str, gold_base: str, trade_dates: list[str] | None = None,
                   seed: list[tuple] | None = None) -> dict:
    """Load Silver (optionally some trade dates) into the star schema, under its constraints.

    New dates, instruments and fact rows are inserted if absent. A fact row
    that breaks a NOT NULL, width or range constraint, or whose instrument or
    date is unknown, goes to ``fact_rejects`` with the reasons. ``seed`` rows
    start an instrument dimension that doesn't exist yet. Fact rows are
    partitioned by trade_date, and merged through a key index next to the fact,
    so that a load costs what it brings. Returns, per table, how many rows were inserted
    and how many were skipped as already present.
    """
    base = gold_base.rstrip("/")
    stage = work_dir(spark, "fact")
    counts = {}

    def insert(name: str, frame: DataFrame, key: str, parts: list[str] | None = None) -> None:
        path = f"{base}/{name}"
        obs_in, obs_out = Observation(f"gold_{name}_in"), Observation(f"gold_{name}_out")
        frame = frame.observe(obs_in, F.count(F.lit(1)).alias("n"))
        if path_exists(spark, path):
            frame = gold.insert_new(frame, spark.read.parquet(path), key)
        frame = frame.observe(obs_out, F.count(F.lit(1)).alias("n"))
        with conf_override(spark, OBSERVED_WRITE_CONF):
            writers.write_table(frame, path, partition_by=parts, mode="append")
        inserted = int(obs_out.get["n"])
        counts[name] = {"inserted": inserted, "skipped": int(obs_in.get["n"]) - inserted}

    try:
        rows = silver.dedup_by_key(layers.read_silver(spark, silver_path, trade_dates))
        rows.withColumn("reason", gold.fact_violations()).write.parquet(stage)
        rows = spark.read.parquet(stage)
        fact = gold.to_fact(rows.filter("reason = ''"))
        insert("dim_time", gold.dim_time(fact), "trade_date")
        if seed and not path_exists(spark, f"{base}/dim_instrument"):
            writers.write_table(gold.seed_dim_instrument(spark, seed), f"{base}/dim_instrument")
        insert("dim_instrument", gold.valid_instruments(gold.dim_instrument(fact)), "symbol")
        kept, orphans = gold.enforce_foreign_keys(fact, spark.read.parquet(f"{base}/dim_instrument"),
                                                  spark.read.parquet(f"{base}/dim_time"))
        path, staged_kept = f"{base}/fact_trades", work_dir(spark, "kept")
        try:
            kept.write.parquet(staged_kept)
            kept = spark.read.schema(kept.schema).parquet(staged_kept)
            offered = kept.count()
            inserted = insert_indexed(
                kept, KeyIndex(spark, f"{base}/fact_trades-keys"), spark.read.parquet(path) if path_exists(spark, path) else None,
                lambda new: writers.write_table(new, path, partition_by=["trade_date"], mode="append", bloom="trade_id"))
            counts["fact_trades"] = {"inserted": inserted, "skipped": offered - inserted}
        finally:
            remove_path(spark, staged_kept)
        rejects = gold.reject_rows(rows.filter("reason <> ''")).unionByName(gold.reject_rows(orphans))
        insert("fact_rejects", rejects, "reject_id")
    finally:
        remove_path(spark, stage)
    return counts


def gold_to_marts(spark: SparkSession, gold_base: str, marts_base: str,
                  majors: tuple = marts.MAJOR_BASES, dates: list[str] | None = None) -> None:
    """Staging as views, marts as tables.

    ``dates=None`` rebuilds everything. With ``dates`` (the trade dates a load
    touched), only those days are recomputed: the fact is read for those
    partitions alone, and the daily mart and the per-day state table replace
    just those partitions (dynamic partition overwrite). The symbol mart is
    then rolled up from the state table, whose size is days x symbols.
    """
    base, out = gold_base.rstrip("/"), marts_base.rstrip("/")
    fact = spark.read.parquet(f"{base}/fact_trades")
    if dates:
        fact = fact.filter(F.col("trade_date").isin([F.lit(x).cast("date") for x in dates]))
    stg = writers.materialize(spark, marts.stg_trades(fact), "stg_trades")
    inst = writers.materialize(spark, marts.stg_instruments(spark.read.parquet(f"{base}/dim_instrument"), majors),
                               "stg_instruments")
    days = spark.read.parquet(f"{base}/dim_time")
    # A full rebuild replaces the tables, with days that are gone; a refresh replaces the days given.
    with conf_override(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic" if dates else "static"}):
        writers.write_table(marts.mart_daily_summary(stg, days), f"{out}/mart_daily_summary", ["trade_date"])
        writers.write_table(marts.daily_state(stg), f"{out}/mart_daily_state", ["trade_date"])
    # derived from the state table (another path), so overwriting is safe
    state = spark.read.parquet(f"{out}/mart_daily_state")
    writers.write_table(marts.mart_symbol_performance_from_state(state, inst), f"{out}/mart_symbol_performance")


def marts_to_documents(spark: SparkSession, gold_base: str, marts_base: str, docs_base: str,
                       run_time: str | None = None, buckets: int | None = None, symbols: list[str] | None = None) -> dict:
    """Build all documents and publish them as a new version (replace-by-key
    against the live version, which is never overwritten in place). Returns
    the new version's path and the inserted / updated / kept counts.

    With ``buckets``, the documents are in a ``DocumentStore`` of so many hash
    buckets, where only those of the documents built are written again;
    ``symbols`` (those that a load touched) limits what is built."""
    fact = spark.read.parquet(f"{gold_base.rstrip('/')}/fact_trades")
    perf = spark.read.parquet(f"{marts_base.rstrip('/')}/mart_symbol_performance")
    daily = spark.read.parquet(f"{marts_base.rstrip('/')}/mart_daily_summary")
    if symbols is not None:
        fact, perf, daily = (d.filter(F.col("symbol").isin(list(symbols))) for d in (fact, perf, daily))
    docs = documents.portfolio_documents(perf, documents.recent_trades_per_symbol(fact), daily, run_time)
    if buckets:
        return DocumentStore(spark, docs_base, buckets=buckets).upsert(docs)
    live = writers.read_version(spark, docs_base)
    merged = (documents.upsert_documents(live, docs) if live is not None
              else docs.withColumn("_action", F.lit("inserted")))
    obs = Observation("documents")
    merged = merged.observe(obs, F.count_if(F.col("_action") == "inserted").alias("inserted"),
                            F.count_if(F.col("_action") == "updated").alias("updated"),
                            F.count_if(F.col("_action") == "kept").alias("kept"))
    with conf_override(spark, OBSERVED_WRITE_CONF):
        path = writers.write_version(spark, merged.drop("_action"), docs_base)
    return {"path": path, **{k: int(v) for k, v in obs.get.items()}}
