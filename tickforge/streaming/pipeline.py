"""Structured Streaming forms of ingest (topic -> Bronze) and Bronze -> Silver.

* Sources: a Kafka topic (``kafka_source``; needs the Kafka connector on the
  cluster) or a folder of files, both with an explicit schema and a
  per-trigger rate.
* Topic -> Bronze: ``topic_to_bronze`` tells the feeds apart, normalises both
  and writes Bronze. The file sink with a checkpoint is exactly-once, replacing
  the consumer-side auto-commit that could lose a partly written batch.
* Silver: the batch transforms run unchanged inside ``foreachBatch``. Every
  micro-batch is deduplicated, then merged into Silver insert-if-absent on
  trade_id through a key index, so a replayed epoch (after a failure) or a copy
  arriving in a later batch adds nothing, and no epoch reads the history.
* Streaming dedup: ``dedup_stream`` keeps the first arrival of each key. Keys
  of the last day of event time are in a state store (RocksDB) that a watermark
  bounds; rows behind the watermark are looked up in a key index instead, so
  none is lost and the fast path reads no stored key.
* Totals: each epoch notes its counts next to the checkpoint, and a listener
  folds the notes into one table (``totals``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import passes_all, with_failed_rules
from ..operators import gold, silver
from ..schemas import BRONZE_COLUMNS, BRONZE_PARTITIONS, BRONZE_SCHEMA
from ..session import OBSERVED_WRITE_CONF, conf_override, path_exists, remove_path, work_dir
from ..sinks import writers
from ..sinks.key_index import KeyIndex, insert_indexed
from ..sources import layers
from .totals import EpochTotals, counted


def bronze_file_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Bronze JSON files, at any depth under ``path``, as a stream (explicit
    schema, no inference)."""
    return (spark.readStream.schema(BRONZE_SCHEMA)
                 .option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", "true")
                 .json(path).select(*BRONZE_COLUMNS))


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str = "trades",
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Raw (key, value, timestamp) records of the trade topic, from earliest."""
    r = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"),
                           F.col("timestamp").alias("arrived_at"))


def events_as_bronze(events: DataFrame) -> DataFrame:
    """Normalised events (typed) -> Bronze text columns."""
    from ..sources.feeds import to_bronze_text

    return to_bronze_text(events)


def feed_file_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Raw feed messages landed as text lines (one JSON message per line),
    with the file's modification time as the arrival time."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
                 .load(path).select(F.col("value"), F.col("_metadata.file_modification_time").alias("arrived_at")))


def topic_file_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Topic records (value, arrived_at) landed as parquet files, with the
    arrival time of the topic's envelope."""
    return (spark.readStream.schema("value string, arrived_at timestamp").option("maxFilesPerTrigger", max_files_per_trigger)
                 .parquet(path))


def topic_to_bronze(records: DataFrame) -> DataFrame:
    """Topic records (value, arrived_at) of both feeds -> Bronze text columns.
    Feed-A events without an arrival time of their own get the envelope's."""
    from ..sources.feeds import normalize_topic

    return events_as_bronze(normalize_topic(records))


def write_bronze_stream(bronze: DataFrame, path: str, checkpoint: str,
                        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Exactly-once JSON file sink by arrival year/month/day/hour. As in the
    batch writer, an epoch's rows are dealt by hour first, so that each hour
    gets few files."""
    out = writers.by_partition(writers.bronze_partition_columns(bronze), BRONZE_PARTITIONS)
    w = (out.writeStream.format("json").partitionBy(*BRONZE_PARTITIONS)
            .option("path", path).option("checkpointLocation", checkpoint)
            .option("timestampFormat", writers.ISO_UTC).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def _note_counts(spark: SparkSession, checkpoint: str, epoch_id: int, **counts: int) -> None:
    EpochTotals(spark, checkpoint).note(epoch_id, **counts)


def progress_totals(spark: SparkSession, checkpoint: str) -> dict:
    """Running totals of a counted stream since its checkpoint began: batches,
    and the sum of each count."""
    return EpochTotals(spark, checkpoint).totals()


#: A time this far beyond a row's arrival is not taken for the stream's clock.
LEAD = "INTERVAL 1 DAY"
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _clock() -> Column:
    """A row's event time, null where there is none or it runs ahead of the row's arrival (it would make all others late)."""
    at, arrived = silver.parse_event_time("timestamp"), silver.parse_event_time("ingested_at")
    return F.when(at <= arrived + F.expr(LEAD), at)


def first_seen(bronze: DataFrame, delay: str, key: str = "trade_id") -> DataFrame:
    """The stream's rows (``_raw``), and beside them a row with the key alone for each key that the state has not seen.

    The state drops keys once the stream's clock is ``delay`` past their event
    time, and rows that come later than that do not reach it.
    """
    rows = bronze.withColumn("_clock", _clock())
    seen = (rows.filter(F.col("_clock").isNotNull() & F.col(key).isNotNull()).select(key, "_clock")
                .withWatermark("_clock", delay).dropDuplicatesWithinWatermark([key]))
    return rows.withColumn("_raw", F.lit(True)).unionByName(seen.withColumn("_raw", F.lit(False)), allowMissingColumns=True)


def dedup_batch_writer(path: str, checkpoint: str, delay: str, key: str = "trade_id", buckets: int = 64):
    """foreachBatch function over ``first_seen``: appends the first arrival of each new key to ``path``.

    Keys that the state let through are new, as their copies carry the same
    event time and would be in the state: the fast path reads no stored key.
    Rows behind the watermark, or without a time, are looked up in the key
    index next to ``path``, which both paths add to. The watermark in force is
    worked out from the epochs before (never lower than the state's, so that a
    row the state refused is always looked up). A replayed epoch looks up all
    of its rows; one that was complete is skipped.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        totals, index = EpochTotals(spark, checkpoint), KeyIndex(spark, f"{path.rstrip('/')}-keys", key, buckets)
        tag = f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}-{int(epoch_id):010d}"
        before = index.confirmed(tag)
        if before:
            return
        stored = spark.read.parquet(path) if path_exists(spark, path) else None
        replay = before is not None
        if replay and stored is not None:
            index.settle(stored)
        elif replay:
            remove_path(spark, index.path)
        elif stored is not None and not index.exists():
            index.build(stored.select(key))
        index.maintain(but=tag)
        past = totals.epochs()
        clock = past.filter(F.col("epoch") < int(epoch_id)).agg(F.max("clock")).first()[0] if past is not None else None
        stage, found = work_dir(spark, "dedup-batch"), work_dir(spark, "dedup-new")
        try:
            batch.write.parquet(stage)
            staged_rows = spark.read.schema(batch.schema).parquet(stage)
            rows = staged_rows.filter("_raw")
            watermark = None if clock is None else F.timestamp_micros(F.lit(clock)) - F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 SECOND")
            late = F.col("_clock").isNull() | (F.lit(False) if watermark is None else F.col("_clock") <= watermark)
            candidates = silver.dedup_by_key(rows.withColumn("_late", late).drop("_raw"), key)
            late_keys = rows.filter(late).select(key).distinct()
            on_time = staged_rows.filter(~F.col("_raw")).select(key).distinct()
            counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"),
                               F.unix_micros(F.max("_clock")).alias("clock")).first()
            columns = [c for c in candidates.columns if c not in ("_clock", "_late")]
            new = candidates.join(on_time, key, "left_semi").select(*columns)
            if replay:
                new = index.absent(new)
            if counted.late:
                behind = candidates.join(late_keys, key, "left_semi").join(on_time, key, "left_anti").select(*columns)
                new = new.unionByName(index.absent(behind))
            new.write.parquet(found)
            new = spark.read.schema(batch.select(*columns).schema).parquet(found)
            index.add(new, tag)
            new.write.mode("append").parquet(path)
            totals.note(epoch_id, input_rows=counted.n, late_rows=counted.late, stored_rows=new.count(),
                        clock=max((x for x in (counted.clock, clock) if x is not None), default=None))
            index.done(tag)
        finally:
            remove_path(spark, stage)
            remove_path(spark, found)
    return run


def dedup_stream(bronze: DataFrame, path: str, checkpoint: str, available_now: bool = True, delay: str = "1 day") -> StreamingQuery:
    """Stream dedup on trade_id, exact for any lateness. Its state, in RocksDB,
    holds the keys of the last ``delay`` of event time."""
    spark = bronze.sparkSession
    w = (first_seen(bronze, delay).writeStream.foreachBatch(dedup_batch_writer(path, checkpoint, delay))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    with conf_override(spark, ROCKSDB):
        return counted(spark, checkpoint, w.start)


def silver_key_index(silver_path: str) -> str:
    """Where the key index of a Silver table is."""
    return f"{silver_path.rstrip('/')}-keys"


def silver_batch_writer(silver_path: str, dead_letter_base: str, checkpoint: str, rules: dict[str, str] | None = None,
                        key_scope: str = "index", buckets: int = 64):
    """foreachBatch function: clean one micro-batch and merge it into Silver.

    The prepared rows are staged once for both sides of the split. The merge
    finds the batch's keys in an index kept next to Silver (``key_index``), so
    its cost follows the batch and not the history. ``key_scope="global"``
    compares with every stored key instead; ``"partition"`` reads only the
    Silver partitions (trade dates) that the micro-batch touches, for feeds
    whose copies never change their event time.
    The dead letter and the counts of epoch N have a place of their own,
    overwritten on replay, so a retried epoch duplicates nothing.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        raw, stage = work_dir(spark, "batch"), work_dir(spark, "prepared")
        try:
            batch.write.parquet(raw)
            rows = spark.read.parquet(raw)
            silver.silver_prepared(rows).withColumn("_ok", passes_all(rules)).write.parquet(stage)
            prepared = spark.read.parquet(stage)
            good, bad = prepared.filter("_ok").drop("_ok"), prepared.filter("NOT _ok").drop("_ok")
            stored = layers.read_silver(spark, silver_path) if path_exists(spark, silver_path) else None
            if key_scope == "index":
                index = KeyIndex(spark, silver_key_index(silver_path), buckets=buckets)
                stored_rows = insert_indexed(good, index, stored, lambda new: writers.write_silver(new, silver_path))
            else:
                if stored is not None:
                    good = (gold.insert_new_in_partitions(good, stored, "trade_id", "trade_date")
                            if key_scope == "partition" else gold.insert_new(good, stored, "trade_id"))
                obs = Observation("good")
                with conf_override(spark, OBSERVED_WRITE_CONF):
                    writers.write_silver(good.observe(obs, F.count(F.lit(1)).alias("n")), silver_path)
                stored_rows = int(obs.get["n"])
            (with_failed_rules(bad, rules).write.mode("overwrite").option("timestampFormat", writers.ISO_UTC)
                .json(f"{dead_letter_base.rstrip('/')}/epoch_{epoch_id:08d}"))
            _note_counts(spark, checkpoint, epoch_id, input_rows=rows.count(), dead_letter_rows=bad.count(), stored_rows=stored_rows)
        finally:
            remove_path(spark, raw)
            remove_path(spark, stage)
    return run


def start_silver_stream(bronze_stream: DataFrame, silver_path: str, dead_letter_base: str, checkpoint: str,
                        available_now: bool = True, rules: dict[str, str] | None = None,
                        key_scope: str = "index") -> StreamingQuery:
    w = (bronze_stream.writeStream
            .foreachBatch(silver_batch_writer(silver_path, dead_letter_base, checkpoint, rules, key_scope))
            .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return counted(bronze_stream.sparkSession, checkpoint, w.start)


def land_by_arrival_day(bronze: DataFrame, path: str, time_col: str = "ingested_at") -> None:
    """Land ``bronze`` as JSON files in a folder per arrival day (rows without
    one in a folder of their own), in one job with as many files as the rows
    need: a landing folder for the file-stream sources."""
    day = F.date_format(silver.parse_event_time(time_col), "yyyy-MM-dd")
    (writers.by_partition(bronze.withColumn("arrival_day", day), ["arrival_day"])
        .write.mode("append").partitionBy("arrival_day").json(path))
