"""SparkSession construction and the few session-level settings the engine relies on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in the package assumes. UTC matters for date_format / hour()
# (the trade_date / trade_hour partition values); AQE re-plans joins and coalesces
# shuffle partitions at runtime, and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tickforge",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Return (or create) a session configured for the engine.

    On a cluster, ``master`` stays None and the launcher decides; pass
    ``input_bytes`` and ``total_cores`` to size shuffles with ``cluster_conf``. Locally we default to the
    core count, since 200 tiny partitions only add scheduling overhead.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if input_bytes and total_cores:
        conf.update(cluster_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark, shuffle_partitions)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Sizing for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 2 per core), so no reducer holds more than its share in
    memory; AQE then coalesces small ones toward the same advisory size and
    splits skewed join partitions above 4x the median. Scans split at the same
    size. Example: 100 TB on 1000 executors x 8 cores gives ~400k shuffle
    partitions before coalescing.
    """
    parts = max(2 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # broadcast only what the runtime statistics show to be small
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def apply_engine_conf(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    """Apply the engine settings, all of which a session can change at run time, to an existing session.

    Fails if one cannot be set: results depend on the UTC zone.
    """
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))


class NoSharedFolderError(RuntimeError):
    """Raised when intermediate tables have no folder that every executor sees."""


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or a checkpoint dir that is already set). A local master, where
    driver and executors are one process, falls back to a temp folder, which goes when Python ends; any other fails,
    since each executor would write to its own disk.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        base = sc.getConf().get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise NoSharedFolderError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="tickforge-ckpt-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
        sc.setCheckpointDir(base)
    return sc.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint base."""
    return f"{checkpoint_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint base and read back: computed once, its lineage cut."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller made for intermediate data."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def conf_override(spark: SparkSession, settings: dict):
    """Temporarily set runtime SQL confs, restoring the previous values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# AQE replaces a stage found empty at runtime by an empty relation, which also
# drops the CollectMetrics nodes of DataFrame.observe from the final plan, so
# the observed counts of a write with nothing left to write would be lost.
OBSERVED_WRITE_CONF = {
    "spark.sql.adaptive.optimizer.excludedRules":
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation",
}
