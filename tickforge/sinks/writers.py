"""Writers for every layer. One action per sink; paths and formats are
arguments, so the same code writes to a cluster file system or object store.

Layouts:
* Bronze: JSON lines, partitioned by arrival year/month/day/hour (zero-padded).
* Silver: parquet partitioned by trade_date/trade_hour; rows are dealt by the
  partition columns first, so each task writes few files, and sorted by
  symbol/timestamp inside files so row-group statistics prune symbol filters.
  Large partitions are split over tasks (see ``by_partition``).
* Dead letter: JSON under a per-run folder that must not exist yet.
* Gold tables: parquet, fact partitioned by trade_date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import BRONZE_PARTITIONS, SILVER_PARTITIONS

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def bronze_partition_columns(df: DataFrame, arrival_col: str = "ingested_at") -> DataFrame:
    """year / month / day / hour of the arrival time, zero-padded text.
    Text arrival times are parsed the same way the Silver cast parses them."""
    from ..operators.silver import parse_event_time

    t = F.col(arrival_col)
    if dict(df.dtypes)[arrival_col] == "string":
        t = parse_event_time(t)
    return df.withColumns({"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"),
                           "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")})


def by_partition(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows dealt to tasks by their partition columns, for a partitioned write.

    A rebalance, unlike ``repartition``, lets adaptive execution split a large
    partition (a hot hour, day or the NULL partition) over several tasks and
    files of the advisory size, and merge small ones into one task.
    """
    return df.hint("rebalance", *columns)


def write_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Bronze rows as JSON lines by arrival hour. File names are unique per
    write, so two writes in the same second never overwrite each other."""
    out = bronze_partition_columns(df)
    (by_partition(out, BRONZE_PARTITIONS)
        .write.mode(mode).partitionBy(*BRONZE_PARTITIONS)
        .option("timestampFormat", ISO_UTC).json(path))


def bloom_options(column: str) -> dict:
    """Writer options for a Bloom filter on a column in every row group, of the size its values need."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def write_silver(df: DataFrame, path: str, mode: str = "append") -> None:
    """Silver with a Bloom filter on trade_id: a look-up of some ids skips the row groups that hold none of them."""
    (by_partition(df, SILVER_PARTITIONS)
       .sortWithinPartitions(*SILVER_PARTITIONS, "symbol", "timestamp")
       .write.mode(mode).options(**bloom_options("trade_id")).partitionBy(*SILVER_PARTITIONS).parquet(path))


def write_dead_letter(df: DataFrame, base: str, run_id: str) -> str:
    """Rejected rows (with ``failed_rules``) under ``base/trades_<run_id>``;
    fails if that run folder already exists. A run without rejects leaves a
    folder without rows, which marks the run as done."""
    path = f"{base.rstrip('/')}/trades_{run_id}"
    df.write.mode("errorifexists").option("timestampFormat", ISO_UTC).json(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", bloom: str | None = None) -> None:
    """A parquet table, where asked by partition and with a Bloom filter on one column."""
    options = bloom_options(bloom) if bloom else {}
    if partition_by:
        by_partition(df, partition_by).write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).options(**options).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export with a header line (one folder of part files)."""
    df.write.mode(mode).option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str = "view",
                path: str | None = None) -> DataFrame:
    """``view``: a temp view (recomputed on use, always fresh).
    ``table``: written to ``path`` as parquet and read back (a lineage cut),
    then registered under ``name``."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table" or not path:
        raise ValueError("kind must be 'view', or 'table' with a path")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, base: str) -> list[int]:
    fs, folder = _fs(spark, f"{base.rstrip('/')}/_VERSIONS")
    if not fs.exists(folder):
        return []
    return [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit() and f.getLen() > 0]


def current_version(spark: SparkSession, base: str) -> str | None:
    """Path of the live version of a versioned table, or None."""
    numbers = _versions(spark, base)
    if not numbers:
        return None
    return _pointed(spark, f"{base.rstrip('/')}/_VERSIONS/{max(numbers):010d}")


def _pointed(spark: SparkSession, pointer: str) -> str:
    fs, p = _fs(spark, pointer)
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def write_version(spark: SparkSession, df: DataFrame, base: str) -> str:
    """Replace a table without overwriting the path being read: write the new
    rows to a fresh version folder, then add a pointer file ``_VERSIONS/<n>``
    that names it. Pointers are only ever added, under the next free number,
    and readers follow the highest: at every moment one complete version is
    live, a failed write leaves the old one live, and nothing is renamed or
    deleted. Two writers that race for a number: the second fails, as
    creation does not overwrite.
    """
    import uuid

    target = f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(target)
    publish_version(spark, base, target)
    return target


def publish_version(spark: SparkSession, base: str, target: str) -> None:
    """Make the complete folder ``target`` the live version of ``base`` (see ``write_version``)."""
    number = max(_versions(spark, base), default=0) + 1
    fs, pointer = _fs(spark, f"{base.rstrip('/')}/_VERSIONS/{number:010d}")
    out = fs.create(pointer, False)
    out.write(bytearray(target.encode("utf-8")))
    out.close()


def drop_versions(spark: SparkSession, base: str, keep: int) -> None:
    """Delete the folders of all but the ``keep`` newest versions, and then their pointers."""
    from ..session import remove_path

    for number in sorted(_versions(spark, base))[:-keep]:
        pointer = f"{base.rstrip('/')}/_VERSIONS/{number:010d}"
        remove_path(spark, _pointed(spark, pointer))
        remove_path(spark, pointer)


def read_version(spark: SparkSession, base: str) -> DataFrame | None:
    v = current_version(spark, base)
    return spark.read.parquet(v) if v else None


def write_keyed_files(df: DataFrame, path: str, key: str = "symbol", order: str = "timestamp",
                      fmt: str = "json", mode: str = "overwrite") -> None:
    """Files in which each key's rows are contiguous and in ``order``.

    Range partitioning on (key, order) keeps a key's rows in order across
    consecutive files and splits a hot key over several tasks (hash
    partitioning on the key alone would put all of it in one task).
    """
    (df.repartitionByRange(key, order).sortWithinPartitions(key, order)
       .write.mode(mode).format(fmt).option("timestampFormat", ISO_UTC).save(path))


def order_violations(files: DataFrame, key: str = "symbol", order: str = "timestamp") -> DataFrame:
    """Per key: rows, and how often a row of keyed files comes before an earlier
    one, inside a file or across files. Files are of bounded size, so no task
    sees more than one file's rows or one key's files."""
    place = files.select(key, order, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.partitionBy("_file").orderBy("_row")
    late = (F.lag(key).over(before) == F.col(key)) & (F.lag(order).over(before) > F.col(order))
    inside = place.withColumn("_late", F.coalesce(late, F.lit(False)).cast("int")).groupBy(key, "_file").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_late").alias("_late"), F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    across = F.lag("_hi").over(Window.partitionBy(key).orderBy("_file")) > F.col("_lo")
    return (inside.withColumn("_across", F.coalesce(across, F.lit(False)).cast("int")).groupBy(key)
                  .agg(F.sum("_n").alias("trades"), F.sum(F.col("_late") + F.col("_across")).alias("order_violations")))


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str = "trades", key_col: str = "symbol") -> None:
    """JSON messages keyed by ``key_col`` (per-key order within a partition)
    to a topic. Needs the Kafka connector on the cluster."""
    from ..sources.feeds import encode_messages

    (encode_messages(df, key_col=key_col).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())


def write_documents_json(docs: DataFrame, path: str, key: str = "_id", mode: str = "overwrite") -> None:
    """Nested documents as JSON lines (one document per line), the form a
    document store bulk-loads. Documents are range-partitioned by key so each
    file holds a contiguous key range; NULL fields are kept as JSON nulls."""
    (docs.repartitionByRange(key).write.mode(mode)
         .option("ignoreNullFields", "false").json(path))
