"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

The index is a table (digest, keep_id) whose files are bucketed and sorted by digest. A batch is reduced to one row per
digest, a sort-merge anti-join against the index finds the digests not seen before, and those are appended. The index
side of that join needs no shuffle; the batch side is dealt to the same number of buckets.

Defined results: a null text counts as empty; texts are equal when they are the same after each white-space run became
one space; of equal texts new to the index the smallest doc_id stays (a null doc_id only if no other has the text); rows
that repeat a doc_id get the same decision; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import SPACE_RUN, carrying, join_counted, staged, table
from tickforge.session import work_dir


def normalised(text):
    """The text with each white-space run turned into one space; null gives the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def open_index(spark: SparkSession, name: str, path: str, buckets: int) -> str:
    """Register the index kept under ``path`` (made empty if absent) as table ``name`` of this session.

    ``buckets`` is fixed when an index is first made; size it so that one bucket's digests fit a task (about 70 bytes
    a digest: 4,096 buckets hold 3e10 digests at half a GB each).
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT) USING parquet "
              f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return name


def index_buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").select("data_type").collect()
    return int(rows[0][0])


def add_documents(docs: DataFrame, index: str) -> DataFrame:
    """Dedupe a batch against the index, append its new digests, and return each row's decision.

    Columns: doc_id, keep_id (the document that stands for the text, of this batch or an earlier one), group_size (rows
    of this batch with the text), kept, text_sha256.
    """
    spark = docs.sparkSession
    batch = staged(docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256")), "digests")
    groups = staged(batch.groupBy("text_sha256").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")),
                    "groups")
    buckets = index_buckets(spark, index)
    fresh = (groups.select(F.col("text_sha256").alias("digest"), F.col("first_id").alias("keep_id"))
             .repartition(buckets, "digest").hint("merge")
             .join(spark.table(index).hint("merge"), "digest", "left_anti"))
    # Reading and appending the same table: the new rows are staged before they are inserted.
    staged(fresh, "fresh").repartition(buckets, "digest").write.insertInto(index)
    spark.catalog.refreshTable(index)
    standing = groups.hint("merge").join(
        spark.table(index).withColumnRenamed("digest", "text_sha256").hint("merge"), "text_sha256")
    out = join_counted(batch, staged(standing, "standing"), "text_sha256", batch.count())
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def dedupe(docs: DataFrame) -> DataFrame:
    """Decisions for ``docs`` alone, through a new index."""
    spark = docs.sparkSession
    name = f"digest_index_{uuid.uuid4().hex[:12]}"
    open_index(spark, name, work_dir(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return add_documents(docs, name)


@carrying
def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat a doc_id one stays."""
    kept = dedupe(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_n"))
    kept = staged(kept, "kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"), "_n")
    columns = docs.columns
    digest = F.sha2(normalised(F.col("text")), 256)
    marked = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (digest == F.col("_digest"))).drop("_id")
    once = marked.filter("_n = 1").select(columns)
    repeated = (marked.filter("_n > 1").groupBy(F.col("doc_id").alias("_key"), "_digest")
                .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("row")).select("row.*"))
    return once.unionByName(repeated)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256."""
    return dedupe(table(spark, sf_dir, "documents", "doc_id", "text"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
