"""The keys that a stored table holds, laid out so that a small batch finds its own without reading them all.

``base``  an external table of the keys alone, bucketed and sorted by the key, with Parquet Bloom filters. A short list of keys
          selects their buckets, and inside these only row groups whose Bloom filter and extremes admit one of them; a long
          list meets the buckets by a merge join that shuffles the batch only.
``tail``  a small folder of keys per load since the last merge, of at most ``MERGE_AT`` loads.

A load says what it is about to store (``add``), stores it, and confirms (``done``). If it fails between, the next one calls
``settle``, which reduces what was not confirmed to what the table really holds, so that a replay stores the rest once. Merging
adds to the base what is confirmed, and only then removes it from the tail: a key that is in both for a moment counts once.
After ``FILES_A_BUCKET`` merges the base is rewritten as a new version with one sorted file a bucket.

One writer at a time, as for any stream with a checkpoint. Null keys are never held.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import conf_override, path_exists, remove_path
from . import writers

#: Up to this many distinct keys of a batch are looked up one by one.
LISTED = 1000
#: Loads that the tail holds before they are merged into the base, and merges before the base is rewritten.
MERGE_AT, FILES_A_BUCKET = 16, 8


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key: str = "trade_id", buckets: int = 64, listed: int = LISTED):
        self.spark, self.path, self.key, self.listed = spark, path.rstrip("/"), key, listed
        self.buckets = buckets

    # ---- layout -----------------------------------------------------------------------------

    @property
    def _schema(self) -> str:
        return f"`{self.key}` string"

    def _base(self) -> str | None:
        """Name of the table over the live version of the base, registered in this session's catalog; None without one."""
        location = writers.current_version(self.spark, f"{self.path}/base")
        return self._table(location) if location else None

    def _table(self, location: str) -> str:
        name = "key_index_" + hashlib.sha256(location.encode()).hexdigest()[:16]
        buckets = int(location.rsplit("-b", 1)[1])
        options = ", ".join(f"'{k}' '{v}'" for k, v in writers.bloom_options(self.key).items())
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self._schema}) USING parquet OPTIONS ({options}) "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{location}'")
        return name

    def _tags(self) -> dict[str, bool]:
        """The tail's loads, and whether each is confirmed."""
        fs, folder = writers._fs(self.spark, f"{self.path}/tail")
        if not fs.exists(folder):
            return {}
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return {n: path_exists(self.spark, f"{self.path}/tail/{n}/_DONE") for n in sorted(names)}

    def _tail(self, tags) -> DataFrame | None:
        paths = [f"{self.path}/tail/{t}" for t in tags]
        return self.spark.read.schema(self._schema).parquet(*paths) if paths else None

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def keys(self) -> DataFrame:
        """All keys held, each at least once."""
        parts = [self.spark.table(b) for b in [self._base()] if b] + [t for t in [self._tail(self._tags())] if t is not None]
        out = self.spark.createDataFrame([], self._schema)
        for p in parts:
            out = out.unionByName(p)
        return out

    # ---- looking up -------------------------------------------------------------------------

    def stored_among(self, keys: list[str]) -> DataFrame:
        """Which of a short list of keys are held; a scan of their buckets' row groups that may hold one, and of the tail."""
        wanted = F.col(self.key).isin(keys)
        parts = [self.spark.table(b).filter(wanted) for b in [self._base()] if b]
        parts += [t.filter(wanted) for t in [self._tail(self._tags())] if t is not None]
        out = parts[0] if parts else self.spark.createDataFrame([], self._schema)
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def lookup_conf(self) -> dict:
        """Pushes lists of keys down to the Parquet reader whole, where Bloom filters can see each."""
        return {"spark.sql.parquet.pushdown.inFilterThreshold": str(self.listed)}

    def absent(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (staged, each key once) whose key is not held; rows with a null key are left out."""
        batch = batch.dropna(subset=[self.key])
        keys = [r[0] for r in batch.select(self.key).distinct().limit(self.listed + 1).collect()]
        if len(keys) <= self.listed:
            with conf_override(self.spark, self.lookup_conf()):
                held = {r[0] for r in self.stored_among(keys).collect()} if keys else set()  # at most ``listed``
            return batch.filter(~F.col(self.key).isin(list(held))) if held else batch
        base, tail = self._base(), self._tail(self._tags())
        if base:
            # A merge join on the bucketing: the stored side keeps its place.
            batch = batch.join(self.spark.table(base).hint("merge"), self.key, "left_anti")
        if tail is not None:
            batch = batch.join(tail, self.key, "left_anti")
        return batch

    # ---- changing ---------------------------------------------------------------------------

    def _insert(self, keys: DataFrame, location: str) -> None:
        """Adds one sorted file to each bucket of a base."""
        buckets = int(location.rsplit("-b", 1)[1])
        keys.repartition(buckets, self.key).sortWithinPartitions(self.key).write.insertInto(self._table(location))

    def build(self, keys: DataFrame) -> None:
        """A new base of these keys alone, published when it is complete; the tail's confirmed loads are dropped."""
        tags = [t for t, ok in self._tags().items() if ok]
        location = f"{self.path}/base/v-{uuid.uuid4().hex[:12]}-b{self.buckets}"
        self._insert(keys.select(F.col(self.key).cast("string").alias(self.key)).dropna().distinct(), location)
        writers.publish_version(self.spark, f"{self.path}/base", location)
        for t in tags:
            remove_path(self.spark, f"{self.path}/tail/{t}")

    def add(self, rows: DataFrame, tag: str | None = None) -> str:
        """Notes the keys of rows that are about to be stored; returns the load's tag."""
        tag = tag or uuid.uuid4().hex[:12]
        keys = rows.select(F.col(self.key).cast("string").alias(self.key)).dropna()
        keys.hint("rebalance").write.options(**writers.bloom_options(self.key)).parquet(f"{self.path}/tail/{tag}")
        return tag

    def done(self, tag: str) -> None:
        fs, marker = writers._fs(self.spark, f"{self.path}/tail/{tag}/_DONE")
        fs.create(marker, False).close()

    def settle(self, stored: DataFrame) -> None:
        """Reduces loads that were never confirmed to the keys that ``stored`` holds."""
        for tag in [t for t, ok in self._tags().items() if not ok]:
            if path_exists(self.spark, f"{self.path}/tail/{tag}/_SUCCESS"):
                noted = self._tail([tag])
                kept = self.add(stored.select(self.key).join(noted, self.key, "left_semi").distinct())
                self.done(kept)
            remove_path(self.spark, f"{self.path}/tail/{tag}")

    def confirmed(self, tag: str) -> bool | None:
        """Whether a load in the tail is confirmed; None if there is none of that tag."""
        return self._tags().get(tag)

    def maintain(self, but: str | None = None) -> None:
        """Merges a long tail into the base, all but one load of it, and rewrites a base of many files."""
        tags = [t for t, ok in self._tags().items() if ok and t != but]
        if len(tags) < MERGE_AT:
            return
        location = writers.current_version(self.spark, f"{self.path}/base")
        if location is None:
            self.build(self._tail(tags))
            return
        self._insert(self._tail(tags), location)
        for t in tags:
            remove_path(self.spark, f"{self.path}/tail/{t}")
        name = self._table(location)
        self.spark.catalog.refreshTable(name)
        if len(self.spark.table(name).inputFiles()) > FILES_A_BUCKET * int(location.rsplit("-b", 1)[1]):
            self.build(self.spark.table(name))


def insert_indexed(batch: DataFrame, index: KeyIndex, stored: DataFrame | None, store) -> int:
    """Stores the rows of ``batch`` (staged, each key once) whose key is new, by ``store(rows)``, and notes them in the index.

    ``stored``: the table as it is, None if there is none yet; read only to build a missing index and after a failed load.
    Returns the number of rows stored.
    """
    spark = batch.sparkSession
    if stored is not None and not index.exists():
        index.build(stored.select(index.key))
    elif stored is not None:
        index.settle(stored)
    elif index.exists():
        remove_path(spark, index.path)  # nothing is stored, whatever was noted
    from ..session import work_dir

    stage = work_dir(spark, "new-rows")
    try:
        index.absent(batch).write.parquet(stage)
        new = spark.read.schema(batch.schema).parquet(stage)
        tag = index.add(new)
        store(new)
        index.done(tag)
        index.maintain()
        return new.count()
    finally:
        remove_path(spark, stage)
