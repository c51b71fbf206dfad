"""Documents by key in hash buckets, with a manifest per version: an upsert rewrites the buckets that its keys fall in.

A version is one line that names the folder of each bucket; it is added when its new folders are complete, and readers follow
the newest, so a failed upsert leaves the live version as it was. Folders of older versions stay until ``drop_unused``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import upsert_documents
from ..session import OBSERVED_WRITE_CONF, conf_override, remove_path, work_dir
from . import writers


class DocumentStore:
    def __init__(self, spark: SparkSession, base: str, key: str = "_id", buckets: int = 64):
        """``buckets`` counts for a new store; one that exists keeps its own number."""
        self.spark, self.base, self.key = spark, base.rstrip("/"), key
        self.buckets = self._manifest().get("buckets", buckets)

    def _manifest(self) -> dict:
        line = writers.current_version(self.spark, self.base)
        return json.loads(line) if line else {}

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _read(self, folders: dict) -> DataFrame | None:
        paths = [f"{self.base}/{folder}/_bucket={b}" for b, folder in folders.items()]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        """All documents of the live version; None before the first."""
        return self._read(self._manifest().get("folders", {}))

    def get(self, keys: list) -> DataFrame | None:
        """The documents of some keys, from their buckets alone."""
        folders = self._manifest().get("folders", {})
        asked = self.spark.createDataFrame([(k,) for k in keys], f"`{self.key}` string").select(self._bucket().alias("b")).distinct()
        found = self._read({str(r.b): folders[str(r.b)] for r in asked.collect() if str(r.b) in folders})
        return None if found is None else found.filter(F.col(self.key).isin(list(keys)))

    def upsert(self, docs: DataFrame) -> dict:
        """Replaces whole documents by key and adds new ones; the numbers of either, and of buckets written."""
        stage, folder = work_dir(self.spark, "documents"), f"v-{uuid.uuid4().hex[:12]}"
        try:
            docs.withColumn("_bucket", self._bucket()).write.parquet(stage)
            incoming = self.spark.read.parquet(stage)
            touched = [str(r[0]) for r in incoming.select("_bucket").distinct().collect()]
            if not touched:
                return {"inserted": 0, "updated": 0, "buckets": 0}
            manifest = self._manifest()
            folders = manifest.get("folders", {})
            old = self._read({b: folders[b] for b in touched if b in folders})
            merged = (upsert_documents(old, incoming.drop("_bucket"), self.key) if old is not None
                      else incoming.drop("_bucket").withColumn("_action", F.lit("inserted")))
            obs = Observation("documents")
            merged = merged.observe(obs, *[F.count_if(F.col("_action") == a).alias(a) for a in ("inserted", "updated")])
            with conf_override(self.spark, OBSERVED_WRITE_CONF):
                writers.write_table(merged.drop("_action").withColumn("_bucket", self._bucket()), f"{self.base}/{folder}",
                                    ["_bucket"], mode="errorifexists")
            writers.publish_version(self.spark, self.base, json.dumps(
                {"buckets": self.buckets, "folders": folders | {b: folder for b in touched}}))
            return {k: int(v) for k, v in obs.get.items()} | {"buckets": len(touched)}
        finally:
            remove_path(self.spark, stage)

    def drop_unused(self) -> list[str]:
        """Deletes the folders that the live version does not name, once no reader follows an older one."""
        fs, at = writers._fs(self.spark, self.base)
        used = set(self._manifest().get("folders", {}).values())
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        unused = [n for n in names if n.startswith("v-") and n not in used]
        for n in unused:
            remove_path(self.spark, f"{self.base}/{n}")
        return unused
