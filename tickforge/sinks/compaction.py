"""Compaction of a partitioned folder of many small files, while streams go on appending to it.

Small files of a partition are packed by first-fit decreasing into groups of about the target size, and each group of two or
more is written again as one file beside the folder. A manifest (one line, a new version each time) names the files that were
replaced and the folders that replace them; it is added when the new files are complete. A reader takes the folder's files
that no manifest names, whenever they came, and the replacing files: every row once, before, during and after. Nothing in the
folder is touched, so a streaming sink's own log stays true; ``drop_replaced`` deletes the small files later.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path
from . import writers


def first_fit_decreasing(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Groups of files whose sizes add up to ``target`` at most (a larger file is a group of its own)."""
    groups, room = [], []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        at = next((i for i, r in enumerate(room) if r >= sizes[name]), None)
        if at is None:
            groups.append([])
            room.append(target)
            at = len(groups) - 1
        groups[at].append(name)
        room[at] -= sizes[name]
    return groups


class CompactedFolder:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partitions: list[str], fmt: str = "json",
                 options: dict | None = None):
        self.spark, self.path, self.schema, self.partitions = spark, path.rstrip("/"), schema, partitions
        self.format, self.options = fmt, options or {}
        self.beside = f"{self.path}-compacted"

    def _manifest(self) -> dict:
        line = writers.current_version(self.spark, self.beside)
        return json.loads(line) if line else {"replaced": [], "folders": []}

    def _load(self, base: str, paths: list[str], extra: list[str] | None = None) -> DataFrame:
        have = {f.name for f in self.schema.fields}
        schema = T.StructType([*self.schema.fields, *(T.StructField(p, T.StringType()) for p in [*self.partitions, *(extra or [])] if p not in have)])
        return self.spark.read.schema(schema).options(**self.options).option("basePath", base).format(self.format).load(paths)

    def _loose(self) -> list[str]:
        """Files of the folder that no manifest replaces, by the sink's own log where it keeps one."""
        replaced = set(self._manifest()["replaced"])
        # Spark hands file names out as URIs, which escape what partition names escape already.
        return [f for f in (unquote(u) for u in self._load(self.path, [self.path]).inputFiles()) if f not in replaced]

    def _size(self, file: str) -> int:
        fs, p = writers._fs(self.spark, file)
        return fs.getFileStatus(p).getLen()

    def read(self) -> DataFrame:
        """Every row once, with the partition columns."""
        columns = [*self.schema.fieldNames(), *(p for p in self.partitions if p not in self.schema.fieldNames())]
        loose, folders = self._loose(), self._manifest()["folders"]
        parts = [self._load(self.path, loose)] if loose else []
        parts += [self._load(f, [f], ["_group"]) for f in folders]
        out = parts[0].select(*columns) if parts else self._load(self.path, [self.path]).limit(0).select(*columns)
        for p in parts[1:]:
            out = out.unionByName(p.select(*columns))
        return out

    def compact(self, target: int) -> dict:
        """Packs the loose files of every partition; the numbers of files replaced and written."""
        of = defaultdict(dict)
        for f in self._loose():
            of[f.rsplit("/", 1)[0]][f] = self._size(f)
        groups = [g for sizes in of.values() for g in first_fit_decreasing(sizes, target) if len(g) > 1]
        if not groups:
            return {"replaced": 0, "written": 0}
        files = [f for g in groups for f in g]
        folder = f"{self.beside}/c-{uuid.uuid4().hex[:12]}"
        number = self.spark.createDataFrame([(f, i) for i, g in enumerate(groups) for f in g], "_path string, _group int")
        rows = self._load(self.path, files).select("*", F.col("_metadata.file_path").alias("_path"))
        known = {u: unquote(u) for u in self._load(self.path, files).inputFiles()}
        names = self.spark.createDataFrame([(_plain(u), f) for u, f in known.items()], "_path string, _file string")
        rows = (rows.withColumn("_path", F.regexp_replace("_path", "^[a-z0-9]+:/+", "/"))
                    .join(F.broadcast(names.join(number.withColumnRenamed("_path", "_file"), "_file").drop("_file")), "_path").drop("_path"))
        (rows.repartition(len(groups), "_group").write.mode("errorifexists").options(**self.options)
             .partitionBy(*self.partitions, "_group").format(self.format).save(folder))
        before = self._manifest()
        writers.publish_version(self.spark, self.beside, json.dumps(
            {"replaced": before["replaced"] + files, "folders": before["folders"] + [folder]}))
        return {"replaced": len(files), "written": len(groups)}

    def file_count(self) -> int:
        return len(self._loose()) + sum(len(self._load(f, [f], ["_group"]).inputFiles()) for f in self._manifest()["folders"])

    def drop_replaced(self) -> int:
        """Deletes the replaced small files, once no reader follows an older manifest and no sink's log names them."""
        gone = self._manifest()["replaced"]
        for f in gone:
            remove_path(self.spark, f)
        return len(gone)


def _plain(uri: str) -> str:
    """A file's URI without scheme."""
    return "/" + uri.split(":", 1)[1].lstrip("/") if ":" in uri.split("/", 1)[0] else uri
