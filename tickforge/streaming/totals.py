"""Totals of a counted stream, kept next to its checkpoint in a bounded number of files.

Every epoch notes its counts under its number (a replayed epoch replaces them), so they are complete whatever fails. A
listener folds the noted epochs into one table, keyed by epoch, when ``FOLD_AT`` of them have ended: the table is written as a
new version and published before the notes go, so a crash leaves an epoch in both places at most, where it counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import path_exists, remove_path
from ..sinks import writers

#: Ended epochs that are folded at once, and versions of the table that stay for readers that began with an older one.
FOLD_AT, KEPT_VERSIONS = 16, 2


class EpochTotals:
    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}-counts"

    def _noted(self) -> dict[int, str]:
        fs, folder = writers._fs(self.spark, f"{self.path}/epochs")
        if not fs.exists(folder):
            return {}
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return {int(n): f"{self.path}/epochs/{n}" for n in names
                if n.isdigit() and path_exists(self.spark, f"{self.path}/epochs/{n}/_SUCCESS")}

    def note(self, epoch: int, **counts: int | None) -> None:
        """The epoch's counts; a replayed epoch replaces them."""
        (self.spark.createDataFrame([(int(epoch), *(None if v is None else int(v) for v in counts.values()))],
                                    "epoch long, " + ", ".join(f"{c} long" for c in counts))
             .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/epochs/{int(epoch):010d}"))

    def epochs(self) -> DataFrame | None:
        """One row per epoch; None before the first."""
        noted, table = self._noted(), writers.read_version(self.spark, f"{self.path}/table")
        parts = ([self.spark.read.parquet(*noted.values())] if noted else []) + ([table] if table is not None else [])
        if not parts:
            return None
        # A note is at least as new as the folded row of its epoch.
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(
            parts[1].join(F.broadcast(self.spark.createDataFrame([(e,) for e in noted], "epoch long")), "epoch", "left_anti"),
            allowMissingColumns=True)
        return rows

    def fold(self, ended: int, at_least: int = FOLD_AT) -> None:
        """Fold the notes of epochs up to ``ended`` into the table, if there are ``at_least`` so many."""
        old = {e: p for e, p in self._noted().items() if e <= ended}
        if len(old) < at_least:
            return
        rows = self.epochs().filter(F.col("epoch") <= ended).coalesce(1).sortWithinPartitions("epoch")
        writers.write_version(self.spark, rows, f"{self.path}/table")
        for path in old.values():
            remove_path(self.spark, path)
        writers.drop_versions(self.spark, f"{self.path}/table", KEPT_VERSIONS)

    def totals(self) -> dict:
        """Running totals since the checkpoint began: batches, and the sum of each count of rows."""
        rows = self.epochs()
        if rows is None:
            return {"batches": 0, "input_rows": 0}
        sums = rows.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in rows.columns if c.endswith("_rows")]).first()
        return {k: int(v or 0) for k, v in sums.asDict().items()}


class TotalsListener(StreamingQueryListener):
    """Folds a query's notes as its epochs end, and the rest when it ends."""

    def __init__(self, totals: EpochTotals):
        self.totals, self.id, self.last = totals, None, -1

    def follow(self, query) -> None:
        """Events of other queries are ignored."""
        self.id = str(query.id)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.id and event.progress.batchId % FOLD_AT == FOLD_AT - 1:
            # The epoch before has been committed, whatever becomes of this one.
            self.totals.fold(event.progress.batchId - 1)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.id:
            self.totals.spark.streams.removeListener(self)


def counted(spark: SparkSession, checkpoint: str, start):
    """Starts a query by ``start()`` and follows it with a listener that folds its notes."""
    listener = TotalsListener(EpochTotals(spark, checkpoint))
    spark.streams.addListener(listener)
    query = start()
    listener.follow(query)
    return query
