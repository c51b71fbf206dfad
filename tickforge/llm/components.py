"""Connected components over membership rows (node, key): nodes that share a key are connected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import join_counted, staged


def components(members: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for each node of ``members`` (node, key; both not null).

    Each round every key takes the least label of its nodes (partial minima first) and every node the least of its keys'.
    Rounds run until nothing changes, about half the largest distance in a component. Hot keys are met by
    ``join_counted``; a node must have few keys.
    """
    state = staged(members.select("node", "key", F.col("node").alias("label")), "members")
    rows = state.count()
    while rows:
        least = staged(state.groupBy("key").agg(F.min("label").alias("least"), F.count(F.lit(1)).alias("n")), "least")
        met = join_counted(state, least, "key", rows)
        new = F.min("least").over(W.partitionBy("node"))
        state = staged(met.withColumn("new", new).select("node", "key", F.col("new").alias("label"),
                                                         (F.col("new") < F.col("label")).alias("moved")), "members")
        if state.filter("moved").isEmpty():
            break
        state = state.drop("moved")
    return state.groupBy("node").agg(F.min("label").alias("label"))
