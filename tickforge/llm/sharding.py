"""Sharding by balanced label propagation, in DataFrame operations only.

Documents of equal text are linked. Every document starts in a hash shard; then rounds of joins move linked documents to
the shard that holds most of their neighbours, as far as the shards' capacity lets them, so that few links are cut while
the shards stay even. The law is ``rows``: shard sizes differ by one row at most.

State. Neighbours with the same hash atom are interchangeable, so the state is a row per (link group, atom) with the
number of its documents and its shard. A group of two has two atoms as a rule; a group that holds a third of all rows has
``ATOMS`` of them, none of which outweighs a task.

A round: (1) documents per (group, shard), partial sums first; (2) each group's best shard: most neighbours, ties by a
hash that changes with the round. Even rounds take any shard that isn't full of the group itself, odd rounds prefer
shards with room; (3) atoms elsewhere propose to move there; (4) proposals from one shard to another are ordered by gain
(neighbours gained less neighbours left) and then by hash, in ``GAINS * HASHES`` classes. Documents may move along cycles
of shards, which leaves every shard as full as it was, so that full shards exchange documents, and along paths that end in
free room. ``exchanges`` finds how many may go from each shard to each other one, and the leading classes that fit go.
What passes the driver in a round is a load and a row of wishes and limits per shard.

Afterwards unlinked documents give way: each shard ranks its documents, linked ones first and small groups side by side,
and those beyond its quota fill the places left in other shards, by rank.

Defined results: a null text is linked to nothing, has size 1 and a null crc; an empty text is a text like others; rows
that repeat a doc_id are rows of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import staged, table

SHARDS, ROUNDS = 16, 8
#: Most atoms that a link group is split into; at least the number of tasks that a hot group should spread over.
ATOMS = 4096
#: Order classes of proposals: so many levels of gain (powers of two), each with so many hash classes.
GAINS, HASHES = 32, 1024
#: Hash buckets in which a shard's documents are ranked.
BUCKETS = 4096
#: Link groups of so many documents at most are ranked side by side.
TOGETHER = 64


def _per_shard(values) -> "F.Column":
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _sums(df: DataFrame, shards: int, value="n") -> list[int]:
    got = {r[0]: r[1] for r in df.groupBy("shard").agg(F.sum(value)).collect()}
    return [int(got.get(s) or 0) for s in range(shards)]


def exchanges(wishes: list[list[int]], free: list[int]) -> list[list[int]]:
    """How many documents may move from shard to shard, of so many ``wishes``: what arrives beyond what leaves fits ``free``.

    Cycles of wishes, short ones first, with one more node that takes a shard's free room and gives to any shard.
    """
    count = len(free)
    left = [[n if a != b else 0 for b, n in enumerate(row)] + [free[a]] for a, row in enumerate(wishes)]
    left.append([sum(map(sum, wishes))] * count + [0])
    nodes = range(count + 1)
    taken = [[0] * (count + 1) for _ in nodes]

    def push(cycle: list[int]) -> None:
        edges = list(zip(cycle, cycle[1:] + cycle[:1]))
        flow = min(left[a][b] for a, b in edges)
        for a, b in edges:
            left[a][b] -= flow
            taken[a][b] += flow

    for a in range(count):
        for b in range(a):
            push([a, b])
    for a in range(count):
        for b in range(count):
            while left[a][b]:
                came, todo = {b: b}, [b]
                for at in todo:
                    new = [to for to in nodes if left[at][to] and to not in came]
                    came.update((to, at) for to in new)
                    todo += new
                if a not in came:
                    break
                cycle = [a]
                while cycle[-1] != b:
                    cycle.append(came[cycle[-1]])
                push(cycle[::-1])
    return [row[:count] for row in taken[:count]]


def _round(state: DataFrame, capacity: list[int], number: int) -> DataFrame | None:
    """The state after one round of moves; None where nothing moves."""
    shards = len(capacity)
    free = [max(0, c - x) for c, x in zip(capacity, _sums(state, shards))]
    held = state.groupBy("link", "shard").agg(F.sum("n").alias("near"))
    tie = F.xxhash64("link", "shard", F.lit(number))
    limit = lambda values: F.element_at(_per_shard(values), F.col("shard") + 1)
    open_ = limit(free) > 0 if number % 2 else F.col("near") < limit(capacity)
    # The shard a group is heaviest in has priority even when full: its atoms stay. Others compete if they are open.
    fits = F.struct(open_.cast("int"), "near", tie, "shard")
    stay = F.struct("near", tie, "shard")
    best = held.groupBy("link").agg(F.max(fits).alias("fits"), F.max(stay).alias("top")).select(
        "link", F.col("fits.shard").alias("best"), F.col("fits.near").alias("best_near"), F.col("top.shard").alias("top"))
    moved = (state.join(best, "link").join(held, ["link", "shard"])
             .withColumn("gain", F.col("best_near") - (F.col("near") - F.col("n")))
             .withColumn("to", F.when((F.col("best") != F.col("shard")) & (F.col("top") != F.col("shard"))
                                      & (F.col("gain") > 0), F.col("best"))))
    level = F.least(F.lit(GAINS - 1), F.floor(F.log2(F.col("gain").cast("double")))).cast("int")
    rank = (F.lit(GAINS - 1) - level) * HASHES + F.pmod(F.xxhash64("link", "atom", F.lit(number)), F.lit(HASHES))
    moved = staged(moved.withColumn("class", F.when(F.col("to").isNotNull(), rank.cast("int")))
                   .select("link", "atom", "n", "shard", "to", "class"), "proposals")
    totals = moved.filter("to IS NOT NULL").groupBy("shard", "to", "class").agg(F.sum("n").alias("n"))
    totals = staged(totals.withColumn("upto", F.sum("n").over(W.partitionBy("shard", "to").orderBy("class"))), "wishes")
    wishes = [[0] * shards for _ in range(shards)]
    for r in totals.groupBy("shard", "to").agg(F.max("upto").alias("n")).collect():
        wishes[r["shard"]][r["to"]] = r["n"]
    move = F.col("shard") * shards + F.col("to") + 1
    quota = _per_shard(n for row in exchanges(wishes, free) for n in row)
    got = {(r[0], r[1]): r[2] for r in totals.filter(F.col("upto") <= F.element_at(quota, move))
           .groupBy("shard", "to").agg(F.max("class")).collect()}
    if not got:
        return None
    limits = _per_shard(got.get((a, b), -1) for a in range(shards) for b in range(shards))
    accepted = F.col("to").isNotNull() & (F.col("class") <= F.element_at(limits, move))
    return staged(moved.select("link", "atom", "n", F.when(accepted, F.col("to")).otherwise(F.col("shard")).alias("shard")),
                  "state")


def propagate(state: DataFrame, capacity: list[int], rounds: int) -> DataFrame:
    """Balanced label propagation over the state (link, atom, n, shard): ``rounds`` rounds, fewer once two have moved nothing."""
    idle = 0
    for number in range(rounds):
        moved = _round(state, capacity, number)
        state, idle = (state, idle + 1) if moved is None else (moved, 0)
        if idle == 2:
            break
    return state


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col("text")
    rows = staged(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text.cast("binary"), 256).alias("link"),
        F.pmod(F.xxhash64("doc_id"), F.lit(ATOMS)).cast("int").alias("atom")), "rows")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    start = F.pmod(F.col("atom"), F.lit(shards)).cast("int")
    atoms = staged(rows.filter("link IS NOT NULL").groupBy("link", "atom").agg(F.count(F.lit(1)).alias("n")), "atoms")
    groups = atoms.groupBy("link").agg(F.sum("n").alias("members")).filter("members > 1")
    state = staged(atoms.join(groups, "link").select("link", "atom", "n", start.alias("shard")), "state")
    state = propagate(state, capacity, rounds)

    # Documents get their atom's shard. A group's atoms are rows of their own; an atom is hot only where one id repeats so often.
    to = state.join(groups, "link").select("link", "atom", F.col("shard").alias("moved"), "members")
    placed = rows.join(to, ["link", "atom"], "left")
    together = F.xxhash64("link", F.when(F.coalesce("members", F.lit(TOGETHER + 1)) > TOGETHER, F.col("doc_id")))
    placed = placed.select(
        "doc_id", "size", "text_crc32", F.coalesce("moved", start).alias("shard"),
        F.when(F.col("moved").isNull(), 1).otherwise(0).alias("unlinked"),
        F.pmod(together, F.lit(BUCKETS)).cast("int").alias("bucket"))
    placed = staged(placed, "placed")
    part = ["shard", "unlinked", "bucket"]
    counts = placed.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(*part, (F.sum("n").over(W.partitionBy("shard").orderBy("unlinked", "bucket")) - F.col("n")).alias("before"))
    inside = W.partitionBy(*part).orderBy("text_crc32", "doc_id", "size")
    ranked = (placed.withColumn("rn", F.row_number().over(inside)).join(before, part)
              .withColumn("slot", F.col("before") + F.col("rn") - 1))

    have = _sums(counts, shards)
    over = [max(0, h - c) for h, c in zip(have, capacity)]
    gaps = [max(0, c - h) for h, c in zip(have, capacity)]
    at = F.col("shard") + 1
    number = F.element_at(_per_shard(sum(over[:s]) for s in range(shards)), at) + F.col("slot") - F.element_at(_per_shard(capacity), at)
    beyond = F.col("slot") >= F.element_at(_per_shard(capacity), at)
    shard, slot = F.col("shard"), F.col("slot")
    for s in range(shards):
        begin = sum(gaps[:s])
        here = beyond & (number >= begin) & (number < begin + gaps[s])
        shard, slot = F.when(here, F.lit(s)).otherwise(shard), F.when(here, number - begin + have[s]).otherwise(slot)
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
                         slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in shards 0 to 15, by the law ``rows``."""
    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
