"""Hard negatives for contrastive training, mined with exact integer scores by the method of four Russians.

A component x counts as floor(256 * x). A row is kept as bit planes: plane b holds bit b of every component (in two's
complement, so the highest plane weighs negatively), packed eight components a byte. An anchor has a table per group of eight
components: the sums of its components over all 256 subsets, each made of a smaller one by one addition. A plane's byte is an
index into that table, so the inner product is a look-up per group and plane, the planes added from the highest by shifts.

Anchors meet rows in blocks: a group holds at most about ``BLOCK`` rows and ``ANCHORS`` anchors, whatever the size of a label
or the number of equal vectors. Rows of the anchor's label are scored first and give its positives; the others are scored in
a second pass and give the negatives between two shares of each positive's score. Every group hands on its best ``k`` for each
anchor (and positive) only, which the next step merges, so ties and large labels are decided exactly, by vec_id.

Defined results: rows whose id, label, vector or any component is null, or a component not finite, take no part; neither do
empty vectors, vectors not of the commonest length (of equally common, the largest), and those with components so large that
their scores might not fit a long (``d * floor(256 * x)**2`` from 2**56 on; in 64 dimensions, components of 131,072). Rows
equal in id, label and counted components are one; rows that share an id only take part each for itself, but never as one
another's candidate. An anchor without positives, and a positive without negatives, give no rows. Other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import staged, table

SCALE = 256
#: Rows and anchors of one group, about; a group's memory and time are bounded by them.
BLOCK, ANCHORS, LEAST_BLOCK = 65_536, 16_384, 1_000
#: Anchors and rows scored at a time: their tables and scores stay in a core's cache.
AT_ONCE, ROWS_AT_ONCE = 64, 4_096
POSITIVES, NEGATIVES, LEAST, MOST = 5, 5, 80, 100
MAX_NORM = 2.0**56


def _fits(d: Column) -> Column:
    return F.forall("values", lambda x: F.abs(x * SCALE) < F.sqrt(F.lit(MAX_NORM) / d))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (long), values (doubles): rows without a null and with finite components, of any length."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("values"))
    finite = F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("values") > 0) & finite)


def _shape(rows: DataFrame):
    """d, high, low: the commonest length and the extremes of the counted components; None for an empty table."""
    counted = lambda pick: F.when(_fits(F.size("values")), F.floor(pick("values") * SCALE))
    kinds = rows.groupBy(F.size("values").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(counted(F.array_max)).alias("high"), F.min(counted(F.array_min)).alias("low"))
    first = kinds.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return first[0] if first and first[0].high is not None else None


def packed(values: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of integers (rows x components), a byte per group of eight components: rows x planes x groups."""
    bits = values[:, None, :] >> np.arange(planes)[None, :, None] & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpacked(planes: np.ndarray, d: int) -> np.ndarray:
    bits = np.unpackbits(planes, axis=2, count=d, bitorder="little").astype(np.int64)
    weight = 1 << np.arange(planes.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.einsum("rpd,p->rd", bits, weight)


def subset_sums(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """The sums over all subsets of each group of eight components: groups x 256 x anchors."""
    count, d = anchors.shape
    groups = -(-d // 8)
    parts = np.zeros((groups * 8, count), kind)
    parts[:d] = anchors.T
    sums = np.zeros((groups, 256, count), kind)
    for j in range(8):
        sums[:, 1 << j:2 << j] = sums[:, :1 << j] + parts[j::8, None, :]
    return sums


def kinds_for(planes: int, d: int) -> tuple:
    """The smallest integers that hold every sum of one plane, and every score."""
    fit = lambda bound, *kinds: next(k for k in kinds if bound <= np.iinfo(k).max)
    return fit(d << planes - 1, np.int16, np.int32, np.int64), fit(d << 2 * planes - 2, np.int32, np.int64)


def scores(sums: np.ndarray, planes: np.ndarray, kind=np.int64) -> np.ndarray:
    """Exact inner products, rows x anchors, by look-ups, additions and shifts."""
    count, last = len(planes), planes.shape[1] - 1
    total = np.zeros((count, sums.shape[2]), kind)
    one, plane = (np.empty(total.shape, sums.dtype) for _ in range(2))
    for p in range(last, -1, -1):
        for g in range(sums.shape[0]):
            np.take(sums[g], planes[:, p, g], axis=0, out=one if g else plane, mode="clip")
            if g:
                plane += one
        if p == last:  # the sign plane
            total -= plane
        else:
            total <<= 1
            total += plane
    return total


def _planes(column, planes: int) -> np.ndarray:
    raw = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(len(raw), planes, -1)


def _pack(rows: DataFrame, planes: int, d: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values = batch.column("values").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)
                bits = [b.tobytes() for b in packed(values, planes)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(bits, pa.binary())],
                                                 ["vec_id", "label", "bits"])

    return rows.mapInArrow(run, "vec_id long, label long, bits binary")


#: An anchor's wanted scores for a positive's score.
WINDOWS = "array<struct<score:long,low:long,high:long>>"


def _groups(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Both sides dealt to groups (row block, anchor block)."""
    deal = lambda blocks: F.pmod(F.xxhash64("vec_id", "bits", "label"), F.lit(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    right = rows.select("vec_id", "label", "bits", F.lit(None).cast(WINDOWS).alias("windows"), F.lit(False).alias("asks"),
                        deal(row_blocks).alias("row_block")).withColumn("anchor_block", every(anchor_blocks))
    left = anchors.select("vec_id", "label", "bits", F.col("windows").cast(WINDOWS).alias("windows"), F.lit(True).alias("asks"),
                          deal(anchor_blocks).alias("anchor_block")).withColumn("row_block", every(row_blocks))
    both = right.unionByName(left.select(*right.columns))
    # Groups cost time rather than bytes, so they keep tasks of their own.
    return both.repartition(row_blocks * anchor_blocks, "row_block", "anchor_block").groupBy("row_block", "anchor_block")


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    at = np.arange(len(score))
    if len(score) > k:
        least = np.partition(score, -k)[-k]
        above, level = np.flatnonzero(score > least), np.flatnonzero(score == least)
        if len(level) > (room := k - len(above)):
            level = level[np.argpartition(ids[level], room - 1)[:room]]
        at = np.concatenate([above, level])
    return at[np.lexsort((ids[at], -score[at]))]


def _scored(sums: np.ndarray, bits: np.ndarray, parts, kind, wanted):
    """(anchor, row, score) arrays of the pairs that ``wanted`` keeps, for the rows of parts (begin, end)."""
    found = []
    for begin, end in parts:
        for r in range(begin, end, ROWS_AT_ONCE):
            got = np.ascontiguousarray(scores(sums, bits[r:min(r + ROWS_AT_ONCE, end)], kind).T)
            anchor, row = wanted(got, r)
            found.append((anchor, row + r, got[anchor, row].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def _mine(group: pa.Table, planes: int, d: int, k: int, same_label: bool) -> pa.Table:
    """The group's best rows of each anchor: of its label, or of other labels for each of its windows of scores."""
    asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    left, right = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
    out = {n: [] for n in ("anchor", "for_score", "vec_id", "score")}
    if left.num_rows and right.num_rows:
        small, large = kinds_for(planes, d)
        order = np.argsort(right.column("label").to_numpy(), kind="stable")
        labels, ids = right.column("label").to_numpy()[order], right.column("vec_id").to_numpy()[order]
        bits, values = _planes(right.column("bits"), planes)[order], unpacked(_planes(left.column("bits"), planes), d)
        anchor_ids, anchor_labels, windows = left.column("vec_id").to_numpy(), left.column("label").to_numpy(), left.column("windows").to_pylist()

        def keep(j, for_score, row, s):
            at = _first(s, ids[row], k)
            out["anchor"].append(np.full(len(at), j))
            out["for_score"].append(np.full(len(at), for_score))
            out["vec_id"].append(ids[row[at]])
            out["score"].append(s[at])

        for label in np.unique(anchor_labels):
            begin, end = np.searchsorted(labels, label, side="left"), np.searchsorted(labels, label, side="right")
            mine = np.flatnonzero(anchor_labels == label)
            for asked in np.split(mine, range(AT_ONCE, len(mine), AT_ONCE)):
                sums = subset_sums(values[asked], small)
                if same_label:
                    def wanted(got, r):
                        best = [_first(g, ids[r:r + len(g)], k + 1) for g in got]  # an anchor finds itself too
                        return np.repeat(np.arange(len(got)), [len(b) for b in best]), np.concatenate(best)

                    parts = [(begin, end)]
                else:
                    low, high = (np.array([pick(w[bound] for w in windows[j]) for j in asked])[:, None]
                                 for pick, bound in ((min, "low"), (max, "high")))
                    wanted = lambda got, r: np.nonzero((got >= low) & (got <= high))  # noqa: B023,E731
                    parts = [(0, begin), (end, len(labels))]
                anchor, row, s = _scored(sums, bits, parts, large, wanted)
                order = np.argsort(anchor, kind="stable")
                starts = np.searchsorted(anchor[order], np.arange(len(asked) + 1))
                for i, j in enumerate(asked):
                    at = order[starts[i]:starts[i + 1]]
                    at = at[ids[row[at]] != anchor_ids[j]]
                    if same_label:
                        keep(j, 0, row[at], s[at])
                    else:
                        for w in windows[j]:
                            inside = at[(s[at] >= w["low"]) & (s[at] <= w["high"])]
                            keep(j, w["score"], row[inside], s[inside])
    whole = {n: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for n, v in out.items()}
    of = left.take(pa.array(whole["anchor"]))
    return pa.Table.from_arrays([of.column("vec_id"), of.column("label"), of.column("bits"),
                                 *(pa.array(whole[n]) for n in ("for_score", "vec_id", "score"))],
                                ["anchor_id", "label", "bits", "for_score", "vec_id", "score"])


FOUND = "anchor_id long, label long, bits binary, for_score long, vec_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _share(score: str, hundredths: int) -> Column:
    """The largest whole number not above the share of a score."""
    scaled = f"({score} * {hundredths}L)"
    return F.expr(f"({scaled} - pmod({scaled}, 100L)) div 100L")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         least: int = LEAST, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a condition on vec_id) and
    each of its first ``positives`` rows of the same label, the first ``negatives`` rows of other labels that score from
    ``least`` to ``most`` hundredths of the positive's score."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    shape = _shape(rows)
    if shape is None:
        return spark.createDataFrame([], RESULT)
    d, planes = shape.d, 1 + max(shape.high.bit_length(), (-shape.low - 1).bit_length() if shape.low < 0 else 0, 1)
    counted = rows.filter((F.size("values") == d) & _fits(F.lit(d))).select(
        "vec_id", "label", F.transform("values", lambda x: F.floor(x * SCALE).cast("int")).alias("values"))
    bits = staged(_pack(counted, planes, d).distinct(), "bits")
    anchors = staged(bits.filter(is_anchor), "anchors")
    count = bits.count()
    # Groups of the stated size, or as many as there are cores to work on them.
    anchor_blocks = max(1, math.ceil(anchors.count() / ANCHORS))
    row_blocks = max(math.ceil(count / BLOCK), min(math.ceil(count / LEAST_BLOCK), 4 * spark.sparkContext.defaultParallelism))

    key = ("anchor_id", "label", "bits")
    near = _groups(bits, anchors.withColumn("windows", F.lit(None)), row_blocks, anchor_blocks).applyInArrow(
        lambda t: _mine(t, planes, d, positives, True), FOUND)
    order = W.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    best = staged(near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives), "positives")

    # A negative's whole score is at least the share rounded up, at most the share rounded down.
    pairs = best.select(*key, F.col("vec_id").alias("positive_id"), F.col("score").alias("for_score"),
                        (-_share("(-score)", least)).alias("low"), _share("score", most).alias("high")).filter("low <= high")
    asked = staged(pairs.groupBy(*key).agg(F.collect_set(F.struct(F.col("for_score").alias("score"), "low", "high")).alias("windows"))
                   .withColumnRenamed("anchor_id", "vec_id"), "windows")
    far = _groups(bits, asked, row_blocks, anchor_blocks).applyInArrow(lambda t: _mine(t, planes, d, negatives, False), FOUND)
    order = W.partitionBy(*key, "for_score").orderBy(F.desc("score"), "vec_id")
    hard = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return hard.join(pairs.select(*key, "positive_id", "for_score"), [*key, "for_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("for_score").alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows of ``embeddings`` whose vec_id is divisible by 100; every seventh label moves on by one."""
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
             CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 5"""
