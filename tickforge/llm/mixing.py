"""Mixing sources to target weights with a low-discrepancy schedule over equal-token blocks.

Each source's documents are shuffled (ordered by a seeded hash) and laid end to end; the stream is cut into blocks of
``block_words`` words. Slot t of the schedule takes the golden-ratio point frac((t + 1) * phi), in 31-bit fixed point, and
maps it through the cumulative block quotas to a source; the k-th slot of a source takes its k-th block, and after the
last block the first again. A source with more slots than its quota gives the surplus up, one with fewer gets its rest at
the end of the schedule, so every source takes its target to the word.

Targets: a source's share of ``share`` times all words follows its weight, stops at ``cap`` times the source's own words,
and the excess is reshared by weight until none is above its cap.

Nothing is gathered in one task: ranks and offsets are sums over (source, hash bucket) or (source, slot chunk) plus a
rank inside each, and blocks meet documents on (source, block). Only windows over one row per source are unpartitioned.

Defined results: a null text has no words; a document without words takes none; null is a source of its own, the last;
a null doc_id is one like others, hashed as the empty string; rows that repeat a doc_id count as rows of their own, told
apart by the digest of doc_id, source and text; other columns pass through ``mix`` untouched and are ignored otherwise; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import WORD, carrying, join_counted, staged, table

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
BLOCK_WORDS = 128
SEED = "mix-1"
#: Hash buckets of a source, and slots of a chunk: what one task ranks at a time.
BUCKETS, CHUNK = 4096, 1 << 12
#: Golden ratio in 31-bit fixed point: round(0.6180339887 * 2^31), made odd, so that the points run through all 2^31 values.
GOLDEN, POINTS = 1327217885, 1 << 31
#: Cells of the unit interval on which schedule points meet the sources' intervals.
CELLS = 1024


def _digest():
    """Tells rows of another doc_id, source or text apart."""
    parts = [F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("null")) for c in ("doc_id", "source", "text")]
    return F.unhex(F.md5(F.concat_ws(":", *(F.length(p).cast("string") for p in parts), *parts).cast("binary")))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """doc_id, skey (the source, null included), size in words, the shuffle order with its bucket, and the row's digest."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return staged(docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("z-null")).alias("skey"), F.col("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        order.alias("ord"), F.conv(F.substring(order, 1, 3), 16, 10).cast("int").alias("bucket"),
        _digest().alias("digest")), "sizes")


def source_targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, block_words=BLOCK_WORDS) -> DataFrame:
    """One row per source: sid, weight, words, target, and what the schedule needs (quota in words and in blocks)."""
    s = sized.groupBy("skey", "source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    s = s.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (F.col("sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("capped", F.col("words").cast("double") * F.lit(float(cap)))
    order = W.orderBy(F.col("capped") / F.col("weight"), "sid")
    before = F.coalesce(F.sum("capped").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("level", (F.sum(F.col("words")).over(W.partitionBy()) * F.lit(float(share)) - before) / rest)
    s = s.withColumn("target", F.least("capped", F.col("weight") * F.max("level").over(W.partitionBy())))
    s = s.withColumn("quota", F.round("target").cast("long"))
    blocks = lambda c: F.ceil(c / F.lit(block_words)).cast("long")
    s = s.withColumn("blocks", blocks(F.col("words")))
    # A pass over the source ends with a short block, so whole passes count their blocks apart.
    s = s.withColumn("slots", F.when(F.col("words") == 0, 0).otherwise(
        F.floor(F.col("quota") / F.col("words")) * F.col("blocks") + blocks(F.col("quota") % F.greatest("words", F.lit(1)))))
    s = s.withColumn("hi", F.sum("slots").over(W.orderBy("sid"))).withColumn("lo", F.col("hi") - F.col("slots"))
    return staged(s.drop("capped", "level"), "sources")


def schedule(sources: DataFrame, block_words=BLOCK_WORDS) -> DataFrame:
    """The mixture's order: slot, sid, rank (of the slot within its source), pass, block, and the words of the pass."""
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    point = ((F.col("id") + 1) % POINTS) * GOLDEN % POINTS
    at = F.floor(point.cast("double") / POINTS * F.lit(float(total))).cast("long")
    slots = spark.range(total).select(F.col("id").alias("slot"), at.alias("at"),
                                      F.floor(F.col("id") / CHUNK).alias("chunk"))
    cell = lambda c: F.floor(c.cast("double") * CELLS / F.lit(float(max(total, 1)))).cast("long")
    spans = (sources.filter("slots > 0")
             .select("sid", "lo", "hi", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))).alias("cell")))
    dealt = (slots.withColumn("cell", cell(F.col("at"))).join(spans, "cell")
             .filter("at >= lo AND at < hi").select("slot", "chunk", "sid"))
    counts = dealt.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("sid", "chunk", (F.sum("n").over(W.partitionBy("sid").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = (dealt.withColumn("rn", F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot")))
              .join(before, ["sid", "chunk"])
              .select("slot", "sid", (F.col("before") + F.col("rn") - 1).alias("rank")))
    had = counts.groupBy("sid").agg(F.sum("n").alias("had"))
    short = (sources.join(had, "sid", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < slots")
             .select("sid", F.explode(F.sequence(F.col("had"), F.col("slots") - 1)).alias("rank")))
    tail = short.select((F.lit(total) + F.row_number().over(W.orderBy("rank", "sid")) - 1).alias("slot"), "sid", "rank")
    of = sources.select("sid", "slots", "blocks", "words", "quota")
    both = ranked.unionByName(tail.select(ranked.columns)).join(of, "sid").filter("rank < slots")
    turn = F.floor(F.col("rank") / F.col("blocks"))
    return both.select("slot", "sid", "rank", turn.alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"),
                       F.least("words", F.col("quota") - turn * F.col("words")).alias("limit"))


def positions(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's offset, in words, in its source's shuffled stream; unique per source where size > 0."""
    rows = join_counted(sized.drop("source"), sources.select("skey", "sid", "n"), "skey", sized.count())
    rows = rows.select("doc_id", "sid", "size", "ord", "bucket", "digest")
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("sid", "bucket", (F.sum("words").over(W.partitionBy("sid").orderBy("bucket")) - F.col("words")).alias("before"))
    inside = W.partitionBy("sid", "bucket").orderBy("ord", "doc_id", "size", "digest").rowsBetween(W.unboundedPreceding, 0)
    return staged(rows.withColumn("upto", F.sum("size").over(inside)).join(before, ["sid", "bucket"])
                  .select("doc_id", "digest", "sid", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("off")), "positions")


def mixed_spans(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, block_words=BLOCK_WORDS, seed=SEED):
    """(spans, positions, sources). spans is the mixture, in order of slot and word_from: slot, pass, sid, off, doc_id,
    digest and size (of the row of docs), and the words word_from..word_to (end exclusive) of the document that the slot takes."""
    sized = _sized(docs, seed)
    sources = source_targets(sized, weights, share, cap, block_words)
    where = positions(sized, sources)
    parts = where.filter("size > 0").select(
        "doc_id", "digest", "sid", "off", "size",
        F.explode(F.sequence(F.floor(F.col("off") / block_words),
                             F.floor((F.col("off") + F.col("size") - 1) / block_words))).alias("block"))
    taken = parts.join(schedule(sources, block_words), ["sid", "block"])
    start = F.greatest("off", F.col("block") * block_words)
    end = F.least(F.col("off") + F.col("size"), (F.col("block") + 1) * block_words, F.col("limit"))
    spans = (taken.select("slot", "pass", "sid", "off", "doc_id", "digest", "size", (start - F.col("off")).alias("word_from"),
                          (end - F.col("off")).alias("word_to")).filter("word_to > word_from"))
    return spans, where, sources


def take(docs: DataFrame, **kw) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    spans, where, sources = mixed_spans(docs, **kw)
    taken = spans.groupBy("sid", "off").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    full = where.filter("size > 0").join(taken, ["sid", "off"], "left").unionByName(
        where.filter("size = 0").withColumn("taken", F.lit(None).cast("long")))
    of = sources.select("sid", "n", F.col("words").alias("source_size"), "target")
    return join_counted(full, of, "sid", where.count()).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


@carrying
def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixture as documents: a row of ``docs`` for each pass that takes words of it, its text cut to those words.

    A document that is taken whole keeps its text as it is; a cut one has its words joined by one space. Only the documents at a source's quota are cut: what a pass
    takes of a document is always its first words, as passes end at a prefix of the source's stream. Rows of one digest lie
    next to each other in that stream, so a pass takes the first of them whole, cuts one at most, and leaves the others.
    """
    spans, _, _ = mixed_spans(docs, **kw)
    picks = (spans.groupBy("digest", "pass").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("_all"), F.max("size").alias("_size"))
             .select(F.col("digest").alias("_row"), "_all", "_size"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    head = F.array_join(F.slice(words, 1, F.col("_words").cast("int")), " ")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "source", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    rows = docs.withColumn("_row", _digest())
    rows = rows.withColumn("_before", F.row_number().over(W.partitionBy("_row").orderBy(order)) - 1)
    taken = (rows.join(picks, "_row").withColumn("_words", F.least("_size", F.col("_all") - F.col("_before") * F.col("_size")))
             .filter("_words > 0"))
    text = F.when(F.col("_words") < F.col("_size"), head).otherwise(F.col("text"))
    return taken.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` mixed with weights 3, 1, 2 to 150% of their words, each source at most twice."""
    return take(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat('mix-1', ':', doc_id)) AS ord
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         words::DOUBLE * 2.0::DOUBLE AS capped FROM s
), l AS (
  SELECT *, ((SELECT sum(words) FROM s)::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(capped) OVER (ORDER BY capped / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY capped / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, words, least(capped, weight * (SELECT max(level) FROM l)) AS target FROM l
), p AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS off FROM d
)
SELECT p.doc_id, p.size, t.words AS source_size, t.target,
       (greatest(0, least(p.size, least(t.words, round(t.target)::BIGINT) - p.off))
        + greatest(0, least(p.size, round(t.target)::BIGINT - t.words - p.off)))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""
