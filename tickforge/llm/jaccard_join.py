"""N-gram Jaccard join: MinHash banding finds candidate pairs, full n-gram sets decide.

An n-gram is five consecutive words (maximal runs without ASCII white space, case and punctuation kept); a text of one to
four words has one n-gram, all of them. Two texts are linked when the Jaccard similarity of their n-gram sets is
``THRESHOLD`` or more. ``choose_bands`` picks the number of bands and of rows in a band so that a pair at the threshold
shares a band with probability ``RECALL`` at least (22 bands of 4 rows: 0.99999; more similar pairs are all but certain).

1. A task turns each text into a digest of its words, its number of n-grams and its band hashes. Texts of the same words
   are collapsed to one with a count, so groups of copies weigh nothing from here on.
2. (band hash, text) rows are shuffled on the band hash; only hashes that two texts share go on, without any text.
   Connected components over them are the candidate clusters, and only texts in one are looked at again. Texts are nodes by
   a number of their own, whatever ids their rows have.
3. A cluster's texts meet once, with full n-gram sets: small clusters are packed together, a large one is split in blocks
   of bounded size and every pair of blocks is one task. There a pair is verified if it shares a band hash. Tasks return
   each text's number of links and the text that stands for its local cluster: rows by text, never by pair.
4. Connected components over those rows are the classes; only then do ids come in.

Defined results: a null text, or one without words, is in a class of its own without links; texts of the same words are
linked; rows without a doc_id are linked like others, and their class is null only where no row of it has an id. Rows that
repeat a doc_id are rows of their own, each in its text's class: an id whose texts are in several classes stands for one
of them only if that class has no other id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import HOT_KEYS, WORD, carrying, join_counted, staged, table
from tickforge.llm.components import components

N, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.99999, 100
#: A block of a large cluster holds about so many texts and n-grams at most; small clusters are packed up to that.
BLOCK_TEXTS, BLOCK_NGRAMS = 2048, 1_000_000
MEMO_WORDS = 500_000
_WORDS = re.compile(WORD)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, that is the fewest false candidates, for which ``most`` hashes reach the recall."""
    fits = []
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            fits.append((rows, bands))
    if not fits:
        raise ValueError("no banding reaches this recall with so few hashes")
    rows, bands = max(fits)
    return bands, rows


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def words_digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def ngram_set(words: list[str], hashes: dict, n: int = N) -> np.ndarray:
    """The distinct n-grams as sorted 64-bit hashes."""
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(w))
    x = np.full(max(len(w) - width + 1, 0), width, np.uint64)
    for k in range(width):
        x = x * _MIX + w[k:k + len(x)]
    return np.unique(_scramble(x))


class Signer:
    def __init__(self, bands: int, rows: int, n: int = N, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, self.n = bands, rows, n
        self.a = rng.integers(0, 2**63, (bands * rows, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, (bands * rows, 1), dtype=np.uint64)
        self.hashes = _Hashes()

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(self.bands * self.rows, 2**64 - 1, np.uint64)
        for i in range(0, len(grams), 2048):
            least = np.minimum(least, (self.a * grams[i:i + 2048] + self.b).min(axis=1))
        x = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T:
            x = _scramble(x * _MIX + column)
        return x.view(np.int64)

    def sign(self, text: str | None):
        words = _WORDS.findall(text or "")
        if not words:
            return None, 0, []
        grams = ngram_set(words, self.hashes, self.n)
        return words_digest(words), len(grams), self.band_hashes(grams)


def signatures(docs: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """doc_id, rid, digest (null without words), grams, bands."""
    def run(batches):
        signer = Signer(bands, rows, n)
        for batch in batches:
            got = [signer.sign(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rid"), pa.array([g[0] for g in got], pa.binary()),
                 pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.list_(pa.int64()))],
                ["doc_id", "rid", "digest", "grams", "bands"])

    return docs.select("doc_id", "rid", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, rid binary, digest binary, grams int, bands array<long>")


def _links(sets: list[np.ndarray], bands: np.ndarray, copies: np.ndarray, side: np.ndarray | None, threshold: float):
    """(links, label) of one cluster's texts. side: block of each, if only pairs across the two blocks count."""
    n = len(sets)
    links, label = np.zeros(n, np.int64), np.arange(n)
    sizes = np.array([len(s) for s in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    start = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(number.max() + 1, bool)
    for i in range(n - 1):
        near = (bands[i + 1:] == bands[i]).any(axis=1) & (np.minimum(sizes[i + 1:], sizes[i]) >= threshold * np.maximum(sizes[i + 1:], sizes[i]) - 1e-9)
        if side is not None:
            near &= side[i + 1:] != side[i]
        other = np.flatnonzero(near) + i + 1
        if not len(other):
            continue
        own = number[start[i]:start[i + 1]]
        mark[own] = True
        if len(other) > 0.2 * (n - i):
            shared = np.add.reduceat(mark[number], start[:-1])[other]
        else:
            shared = np.array([mark[number[start[j]:start[j + 1]]].sum() for j in other])
        mark[own] = False
        linked = other[shared >= threshold * (sizes[i] + sizes[other] - shared) - 1e-9]
        if len(linked):
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            met = np.unique(label[np.append(linked, i)])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return links, label


_VERIFIED = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _verify(rows: pa.Table, n: int, threshold: float) -> pa.Table:
    """Links within the clusters of a pack, or across or within the blocks of a task."""
    hashes, seen, got = _Hashes(), set(), []
    columns = [rows.column(c).to_pylist() for c in ("label", "node", "digest", "text", "copies", "block", "bands")]
    for label, node, digest, text, copies, block, bands in zip(*columns):
        words = _WORDS.findall(text or "")
        if words_digest(words) == digest and (node, digest) not in seen:
            seen.add((node, digest))
            got.append((label, node, copies, block, bands, ngram_set(words, hashes, n)))
    got.sort(key=lambda r: (r[0], r[1]))
    cross = rows.num_rows > 0 and rows.column("b1")[0].as_py() != rows.column("b2")[0].as_py()
    out = []
    begin = 0
    for end in range(1, len(got) + 1):
        if end < len(got) and got[end][0] == got[begin][0]:
            continue
        part, begin = got[begin:end], end
        if len(part) > 1:
            side = np.array([r[3] for r in part]) if cross else None
            links, label = _links([r[5] for r in part], np.array([r[4] for r in part]), np.array([r[2] for r in part]), side, threshold)
            out += [(part[i][1], part[label[i]][1], int(links[i])) for i in np.flatnonzero(links)]
    return pa.Table.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], schema=_VERIFIED)


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``rid``, which only rows of the same doc_id (or none) and text share."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))
    return docs.withColumn("rid", F.unhex(F.md5(name.cast("binary"))))


def _once(docs: DataFrame, signed: DataFrame, rows: int) -> DataFrame:
    """rid, text of ``docs``; of rows that repeat more than ``rows`` / 1024 times (fewer than 1024 kinds) just one."""
    hot = staged(signed.groupBy("rid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows // HOT_KEYS + 1).select("rid"), "hot")
    texts = docs.select("rid", "text")
    if hot.isEmpty():
        return texts
    return texts.join(F.broadcast(hot), "rid", "left_anti").unionByName(
        texts.join(F.broadcast(hot), "rid", "left_semi").dropDuplicates(["rid"]))


def _verified(docs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, root, links): a row per text and task that linked it. docs: rid, text. texts: node, rid, label, digest, grams, bands, copies."""
    stats = texts.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("grams").alias("all"))
    stats = stats.withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("all") / BLOCK_NGRAMS)).cast("int"))
    stats = staged(stats, "clusters")
    small = stats.filter("blocks = 1").agg(F.coalesce(F.sum("all"), F.lit(0))).first()[0]
    packs = int(small // BLOCK_NGRAMS) + 1
    whole = join_counted(texts, stats.select("label", "n", "blocks"), "label", texts.count())
    whole = docs.join(whole, "rid")
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    with_block = whole.withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    packed = with_block.filter("blocks = 1").withColumns(
        {"pack": F.pmod(F.xxhash64("label"), F.lit(packs)), "b1": F.lit(-1), "b2": F.lit(-1)})
    split = with_block.filter("blocks > 1").withColumn("other", other).withColumns(
        {"pack": F.col("label"), "b1": F.least("block", "other"), "b2": F.greatest("block", "other")}).drop("other")
    rows = packed.unionByName(split).select("pack", "b1", "b2", "label", "node", "digest", "text", "copies", "block", "bands")
    return rows.groupBy("pack", "b1", "b2").applyInArrow(lambda t: _verify(t, n, threshold), "node long, root long, links long")


def _ids(signed: DataFrame, texts: DataFrame) -> DataFrame:
    """label, class_id, least (of a class without ids, the hash of the row that stands for it), n (its texts)."""
    rows = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL").select("doc_id", "digest", F.xxhash64("digest").alias("hash"))
    several = rows.groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).filter("low <> high").select("doc_id")
    met = rows.join(several, "doc_id").join(texts.select("digest", "label"), "digest")
    torn = met.groupBy("doc_id").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("doc_id")
    sure = rows.join(torn, "doc_id", "left_anti").groupBy("digest").agg(F.min("doc_id").alias("sure"))
    return texts.join(sure, "digest", "left").groupBy("label").agg(
        F.coalesce(F.min("sure"), F.min("doc_id")).alias("class_id"), F.min(F.xxhash64("rid")).alias("least"),
        F.count(F.lit(1)).alias("n"))


def _classes(docs: DataFrame, threshold: float, recall: float, n: int) -> DataFrame:
    """One row per document: doc_id, rid, class_id, n_links, stays. docs: doc_id, text, rid."""
    bands, rows = choose_bands(threshold, recall)
    signed = staged(signatures(docs, bands, rows, n), "signatures")
    total = signed.count()
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "rid", "grams", "bands")
    texts = signed.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
    # The numbers are fixed once written, so a task that is run again changes none that was read.
    texts = staged(texts.select("digest", "copies", "first.doc_id", "first.rid", "first.grams", "first.bands",
                                F.monotonically_increasing_id().alias("node")), "texts")
    spread = texts.select("node", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    clusters = staged(components(spread.join(shared, "key")), "candidates")
    found = staged(_verified(_once(docs, signed, total), texts.join(clusters, "node"), n, threshold), "verified")
    classes = staged(components(found.select("node", F.col("root").alias("key"))), "classes")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = (texts.select("digest", "copies", "doc_id", "rid", "node").join(classes, "node", "left").join(links, "node", "left")
          .select("digest", "copies", "doc_id", "rid", F.coalesce("label", "node").alias("label"),
                  (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    of = staged(of, "linked")
    ids = staged(_ids(signed, of), "ids")
    answers = join_counted(of, ids, "label", of.count()).select("digest", F.col("copies").alias("n"), "class_id", "least", "n_links")
    out = join_counted(signed.select("doc_id", "rid", "digest"), staged(answers, "answers"), "digest", total)
    stands = F.when(F.col("class_id").isNull(), F.xxhash64("rid") == F.col("least")).otherwise(F.col("class_id").eqNullSafe(F.col("doc_id")))
    alone = signed.filter("digest IS NULL").select(
        "doc_id", "rid", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("stays"))
    return out.select("doc_id", "rid", "class_id", "n_links", stands.alias("stays")).unionByName(alone)


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, n: int = N) -> DataFrame:
    """One row per document: doc_id, class_id (the class's smallest doc_id), n_links (documents linked to it)."""
    docs = _identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return _classes(docs, threshold, recall, n).select("doc_id", "class_id", "n_links")


@carrying
def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, n: int = N) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with all columns: those of the id that names it (copies included)
    or, in a class without ids, those of one text."""
    docs = _identified(docs)
    found = _classes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "rid"), threshold, recall, n)
    goes = staged(found.filter("NOT stays").select("rid"), "goes")
    return docs.join(goes, "rid", "left_anti").drop("rid")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: doc_id, class_id, n_links (five-word n-grams, similarity 0.8 or more)."""
    return jaccard_classes(table(spark, sf_dir, "documents", "doc_id", "text"))
