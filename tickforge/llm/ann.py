"""Approximate nearest neighbours by cosine, with multiprobe p-stable hashing.

Vectors are scaled to length one, where the largest cosine is the smallest distance. A table hashes a vector to the cell
(floor((a_1 x + b_1) / w), ...) of M Gaussian projections. A query visits its own cell and perturbed ones (up to one step
in every projection) in the order of their estimated chance to hold a neighbour at distance ``reach``, the product over the
projections of a normal interval's probability, until the visited cells hold it with the chance that ``TABLES`` tables need
together for ``RECALL``. All vectors of the visited cells are candidates; their exact cosines are computed from the original
vectors in double precision, and the best of all tables are merged.

``reach`` is the distance to the last wanted neighbour that 95% of a bounded sample (``SAMPLE`` queries, by hash order)
don't exceed, found by an exact scan. M grows with the logarithm of the number of vectors.

Cells meet probes by shuffling on packs of neighbouring cells (equal or next in a table's ``LEADING`` projections), of about
``BLOCK`` vectors, so that a query meets few packs. A pack that over ``QUERIES`` queries visit is searched in blocks of them. A cell that holds over 1/1024 of the vectors (fewer than 1024 such a table, so
the list is bounded) is split in blocks, and its probes go to each. Equal vectors are indexed once, with the smallest ids
that could be among any query's answers; equal queries are searched once. A query for which fewer neighbours are found than
exist is answered by an exact scan of all vectors in blocks.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, have no id or are not of the
commonest length (of equally common, the largest) take no part; rows that repeat a vec_id count as one if their vectors are
equal, else as two; with fewer candidates than wanted all are returned; ties go to the smaller vec_id; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import HOT_KEYS, staged, table

TABLES, WIDTH, RECALL, SAMPLE, SEED = 6, 2.0, 0.97, 64, 11
#: Rows of the index that one task holds, about.
BLOCK = 50_000
#: Queries that one task holds, about, and projections by which cells are neighbours: three bits of a cell's key each.
QUERIES, LEADING = 10_000, 4
PREFIXES, HASH_BITS = 1 << 3 * (LEADING + 1), 63 - 3 * (LEADING + 1)
_PHI = np.vectorize(lambda z: 0.5 * math.erfc(-z / math.sqrt(2)), otypes=[float])


def projections_for(rows: int) -> int:
    return max(3, round(math.log2(max(rows, 2)) / 1.95))


class Hasher:
    def __init__(self, dim: int, m: int, tables: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.m, self.tables, self.width = m, tables, width
        self.a = rng.standard_normal((tables, dim, m))
        self.b = rng.random((tables, m)) * width

    def places(self, unit: np.ndarray) -> np.ndarray:
        """Real-valued cell coordinates: tables x vectors x projections."""
        return (np.einsum("nd,tdm->tnm", unit, self.a) + self.b[:, None, :]) / self.width

    def key(self, t: int, coordinates: np.ndarray) -> np.ndarray:
        """A number of a table's cells: the table and the leading coordinates, three bits each, then a hash."""
        x = np.full(coordinates.shape[:-1], t + 1, np.uint64)
        for c in np.moveaxis(coordinates.astype(np.int64).view(np.uint64), -1, 0):
            x = (x ^ c) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
        prefix = np.full(x.shape, t & 7, np.int64)
        for j in range(LEADING):
            prefix = prefix << 3 | (np.clip(coordinates[..., j].astype(np.int64) + 4, 0, 7) if j < self.m else 0)
        return prefix << HASH_BITS | (x >> np.uint64(64 - HASH_BITS)).view(np.int64)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        places = np.floor(self.places(unit))
        return np.stack([self.key(t, p) for t, p in enumerate(places)], axis=1)

    def probes(self, unit: np.ndarray, reach: float, chance: float) -> np.ndarray:
        """The cells that one query visits, all tables together."""
        out = []
        for t, place in enumerate(self.places(unit[None])[:, 0]):
            cell = np.floor(place)
            part = (place - cell) * self.width
            steps = np.array([-1.0, 0.0, 1.0])
            z = (steps[:, None] * self.width - part) / reach
            cost = -np.log(np.maximum(_PHI(z + self.width / reach) - _PHI(z), 1e-12))
            most = 512
            while True:
                total, steps_of = np.zeros(1), np.zeros((1, 0), np.int8)
                for j in range(self.m):  # the best sums are made of the best partial sums
                    total = (total[:, None] + cost[:, j]).ravel()
                    best = np.argsort(total, kind="stable")[:most]
                    total, steps_of = total[best], np.column_stack([steps_of[best // 3], (best % 3 - 1).astype(np.int8)])
                reached = np.cumsum(np.exp(-total))
                if reached[-1] >= chance or len(total) == 3**self.m:
                    break
                most *= 4
            count = min(int(np.searchsorted(reached, chance)) + 1, len(total))
            out.append(self.key(t, cell + steps_of[:count]))
        return np.concatenate(out)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector, digest of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")).filter(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull()))
    dim = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    kind = dict(rows.dtypes)["vector"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column("vector"))
            ok = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
            digest = [hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() for v in m]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(digest, pa.binary())],
                                             ["vec_id", "vector", "digest"]).filter(pa.array(ok))

    rows = rows.filter(F.size("vector") == (dim[0][0] if dim else 0))
    return rows.mapInArrow(run, f"vec_id long, vector {kind}, digest binary")


def _scaled(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that no square over- or underflows."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _best(query: np.ndarray, vectors: np.ndarray, unit: np.ndarray, ids: list, k: int):
    """The k best (id, cosine) among candidate rows: a product finds those near the top, exact sums rank them."""
    rough = unit @ (query / np.abs(query).max() / np.sqrt(((query / np.abs(query).max())**2).sum()))
    if len(rough) > k:
        rough_k = np.partition(rough, -k)[-k]
        near = np.flatnonzero(rough >= rough_k - 1e-9)
    else:
        near = np.arange(len(rough))
    v = vectors[near]
    s, q = np.abs(v).max(axis=1, keepdims=True), np.abs(query).max()
    s, q = np.where((s > 1e100) | (s < 1e-100), s, 1.0), q if q > 1e100 or q < 1e-100 else 1.0
    v, w = v / s, query / q
    score = (v * w).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((w * w).sum()))
    found = [(-score[j], i) for j, row in enumerate(near) for i in ids[row]]
    return sorted(found)[:k]


def _search(rows: pa.Table, k: int) -> pa.Table:
    """Each query of the pack against its cells' vectors, or against all where it names no cells."""
    is_query = rows.column("query").to_numpy(zero_copy_only=False).astype(bool)
    base, asked = rows.filter(pa.array(~is_query)), rows.filter(pa.array(is_query))
    out = []
    if base.num_rows and asked.num_rows:
        cell = np.array([c[0] if c else 0 for c in base.column("cells").to_pylist()], np.int64)
        order = np.argsort(cell, kind="stable")
        cell, base = cell[order], base.take(pa.array(order))
        vectors, ids, digest = _matrix(base.column("vector")), base.column("ids").to_pylist(), base.column("digest").to_pylist()
        number = np.unique(np.array(digest, dtype="S16"), return_inverse=True)[1]
        unit = _scaled(vectors)
        for q, query, cells in zip(asked.column("digest").to_pylist(), _matrix(asked.column("vector")), asked.column("cells").to_pylist()):
            if cells is None:
                at = np.arange(len(cell))
            else:
                cells = np.unique(np.array(cells, np.int64))
                begin, end = np.searchsorted(cell, cells), np.searchsorted(cell, cells, side="right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(begin, end) if b > a] or [np.zeros(0, np.int64)])
                at = at[np.unique(number[at], return_index=True)[1]]
            if len(at):
                out += [(q, i, -s) for s, i in _best(query, vectors[at], unit[at], [ids[j] for j in at], k)]
    return pa.Table.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()),
                                 pa.array([r[2] for r in out], pa.float64())], ["digest", "vec_id", "score"])


def _merged(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("digest").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("digest", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def _blocked(index: DataFrame, queries: DataFrame, visits: DataFrame | int):
    """index and queries with ``block``: a pack's queries are dealt to blocks of about ``QUERIES``, its vectors are in each.

    visits: the number of queries, or pack and n, the number of its queries, for packs that have more than ``QUERIES``.
    """
    if isinstance(visits, int):
        blocks = F.lit(max(1, math.ceil(visits / QUERIES)))
    else:
        visits = visits.select("pack", F.ceil(F.col("n") / QUERIES).cast("int").alias("blocks"))
        index, queries = (side.join(visits, "pack", "left") for side in (index, queries))
        blocks = F.coalesce("blocks", F.lit(1))
    last = (blocks - 1).cast("int")
    return (index.withColumn("block", F.explode(F.sequence(F.lit(0), last))).drop("blocks"),
            queries.withColumn("block", F.pmod(F.xxhash64("digest"), blocks).cast("int")).drop("blocks"))


def _packed(index: DataFrame, queries: DataFrame, k: int, visits: DataFrame | int) -> DataFrame:
    """index and queries: pack, digest, vector, cells, and of the index ids."""
    index, queries = _blocked(index, queries, visits)
    both = index.withColumn("query", F.lit(False)).unionByName(
        queries.withColumn("ids", F.lit(None).cast("array<long>")).withColumn("query", F.lit(True)))
    found = both.select("pack", "block", "query", "digest", "vector", "cells", "ids").groupBy("pack", "block").applyInArrow(
        lambda t: _search(t, k), "digest binary, vec_id long, score double")
    return _merged(found, k)


def scan(base: DataFrame, queries: DataFrame, rows: int, k: int) -> DataFrame:
    """Exact search: every block of the base meets every query."""
    blocks = max(1, math.ceil(rows / BLOCK))
    none = F.lit(None).cast("array<long>")
    index = base.withColumn("pack", F.pmod(F.xxhash64("digest"), F.lit(blocks))).withColumn("cells", none)
    asked = queries.select("digest", "vector", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("pack"))
    return _packed(index, asked.withColumn("cells", none), k, queries.count())


def _hashed(base: DataFrame, hasher: Hasher) -> DataFrame:
    """The base with each vector's cell in each table, in ``all_cells``."""
    kind = dict(base.dtypes)["vector"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cells = hasher.cells(_scaled(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells), pa.list_(pa.int64()))],
                                                 [*batch.schema.names, "all_cells"])

    return base.mapInArrow(run, f"digest binary, vector {kind}, ids array<long>, all_cells array<long>")


def _packs(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(first pack, number of packs) of each prefix by its number of vectors: small neighbours share one, large ones are split."""
    first, split = np.zeros(PREFIXES, np.int64), np.ones(PREFIXES, np.int64)
    pack, held = 0, 0
    for prefix in range(PREFIXES):
        n = counts.get(prefix, 0)
        if held and held + n > BLOCK:
            pack, held = pack + 1, 0
        first[prefix], held = pack, held + n
        if n > BLOCK:
            split[prefix] = math.ceil(n / BLOCK)
            pack, held = pack + int(split[prefix]), 0
    return first, split


def _pack_of(cell: np.ndarray, block, packs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    first, split = (p[cell >> HASH_BITS] for p in packs)
    x = (cell.view(np.uint64) + np.uint64(1) * np.asarray(block, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return first + ((x ^ (x >> np.uint64(31))) % split.astype(np.uint64)).astype(np.int64)


def _index_rows(hashed: DataFrame, blocks_of: dict, packs: tuple) -> DataFrame:
    """A row per vector and table, in the pack of its cell (of one block of it, where the cell is split)."""
    kind = dict(hashed.dtypes)["vector"]

    def run(batches):
        for batch in batches:
            cells = batch.column("all_cells").to_pylist()
            for t in range(len(cells[0]) if cells else 0):
                c = np.array([x[t] for x in cells], np.int64)
                split = np.array([blocks_of.get(x, 1) for x in c.tolist()])
                own = np.array([int.from_bytes(d[:6], "little") for d in batch.column("digest").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_pack_of(c, own % split, packs)), batch.column("digest"), batch.column("vector"), batch.column("ids"),
                     pa.array([[x] for x in c.tolist()], pa.list_(pa.int64()))], ["pack", "digest", "vector", "ids", "cells"])

    return hashed.mapInArrow(run, f"pack long, digest binary, vector {kind}, ids array<long>, cells array<long>")


def _probe_rows(queries: DataFrame, hasher: Hasher, reach: float, chance: float, blocks_of: dict, packs: tuple) -> DataFrame:
    """A row per query and pack with the cells to visit there."""
    kind = dict(queries.dtypes)["vector"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _scaled(_matrix(batch.column("vector")))
            for i in range(batch.num_rows):
                cells = hasher.probes(unit[i], reach, chance)
                split = np.array([blocks_of.get(x, 1) for x in cells.tolist()])
                cells = np.repeat(cells, split)
                block = np.concatenate([np.arange(s) for s in split])
                pack = _pack_of(cells, block, packs)
                order = np.argsort(pack, kind="stable")
                names, start = np.unique(pack[order], return_index=True)
                lists = [c.tolist() for c in np.split(cells[order], start[1:])]
                take = pa.array([i] * len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), batch.column("digest").take(take), batch.column("vector").take(take),
                     pa.array(lists, pa.list_(pa.int64()))], ["pack", "digest", "vector", "cells"])

    return queries.mapInArrow(run, f"pack long, digest binary, vector {kind}, cells array<long>")


def nearest(vectors: DataFrame, is_query, k: int = 5, tables: int = TABLES, recall: float = RECALL) -> DataFrame:
    """The k nearest other rows of each row for which ``is_query`` (a condition on vec_id) holds: query_id, rank, vec_id, score."""
    k1 = k + 1  # a query finds itself too
    rows = staged(_usable(vectors), "vectors")
    first = rows.withColumn("rn", F.row_number().over(W.partitionBy("digest").orderBy("vec_id"))).filter(F.col("rn") <= k1)
    base = staged(first.groupBy("digest").agg(
        F.sort_array(F.collect_set("vec_id")).alias("ids"), F.min(F.when(F.col("rn") == 1, F.col("vector"))).alias("vector"))
        .select("digest", "vector", "ids"), "base")
    asked = staged(rows.filter(is_query).select("vec_id", "digest").distinct(), "asked")
    queries = staged(base.join(asked.select("digest").distinct(), "digest", "left_semi").select("digest", "vector"), "queries")
    distinct = base.count()
    answer_type = "query_id long, rank int, vec_id long, score double"
    if not distinct:
        return vectors.sparkSession.createDataFrame([], answer_type)
    dim = len(base.select("vector").first()[0])
    sample = scan(base, queries.orderBy("digest").limit(SAMPLE), distinct, k1)
    last = [r[0] for r in sample.groupBy("digest").agg(F.min("score")).select("min(score)").collect()]
    reach = float(np.quantile(np.sqrt(np.maximum(2 - 2 * np.array(last), 1e-4)), 0.95)) if last else 1.0
    hasher = Hasher(dim, projections_for(distinct), tables, WIDTH, SEED)
    chance = 1 - (1 - recall) ** (1 / tables)
    hashed = staged(_hashed(base, hasher), "hashed")
    limit = max(BLOCK // 4, distinct // HOT_KEYS)
    counts = hashed.select(F.explode("all_cells").alias("cell")).groupBy("cell").count().filter(F.col("count") > limit).collect()
    blocks_of = {r[0]: math.ceil(r[1] / limit) for r in counts}
    prefixes = hashed.select(F.explode("all_cells").alias("cell")).groupBy(F.shiftright("cell", HASH_BITS).alias("prefix"))
    packs = _packs({r[0]: r[1] for r in prefixes.count().collect()})  # PREFIXES rows at most
    probes = staged(_probe_rows(queries, hasher, reach, chance, blocks_of, packs), "probes")
    visits = probes.groupBy("pack").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > QUERIES)
    found = staged(_packed(_index_rows(hashed, blocks_of, packs), probes, k1, 1 if visits.isEmpty() else visits), "found")
    total = base.agg(F.sum(F.size("ids"))).first()[0]
    short = queries.join(found.groupBy("digest").count().filter(F.col("count") >= min(k1, total)), "digest", "left_anti")
    if not short.isEmpty():
        found = found.join(short.select("digest"), "digest", "left_anti").unionByName(scan(base, short, distinct, k1))
    answers = asked.withColumnRenamed("vec_id", "query_id").join(found.drop("rank"), "digest").filter("vec_id <> query_id")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of each row of ``embeddings`` whose vec_id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)
