import math

import numpy as np
import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from tickforge.llm import ann as A


def table(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], f"vec_id long, embedding array<{kind}>, digest string, rank string")


def brute(vectors, k=5):
    """rank -> (vec_id, score) of each query, in double precision; equal vectors have equal scores."""
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % 50 == 0:
            s = sorted((-float((v * w).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum()))), i) for i, w in ok if i != q)
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


def answers(df):
    got = {}
    for r in sorted(rows_of(df), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got.setdefault(r["query_id"], [])) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    return got


def recall(got, expected):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in e}) for q, e in expected.items())
    return hit / sum(len(e) for e in expected.values())


def test_recall_and_scores_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 24))
    vectors = [(i, (centres[i % 20] + 0.7 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(1500)]
    got, expected = answers(A.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0)), brute(vectors)
    assert recall(got, expected) >= 0.9 and all(len(a) == 5 for a in got.values())
    scores = {q: dict(brute(vectors, 2000)[q]) for q in list(got)[:5]}
    for q, of in scores.items():
        assert all(abs(of[i] - s) < 1e-12 for i, s in got[q])


def test_equal_vectors_and_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(2)
    common = rng.standard_normal(16).astype(np.float32).tolist()
    vectors = [(i, common if i % 3 == 0 else rng.standard_normal(16).astype(np.float32).tolist()) for i in range(600)]
    got = answers(A.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0))
    assert [i for i, _ in got[150]] == [0, 3, 6, 9, 12] and [i for i, _ in got[0]] == [3, 6, 9, 12, 15]


def test_split_cells_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = [(i, (np.ones(12) + 0.05 * rng.standard_normal(12)).astype(np.float32).tolist()) for i in range(800)]
    whole = answers(A.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0))
    monkeypatch.setattr(A, "BLOCK", 100)
    assert answers(A.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0)) == whole


def test_query_blocks_are_bounded_and_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = [(50 * i, rng.standard_normal(12).astype(np.float32).tolist()) for i in range(400)]
    whole = answers(A.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0))
    monkeypatch.setattr(A, "QUERIES", 50)
    assert answers(A.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0)) == whole
    rows = spark.range(400).select((F.col("id") % 2).alias("pack"), F.col("id").cast("string").cast("binary").alias("digest"))
    many = spark.createDataFrame([(0, 200)], "pack long, n long")
    for visits, copies in ((400, 8 * 400), (many, 4 * 200 + 200)):
        index, queries = A._blocked(rows, rows, visits)
        sizes = {(r["pack"], r["block"]): r["count"] for r in queries.groupBy("pack", "block").count().collect()}
        assert sum(sizes.values()) == 400 and index.count() == copies
        assert all(n < 100 for (p, _), n in sizes.items() if p == 0 or visits == 400)


def test_neighbouring_cells_share_packs(monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 100)
    h = A.Hasher(16, 8, 2, 2.0, 5)
    cells = h.cells(A._scaled(np.random.default_rng(7).standard_normal((4000, 16)))).ravel()
    names, n = np.unique(cells >> A.HASH_BITS, return_counts=True)
    packs = A._packs(dict(zip(names.tolist(), n.tolist())))
    sizes = np.bincount(A._pack_of(cells, 0, packs))
    probes = h.probes(A._scaled(np.ones((1, 16)))[0], 0.5, 0.8)
    assert len(sizes) >= 80 and len(set(A._pack_of(probes, 0, packs).tolist())) < len(sizes) / 3


def test_probes_come_in_order_of_their_chance():
    h = A.Hasher(8, 4, 1, 2.0, 5)
    unit = A._scaled(np.random.default_rng(4).standard_normal((1, 8)))[0]
    few, many = h.probes(unit, 1.0, 0.2), h.probes(unit, 1.0, 0.8)
    assert many[:len(few)].tolist() == few.tolist() and len(many) > len(few)
    assert few[0] == h.cells(unit[None])[0, 0] or len(few) > 1
    assert len(set(h.probes(unit, 1.0, 1.0).tolist())) == 81


@pytest.mark.parametrize("kind", ["float", "double"])
def test_unusable_vectors_take_no_part(spark, kind):
    vectors = [(0, [1.0, 2.0]), (50, None), (100, [0.0, 0.0]), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]),
               (None, [1.0, 1.0]), (300, []), (350, [1.0, 1.0, 1.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.5]), (1, [2.0, 1.0])]
    got = answers(A.nearest(table(spark, vectors, kind), F.col("vec_id") % 50 == 0))
    assert set(got) == {0} and [i for i, _ in got[0]] == [1, 2]


def test_few_candidates_and_empty_table(spark):
    assert A.nearest(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert A.nearest(table(spark, [(0, [1.0, 0.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert A.nearest(table(spark, [(7, [1.0, 0.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert len(answers(A.nearest(table(spark, [(0, [1.0, 0.0]), (7, [0.0, -3.0])]), F.col("vec_id") % 50 == 0))[0]) == 1
