import math
import random

import numpy as np
import pytest
from helpers import CLASHING

from pyspark.sql import functions as F

from tickforge.llm import hard_negatives as hn

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def vectors(spark, rows):
    extra = [c for c in CLASHING if c != "label"]
    full = [(i, v, c, *extra) for i, v, c in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, " + ", ".join(f"`{c}` string" for c in extra))


def brute(rows, every, positives=5, negatives=5, least=80, most=100):
    usable = [(i, tuple(math.floor(256 * x) for x in v), c) for i, v, c in rows
              if i is not None and c is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v, _ in usable]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n), default=0)
    usable = {r for r in usable if len(r[1]) == d and all(d * x * x < 2**56 for x in r[1])}
    out = []
    for i, v, c in (r for r in usable if r[0] % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, g) for j, w, g in usable if j != i)
        for p, j, _ in [x for x in scored if x[2] == c][:positives]:
            inside = [x for x in scored if x[2] != c and least * -p <= 100 * -x[0] <= most * -p]
            out += [(i, j, rank + 1, n, -p, -s) for rank, (s, n, _) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(df, every, **more):
    return sorted(tuple(r[n] for n in NAMES) for r in hn.mine(df, F.col("vec_id") % every == 0, **more).collect())


def test_scores_are_exact_inner_products():
    rng = np.random.default_rng(1)
    for d, high in ((1, 1), (7, 3), (8, 200), (64, 256), (65, 30_000), (3, 2**26)):
        values, anchors = rng.integers(-high, high, (50, d)), rng.integers(-high, high, (9, d))
        values[0], anchors[0] = -high, -high
        planes = 1 + int(high).bit_length()
        bits = hn.packed(values, planes)
        assert (hn.unpacked(bits, d) == values).all()
        small, large = hn.kinds_for(planes, d)
        assert (hn.scores(hn.subset_sums(anchors, small), bits, large) == values @ anchors.T).all()


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 40)
    monkeypatch.setattr(hn, "ANCHORS", 6)
    monkeypatch.setattr(hn, "ROWS_AT_ONCE", 16)
    rng = random.Random(seed)
    shared = [[rng.choice((0.25, 0.5, -0.25)) for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(260):
        v = list(rng.choice(shared)) if rng.random() < 0.4 else [rng.uniform(-0.2, 1) for _ in range(9)]
        rows.append((i - 20, v, 1 if rng.random() < 0.5 else rng.randrange(4)))
    rows += rows[:30]                                                    # repeated rows
    rows += [(i, [rng.uniform(0, 1) for _ in range(9)], 1) for i in range(0, 60, 7)]  # ids shared with other vectors
    rows += [(500, None, 1), (501, [], 1), (502, [0.1] * 8, 1), (503, [None] + [0.1] * 8, 1), (504, [float("nan")] * 9, 1),
             (None, [0.5] * 9, 1), (505, [0.5] * 9, None), (510, [float("inf")] + [0.0] * 8, 2), (520, [1e300] + [0.0] * 8, 2),
             (530, [0.0] * 9, 1), (540, [2.0**17] + [0.0] * 8, 1), (541, [-(2.0**17)] * 9, 3)]
    df = vectors(spark, rows).repartition(3)
    want = brute(rows, 10)
    assert len(want) > 100
    assert mined(df, 10) == want
    assert mined(df, 10, positives=2, negatives=3, least=50, most=97) == brute(rows, 10, 2, 3, 50, 97)


def test_few_rows(spark):
    df = vectors(spark, [(0, [1.0, 0.5], 1)])
    assert mined(df, 10) == [] and mined(df.limit(0), 10) == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [-1.0], 1), (3, [0.9], 2), (4, [0.79], 2), (5, [-0.9], 2)]
    assert mined(vectors(spark, rows), 10) == brute(rows, 10) == [(0, 1, 1, 3, 65536, 58880)]


def test_one_vector_held_by_most_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 100)
    rows = [(i, [0.5, 0.25], i % 2) for i in range(600)] + [(i, [i / 700, 0.3], i % 3) for i in range(600, 700)]
    assert mined(vectors(spark, rows), 100) == brute(rows, 100)


def test_query_moves_every_seventh_label(spark):
    got = hn.op13_hard_negatives(spark, "/root/testdata/sf0.001").select(*NAMES).collect()
    rows = [(r.vec_id, list(map(float, r.embedding)), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert sorted(map(tuple, got)) == brute(rows, 100)
