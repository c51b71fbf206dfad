"""Z-order, compaction and signed deltas."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tickforge.operators import deltas
from tickforge.sinks import writers
from tickforge.sinks.compaction import CompactedFolder, first_fit_decreasing
from tickforge.sinks.zorder import write_zordered


def _rows_scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_zorder_skips_row_groups_by_either_column(spark, tmp_dir):
    n = 64_000
    rows = spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'HOT/USD' ELSE concat('S', lpad(CAST(hash(id) % 40 + 40 AS STRING), 2, '0'), '/USD') END AS symbol",
        "CASE WHEN id % 9000 = 5 THEN NULL WHEN id = 77 THEN TIMESTAMP'9000-01-01' ELSE timestampadd(SECOND, CAST(id * 40 AS INT), TIMESTAMP'2024-01-01') END AS timestamp")
    write_zordered(rows, f"{tmp_dir}/z", ["symbol", "timestamp"], rows_per_file=1000)
    back = spark.read.parquet(f"{tmp_dir}/z")
    assert back.count() == n and back.exceptAll(rows).isEmpty()
    hours = "timestamp >= TIMESTAMP'2024-01-10 06:00:00' AND timestamp < TIMESTAMP'2024-01-10 12:00:00'"  # one in 119
    shares = {f: _rows_scanned(back.filter(f)) / n for f in ("symbol = 'S47/USD'", "symbol = 'HOT/USD'", hours, f"{hours} AND symbol = 'S47/USD'")}
    assert shares["symbol = 'S47/USD'"] < 0.35 and shares[hours] < 0.35, shares
    assert shares["symbol = 'HOT/USD'"] < 0.6 and shares[f"{hours} AND symbol = 'S47/USD'"] < 0.1, shares


@pytest.mark.parametrize("rows", [0, 1])
def test_zorder_of_few_rows(spark, tmp_dir, rows):
    write_zordered(spark.range(rows).selectExpr("id", "CAST(NULL AS STRING) AS s"), f"{tmp_dir}/z", ["s", "id"])
    assert spark.read.parquet(f"{tmp_dir}/z").count() == rows


def test_first_fit_decreasing():
    assert first_fit_decreasing({}, 10) == []
    assert first_fit_decreasing({"a": 6, "b": 5, "c": 5, "d": 4, "e": 11}, 10) == [["e"], ["a", "d"], ["b", "c"]]
    rng = random.Random(1)
    sizes = {str(i): rng.randrange(1, 100) for i in range(500)}
    groups = first_fit_decreasing(sizes, 100)
    assert sorted(f for g in groups for f in g) == sorted(sizes)
    assert all(sum(sizes[f] for f in g) <= 100 for g in groups)
    assert len(groups) <= 1.25 * sum(sizes.values()) / 100 + 1


SCHEMA = T.StructType([T.StructField("x", T.LongType())])


def _append(spark, path, ids, files):
    (spark.createDataFrame([(i, None if i % 50 == 3 else f"h{i % 3}") for i in ids], "x long, part string")
          .repartition(files).write.mode("append").partitionBy("part").json(path))


def test_compaction_keeps_every_row_while_files_are_appended(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "bronze")
    folder = CompactedFolder(spark, path, SCHEMA, ["part"])
    ids = lambda: sorted((r.x, r.part) for r in folder.read().collect())
    want = lambda n: [(i, None if i % 50 == 3 else f"h{i % 3}") for i in range(n)]
    for n in range(3):
        _append(spark, path, range(100 * n, 100 * n + 100), 8)
    small = folder.file_count()
    assert ids() == want(300) and small > 60
    real = writers.publish_version
    monkeypatch.setattr(writers, "publish_version", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        folder.compact(1 << 20)
    assert ids() == want(300) and folder.file_count() == small  # a failed run changes nothing
    monkeypatch.setattr(writers, "publish_version", real)
    assert folder.compact(1 << 20) == {"replaced": small, "written": 4}
    assert ids() == want(300) and folder.file_count() == 4
    _append(spark, path, range(300, 400), 8)                          # after the compaction
    assert ids() == want(400)
    folder.compact(1 << 20)
    assert ids() == want(400) and folder.file_count() == 8
    assert folder.compact(1 << 20) == {"replaced": 0, "written": 0}
    folder.drop_replaced()
    assert ids() == want(400)


def test_compaction_groups_reach_the_target_size(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    _append(spark, path, range(3000), 10)
    folder = CompactedFolder(spark, path, SCHEMA, ["part"])
    total = sum(folder._size(f) for f in folder._loose())
    folder.compact(4000)
    assert folder.file_count() <= 1.5 * total / 4000 + 4 and folder.read().count() == 3000


def _trades(spark, rows):
    return spark.createDataFrame(
        [(i, d, s, Decimal(p), Decimal(1), None if p % 7 == 0 else Decimal(p), p * 10, p) for i, (d, s, p) in rows.items()],
        "trade_id long, trade_date string, symbol string, price decimal(18,8), quantity decimal(18,8), notional decimal(18,2), "
        "traded_at long, ingested_at long")


@pytest.mark.parametrize("seed", range(3))
def test_signed_deltas_equal_a_rebuild(spark, seed):
    rng = random.Random(seed)
    draw = lambda: (rng.choice(["a", "b", "c", None]), rng.choice("XYZ"), rng.randrange(1, 40))
    now = {i: draw() for i in range(60)}
    state = deltas.state_of(_trades(spark, now))
    for step in range(2):
        change = rng.sample(sorted(now), 6 + step)
        gone = {i: now[i] for i in change}
        come = {i: (*now[i][:2], rng.randrange(1, 40)) if rng.random() < 0.5 else draw() for i in change[:4]}
        come |= {100 * (step + 1) + i: draw() for i in range(4)}
        now = {i: v for i, v in now.items() if i not in gone} | come
        if step == 1:  # a whole group goes
            last = {i: v for i, v in now.items() if v[:2] == next(iter(now.values()))[:2] and i not in come}
            gone, now = gone | last, {i: v for i, v in now.items() if i not in last}
        new, again = deltas.changed_state(state, _trades(spark, gone), _trades(spark, come), _trades(spark, now))
        want = deltas.state_of(_trades(spark, now))
        key = lambda r: str(tuple(r))
        assert sorted(map(key, new.select(want.columns).collect())) == sorted(map(key, want.collect()))
        touched = {(v[0], v[1]) for v in gone.values()}
        assert {(r.trade_date, r.symbol) for r in again.collect()} <= touched
        state = spark.createDataFrame(new.collect(), state.schema)


def test_a_change_inside_the_extremes_reads_no_group_again(spark):
    rows = {i: ("a", "X", p) for i, p in enumerate((1, 20, 39))}
    state = deltas.state_of(_trades(spark, rows))
    gone, come = {1: rows[1]}, {1: ("a", "X", 25), 9: ("b", "Y", 3)}
    new, again = deltas.changed_state(state, _trades(spark, gone), _trades(spark, come), _trades(spark, rows | come))
    assert again.count() == 0 and {(r.symbol, int(r.sum_price)) for r in new.collect()} == {("X", 65), ("Y", 3)}
