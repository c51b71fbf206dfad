"""The key index: what a look-up reads, and that failures between its steps lose and repeat nothing."""

import os

import pytest

from conftest import SF_SMALL
from tickforge.plans import datasets as ds
from tickforge.session import conf_override
from tickforge.sinks import key_index as ki
from tickforge.sinks import writers


def _keys(spark, ids):
    return spark.createDataFrame([(None if i is None else f"k{i}", i) for i in ids], "trade_id string, x long")


def _staged(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def _ids(df):
    return sorted(r.x for r in df.collect())


def _rows_scanned(df):
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _index(spark, tmp_dir, rows, **more):
    index = ki.KeyIndex(spark, f"{tmp_dir}/index", **more)
    index.build(spark.range(rows).selectExpr("concat('k', id) AS trade_id"))
    return index


def test_a_short_list_reads_only_its_buckets(spark, tmp_dir):
    index = _index(spark, tmp_dir, 200_000, buckets=32)
    with conf_override(spark, index.lookup_conf()):
        found = index.stored_among(["k5", "k77777", "k999999"])
        assert sorted(r.trade_id for r in found.collect()) == ["k5", "k77777"]
        # 200,000 keys in 32 buckets: three at most are read, of them none for the absent key, whose Bloom filter says no
        assert 0 < _rows_scanned(found) < 3 * 200_000 / 32 * 1.2
        absent = index.stored_among([f"z{i}" for i in range(20)])
        assert absent.collect() == [] and _rows_scanned(absent) < 200_000 / 8


def test_a_long_list_shuffles_the_batch_only(spark, tmp_dir):
    index = _index(spark, tmp_dir, 20_000, buckets=8, listed=10)
    batch = _staged(spark, _keys(spark, [*range(19_000, 21_000)]), f"{tmp_dir}/batch")
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}):
        new = index.absent(batch)
        p = new._jdf.queryExecution().executedPlan().toString()
        assert p.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in p
        assert _ids(new) == list(range(20_000, 21_000))


@pytest.mark.parametrize("listed", [3, 1000])
def test_loads_add_each_key_once(spark, tmp_dir, listed, monkeypatch):
    monkeypatch.setattr(ki, "MERGE_AT", 3)
    monkeypatch.setattr(ki, "FILES_A_BUCKET", 1)
    path = f"{tmp_dir}/table"
    index = ki.KeyIndex(spark, f"{tmp_dir}/index", buckets=4, listed=listed)
    store = lambda rows: rows.write.mode("append").parquet(path)
    expected = set()
    for n in range(8):
        ids = [*range(5 * n, 5 * n + 8), None]
        batch = _staged(spark, _keys(spark, ids), f"{tmp_dir}/batch{n}")
        stored = spark.read.parquet(path) if os.path.exists(path) else None
        assert ki.insert_indexed(batch, index, stored, store) == len(set(ids) - expected - {None})
        expected |= set(ids) - {None}
        assert _ids(spark.read.parquet(path)) == sorted(expected)
    assert {r.trade_id for r in index.keys().collect()} == {f"k{i}" for i in expected}
    # the tail was merged, and a base of too many files rewritten
    assert len(index._tags()) < 3 and len(writers._versions(spark, f"{tmp_dir}/index/base")) > 1


@pytest.mark.parametrize("fails", ["before", "half", "after"])
def test_a_failed_load_is_repeated_exactly(spark, tmp_dir, fails):
    path = f"{tmp_dir}/table"
    _keys(spark, range(10)).write.parquet(path)
    index = ki.KeyIndex(spark, f"{tmp_dir}/index", buckets=4)
    batch = _staged(spark, _keys(spark, range(5, 25)), f"{tmp_dir}/batch")

    def broken(rows):
        if fails != "before":
            (rows.filter("x % 2 = 0") if fails == "half" else rows).write.mode("append").parquet(path)
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        ki.insert_indexed(batch, index, spark.read.parquet(path), broken)
    ki.insert_indexed(batch, index, spark.read.parquet(path), lambda rows: rows.write.mode("append").parquet(path))
    assert _ids(spark.read.parquet(path)) == list(range(25))
    assert sorted(r.trade_id for r in index.keys().distinct().collect()) == sorted(f"k{i}" for i in range(25))


def test_silver_look_up_skips_row_groups_by_bloom_filter(spark, tmp_dir):
    """Inside one partition the ids are in no order, so only the filters can tell that a row group holds none."""
    rows = ds.silver_good(spark, SF_SMALL)
    writers.write_silver(rows, f"{tmp_dir}/silver")
    with conf_override(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": "100"}):
        back = spark.read.parquet(f"{tmp_dir}/silver")
        some = [r.trade_id for r in back.select("trade_id").limit(3).collect()]
        none = back.select("trade_id").filter(back.trade_id.isin(["5x", "no such id"]))
        assert none.collect() == [] and _rows_scanned(none) < back.count() / 4
        assert back.filter(back.trade_id.isin(some)).count() == 3
