import hashlib
import re

from helpers import documents, rows_of
from pyspark.sql import functions as F

from tickforge.llm import exact_dedup as X

ROWS = [(5, "a  b", "en", "s"), (3, "a\tb", "en", None), (4, " a b", "en", "s"), (7, None, None, "s"), (6, "", "de", "t"), (1, "\n", "en", "s"),
        (2, "Ünï \x0b x", "en", "s"), (8, "Ünï x", "en", "s"), (9, "a b", "en", "s"), (5, "a  b", "en", "s"), (None, "a b", "en", "s"),
        (None, "lonely", "en", "s")]


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    out = []
    for i, t, *_ in rows:
        same = [j for j, u, *_ in rows if norm(u) == norm(t)]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_decisions_equal_brute_force(spark):
    got = rows_of(X.dedupe(documents(spark, ROWS)))
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got), key=str) == brute(ROWS)


def test_hot_group_is_whole(spark):
    rows = [(i, "copy" if i % 3 else f"own {i}", "en", "s") for i in range(6000)]
    got = rows_of(X.dedupe(documents(spark, rows)))
    assert len(got) == 6000 and sum(r["kept"] for r in got) == 2001
    assert {r["group_size"] for r in got} == {1, 4000}


def test_index_remembers_across_batches_and_sessions(spark, tmp_dir):
    X.open_index(spark, "dedup_index_a", f"{tmp_dir}/index", 4)
    first = rows_of(X.add_documents(documents(spark, [(10, "x y", "en", "s"), (11, "z", "en", "s")]), "dedup_index_a"))
    assert all(r["kept"] for r in first)
    spark.sql("DROP TABLE dedup_index_a")  # an external table: its files stay, as for another session
    X.open_index(spark, "dedup_index_b", f"{tmp_dir}/index", 4)
    again = {r["doc_id"]: r for r in rows_of(X.add_documents(documents(spark, [(1, "x  y", "en", "s"), (2, "new", "en", "s")]), "dedup_index_b"))}
    assert (again[1]["keep_id"], again[1]["kept"], again[2]["kept"]) == (10, False, True)
    assert spark.table("dedup_index_b").count() == 3


def test_index_join_needs_no_shuffle_of_the_index(spark, tmp_dir):
    X.open_index(spark, "dedup_index_c", f"{tmp_dir}/index", 8)
    rows_of(X.add_documents(documents(spark, ROWS), "dedup_index_c"))
    new = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("digest")).repartition(8, "digest")
    plan = new.hint("merge").join(spark.table("dedup_index_c").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


def test_keep_first_returns_whole_rows_once(spark):
    docs = documents(spark, ROWS)
    kept = X.keep_first(docs)
    assert kept.columns == docs.columns
    got = rows_of(kept)
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got if r["doc_id"] is not None) == [(False, i) for i in (1, 2, 3, 4, 6, 9)]
    assert [r["text"] for r in got if r["doc_id"] is None] == ["lonely"]


def test_empty_table(spark):
    assert X.dedupe(documents(spark, [])).count() == 0
