import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, prose, rows_of
from tokenizers import Tokenizer

import corpus_pipeline
from test_exact_dedup import brute as brute_exact
from test_jaccard_join import brute as brute_near
from test_jaccard_join import near_copies
from tickforge.llm import bpe, mixing
from tickforge.llm.queries import ORACLE, QUERIES


def corpus():
    rng = random.Random(8)
    texts = [prose(rng, rng.choice([6, 50, 200])) for _ in range(80)] + near_copies(rng, 12) + ["twice the same words in a row here"] * 4 + [None, "", "12 34", "!!"]
    rng.shuffle(texts)
    return [(i, t, "en", rng.choice("ab")) for i, t in enumerate(texts)]


def test_each_stage_and_the_whole(spark, tmp_dir):
    """Every stage against plain Python on its own input; the last gives run()'s rows."""
    rows = corpus()
    documents(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir)
        assert docs.columns == columns, name
        kept.append([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows_of(docs)])
    language, exact, near, mixed = kept
    assert sorted(i for i, *_ in language) == [i for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    assert sorted(i for i, *_ in exact) == sorted(i for i, _, _, stays, _ in brute_exact(language) if stays)
    assert sorted(i for i, *_ in near) == sorted(i for i, (c, _) in brute_near(exact).items() if c == i)
    taken = {r["doc_id"]: r["taken"] for r in rows_of(mixing.take(documents(spark, near))) if r["taken"]}
    words = Counter()
    for i, t, *_ in mixed:
        words[i] += len(t.split())
    assert dict(words) == taken
    library = Tokenizer.from_file(bpe.default_vocabulary())
    expected = []
    for i, t, *_ in mixed:
        ids = library.encode(t, add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(corpus_pipeline.run(spark, tmp_dir))]
    assert sorted(got) == sorted(expected)


def test_empty_documents_run_through(spark, tmp_dir):
    documents(spark, []).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_queries_are_registered_in_full():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in QUERIES}
    assert len(QUERIES) == 14 and set(ORACLE) <= set(QUERIES) and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", ["op1_mixing", "op4_exact_dedup", "op12_pii"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    from conftest import SF_SMALL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    sql = con.execute(ORACLE[name])
    names = [d[0] for d in sql.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(sql.fetchall())
