"""Columns that documents bring along keep their values through the stages, whatever they are called."""

from helpers import CLASHING, documents

from tickforge.llm import exact_dedup, jaccard_join, mixing


def _rows():
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    return [(i, " ".join(words[i % 5:] + words[:i % 5]) + f" w{i // 2}", "en", "ab"[i % 2]) for i in range(20)] + [(None, "x y z", "en", None)]


def test_stages_keep_clashing_columns(spark):
    docs = documents(spark, _rows())
    for operator in (exact_dedup.keep_first, jaccard_join.keep_one, mixing.mix):
        got = operator(docs)
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r[c] == c for r in rows for c in CLASHING), operator


def test_stages_decide_alike_without_the_other_columns(spark):
    docs = documents(spark, _rows())
    plain = docs.drop(*CLASHING)
    for operator in (exact_dedup.keep_first, jaccard_join.keep_one):
        names = ("doc_id", "text", "source")
        assert sorted(map(str, operator(docs).select(*names).collect())) == sorted(map(str, operator(plain).select(*names).collect()))
