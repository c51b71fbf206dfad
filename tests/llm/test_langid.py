import random
import zlib

import numpy as np
import pytest
from conftest import SF_CHECK
from helpers import documents, prose, rows_of

from tickforge.llm import langid as L
from tickforge.llm.letters import codes, has_letter


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = rows_of(L.identify(docs))
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.97


def test_folded_scores_equal_the_kernel_machine():
    """The folded matrix gives what kernels with landmarks, Nystroem map and ridge weights give one by one."""
    texts = ["der die das und nicht ein"] * 3 + ["the and of to in that it"] * 3 + ["le la les des une que"] * 3
    texts = [f"{t} {i}x{chr(97 + i)}" for i, t in enumerate(texts)]
    model = L.fit(texts, ["de"] * 3 + ["en"] * 3 + ["fr"] * 3, landmarks=4, ridge=1e-2)
    sets = [set(L.ngrams(t).tolist()) & set(model.known.tolist()) for t in texts]
    p = model.presence(texts)
    for i, s in enumerate(sets):
        for j, t in enumerate(sets):
            assert abs(float(p[i] @ p[j]) - len(s & t) / (len(s) * len(t))**0.5) < 1e-5
    assert [x for x in model.predict(texts)[0]] == ["de"] * 3 + ["en"] * 3 + ["fr"] * 3


def test_learns_from_text_and_lang_of_its_fold_only(spark):
    rows = [(i, ("der die das " if i % 2 else "the and of ") * 5 + str(i), "de" if i % 2 else "en", "s") for i in range(120)]
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else g, "other") for i, t, g, s in rows]
    got = [sorted(rows_of(L.identify(documents(spark, r))), key=lambda r: r["doc_id"]) for r in (rows, wrong)]
    assert got[0] == got[1] and {r["lang_pred"] for r in got[0]} == {"de", "en"}


def test_texts_without_letters_are_undetermined(spark):
    rows = [(i, "der die das und nicht", "de", "s") for i in range(20)] + [
        (100, None, "de", "s"), (101, "", "de", "s"), (102, "123 456 !?", "de", "s"), (103, "²³ ½", "de", "s"), (104, "中文", None, "s"), (105, "der", None, None),
        (None, "das", "de", "s")]
    got = {r["doc_id"]: r for r in rows_of(L.identify(documents(spark, rows)))}
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103, 104, 105, None)] == ["und"] * 4 + ["de"] * 3
    docs = documents(spark, rows)
    kept = L.with_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4


@pytest.mark.parametrize("rows", [[], [(1, "text", None, None)], [(1, None, None, None)], [(1, "x", "en", "s"), (1, "x", "en", "s")]])
def test_small_and_odd_tables(spark, rows):
    assert L.identify(documents(spark, rows)).count() == len(rows)


def test_letter_codes():
    assert codes("aB-- z").tolist() == [0, 1, 2, 0, 26, 0] and codes("").tolist() == [0]
    assert codes("É").tolist() == codes("é").tolist() and has_letter("1é") and not has_letter("1_²")
    text = "word " * 30000
    assert len(codes(text)) == len(text) + 1


def test_a_language_of_long_texts_only_is_learned(spark):
    rng = random.Random(4)
    words = {"xx": ["aka", "oko", "uku", "aki"], "yy": ["zrt", "brz", "trk", "krz"]}
    rows = [(i, prose(rng, 6000 if i % 2 else 40, words["yy" if i % 2 else "xx"]), "yy" if i % 2 else "xx", "s") for i in range(60)]
    rows += rows[:6]  # repeated ids
    got = rows_of(L.identify(documents(spark, rows)))
    assert min(len(t) for _, t, g, _ in rows if g == "yy") > L.LONGEST
    assert all(r["lang_pred"] == ("yy" if r["doc_id"] % 2 else "xx") for r in got)
