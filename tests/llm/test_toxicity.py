import random
import zlib

import numpy as np
import pytest
from conftest import SF_CHECK
from helpers import documents, prose, rows_of

from tickforge.llm import toxicity as T

BAD = "idiot moron stupid trash worthless scum".split()


def corpus(count=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words, toxic = prose(rng, 40).split(), int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(40), rng.choice(BAD))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, toxic, "x"))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int, score string")


@pytest.fixture(scope="module")
def chars():
    return T.CharModel(*[c.astype(float) for c in T.ngram_counts(t for _, t, *_ in corpus()[0])])


@pytest.mark.parametrize("written, meant", [("1d10t", "idiot"), ("m o r o n", "moron"), ("s.t.u.p.i.d", "stupid"), ("tr@sh", "trash"), ("w0rthl3ss", "worthless"),
                                            ("stuuuupid", "stupid"), ("$cum", "scum"), ("M0R0N", "moron"), ("t r 4 s h", "trash"), ("idiot", "idiot")])
def test_deobfuscation(chars, written, meant):
    assert T.Restorer(chars).restore(f"You are {written} here.") == f"you are {meant} here."


@pytest.mark.parametrize("written, meant", [("iddiot", "idiot"), ("idiot$", None), ("s. t. u. p. i. d", "stupid"), ("m - o - r - o - n", "moron"),
                                            ("tra$h", "trash"), ("c u s", "cus"), ("tra$$", None), ("1 2 3", "1 2 3"), ("i  d  i  o  t", "idiot")])
def test_gate_is_as_wide_as_the_channel(chars, written, meant):
    got = T.Restorer(chars).restore(f"You, {written}, here.")
    assert got == f"you, {meant}, here." if meant else "$" not in got


def test_viterbi_finds_the_cheapest_reading(chars):
    r = T.Restorer(chars)
    for token in ("1d10t", "ssstup1d", "m00r", "a$$", "4l1"):
        def paths(runs):
            if not runs:
                return [("", 0.0)]
            return [(e + rest, p + q) for e, p in r._readings(*runs[0], False) for rest, q in paths(runs[1:])]
        def total(text, price):
            history, cost = 0, price
            for c in text:
                code = 0 if c == T._BREAK else int(T.codes(c)[1])
                cost += chars.cost(history, code)
                history = (history << 6 | code) & 0x3FFFF
            return cost + chars.cost(history, 0)
        best = min(total(*p) for p in paths(r._runs(token)))
        out = r.decode(token).replace(" ", T._BREAK)
        assert abs(min(total(t, p) for t, p in paths(r._runs(token)) if t == out) - best) < 1e-9


def test_clean_texts_stay(chars):
    for text in ("plain words, good letters!", "call 555 0199 now", "aa bb", "", "a b", "x" * 50000 + "y"):
        restored = T.Restorer(chars).restore(text)
        assert restored == text or "xxx" in text


def test_character_counts_are_those_of_all_texts(spark):
    rows = corpus(60)[0] + [(900, None, None, None), (901, "", None, None)]
    got, expected = T.char_model(documents(spark, rows).repartition(5)), T.ngram_counts(t for _, t, *_ in rows if t)
    assert all((a == b).all() for a, b in zip((got.two, got.three, got.four), expected))


def test_scores_held_out_and_obfuscated_documents(spark):
    rows, labels = corpus()
    rng = random.Random(9)
    hidden = [(1000 + i, prose(rng, 20) + f" {w} " + prose(rng, 20), "en", "s") for i, w in enumerate(("1d10t m0r0n tr4sh", "s t u p i d sc*um w0rthless idi0t", "m o r o n 1diot tr@sh"))]
    got = {r["doc_id"]: r for r in rows_of(T.score_toxicity(documents(spark, rows + hidden), labelled(spark, labels)))}
    truth = dict(x[:2] for x in labels)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert np.mean([got[i]["predicted"] == truth[i] for i in truth if got[i]["held_out"]]) > 0.95
    assert all(got[i]["predicted"] == 1 and got[i]["score"] >= 0.5 for i in (1000, 1001, 1002))


def test_learns_from_its_fold_only(spark):
    rows, labels = corpus(200)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, s) for i, y, s in labels]
    key = lambda r: r["doc_id"]
    a, b = (sorted(rows_of(T.score_toxicity(documents(spark, rows), labelled(spark, x))), key=key) for x in (labels, flipped))
    assert a == b


def test_held_out_quality_on_the_test_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r["score"], truth[r["doc_id"]]) for r in rows_of(T.score_toxicity(docs, labels)) if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.85


@pytest.mark.parametrize("rows, labels", [([], []), ([(1, None, None, None)], []), ([(1, "a", "en", "s"), (1, "a", "en", "s")], [(1, None, "x")]),
                                          ([(None, "a", "en", "s"), (2, "", "en", "s")], [(2, 1, "x"), (2, 0, "x"), (None, 1, "x")])])
def test_small_and_odd_tables(spark, rows, labels):
    got = rows_of(T.score_toxicity(documents(spark, rows), labelled(spark, labels)))
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
