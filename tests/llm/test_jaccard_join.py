import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, prose, rows_of

from tickforge.llm import jaccard_join as J


def brute(rows, threshold=0.8, n=5):
    """(class_id, n_links) of each document, from all pairs."""
    sets = {}
    for i, t, *_ in rows:
        w = J._WORDS.findall(t or "")
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    ids = sorted(sets)
    label, links = {i: i for i in ids}, Counter()
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((label[a], label[b]))
                    label = {k: low if v == high else v for k, v in label.items()}
    return {i: (label[i], links[i]) for i in ids}


def near_copies(rng, count, words=80, changes=2):
    base = prose(rng, words).split()
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"new{rng.random()}"
        out.append(" ".join(w))
    return out


def corpus(rng):
    texts = [prose(rng, rng.choice([1, 2, 4, 5, 9, 40, 200])) for _ in range(120)]
    for _ in range(12):
        texts += near_copies(rng, rng.randint(2, 6))
    texts += near_copies(rng, 60, 120, 3) + ["same text of a few words here"] * 30 + ["same  text of\ta few words here"] * 3
    texts += [None, "", " \n", "one", "one", "two words"]
    rng.shuffle(texts)
    return [(i, t, "en", "s") for i, t in enumerate(texts)]


def test_classes_and_links_equal_brute_force(spark):
    rows = corpus(random.Random(1))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows_of(J.jaccard_classes(documents(spark, rows)))}
    assert got == brute(rows)


def test_split_clusters_give_the_same(spark, monkeypatch):
    rows = corpus(random.Random(2))
    monkeypatch.setattr(J, "BLOCK_TEXTS", 16)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows_of(J.jaccard_classes(documents(spark, rows)))}
    assert got == brute(rows)


def test_banding_meets_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.8, 0.99999), (0.6, 0.95)):
        bands, rows = J.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows)**bands >= recall and bands * rows <= J.MOST_HASHES
    with pytest.raises(ValueError):
        J.choose_bands(0.1, 0.999999, 10)


def test_minhash_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    signer = J.Signer(200, 1)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    x, y = np.unique(a[:600]), np.unique(a[300:])
    agree = (signer.band_hashes(x) == signer.band_hashes(y)).mean()
    assert abs(agree - 1 / 3) < 0.12


def test_keep_one_keeps_whole_rows_and_clean_documents(spark):
    rows = corpus(random.Random(4))
    docs = documents(spark, rows)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in rows_of(kept)} == {i for i, (c, _) in brute(rows).items() if c == i}


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "s")], [(None, "a b c d e f", "en", "s"), (None, "a b c d e f", "en", "s")],
                                  [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, "", None, None)], [(1, "x " * 60000, "en", "s"), (2, "x " * 60001, "en", "s")]])
def test_small_and_odd_tables(spark, rows):
    got = rows_of(J.jaccard_classes(documents(spark, rows)))
    assert len(got) == len(rows)
    if rows and rows[0][1] and len(rows[0][1]) > 1000:
        assert {(r["class_id"], r["n_links"]) for r in got} == {(1, 1)}


def test_rows_without_an_id_are_linked(spark):
    base = prose(random.Random(5), 80)
    texts = [base, base + " more", base + " other", base + " last"]
    rows = [(None, texts[0], "en", "s"), (5, texts[1], "en", "s"), (None, texts[2], "en", "s"), (9, texts[3], "en", "s"), (9, texts[3], "en", "s")]
    docs = documents(spark, rows)
    got = sorted((r["doc_id"] or 0, r["class_id"], r["n_links"]) for r in rows_of(J.jaccard_classes(docs)))
    assert got == [(0, 5, 4), (0, 5, 4), (5, 5, 4), (9, 5, 4), (9, 5, 4)]
    assert [r["doc_id"] for r in rows_of(J.keep_one(docs))] == [5]


def test_a_class_without_ids_keeps_one_text(spark):
    base = prose(random.Random(6), 80)
    docs = documents(spark, [(None, base, "en", "s"), (None, base + " more", "en", "s"), (None, "quite another text than those before", "en", "s")])
    assert {(r["class_id"], r["n_links"]) for r in rows_of(J.jaccard_classes(docs))} == {(None, 1), (None, 0)}
    kept = [r["text"] for r in rows_of(J.keep_one(docs))]
    assert len(kept) == 2 and "quite another text than those before" in kept


def test_one_id_with_two_texts_joins_no_classes(spark):
    rng = random.Random(7)
    a, b = prose(rng, 80), prose(rng, 80)
    docs = documents(spark, [(1, a, "en", "s"), (1, b, "en", "s"), (2, a + " more", "en", "s"), (3, b + " more", "en", "s"), (4, b, "en", "s")])
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in rows_of(J.jaccard_classes(docs)))
    assert got == [(1, 2, 1), (1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 3, 2)]
    assert sorted(r["doc_id"] for r in rows_of(J.keep_one(docs))) == [2, 3]


def test_rows_that_repeat_often_are_verified_once(spark):
    base = prose(random.Random(9), 60)
    rows = [(None, base, "en", "s")] * 1200 + [(7, base, "en", "s")] * 1200 + [(8, base + " more", "en", "s")]
    got = rows_of(J.jaccard_classes(documents(spark, rows)))
    assert {(r["class_id"], r["n_links"]) for r in got} == {(7, 2400)} and len(got) == 2401


def test_components_follow_long_chains(spark):
    from tickforge.llm.components import components

    links = [(i, i) for i in range(12)] + [(i + 1, i) for i in range(12)] + [(100, 900), (101, 900)]
    got = {r["node"]: r["label"] for r in rows_of(components(spark.createDataFrame(links, "node long, key long")))}
    assert got == {i: 0 for i in range(13)} | {100: 100, 101: 100}
