import hashlib
import random

import numpy as np
import pytest
from helpers import documents, rows_of
from tokenizers import Tokenizer

from tickforge.llm import bpe as B

PIECES = list("ab'stremvldX12 .,!-\n\t\r") + [
    "  ", " ", "　", "́", "é", "ß", "中", "文", "😀", " ", "<|endoftext|>", "'s", "'ll", "\x85", "\x1c", "²", "ſ", "​", "﻿", " '", "\x00"]


@pytest.fixture(scope="module")
def pair():
    path = B.default_vocabulary()
    return B.Codec(B._read(path)), Tokenizer.from_file(path)


def same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = codec.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids, repr(text)
    assert codec.decode(got) == library.decode(ids, skip_special_tokens=False), repr(text)


def test_ids_equal_the_library_on_odd_texts(pair):
    rng = random.Random(5)
    for _ in range(4000):
        same(*pair, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 24))))


def test_ids_equal_the_library_on_any_code_points(pair):
    rng = random.Random(6)
    for _ in range(1500):
        same(*pair, "".join(chr(rng.choice([rng.randint(0, 0x7F), rng.randint(0x80, 0x2FFF), rng.randint(0x3000, 0xD7FF), rng.randint(0x10000, 0x1FFFF)]))
                            for _ in range(rng.randint(0, 30))))


def test_every_cut_is_forced(pair):
    codec = pair[0]
    raw = "The quick, brown don't 3.14 <|endoftext|> é naïve 中文 x".encode()
    cuts = codec.cuts(raw)
    assert len(cuts) > 5 and not any(codec.inside[raw[c - 1], raw[c]] for c in cuts)
    assert b"".join(codec.fragments(raw)) == raw


def test_long_and_uncuttable_texts(pair):
    for text in ("a" * 5000, " " * 3000, "word " * 20000, "é" * 4000, "'" * 999):
        same(*pair, text)


def test_memo_stays_bounded(pair, monkeypatch):
    monkeypatch.setattr(B, "MEMO_FRAGMENTS", 50)
    codec = B.Codec(B._read(B.default_vocabulary()))
    for i in range(200):
        same(codec, pair[1], f"word{i} other{i * 7} " + "long" * 20)
    assert len(codec.memo) < 70 and all(len(f) <= B.MEMO_BYTES for f in codec.memo)


def test_query_rows_and_round_trip(spark, pair):
    rows = [(1, "Hello world", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (1, "Hello world", "en", "s"), (None, "naïve 😀", "en", "s")]
    docs = documents(spark, rows)
    got = rows_of(B.round_trip(docs))
    expected = []
    for i, t, *_ in rows:
        ids = pair[1].encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got), key=str) == sorted(expected, key=str)
    back = rows_of(B.decode_documents(B.encode_documents(docs)))
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t, *_ in rows)
    assert B.round_trip(documents(spark, [])).count() == 0


def test_other_kinds_of_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        B.Codec(B._read(public_tokenizers.path("word_bpe_49k.json")))
