"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of adjacent bytes that occurs inside no token of the vocabulary can never end up in one token, so the text can be
cut there for certain. The fragments are encoded one by one and their ids concatenated; as most fragments are words that
recur, each task keeps a bounded memo of them. Ids are the same as those of the whole text, for any text.

A cut must also leave the pre-tokenizer's view of both sides as it was. Its pattern looks at the neighbourhood of white
space and at apostrophes only, so cuts are made only after a character that is not white space (recognised by its UTF-8
bytes), before the first byte of a character, and not before an apostrophe. Special tokens count as tokens of the
vocabulary, which keeps their strings whole.

Fragments are encoded by merging byte pairs in the order of their ranks (tiktoken), which for a vocabulary whose ids
follow its merges is what the tokenizers library does, several times faster on short strings.

Defined results: a null text is an empty one, with no ids; a text without any cut is one fragment; rows that repeat are
encoded alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import array
import hashlib
import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickforge.llm.common import table

#: Fixed value: the pre-tokenizer pattern that a byte-level BPE tokenizer file means by "use_regex".
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fragments that a task remembers before it starts afresh, and the longest one that it remembers.
MEMO_FRAGMENTS, MEMO_BYTES = 200_000, 48


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters are themselves,
    the other bytes follow from code point 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder for one vocabulary file (the JSON text of a byte-level BPE tokenizer without normalizer)."""

    def __init__(self, tokenizer_json: str):
        import tiktoken

        spec = json.loads(tokenizer_json)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]
                or spec["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError("forced-boundary splitting is for byte-level BPE without normalizer and prefix space")
        vocab = model["vocab"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("the vocabulary's ids don't follow its merges")
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.encoding = tiktoken.Encoding("fragments", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        tokens = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.bytes_of = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.inside = np.zeros((256, 256), bool)
        for t in tokens.values():
            b = np.frombuffer(t, np.uint8)
            self.inside[b[:-1], b[1:]] = True
        self.memo: dict[bytes, bytes] = {}

    def cuts(self, raw: bytes) -> np.ndarray:
        """Positions in the UTF-8 text at which it is cut for certain."""
        b = np.frombuffer(raw, np.uint8)
        if len(b) < 2:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(~self.inside[b[:-1], b[1:]])
        padded = np.concatenate([np.zeros(3, np.uint8), b])
        last, second, third, fourth = (padded[at + 3 - k] for k in range(4))
        following = b[at + 1]
        # Not white space: visible ASCII; any 2-byte character from U+00C0; any 3-byte one from U+4000; any 4-byte one.
        solid = ((last >= 0x21) & (last <= 0x7E)) | (last >= 0x80) & (
            (second >= 0xC3) & (second <= 0xDF) | (second < 0xC0) & ((third >= 0xE4) & (third <= 0xEF) | (third < 0xC0) & (fourth >= 0xF0)))
        return at[solid & ((following & 0xC0) != 0x80) & (following != 0x27)] + 1

    def fragments(self, raw: bytes) -> list[bytes]:
        cuts = self.cuts(raw).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)])] if raw else []

    def _ids(self, fragment: bytes) -> bytes:
        ids = array.array("I", self.encoding.encode(fragment.decode(), allowed_special="all"))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        parts = self.fragments(text.encode())
        if len(self.memo) > MEMO_FRAGMENTS:
            self.memo.clear()
        new = {f: self._ids(f) for f in set(parts).difference(self.memo)}
        long = {f: i for f, i in new.items() if len(f) > MEMO_BYTES}
        self.memo.update(new)
        ids = b"".join(map(self.memo.__getitem__, parts))
        for f in long:
            del self.memo[f]
        return ids

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[str]]]:
    for batch in batches:
        yield batch, (t.as_py() or "" for t in batch.column("text"))


def _mapped(docs: DataFrame, vocabulary: str | None, columns: str, row) -> DataFrame:
    """doc_id and what ``row(codec, text)`` returns. The vocabulary (1.3 MB, not growing with data) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(_read(vocabulary or default_vocabulary()))

    def run(batches):
        codec = Codec(shared.value)
        names = [c.strip().split()[0] for c in columns.split(",")]
        for batch, texts in _texts(batches):
            rows = [row(codec, t) for t in texts]
            values = [pa.array(v) for v in zip(*rows)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *values], ["doc_id", *names])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {columns}")


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (binary: little-endian unsigned 32-bit integers)."""
    def row(codec, text):
        ids = codec.encode(text)
        return len(ids) // 4, ids
    return _mapped(docs, vocabulary, "n_tokens long, ids binary", row)


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and text of rows doc_id, ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(_read(vocabulary or default_vocabulary()))

    def run(batches):
        codec = Codec(shared.value)
        for batch in batches:
            texts = [codec.decode(i.as_py() or b"") for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def digest_row(codec: Codec, text: str) -> tuple[int, str, str]:
    ids = codec.encode(text)
    return (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(codec.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text decoded from them; the ids stay in the task."""
    return _mapped(docs, vocabulary, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest_row)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))
