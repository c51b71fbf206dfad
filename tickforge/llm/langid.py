"""Language identification with string kernels.

The kernel of two texts is the number of character 2-, 3- and 4-grams present in both (4-grams hashed to 20 bits), over the
n-grams that some landmark has, divided by the root of the product of both texts' own numbers: a blended-spectrum presence
kernel. A Nystroem map onto ``LANDMARKS`` training texts turns it into features, on which one-versus-rest kernel ridge
regression learns each language. As the kernel is a product of presence vectors, landmarks, Nystroem map and ridge weights
fold into one matrix (n-grams by languages), and a batch of documents is scored by one product with its presence matrix.

The training sample is bounded: ``PER_LANG`` documents of each language by hash order (of at most ``PER_SALT`` from each
of ``SALTS`` hash classes), ``MOST_ROWS`` in all, of at most
the first ``LONGEST`` characters each. It goes through the driver; documents to be scored never do.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for all texts if nothing could be
learned; a text none of whose n-grams a landmark has gets the language that is likeliest a priori, with a low score; rows
that repeat are scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickforge.llm.common import table
from tickforge.llm.letters import codes, has_letter

PER_LANG, MOST_ROWS, LONGEST = 400, 8000, 20_000
SALTS, PER_SALT = 256, 8
LANDMARKS, RIDGE, SEED = 256, 1e-3, 7
FOURS = 1 << 20
FEATURES = 64**2 + 64**3 + FOURS
#: Documents of one matrix product.
BATCH = 64


def ngrams(text: str) -> np.ndarray:
    """Feature numbers of the text's 2-, 3- and 4-grams, with repeats."""
    c = codes(text).astype(np.uint32)
    two = c[:-1] * 64 + c[1:]
    three = two[:-1] * 64 + c[2:]
    four = three[:-1] * 64 + c[3:]
    hashed = (four * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return np.concatenate([two, three + np.uint32(64**2), hashed + np.uint32(64**2 + 64**3)])


class Model:
    """Languages, the n-grams known (feature numbers), and the folded weights."""

    def __init__(self, languages: list[str], known: np.ndarray, weights: np.ndarray, bias: np.ndarray, sharpness: float):
        self.languages, self.known, self.weights, self.bias, self.sharpness = languages, known, weights, bias, sharpness
        self._place = None

    def presence(self, texts: list[str]) -> np.ndarray:
        """Rows of 0 and 1 over the known n-grams, each divided by the root of its sum."""
        if self._place is None:
            self._place = np.full(FEATURES, len(self.known), np.int32)
            self._place[self.known] = np.arange(len(self.known), dtype=np.int32)
        p = np.zeros((len(texts), len(self.known) + 1), np.float32)
        for row, text in zip(p, texts):
            row[self._place[ngrams(text)]] = 1
        p = p[:, :-1]
        return p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))

    def margins(self, texts: list[str]) -> np.ndarray:
        return np.concatenate([self.presence(texts[i:i + BATCH]) @ self.weights + self.bias
                               for i in range(0, len(texts), BATCH)])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        out, score = ["und"] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        if rows:
            p = softmax(self.margins([texts[i] for i in rows]) * self.sharpness)
            for i, best, v in zip(rows, p.argmax(axis=1), p.max(axis=1)):
                out[i], score[i] = self.languages[best], float(v)
        return out, score


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Train on the sample; a fifth of it sets how sharply margins turn into probabilities."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), 1.0)
    order = np.random.default_rng(SEED).permutation(len(texts))
    texts, y = [texts[i] for i in order], np.array([languages.index(langs[i]) for i in order])
    # Landmarks: each language in turn, so that all are covered.
    turn = np.zeros(len(y), int)
    for k in range(len(languages)):
        turn[y == k] = np.arange((y == k).sum())
    marks = np.argsort(turn, kind="stable")[:landmarks]
    known = np.unique(np.concatenate([ngrams(texts[i]) for i in marks]))
    model = Model(languages, known, np.zeros((len(known), len(languages)), np.float32), np.zeros(len(languages), np.float32), 1.0)
    low = model.presence([texts[i] for i in marks])
    values, vectors = np.linalg.eigh((low @ low.T).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    root = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
    kernel = np.concatenate([model.presence(texts[i:i + BATCH]) @ low.T for i in range(0, len(texts), BATCH)])
    features = kernel @ root
    part = np.arange(len(y)) % 5 != 0 if len(y) >= 50 else np.ones(len(y), bool)
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)

    def solve(rows):
        mean = target[rows].mean(axis=0)
        a = features[rows]
        beta = np.linalg.solve(a.T @ a + ridge * rows.sum() * np.eye(a.shape[1]), a.T @ (target[rows] - mean))
        return beta, mean

    beta, mean = solve(part)
    held = ~part if (~part).any() else part
    margins = features[held] @ beta + mean
    loss = lambda s: -np.log(softmax(margins * s)[np.arange(held.sum()), y[held]] + 1e-12).mean()
    model.sharpness = float(min((0.5 * 1.5**i for i in range(16)), key=loss))
    beta, mean = solve(np.ones(len(y), bool))
    model.weights, model.bias = (low.T @ (root @ beta)).astype(np.float32), mean.astype(np.float32)
    return model


def fold(doc_id, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts).cast("int")


def train(docs: DataFrame, may_learn) -> Model:
    """Fit on a bounded sample of the rows for which ``may_learn`` holds and lang is not null."""
    ids = docs.filter(may_learn & F.col("lang").isNotNull()).select("doc_id", "lang")
    # By (language, salt) first, so that the task of a language gets SALTS * PER_SALT rows at most.
    ids = ids.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)))
    for part, most in ((("lang", "salt"), PER_SALT), (("lang",), PER_LANG)):
        order = W.partitionBy(*part).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= most).drop("rn")
    ids = ids.select("doc_id", "lang").distinct().orderBy(F.xxhash64("doc_id", "lang"), "doc_id", "lang").limit(MOST_ROWS)
    # The smallest text of an id and language that repeat; whole rows, each cut to what is learned from.
    sample = (docs.filter(may_learn).select("doc_id", "lang", F.substring("text", 1, LONGEST).alias("text"))
              .join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    rows = sorted((r for r in sample if r.text and has_letter(r.text)), key=lambda r: (r.doc_id, r.lang, r.text))
    return fit([r.text for r in rows], [r.lang for r in rows])


def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            lang, score = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def identify(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score: trained on all rows but those of fold ``held``."""
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs, fold(F.col("doc_id"), parts) != held)
    out = predict_languages(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), parts) == held).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a language, all columns, with ``lang`` as predicted; rows that come out as ``und`` go."""
    model = train(docs, fold(F.col("doc_id"), 4) != 2)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("lang")
    schema = docs.schema

    def run(batches):
        for batch in batches:
            lang, _ = shared.value.predict(batch.column("text").to_pylist())
            keep = pa.array([x != "und" for x in lang])
            yield batch.set_column(at, "lang", pa.array(lang, batch.schema.field(at).type)).filter(keep)

    return docs.mapInArrow(run, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: doc_id, held_out, lang_pred, score."""
    return identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
