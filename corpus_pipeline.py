"""A corpus made ready for training: language ID, exact dedup, near-duplicate removal, source mixing, tokenization.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir), where docs is what its predecessor kept, and
returns a DataFrame; all but the last return the columns of ``documents``. ``run`` applies them to ``documents``, each
written as Parquet in the session's shared checkpoint folder and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import bpe, exact_dedup, jaccard_join, langid, mixing
from tickforge.llm.common import scratch, table
from tickforge.session import remove_path, work_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language, with lang as identified; documents without a letter go."""
    return langid.with_language(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word n-grams, Jaccard 0.8 or more), with the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources: documents once, twice, cut at a source's quota, or left out beyond it."""
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them, a row per document of the mixture."""
    return bpe.round_trip(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

#: SQL can express neither the learned language model nor the tokenizer; tests/llm compares the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stages for itself goes once its result is written, and so does a result
    once the next one is; the last result stays in the shared folder, where the returned frame reads it."""
    docs, last = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = work_dir(spark, f"llm-stage{number}")
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if last:
            remove_path(spark, last)
        docs, last = spark.read.schema(out.schema).parquet(path), path
    return docs
