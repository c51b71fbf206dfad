"""Fixtures for the operators' tests: small tables with nulls, ties, repeated rows and clashing extra columns."""

import random

#: Names that operators use inside; tables that bring them along must not disturb anything.
CLASHING = ("n", "digest", "size", "label", "key", "node", "shard", "rank", "pack", "sid", "words", "link", "bucket", "score",
            "_row", "_before", "_size", "_all", "_words", "_id", "_digest", "_n", "_key", "carried", "rid", "least")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def documents(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    full = [(i, t, g, s, None if t is None else len(t), *CLASHING) for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def prose(rng: random.Random, words: int, vocabulary=None) -> str:
    vocabulary = vocabulary or [a + b for a in "ba ce di fo gu la me ni so tu".split() for b in "ran tel min dor sus ven".split()]
    return " ".join(rng.choice(vocabulary) for _ in range(words))
