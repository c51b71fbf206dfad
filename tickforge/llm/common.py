"""Helpers that the operators of this subpackage share: table access, staged tables and joins on counted keys."""

from __future__ import annotations

from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import remove_path, work_dir

#: Fewer than this many keys can each hold more than 1/HOT_KEYS of the rows, which bounds what ``join_counted`` broadcasts.
HOT_KEYS = 1024

#: Java/RE2/Python regular expressions for a white-space run and for a word: the six ASCII white-space characters.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named parquet table under ``sf_dir``, narrowed to ``columns`` where given."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


#: The columns of ``documents``; any others ride along in one struct column while an operator works.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(operator):
    """An operator (docs, ...) -> rows with all columns of docs, whose own column names clash with none that docs bring along."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **kw) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT_COLUMNS]
        if not others:
            return operator(docs, *args, **kw)
        own = [c for c in docs.columns if c in DOCUMENT_COLUMNS]
        packed = docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in others]).alias("carried"))
        out = operator(packed, *args, **kw)
        return out.select(*[F.col(c) if c in own else F.col("carried").getField(c).alias(c) for c in docs.columns])

    return run


_STAGED: list[str] = []


@contextmanager
def scratch(spark: SparkSession):
    """Delete, on leaving, the tables that were staged inside: for work whose result is written by then."""
    begin = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[begin:]:
            remove_path(spark, path)
        del _STAGED[begin:]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's shared checkpoint folder and read back.

    Cuts the lineage: later jobs and retried tasks read the files, which survive the loss of any executor. The files
    stay until ``scratch`` or the owner of the folder removes them, as results are read from them lazily.
    """
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join on ``key`` where ``right`` has one row per key and a column ``n``, the number of ``left`` rows with it.

    Keys that hold more than 1/1024 of the ``rows`` are fewer than 1024, so their rows of ``right`` are broadcast; the
    rest shuffle, and no task gets more than 1/1024 of ``left`` for one key. Null keys match nothing.
    """
    limit = rows // HOT_KEYS + 1
    hot = F.broadcast(right.filter(F.col("n") > limit))
    cold = right.filter(F.col("n") <= limit)
    return left.join(hot, key).unionByName(
        left.join(F.broadcast(right.filter(F.col("n") > limit).select(key)), key, "left_anti").join(cold, key))
