"""Hand-off form of a result frame: plain scalar types with fixed text formats.

Decimals become doubles (after the plan's own rounding), integers bigint, dates 'yyyy-MM-dd'
text and timestamps 'yyyy-MM-dd HH:mm:ss.SSSSSS' text (UTC). Nested columns
are left as they are. This keeps results comparable across engines and
clients without changing any value the plan computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.expressions import TS_TEXT


def portable(df: DataFrame) -> DataFrame:
    """One projection, written as SQL expressions (parsed on the JVM side)."""
    exprs = []
    for f in df.schema.fields:
        c, t = f"`{f.name}`", f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            e = f"CAST({c} AS DOUBLE)"
        elif isinstance(t, T.DateType):
            e = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            e = f"date_format({c}, '{TS_TEXT}')"
        elif isinstance(t, (T.ShortType, T.ByteType, T.IntegerType)):
            e = f"CAST({c} AS BIGINT)"
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    return df.selectExpr(*exprs)
