"""Declarative quality rules: name -> SQL predicate, compiled to Column expressions.

Routing is NULL-safe: a rule that evaluates to NULL counts as failed, so every
row lands on exactly one side. ``strict_split`` keeps the three-valued form
(``filter(p)`` / ``filter(NOT p)``) in which a NULL row is in neither side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The five trade quality rules and their names.
QUALITY_RULES: dict[str, str] = {
    "price_positive": "price > 0",
    "quantity_positive": "quantity > 0",
    "notional_positive": "notional > 0",
    "symbol_not_empty": "symbol IS NOT NULL AND symbol != ''",
    "trade_id_not_empty": "trade_id IS NOT NULL AND trade_id != ''",
}

# Optional extra rule (off by default): NaN compares greater than every number
# in Spark, so NaN prices pass "price > 0".
NAN_RULES: dict[str, str] = {
    "price_not_nan": "NOT isnan(price)",
}

FAILED_RULES = "failed_rules"


def combined_predicate(rules: dict[str, str] | None = None) -> str:
    rules = QUALITY_RULES if rules is None else rules
    return " AND ".join(f"({r})" for r in rules.values())


def rule_passes(rule: str) -> Column:
    """True only when the predicate is TRUE (NULL counts as a failure)."""
    return F.coalesce(F.expr(rule), F.lit(False))


def passes_all(rules: dict[str, str] | None = None) -> Column:
    """TRUE when every rule is TRUE; a plain predicate (whole-stage codegen)."""
    rules = QUALITY_RULES if rules is None else rules
    out = None
    for r in rules.values():
        out = rule_passes(r) if out is None else out & rule_passes(r)
    return out if out is not None else F.lit(True)


def failed_rules_column(rules: dict[str, str] | None = None) -> Column:
    """array<string> of the names of the rules a row fails (empty when clean).

    Built from concat_ws (which skips NULLs) and split rather than a lambda
    filter, so the expression stays inside generated code.
    """
    rules = QUALITY_RULES if rules is None else rules
    joined = F.concat_ws("\u0001", *[F.when(~rule_passes(r), F.lit(n)) for n, r in rules.items()])
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, "\u0001"))


def with_failed_rules(df: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    return df.withColumn(FAILED_RULES, failed_rules_column(rules))


def strict_split(df: DataFrame, rules: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The as-written three-valued split: rows where the predicate is NULL vanish."""
    p = combined_predicate(rules)
    return df.filter(p), df.filter(f"NOT ({p})")
