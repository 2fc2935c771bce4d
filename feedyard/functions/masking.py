"""Column masking."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedyard.functions.text import col_q

# Masking methods by what they leave behind.
METHODS = ("hash", "redact", "partial", "null")


def mask_value(c: Column, method: str) -> Column:
    """``hash`` keeps equality, ``partial`` the last four characters, ``redact`` only that a value was there."""
    if method == "hash":
        return F.sha2(c.cast("string"), 256)
    if method == "redact":
        return F.when(c.isNotNull(), F.lit("***"))
    if method == "partial":
        text = c.cast("string")
        hidden = F.greatest(F.length(text) - 4, F.lit(0))
        return F.concat(F.repeat(F.lit("*"), hidden), F.right(text, F.lit(4)))
    if method == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown masking method {method!r}; one of {METHODS}")


def mask_columns(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Mask the named columns; a rule for an absent column is an error."""
    absent = [c for c in rules if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns to mask: {absent}")
    return df.select([mask_value(col_q(c), rules[c]).alias(c) if c in rules else col_q(c) for c in df.columns])


def mask_patterns(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """Replace every match of each pattern within a text column by its label."""
    out = col_q(column)
    for label, pattern in patterns.items():
        out = F.regexp_replace(out, pattern, f"[{label}]")
    return df.withColumn(column, out)
