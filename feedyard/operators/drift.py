"""Schema drift and additive evolution."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedyard import schemas
from feedyard.functions.text import yn

# Drift reasons.
REASON_NO_HEADER = "header disabled; schema comparison skipped"
REASON_MATCH = "source columns match target schema"


def missing_from(these: Column, those: Column) -> Column:
    """Entries of ``these`` not among ``those``: order and repeats kept, case matters."""
    return F.filter(these, lambda x: ~F.array_contains(those, x))


def detect_drift(rows: DataFrame, source: str = "source_columns", target: str = "target_columns", has_header: bool = True) -> DataFrame:
    """Add the differences both ways, whether there are any, and their text."""
    gone = missing_from(F.col(target), F.col(source))
    new = missing_from(F.col(source), F.col(target))
    out = rows.withColumns({"missing_in_file": gone, "new_in_file": new})
    parts = F.concat_ws(
        "; ", F.when(F.size("missing_in_file") > 0, F.concat(F.lit("missing_in_file="), F.array_join("missing_in_file", ","))),
        F.when(F.size("new_in_file") > 0, F.concat(F.lit("new_in_file="), F.array_join("new_in_file", ","))))
    if not has_header:
        return out.withColumns({"change_detected": F.lit("N"), "status_reason": F.lit(REASON_NO_HEADER)})
    differs = (F.size("missing_in_file") > 0) | (F.size("new_in_file") > 0)
    return out.withColumns({"change_detected": yn(differs), "status_reason": F.when(differs, parts).otherwise(REASON_MATCH)})


def business_columns(df: DataFrame) -> list[str]:
    technical = set(schemas.names(schemas.BRONZE_TECHNICAL))
    return [c for c in df.columns if c not in technical]


def missing_columns(existing: list[str], expected: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Expected columns a table lacks, names compared without case, blank names ignored."""
    have = {c.lower() for c in existing}
    out = []
    for name, kind in expected:
        if name and name.strip() and name.lower() not in have:
            have.add(name.lower())
            out.append((name, kind))
    return out


def evolve(df: DataFrame, expected: list[tuple[str, str]]) -> DataFrame:
    """Add what is missing as NULL; existing columns stay as they are."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in missing_columns(df.columns, expected)})


def evolve_business(df: DataFrame, columns: list[str]) -> DataFrame:
    return evolve(df, [(c, "string") for c in columns])


def united(columns: list[str], more: list[str]) -> list[str]:
    """Columns in order with those of ``more`` that differ by more than case."""
    return columns + [n for n, _ in missing_columns(columns, [(c, "string") for c in more])]


def initial_columns(policy: str, seed: list[str] | None) -> list[str]:
    """Business columns a bronze table starts with.

    ``FIRST_FILE`` none; ``SEED`` those of the seed, which must exist; ``AUTO`` those of the seed if any.
    """
    if policy == "SEED" and seed is None:
        raise FileNotFoundError("schema_read_policy SEED needs a schema seed file")
    return list(seed or []) if policy in ("SEED", "AUTO") else []
