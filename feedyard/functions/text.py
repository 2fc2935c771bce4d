"""Small text helpers shared by all other expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the characters a strip removes from both ends.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def or_default(c: Column, default: str) -> Column:
    """Stripped text, or ``default`` when NULL or blank."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def yes(c: Column, default: str = "Y") -> Column:
    """Whether a Y/N flag is on; NULL takes the default."""
    return F.upper(strip(F.coalesce(c, F.lit(default)))) == "Y"


def yn(c: Column) -> Column:
    return F.when(c, "Y").otherwise("N")


def quote_name(name: str) -> str:
    return "`" + str(name).replace("`", "``") + "`"


def quote_literal(value: str) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def col_q(name: str) -> Column:
    """Column by its exact name, whatever dots, blanks or backticks it holds."""
    return F.col(quote_name(name))


def parse_utc(c: Column) -> Column:
    """ISO text to a timestamp; text without an offset is UTC, bad or blank text is NULL.

    The session time zone must be UTC, as everywhere in this package.
    """
    text = strip(c)
    iso = text.rlike(
        r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    )
    return F.when(iso, F.try_to_timestamp(text))
