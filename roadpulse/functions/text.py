"""Text expressions. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(_BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_text(*cols: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def slugify(c: Column, *, unicode: bool = False, default: str = "unknown") -> Column:
    """Lower-case words joined by dashes. ASCII letters and digits, or any alphabet."""
    pattern = r"[^\p{L}\p{N}]+" if unicode else "[^a-z0-9]+"
    slug = F.trim(F.regexp_replace(F.lower(c), pattern, "-"), F.lit("-"))
    return F.coalesce(blank_to_null(slug), F.lit(default))


# What a CSV round trip makes of nulls; "nan" in any case.
NULL_TEXTS = ("", "None", "nan", "Nan", "nAn", "naN", "NAn", "NaN", "nAN", "NAN")


def known_text(c: Column) -> Column:
    """Trimmed text; blanks and the literals that stand for nulls become null."""
    text = strip(c)
    return F.when(~text.isin(*NULL_TEXTS), text)
