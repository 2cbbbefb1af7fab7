"""Text functions that stay in the JVM; all other cleaning is in `linker.words`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULLS = ("", "NAN", "NONE")


def compact(c: Column) -> Column:
    """Upper case, letters and digits only."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.upper(c), F.lit("[A-Z0-9]+"), F.lit(0))


def null_if_missing(c: Column, default: str | None = None) -> Column:
    held = F.trim(c.cast("string"))
    return F.when(held.isNull() | F.upper(held).isin(*NULLS), F.lit(default)).otherwise(held)
