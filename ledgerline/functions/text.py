"""Text helpers: CSV null tokens, load normalisation, report number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schema import CSV_NULL_TOKENS


def null_tokens_to_null(c: Column, tokens: list[str] | None = None) -> Column:
    """Missing-value tokens (pandas' defaults) become NULL; Spark's CSV reader takes only one token."""
    toks = CSV_NULL_TOKENS if tokens is None else tokens
    return F.when(c.isin(*toks), F.lit(None).cast("string")).otherwise(c)


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def percent_text(ratio: Column) -> Column:
    """``0.8878`` -> ``88.78%`` (two decimals, as Python's ``:.2%``)."""
    return F.format_string("%.2f%%", ratio * F.lit(100.0))


def thousands_text(n: Column) -> Column:
    """``10500`` -> ``10,500`` (as Python's ``:,`` prints whole numbers)."""
    return F.format_number(n, 0)


def seconds_text(sec: Column) -> Column:
    """``3.106952`` -> ``3.11s``."""
    return F.format_string("%.2fs", sec)
