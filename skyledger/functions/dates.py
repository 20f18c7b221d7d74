"""Year predicates written as ranges, so that they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_year(date: Column, year: int) -> Column:
    """``date`` falls in ``year``; a range on the column, never ``year(date) = y``."""
    first = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    last = F.make_date(F.lit(year), F.lit(12), F.lit(31))
    return date.between(first, last)


def in_year_text(date: Column, year: int) -> Column:
    """The same test on ``YYYY-MM-DD`` text, compared as text."""
    return date.between(f"{year:04d}-01-01", f"{year:04d}-12-31")
