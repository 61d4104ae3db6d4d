"""Dates that arrive as text. A value that is no date yields NULL, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(date: str) -> Column:
    """Month (1-12) of a date, timestamp or ISO date text."""
    return F.month(F.col(date).try_cast("date"))


def year_of(date: str) -> Column:
    """Year of a date, timestamp or ISO date text."""
    return F.year(F.col(date).try_cast("date"))


def month_name(month: str) -> Column:
    """Three-letter English name of a month number; NULL for NULL."""
    return F.date_format(F.make_date(F.lit(2000), F.col(month), F.lit(1)), "MMM")
