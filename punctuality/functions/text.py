"""Numbers as report text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(number: Column) -> Column:
    """Truncate toward zero and group thousands: 1234567.9 -> '1,234,567'."""
    return F.format_number(number.try_cast("bigint"), 0)
