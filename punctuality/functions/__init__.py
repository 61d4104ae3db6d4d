"""Column expressions shared by the operators. All are built-in Spark functions."""

from punctuality.functions.dates import month_name, month_of, year_of
from punctuality.functions.hashing import row_bucket
from punctuality.functions.missing import as_numbers, nan_to_null, present
from punctuality.functions.text import whole_number

__all__ = [
    "as_numbers", "month_name", "month_of", "nan_to_null", "present", "row_bucket", "whole_number",
    "year_of",
]
