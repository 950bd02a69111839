"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date text format of every raw table.
DATE_FORMAT = "yyyy-MM-dd"


def parse_date(col: Column, fmt: str = DATE_FORMAT) -> Column:
    """Parse text to DATE; unparseable text (``bad-date``, ``2024-02-30``,
    ``2024-1-5``) becomes NULL instead of failing under ANSI mode."""
    return F.try_to_date(col.cast("string"), fmt)
