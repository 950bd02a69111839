"""Sizing of written tables.

Join strategies are left to adaptive execution, which broadcasts a side only
from its measured size in bytes.  File counts follow the data as well:
:func:`rebalanced` lets adaptive execution cut or merge the partitions in front
of a write to the advisory size, so a small dimension becomes one file and a
hot month many, without a row-count switch and without a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Partitions of the advisory size, rows of equal ``columns`` together where that fits."""
    return df.hint("rebalance", *columns)
