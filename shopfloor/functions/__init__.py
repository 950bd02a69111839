"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from shopfloor.functions.numeric import (  # noqa: F401
    avg_exact,
    clamp_negative,
    nan_to_null,
    round2,
    sum_exact,
)
from shopfloor.functions.dates import parse_date  # noqa: F401
