"""Labels as people type them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(label: Column) -> Column:
    """Upper case, no padding, words joined by one underscore."""
    return F.upper(F.regexp_replace(F.regexp_replace(label, r"(?U)^[\s_\-]+|[\s_\-]+$", ""), r"(?U)[\s_\-]+", "_"))
