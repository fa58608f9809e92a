from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(column: str | Column) -> Column:
    """Upper-case text without surrounding spaces (other white space is kept)."""
    return F.upper(F.trim(column))
