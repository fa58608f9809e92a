from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def safe_cast(name: str, source: T.DataType, target: str) -> Column:
    """Cast that yields null for unreadable input instead of failing under ANSI rules.

    Text is read as a whole number, else through double, so '5.0' is 5 and long numbers keep their digits. Either kind of timestamp already
    satisfies the target `timestamp`.
    """
    column = F.col(f"`{name}`")
    if source.simpleString() == target:
        return column
    if target == "timestamp" and isinstance(source, T.TimestampNTZType):
        return column
    if target in _WHOLE and isinstance(source, T.StringType):
        return F.coalesce(column.try_cast(target), column.try_cast("double").try_cast(target)).alias(name)
    return column.try_cast(target).alias(name)
