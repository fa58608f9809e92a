"""Keep one row per key, deterministically."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"
_HASH = "__key_hash"


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return isinstance(kind, T.AtomicType)


def settle_ties(df: DataFrame, key: str, first: Sequence[str] = ()) -> list[str]:
    """`first`, then every other sortable column: rows that still tie are equal in all of them."""
    rest = [f.name for f in df.schema.fields if f.name not in (key, *first) and _sortable(f.dataType)]
    return [*first, *rest]


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key (one column or several) that is first in the ascending order of `order` (nulls first).

    Spark reduces every key to one row inside each map task (the rank filter is pushed below the
    exchange as a partial group limit), so a key that holds a third of the input reaches its reducer
    as one row per map task.
    """
    terms: list[Column] = [F.col(c).asc_nulls_first() for c in order]
    ranked = Window.partitionBy(key).orderBy(*terms)
    return df.withColumn(_RANK, F.row_number().over(ranked)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_first_sparse(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Same rows as `keep_first`, for wide input in which few keys repeat: an explicit choice of the caller.

    A pass over the key column alone finds the hashes that occur more than once. Rows of all other keys are
    unique and are not ranked; only rows with a repeated hash are. A hash collision merely sends a unique row
    through the ranking. Whether the repeated hashes are broadcast is left to Spark, which knows their size
    when it joins.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(key))
    repeated = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_HASH)
    unique = hashed.join(repeated, _HASH, "left_anti").drop(_HASH)
    copies = hashed.join(repeated, _HASH, "left_semi").drop(_HASH)
    return unique.unionByName(keep_first(copies, key, order))
