"""Exact-size samples and train/test splits that do not depend on partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sedimark.functions import below_fraction, portable_hash
from sedimark.operators.snapshots import split_by_weight
from sedimark.sources.sinks import materialized


def bounded_sample(df: DataFrame, rows: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """The `rows` rows with the smallest key hashes, or all rows if there are fewer. Runs jobs.

    After a count, a hash bound slightly above the wanted share is applied in every task, so that only
    about `rows` rows are written and meet for the exact cut. If the bound let too few through it is
    widened, so the result is exact. `keys` must identify rows.
    """
    if rows < 1:
        raise ValueError("a sample needs at least one row")
    total = df.count()
    if total <= rows:
        return df
    digest = portable_hash(keys, seed, "sample")
    share = (rows + 6 * rows**0.5 + 10) / total
    near, found = materialized(df.where(below_fraction(digest, share)), "sample", even=True)
    while found < rows:
        share *= 2
        near, found = materialized(df.where(below_fraction(digest, share)), "sample", even=True)
    return near.orderBy(digest, *keys).limit(rows)


def train_test(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    train, test = split_by_weight(df, [train_share, 1 - train_share], keys, seed, "split")
    return train, test
