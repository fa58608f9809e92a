"""Rule-based column renaming."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

_NOT_WORD = re.compile(r"[^0-9A-Za-z]+")


def tidy_name(raw: str) -> str:
    """Lower-case name in which each run of other characters became one `_`, none of them trailing."""
    return _NOT_WORD.sub("_", raw).rstrip("_").lower()


def tidy_names(df: DataFrame) -> DataFrame:
    """Rename every column by `tidy_name`; two columns that would share a name are an error."""
    names = [tidy_name(c) for c in df.columns]
    clashes = sorted(n for n, uses in Counter(names).items() if uses > 1)
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)
