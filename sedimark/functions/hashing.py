"""Hash-derived decisions that do not depend on partition layout, row order or engine version.

Rows are placed by the MD5 text of a purpose, a seed and their key. The purpose keeps decisions
independent: with one hash for all, a sample of the smallest hashes would lie in one part of any split.
Hex digests compare as text in the order of the numbers they stand for, so "the first 33 %" is a plain
string comparison with a constant, and any SQL engine can reproduce the choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 12


def portable_hash(keys: Sequence[str], seed: int, purpose: str) -> Column:
    """32 hex digits, a function of purpose, seed and key values only."""
    return F.md5(F.concat_ws("|", F.lit(f"{purpose}-{seed}"), *[F.col(f"`{k}`").cast("string") for k in keys]))


def hex_bound(fraction: float) -> str:
    """The digest prefix below which `fraction` of all digests lie (0 <= fraction < 1)."""
    return format(int(fraction * 16**_DIGITS), f"0{_DIGITS}x")


def below_fraction(digest: Column, fraction: float) -> Column:
    """True for about `fraction` of the digests, always the smallest ones."""
    if fraction <= 0:
        return F.lit(False)
    if fraction >= 1:
        return F.lit(True)
    return digest < hex_bound(fraction)


def weighted_label(keys: Sequence[str], weights: Mapping[str, float], seed: int, purpose: str) -> Column:
    """One of the labels per row, drawn with the given weights; each row gets exactly one."""
    return label_of(portable_hash(keys, seed, purpose), [(F.lit(name), share) for name, share in weights.items()])


def label_of(digest: Column, shares: Sequence[tuple[Column, float]]) -> Column:
    """The label whose share of the digests, laid out in the given order, holds this one."""
    if not shares or any(share <= 0 for _, share in shares):
        raise ValueError("weights must be positive")
    total = sum(share for _, share in shares)
    reached, ladder = 0.0, None
    for label, share in shares[:-1]:
        reached += share / total
        branch = below_fraction(digest, reached)
        ladder = F.when(branch, label) if ladder is None else ladder.when(branch, label)
    last = shares[-1][0]
    return last if ladder is None else ladder.otherwise(last)
