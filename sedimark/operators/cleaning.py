"""The whole cleaning sequence of a profile, and the accounting of what it removes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.functions import normalized, safe_cast, tidy_names
from sedimark.operators.dedup import keep_first, settle_ties
from sedimark.operators.filling import fill_defaults, fill_from_column
from sedimark.operators.validity import all_in_range, all_present, require, within
from sedimark.profile import RecordProfile

Dedup = Callable[[DataFrame, str, Sequence[str]], DataFrame]
Watch = Callable[[str, DataFrame], DataFrame]


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Store each listed column in its type, in one projection; unreadable values become null."""
    return df.select(
        *[
            safe_cast(f.name, f.dataType, types[f.name]) if f.name in types else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def normalize_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: normalized(c) for c in columns})


def _leading_order(profile: RecordProfile) -> tuple[str, ...]:
    # Range-checked columns come right after a tie-break that is not total, so that the quality report
    # can tell the survivor's fate from a few columns.
    if profile.tie_break_is_total:
        return profile.tie_break
    return (*profile.tie_break, *[c for c in profile.ranges if c not in profile.tie_break])


def ranked_rows(
    df: DataFrame, profile: RecordProfile, watch: Watch = lambda _, rows: rows
) -> tuple[DataFrame, RecordProfile, Sequence[str]]:
    """The rows that compete for their key, filled; the rules that hold for them; the order that decides."""
    named = tidy_names(df)
    rules = profile.bound_to(named.columns)
    present = watch("required_rows", require(named, rules.required))
    filled = fill_defaults(fill_from_column(present, rules.fallbacks), rules.defaults)
    order = _leading_order(rules)
    return filled, rules, order if rules.tie_break_is_total else settle_ties(filled, rules.key, order)


def clean(
    df: DataFrame, profile: RecordProfile, dedup: Dedup = keep_first, strict: bool = False, watch: Watch = lambda _, rows: rows
) -> DataFrame:
    """Rename, require, fill, deduplicate, normalise, cast, check ranges; in this order.

    Casts come before the range checks, so text that is no number costs its own row only.

    Deduplication precedes the range checks: a bad row that is first of its key removes its good
    copies. `strict` makes a rule for a column the frame lacks an error. `watch` is given the rows after each step, under
    the name that the quality report has for their number, and returns what goes on.
    """
    if strict:
        wanted = {*profile.defaults, *profile.fallbacks, *profile.uppercase}
        absent = sorted(wanted - set(tidy_names(df).columns))
        if absent:
            raise ValueError(f"profile columns are missing: {absent}")
    filled, rules, order = ranked_rows(df, profile, watch)
    single = watch("distinct_rows", dedup(filled, rules.key, order))
    typed = cast_columns(normalize_columns(single, rules.uppercase), dict(rules.types))
    return within(typed, rules.ranges)


def quality_report(df: DataFrame, profile: RecordProfile) -> DataFrame:
    """One row: how many rows entered, passed each step of `clean`, and were removed.

    Reads only the key, required, tie-break and range columns, once for the counts and once for the survivors,
    which are ranked as in `keep_first`: every task sends one row per key.
    """
    named = tidy_names(df)
    rules = profile.bound_to(named.columns)
    judged = named.withColumn("__usable", all_present(rules.required))
    filled = fill_defaults(fill_from_column(judged, rules.fallbacks), rules.defaults)
    verdict = F.coalesce(all_in_range(rules.ranges), F.lit(False))
    order = _leading_order(rules)
    # The order as it is in the data, as `clean` has it; the verdict on typed values.
    judged = filled.select("__usable", rules.key, *[F.col(c).alias(f"__by_{i}") for i, c in enumerate(order)], *rules.ranges)
    judged = cast_columns(judged, {c: t for c, t in rules.types.items() if c in rules.ranges and c != rules.key})
    judged = judged.withColumn("__valid", verdict)
    kept = keep_first(judged.where("__usable").select(rules.key, *[f"__by_{i}" for i in range(len(order))], "__valid"),
                      rules.key, [*[f"__by_{i}" for i in range(len(order))], "__valid"])
    none = F.lit(0).cast("bigint")
    counts = judged.agg(F.count(F.lit(1)).alias("i"), F.count_if("__usable").alias("r"), none.alias("d"), none.alias("f"))
    counts = counts.unionAll(kept.agg(none, none, F.count(F.lit(1)), F.count_if("__valid")))
    totals = counts.agg(
        F.sum("i").alias("initial_rows"), F.sum("r").alias("required_rows"),
        F.sum("d").alias("distinct_rows"), F.sum("f").alias("final_rows"),
    )
    removed = F.col("initial_rows") - F.col("final_rows")
    return totals.select(
        "*",
        (F.col("required_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        removed.alias("removed_rows"),
        F.coalesce(F.try_divide(removed * 100.0, F.col("initial_rows")), F.lit(0.0)).alias("removed_percent"),
    )
