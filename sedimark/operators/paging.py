"""Pages of an ordered result, with the totals of the whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimark.operators.dedup import settle_ties
from sedimark.operators.summaries import ordering
from sedimark.session import intermediates
from sedimark.sources.sinks import materialized

# Pages that end within this many rows are cut with a top-k; later ones by counting sorted ranges.
TOP_ROWS = 100_000


def check_page(page: int, size: int, max_size: int | None = None) -> None:
    if page < 1:
        raise ValueError("page numbers start at 1")
    if size < 1 or (max_size is not None and size > max_size):
        raise ValueError(f"page size must be between 1 and {max_size or 'any'}")


def page_of(
    df: DataFrame, order: Sequence[str], page: int, size: int, max_size: int | None = None, top_rows: int = TOP_ROWS
) -> DataFrame:
    """Rows of one page; empty past the end.

    All other sortable columns settle ties of `order`, near the start and far from it alike, so the pages
    together hold every row once. A page deep in a large result (beyond `top_rows`) runs jobs: see `_far_page`.
    """
    check_page(page, size, max_size)
    start = (page - 1) * size
    named = [term.partition(" ")[0] for term in order]
    total = [*order, *settle_ties(df.drop(*named), "")]
    if start + size <= top_rows:
        return df.orderBy(*ordering(total)).offset(start).limit(size)
    with intermediates(df.sparkSession):
        found = _far_page(df, total, start, size).collect()  # one page
    return df.sparkSession.createDataFrame(found, df.schema)


def _far_page(df: DataFrame, order: Sequence[str], start: int, size: int) -> DataFrame:
    """Page cut without gathering the rows before it.

    The rows are range-partitioned in page order and written once; the row count per range (one small
    row each) tells which ranges the page touches, and only those are numbered, each in its own task.
    """
    terms = ordering(order)
    # Equal order values would all fall into one range; a row number as last term spreads them.
    spread = F.monotonically_increasing_id()
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.withColumn("__spread", spread)
        .repartitionByRange(ranges, *terms, "__spread")
        .withColumn("__range", F.spark_partition_id())
    )
    placed, _ = materialized(ranged, "far-page")
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range").collect()
    touched, before = {}, 0
    for row in sizes:
        if before < start + size and before + row["n"] > start:
            touched[row["__range"]] = before
        before += row["n"]
    if not touched:
        return df.limit(0)
    base = F.element_at(F.create_map(*[F.lit(v) for pair in touched.items() for v in pair]), F.col("__range"))
    within_range = Window.partitionBy("__range").orderBy(*terms, "__spread")
    position = F.row_number().over(within_range) + base
    return (
        placed.where(F.col("__range").isin(*touched))
        .withColumn("__position", position)
        .where((F.col("__position") > start) & (F.col("__position") <= start + size))
        .orderBy("__position")
        .select(*df.columns)
    )


def page_totals(df: DataFrame, page: int, size: int) -> DataFrame:
    """One row: page, size, total_pages, total_items of the un-paged frame."""
    check_page(page, size)
    items = F.count(F.lit(1))
    return df.agg(
        F.lit(page).alias("page"),
        F.lit(size).alias("size"),
        F.ceil(items / F.lit(size)).cast("bigint").alias("total_pages"),
        items.alias("total_items"),
    )
