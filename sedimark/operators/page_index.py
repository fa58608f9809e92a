"""An index for pages of a written table: a far page is a look-up and a read of one or two ranges.

The index is a table of its own, written once per version of the indexed one: all columns in page order, sorted in parts
by a sampled sort and cut into ranges by the number of the row, each range a folder. A record beside it holds the number of rows before each
range. A page is found by a search in these numbers; only its ranges are read.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.operators.dedup import settle_ties
from sedimark.operators.paging import check_page
from sedimark.operators.summaries import ordering
from sedimark.session import intermediates, path_exists, read_text, write_text
from sedimark.sources.sinks import materialized

RANGE_ROWS = 200_000
_RANGE, _RECORD = "__range", "_pages.json"


def total_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """`order`, then all other sortable columns, as `page_of` has it."""
    named = [term.partition(" ")[0] for term in order]
    return [*order, *settle_ties(df.drop(*named), "")]


@dataclass(frozen=True)
class PageIndex:
    """The pages of one version of a table in one order. `starts` has the rows before each range, then all rows."""

    spark: SparkSession
    path: str
    order: tuple[str, ...]
    columns: tuple[str, ...]
    starts: tuple[int, ...]
    schema: T.StructType

    @property
    def rows(self) -> int:
        return self.starts[-1]

    def ranges_of(self, start: int, size: int) -> list[int]:
        """The ranges that hold the rows from `start` on."""
        end = min(start + size, self.rows)
        if start >= end:
            return []
        met = range(bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1))
        return [r for r in met if self.starts[r + 1] > self.starts[r]]

    def page(self, page: int, size: int, max_size: int | None = None) -> DataFrame:
        """Rows of one page in order; empty past the end. Lazy, and reads the page's ranges only."""
        check_page(page, size, max_size)
        start = (page - 1) * size
        touched = self.ranges_of(start, size)
        if not touched:
            return self.spark.createDataFrame([], self.schema).select(*self.columns)
        # The partition column is given by the folders.
        kept = T.StructType([*self.schema.fields, T.StructField(_RANGE, T.IntegerType())])
        folders = [f"{self.path}/{_RANGE}={r}" for r in touched]
        rows = self.spark.read.schema(kept).option("basePath", self.path).parquet(*folders)
        # One or two ranges: the page's first row is `start - starts[first]` rows into them.
        found = rows.orderBy(_RANGE, *ordering(self.order)).offset(start - self.starts[touched[0]]).limit(size)
        return found.select(*self.columns)

    def totals(self, page: int, size: int) -> DataFrame:
        """One row: page, size, total_pages, total_items; nothing is counted again."""
        check_page(page, size)
        pages = -(-self.rows // size)
        return self.spark.createDataFrame([(page, size, pages, self.rows)], "page int, size int, total_pages bigint, total_items bigint")


def open_index(spark: SparkSession, path: str, version: str, order: Sequence[str]) -> PageIndex | None:
    """The index at `path`, if it was completed for this version and order."""
    record = f"{path}/{_RECORD}"
    if not path_exists(spark, record):
        return None
    said = json.loads(read_text(spark, record))
    if (said["version"], said["asked"]) != (version, list(order)):
        return None
    schema = T.StructType.fromJson(said["schema"])
    return PageIndex(spark, path, tuple(said["order"]), tuple(schema.names), tuple(said["starts"]), schema)


def build_index(df: DataFrame, path: str, version: str, order: Sequence[str], range_rows: int = RANGE_ROWS) -> PageIndex:
    """Write the index of a table; an older one at `path` is replaced. Runs jobs.

    Ranges have `range_rows` rows, the last one fewer; rows that are equal in all of `order` may lie in several. The
    rows are sorted by as many tasks as a shuffle has, however many ranges there are: the driver gets a sample for
    that many parts, and a number per part.
    """
    spark = df.sparkSession
    total = total_order(df, order)
    terms = ordering(total)
    # A number of the row spreads rows that are equal in every column.
    dealt = df.withColumn("__spread", F.monotonically_increasing_id()).repartitionByRange(*terms, "__spread")
    placed = dealt.sortWithinPartitions(*terms, "__spread").withColumn("__spread", F.monotonically_increasing_id())
    # The new number has the part above, the row's place in it below.
    part, place = F.shiftright("__spread", 33), F.col("__spread").bitwiseAND((1 << 33) - 1)
    with intermediates(spark):
        parts, rows = materialized(placed, "page-order")
        sizes = sorted(parts.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        before = accumulate((r["n"] for r in sizes), initial=0)
        firsts = spark.createDataFrame([(r["part"], b) for r, b in zip(sizes, before, strict=False)], "__part bigint, __first bigint")
        numbered = parts.join(F.broadcast(firsts), part == F.col("__part"))
        cut = numbered.withColumn(_RANGE, F.floor((F.col("__first") + place) / range_rows).cast("int"))
        cut.select(*df.columns, _RANGE).write.mode("overwrite").partitionBy(_RANGE).parquet(path)
    starts = [min(r * range_rows, rows) for r in range(max(-(-rows // range_rows), 1) + 1)]
    said = {"version": version, "asked": list(order), "order": total, "starts": starts, "schema": df.schema.jsonValue()}
    write_text(spark, f"{path}/{_RECORD}", json.dumps(said))
    return PageIndex(spark, path, tuple(total), tuple(df.columns), tuple(starts), df.schema)


def indexed(df: DataFrame, path: str, version: str, order: Sequence[str], range_rows: int = RANGE_ROWS) -> PageIndex:
    """The index for this version of a table, built where it is not there yet."""
    return open_index(df.sparkSession, path, version, order) or build_index(df, path, version, order, range_rows)


def version_of(table: DataFrame) -> str:
    """A name for the written state that a frame reads: a digest of its files' names, which every write makes anew."""
    return hashlib.md5("\n".join(sorted(table.inputFiles())).encode()).hexdigest()
