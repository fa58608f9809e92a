"""CSV whose values contain line breaks, read by as many tasks as the files have splits.

Whether a line break ends a record depends on the number of quotes before it, in the whole file. Three passes over the
lines settle that: the first counts the quotes of every split, whose running parity per file tells which splits begin
inside a value. With that, each task cuts its own split: the second pass yields the pieces of records that cross
splits, which are put together, the third the records that lie within one. Records are then parsed as single values.

Quotes have to be balanced in every record, as writers leave them; an escaped quote inside a value does not count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.sources.files import CORRUPT
from sedimark.sources.sinks import materialized

# What a piece is: a record of one split; the end of one that began before; lines inside one; the begin of one.
_WHOLE, _END, _INSIDE, _BEGIN = range(4)
_CUT = "piece int, first boolean, file string, block bigint, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value, quotes) of every line, in the order of the file within a split."""
    # A carriage return stays in the line: it may belong to a value.
    lines = spark.read.option("lineSep", "\n").text(path)
    plain = F.regexp_replace("value", r"\\.", "")
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _open_splits(lines: DataFrame) -> DataFrame:
    """(file, block, open): whether the split begins inside a value. A row per split."""
    odd = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open"))


class _Split:
    """The state of a split that is being cut: the open piece's lines, and whether it began in an earlier split."""

    def __init__(self, file: str, block: int, open_: int) -> None:
        self.file, self.block, self.parity = file, block, open_
        self.held: list[str] = []
        self.before, self.first = bool(open_), block == 0
        self.rows: list[tuple] = []

    def _emit(self, piece: int, text: str) -> None:
        crossing = piece != _WHOLE
        self.rows.append((piece, self.first and piece != _INSIDE, self.file if crossing else None, self.block if crossing else None, text))
        self.first = False

    def add(self, values: pa.Array, quotes: np.ndarray) -> list[pa.RecordBatch]:
        after = (self.parity + np.cumsum(quotes)) % 2
        ends = np.flatnonzero(after == 0)
        starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64) if len(ends) else ends
        batches = []
        if len(ends):
            # The first record may have lines from before this batch, others of several lines are joined one by one.
            single = starts == ends
            single[0] &= not (self.held or self.before or self.first)
            for a, b in zip(starts[~single].tolist(), ends[~single].tolist(), strict=True):
                self.held += values.slice(a, b - a + 1).to_pylist()
                self._emit(_END if self.before else _WHOLE, "\n".join(self.held))
                self.held, self.before = [], False
            count = int(single.sum())
            if count:
                texts = values.take(pa.array(starts[single]))
                batches.append(_batch([_WHOLE] * count, [False] * count, [None] * count, [None] * count, texts))
        if self.rows:
            batches.append(self._taken())
        rest = int(ends[-1]) + 1 if len(ends) else 0
        self.held += values.slice(rest).to_pylist()
        self.parity = int(after[-1]) if len(after) else self.parity
        return batches

    def close(self) -> pa.RecordBatch | None:
        if self.held:
            self._emit(_INSIDE if self.before else _BEGIN, "\n".join(self.held))
        return self._taken() if self.rows else None

    def _taken(self) -> pa.RecordBatch:
        """The records of several lines since the last batch, which are not held any longer."""
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        return _batch(*columns[:4], pa.array(columns[4], pa.string()))


def _batch(piece: list, first: list, file: list, block: list, text: pa.Array) -> pa.RecordBatch:
    columns = [pa.array(piece, pa.int32()), pa.array(first, pa.bool_()), pa.array(file, pa.string()), pa.array(block, pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, text.cast(pa.string())], ["piece", "first", "file", "block", "text"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split: _Split | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        names = files.to_pylist()
        changes = [i for i in range(1, len(names)) if blocks[i] != blocks[i - 1] or names[i] != names[i - 1]]
        for lo, hi in zip([0, *changes], [*changes, batch.num_rows], strict=True):
            here = (names[lo], int(blocks[lo]))
            if split is None or (split.file, split.block) != here:
                if split is not None and (last := split.close()) is not None:
                    yield last
                split = _Split(*here, int(batch.column(4)[lo].as_py()))
            yield from split.add(batch.column(2).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64))
    if split is not None and (last := split.close()) is not None:
        yield last


def _put_together(pieces: DataFrame) -> DataFrame:
    """(first, text) of the records that cross splits; a row or two per split meet."""
    in_order = Window.partitionBy("file").orderBy("block", "piece")
    numbered = pieces.withColumn("record", F.sum((F.col("piece") == _BEGIN).cast("int")).over(in_order))
    parts = F.sort_array(F.collect_list(F.struct("block", "piece", "text")))
    whole = numbered.groupBy("file", "record").agg(F.bool_or("first").alias("first"), parts.alias("parts"))
    return whole.select("first", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, text): every record of the files as its text, and whether it is the first of its file. Runs jobs."""
    lines = _lines(spark, path)
    splits, _ = materialized(_open_splits(lines), "csv-splits")
    # About 100 bytes per split: a millionth of the data. The lines keep their order.
    placed = lines.join(F.broadcast(splits), ["file", "block"]).select("file", "block", "value", "quotes", "open")
    cut = placed.mapInArrow(_cut, _CUT)
    pieces, _ = materialized(cut.where(F.col("piece") != _WHOLE), "csv-pieces")
    records = cut.where(F.col("piece") == _WHOLE).select("first", "text")
    return records.unionByName(_put_together(pieces)).select("first", F.rtrim(F.col("text"), F.lit("\r")).alias("text"))


def _parsed(text: Column, schema: T.StructType) -> Column:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true", "maxCharsPerColumn": "-1"}
    return F.from_csv(text, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), options)


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and line breaks in values; a large file is read by several tasks. Runs jobs.

    As `read_csv` with a schema: text that does not parse becomes null and the record is kept in `_corrupt_record`.
    """
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    records = read_records(spark, path).where(~F.col("first") & (F.col("text") != ""))
    return records.select(_parsed(F.col("text"), kept).alias("r")).select("r.*")
