"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits over hashed word shingles. Two fingerprints link when they differ in at most
`RADIUS` bits. A position i of the fingerprint carries a vector m(i) of RADIUS + 1 bits; for each non-zero
vector v the mask of v selects the positions where m(i)·v is odd. Any RADIUS differing positions leave a v
with m(i)·v even at all of them, so both fingerprints agree under that mask: every pair within the radius
meets in at least one of the 2^(RADIUS+1) - 1 tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.llm.graph import Forest, connected
from sedimark.llm.tables import stored

RADIUS, WORDS, SEED, BITS = 4, 4, 42, 64
# Different fingerprints compared within one bucket; larger buckets are dealt out again by a further cover.
BUCKET = 4096
# How the covers place their vectors. One mask of each fixes 52 bits or more, so the last cover's buckets have at most
# 2^12 different fingerprints, whatever the input.
_COVERS = ((1, 0), (11, 5), (47, 7), (61, 33))
_STEP = 1 << 15


def fingerprint(text: str | None) -> int:
    """Unsigned SimHash of one text; 0 when it has no words.

    ASCII capitals are lowered, words are runs without ASCII white space, shingles are WORDS words joined by
    one space (the whole sequence when there are fewer). A bit is set when over half the shingle hashes set it.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    size, digest = max(len(words) - WORDS + 1, 1), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for start in range(0, size, _STEP):
        part = words[start : min(start + _STEP, size) + WORDS - 1]
        line = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        ends = ends.tolist()[WORDS - 1 :] or [len(line)]
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=False)], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > size).tobytes(), "big")


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        values = np.array([fingerprint(t) for t in batch], dtype=np.uint64)
        yield pd.Series(values.view(np.int64))


def fingerprint_column(text: str | Column) -> Column:
    """The fingerprint as a signed 64-bit value."""
    return _fingerprints(text)


def _spread(level: int) -> list[int]:
    """m(i) per bit position; every level places the vectors independently of the others."""
    vectors, (step, first) = (1 << (RADIUS + 1)) - 1, _COVERS[level - 1]
    return [(i * step + first) % BITS % vectors + 1 for i in range(BITS)]


def masks(level: int = 1) -> list[int]:
    """The masks of all tables, as unsigned 64-bit values with about half the bits set."""
    m = _spread(level)
    return [
        sum(1 << i for i in range(BITS) if (m[i] & v).bit_count() % 2) for v in range(1, 1 << (RADIUS + 1))
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _dealt(prints: DataFrame, level: int, owner: Column | None = None) -> DataFrame:
    """(bucket, fp) for every table."""
    keys = [
        F.xxhash64(*([owner] if owner is not None else []), F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(mask))))
        for t, mask in enumerate(masks(level))
    ]
    return prints.select(F.explode(F.array(*keys)).alias("bucket"), "fp")


def linked_in(values: np.ndarray, forest: Forest) -> None:
    """Join all pairs of `values` within the radius, comparing block by block.

    In a dense block, values joined already have one label, and only pairs of different labels join.
    """
    label = np.arange(len(values))
    for start in range(0, len(values), 1024):
        block = values[start : start + 1024]
        near = np.bitwise_count(block[:, None] ^ values[None, start:]) <= RADIUS
        if np.count_nonzero(near) < 8 * len(block):
            for i, j in np.argwhere(near).tolist():
                if i < j:
                    forest.join(int(block[i]), int(values[start + j]))
            continue
        for i, row in enumerate(near, start=start):
            others = start + np.flatnonzero(row)
            others = others[label[others] != label[i]]
            while len(others):
                j = int(others[0])
                forest.join(int(values[i]), int(values[j]))
                label[label == label[j]] = label[i]
                others = others[label[others] != label[i]]


def _edges(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, again): an edge, or for a bucket over the limit the (bucket, fp) rows to deal again.

    Input is sorted by bucket; at most BUCKET members of the open bucket are held unless it is the `last` cover, whose
    buckets are bounded by the bits that all covers fix.
    """
    key, held, over = None, [], False

    def closed() -> tuple[list[int], list[int], bool]:
        forest = Forest()
        values = np.unique(np.concatenate(held))
        if len(values) > 1:
            linked_in(values, forest)
        pairs = forest.links()
        return [p[0] for p in pairs], [p[1] for p in pairs], False

    def rows(a, b, again: bool) -> pa.RecordBatch:
        a, b = (np.array(x, dtype=np.uint64).view(np.int64) for x in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([again] * len(a))], ["a", "b", "again"])

    for batch in batches:
        buckets = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        edges: tuple[list[int], list[int]] = ([], [])
        cuts = np.flatnonzero(np.diff(buckets)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
            if lo == hi:
                continue
            if buckets[lo] != key:
                if held and not over and (len(held) > 1 or len(held[0]) > 1):
                    a, b, _ = closed()
                    edges[0].extend(a)
                    edges[1].extend(b)
                key, held, over = buckets[lo], [], False
            held.append(prints[lo:hi])
            if not last and (over or sum(map(len, held)) > BUCKET):
                members = np.concatenate(held)
                yield rows(np.full(len(members), key).view(np.uint64), members, True)
                held, over = [], True
        if edges[0]:
            yield rows(*edges, False)
    if held and not over:
        a, b, _ = closed()
        if a:
            yield rows(a, b, False)


def near_edges(prints: DataFrame) -> DataFrame:
    """(a, b) edges that join all fingerprints linked within the radius; at most one per member and bucket.

    `prints` has the different fingerprints as `fp`. Runs jobs.
    """

    def found(dealt: DataFrame, last: bool) -> DataFrame:
        parts = dealt.repartition("bucket").sortWithinPartitions("bucket")
        return parts.mapInArrow(lambda it: _edges(it, last), "a bigint, b bigint, again boolean")

    edges, open_, owner = None, prints, None
    for level in range(1, len(_COVERS) + 1):
        last = level == len(_COVERS)
        made = stored(found(_dealt(open_, level, owner), last), "simhash-edges")
        here = made.where("not again").select("a", "b")
        edges = here if edges is None else edges.unionAll(here)
        if last or made.where("again").isEmpty():
            break
        open_ = made.where("again").select(F.col("a").alias("owner"), F.col("b").alias("fp"))
        owner = F.col("owner")
    return edges


def classes(prints: DataFrame) -> DataFrame:
    """(fp, root, fp_id, component_id) per different fingerprint. Runs jobs.

    `prints` has fp and doc_id. fp_id is the smallest doc_id of that fingerprint, component_id that of all
    fingerprints reachable by links; both null when no member has an id.
    """
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("fp_id")), "simhash-groups")
    roots = connected(near_edges(groups.select("fp")), "simhash-roots")
    placed = groups.join(roots, groups.fp == roots.node, "left").select(
        "fp", "fp_id", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "simhash-placed")
    least = stored(placed.groupBy("root").agg(F.min("fp_id").alias("component_id")), "simhash-components")
    return stored(placed.join(least, "root").select("fp", "root", "fp_id", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row. Runs jobs.

    Null and blank texts have fingerprint 0 and link like any other. Rows without an id take part; rows
    repeated stay repeated. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fp")), "simhash-prints"
    )
    named = classes(prints).select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest doc_id of each group of linked fingerprints. Runs jobs.

    Of repeated rows one stays; of a group without ids the one whose text hash is smallest.
    """
    width = len(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(width)])
    key, body = (f"c{docs.columns.index(c)}" for c in (doc_id, text))
    marked = stored(plain.withColumn("fp", fingerprint_column(F.col(body))), "simhash-documents", "zstd")
    found = classes(marked.select("fp", F.col(key).alias("doc_id")))
    # One fingerprint represents each group: of those that hold the smallest id, the smallest.
    first = F.min_by(F.struct("fp", "fp_id"), F.struct(F.col("fp_id").isNull(), "fp_id", "fp"))
    chosen = stored(found.groupBy("root").agg(first.alias("s")).select("s.fp", "s.fp_id"), "simhash-survivors")
    same = (marked.fp == chosen.fp) & marked[key].eqNullSafe(chosen.fp_id)
    rows = marked.join(chosen, same, "left_semi")
    # Repeated rows of one id: Spark keeps one row per key and task before it shuffles.
    rank = F.row_number().over(Window.partitionBy("fp", key).orderBy(F.xxhash64(body), body))
    kept = rows.withColumn("rank", rank).where("rank = 1")
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(docs.columns)])
