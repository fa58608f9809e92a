"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Every level of a tree projects the vectors, scaled to length one, on a random direction and splits each node
at a threshold; vectors within a margin of the threshold go to both sides. Two vectors of cosine COSINE are
sqrt(2 - 2 COSINE) apart, so the gap between their projections on a direction drawn independently of them
has a known spread. Copies on both sides of a threshold cover three such spreads at every depth, so a split loses
a pair with a chance of 0.3 % at most, wherever its threshold lies, and the trees are independent of each other:
at depth d all of them lose it with a chance of (0.0027 d)^TREES at most (`loss_bound`), whatever the vectors are.
Pairs are compared within leaves of one label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.llm.graph import connected
from sedimark.llm.tables import stored
from sedimark.operators.sampling import bounded_sample

COSINE, TREES, LEAF, SEED = 0.98, 4, 256, 42
# Vectors used to place the splits; every vector is sent down every tree.
SAMPLE_ROWS = 20_000
# Spreads of the gap that the copies at a threshold cover.
SPREADS = 3.0
# Nodes with fewer sample vectors split where the whole sample does. Nodes that would copy more than this share
# of their vectors do not split at that level: a dense group stays together instead of being copied.
NODE_SAMPLE, SPILL = 32, 0.4
# Members of one leaf compared in one task; larger leaves are compared block against block.
BLOCK = 2_048
_LEVELS = 40


@dataclass(frozen=True)
class Trees:
    """Directions per tree and level, and thresholds: per node where the sample reaches, else per level."""

    directions: np.ndarray  # trees x levels x dimensions
    nodes: list[list[dict[int, float]]]  # per tree and level: node code -> threshold, infinite for no split
    levels: list[list[float]]
    margin: float

    def places(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, code) of every leaf each vector falls into; codes are positive and differ between trees."""
        rows_out, codes_out = [], []
        for t in range(len(self.directions)):
            rows, codes = np.arange(len(units)), np.ones(len(units), np.int64)
            for level, direction in enumerate(self.directions[t]):
                known = self.nodes[t][level]
                nodes, inverse = np.unique(codes, return_inverse=True)
                cuts = np.array([known.get(n, self.levels[t][level]) for n in nodes.tolist()])[inverse]
                # Row by row in one order of additions, so that a vector falls into the same leaves in every batch.
                value = np.einsum("ij,j->i", units, direction)[rows]
                left, right = value <= cuts + self.margin, value >= cuts - self.margin
                rows = np.concatenate([rows[left], rows[right]])
                codes = np.concatenate([codes[left] * 2, codes[right] * 2 + 1])
            rows_out.append(rows)
            codes_out.append(codes + (t << (_LEVELS + 2)))
        return np.concatenate(rows_out), np.concatenate(codes_out)


def grow(sample: np.ndarray, depth: int, cosine: float = COSINE, trees: int = TREES, seed: int = SEED) -> Trees:
    """A forest over unit vectors, placed by a sample of them."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    directions = rng.normal(size=(trees, depth, size))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    gap = math.sqrt(2 - 2 * cosine) / math.sqrt(size)
    # Both sides together three spreads, at every depth.
    margin = SPREADS / 2 * gap

    def cut_of(value: np.ndarray) -> float:
        """The most even split that does not copy too much; infinite if there is none."""
        tried = np.quantile(value, 0.5 + np.array([0, -0.05, 0.05, -0.1, 0.1, -0.15, 0.15, -0.2, 0.2]))
        return next((float(c) for c in tried if (np.abs(value - c) <= margin).mean() <= SPILL), math.inf)

    nodes: list[list[dict[int, float]]] = []
    levels: list[list[float]] = []
    for t in range(trees):
        held = {1: np.arange(len(sample))}
        nodes.append([])
        levels.append([])
        for direction in directions[t]:
            value, cuts, after = sample @ direction, {}, {}
            levels[t].append(cut_of(value) if len(value) else 0.0)
            for node, members in held.items():
                cut = levels[t][-1]
                if len(members) >= NODE_SAMPLE:
                    cut = cuts[node] = cut_of(value[members])
                side = {2 * node: members[value[members] <= cut], 2 * node + 1: members[value[members] > cut]}
                after.update({k: m for k, m in side.items() if len(m) >= NODE_SAMPLE})
            nodes[t].append(cuts)
            held = after
    return Trees(directions, nodes, levels, margin)


def unit_rows(vectors: list[np.ndarray], size: int) -> np.ndarray:
    """Rows of length one, in double precision, padded with zeros to `size`."""
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def loss_bound(depth: int, trees: int = TREES) -> float:
    """The chance at most that two vectors of cosine COSINE share no leaf of the forest."""
    return min(depth * math.erfc(SPREADS / math.sqrt(2)), 1.0) ** trees


def _met_before(units: np.ndarray, forest: Trees, here: int) -> np.ndarray:
    """Per pair of vectors, whether they share a leaf of a smaller code."""
    at, codes = forest.places(units)
    at, codes = at[codes < here], codes[codes < here]
    order = np.argsort(codes, kind="stable")
    met = np.zeros((len(units), len(units)), bool)
    for members in np.split(at[order], np.flatnonzero(np.diff(codes[order])) + 1):
        if len(members) > 1:
            met[np.ix_(members, members)] = True
    return met


def compare(group: pd.DataFrame, size: int, forest: Trees, cosine: float = COSINE, kind: type = np.float64) -> pd.DataFrame:
    """(cid, root, n) for the members of one leaf, or two blocks of it, that have links.

    Vectors are the bytes of numbers of the given kind. n adds up the copies of the linked classes. A pair that meets in several leaves counts in the first one
    both fall into. root is the smallest class of those joined here.
    """
    here = int(group["code"].iloc[0])
    units = unit_rows([np.frombuffer(v, kind) for v in group["vector"]], size)
    blocks, ids = group["own"].to_numpy(), group["cid"].to_numpy()
    copies = group["copies"].to_numpy()
    first, second = group["one"].iloc[0], group["two"].iloc[0]
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    linked_left, linked_right = [], []
    for lo in range(0, len(ids), 512):
        near = units[lo : lo + 512] @ units.T >= cosine
        left, right = np.nonzero(near)
        left = left + lo
        keep = left < right
        if first != second:
            keep &= blocks[left] != blocks[right]
        left, right = left[keep], right[keep]
        linked_left.append(left)
        linked_right.append(right)
    left, right = np.concatenate(linked_left), np.concatenate(linked_right)
    touched = np.unique(np.concatenate([left, right]))
    if len(touched):
        met = _met_before(units[touched], forest, here)
        counted = ~met[np.searchsorted(touched, left), np.searchsorted(touched, right)]
        np.add.at(links, left[counted], copies[right[counted]])
        np.add.at(links, right[counted], copies[left[counted]])
    # Numbered by class id, so that the smallest number is the smallest id.
    order = np.argsort(ids, kind="stable")
    root[order] = np.arange(len(ids))
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        if (before == root).all():
            break
    return pd.DataFrame({"cid": ids[touched], "root": ids[order][root[touched]], "n": links[touched]})


def usable(vector: Column) -> Column:
    """Whether the vector can link: not null or empty, no null or non-finite component, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    cosine: float = COSINE, trees: int = TREES,
) -> DataFrame:
    """vec_id, n_links, component_id, kept per row. Runs jobs.

    Vectors link within a label when their cosine in double precision reaches `cosine`. Equal vectors of a
    label are one class, compared once and counted as often as they occur. Rows whose label is null or whose
    vector cannot link stand alone, and so do vectors of another length. Rows without id take part;
    component_id is null where no member has one, and kept is false then. An empty table gives no rows.
    """
    # Vectors of single precision are sent and stored as such, and widened where they are compared.
    held = rows.schema[vector].dataType
    single = isinstance(held, T.ArrayType) and isinstance(held.elementType, T.FloatType)
    number, narrow = ("float", np.float32) if single else ("double", np.float64)
    body = F.col(vector).cast(f"array<{number}>")
    plain = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), body.alias("vector"))
    good = F.col("label").isNotNull() & usable(F.col("vector"))
    # Zeros of either sign are one value.
    same = F.transform("vector", lambda x: x + F.lit(0.0).cast(number))
    marked = plain.select("vec_id", "label", F.when(good, same).alias("vector"))
    marked = stored(marked.withColumn("cid", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))), "vectors")
    groups = marked.where("vector is not null").groupBy("cid").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector")
    )
    classes = stored(groups, "vector-classes")
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("size")).agg(F.max("n"), F.max("size")).first()
    if largest[0] is None:
        return marked.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    size = int(largest[1])
    depth = min(max(math.ceil(math.log2(largest[0] / LEAF)), 0), _LEVELS)
    sample = bounded_sample(classes.select("cid", "vector"), SAMPLE_ROWS, ["cid"]).select("vector").toPandas()["vector"]
    forest = rows.sparkSession.sparkContext.broadcast(vars(grow(unit_rows(list(sample), size), depth, cosine, trees)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest_here = Trees(**forest.value)
        for batch in batches:
            vectors = [np.asarray(v, np.float64) for v in batch.column(2).to_pylist()]
            if not vectors:
                continue
            at, codes = forest_here.places(unit_rows(vectors, size))
            order = np.lexsort((codes, at))
            at, codes = at[order], codes[order]
            ends = np.cumsum(np.bincount(at, minlength=len(vectors)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(v) for v in vectors], pa.int32()), batch.column(3),
                    pa.array([v.astype(narrow).tobytes() for v in vectors], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(codes, pa.int64())),
                ],
                ["cid", "label", "size", "copies", "vector", "codes"],
            )

    kind = classes.schema["label"].dataType.simpleString()
    sent = classes.select("cid", "label", "vector", "copies").mapInArrow(
        send, f"cid bigint, label {kind}, size int, copies bigint, vector binary, codes array<bigint>"
    )
    sent = stored(sent, "vector-leaves")
    leaf = ["label", "size", "code"]
    sizes = sent.select("label", "size", F.explode("codes").alias("code")).groupBy(*leaf).agg(F.count(F.lit(1)).alias("members"))
    large = stored(sizes.where(F.col("members") > BLOCK), "vector-large-leaves")
    dealt = sent.withColumn("code", F.explode("codes")).drop("codes").join(large, leaf, "left")
    blocks = F.coalesce(F.ceil(F.col("members") / BLOCK), F.lit(1)).cast("int")
    dealt = dealt.withColumn("own", F.pmod(F.col("cid"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})
    found = dealt.groupBy(*leaf, "one", "two").applyInPandas(
        lambda group: compare(group, size, Trees(**forest.value), cosine, narrow), "cid bigint, root bigint, n bigint"
    )
    found = stored(found, "vector-links")
    links = found.groupBy("cid").agg(F.sum("n").alias("linked"))
    roots = connected(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "vector-roots")
    placed = classes.select("cid", "copies", "first_id").join(links, "cid", "left").join(roots, F.col("cid") == F.col("node"), "left")
    placed = stored(
        placed.select(
            "cid", "first_id", F.coalesce("root", "cid").alias("root"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "vector-placed",
    )
    least = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "vector-components")
    named = stored(placed.join(least, "root").select("cid", "n_links", "component_id"), "vector-named")
    joined = marked.select("vec_id", "cid").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""
