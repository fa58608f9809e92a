"""Merkle manifest of a table of documents: a tree per source, and one over the sources' roots.

Every level is a table of nodes (tree, at, size, hash), `at` being the place among the `size` nodes of the level.
A node's run is the ARITY consecutive ones around it. The level joins itself by equality of tree and computed place,
once per shift: the sibling `shift` slots further in the run, counted round. Each node then knows what stands before
and after it in its run, and the nodes of slot zero emit the parents. A tree whose level has a single node is done.

Proofs come down again: a node's proof is its own siblings, then its parent's proof, found by an equality join with the
level above, in which every parent has ARITY children at most. No row carries more than one proof.

Places are numbered without gathering a tree: rows are range-partitioned and sorted, numbered within their
partition, and shifted by the sizes of the partitions before. Rows that repeat have the same leaf, so their order among
each other does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.llm.tables import crc_fold, stored, stored_with

ARITY, TAMPERED_FOLD = 3, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NULL = "-"


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon and value."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit(_NULL))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*map(field, columns))


def tree_name(source: Column) -> Column:
    """Never null, ordered as the source is: null first, then by its bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(_NULL))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`rows` (a stored table with `tree`) with at and size: the place within the tree by `order`, and the tree's rows.

    Runs jobs. The windows are over a row per tree and partition.
    """
    bits = 33
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    # A row that repeats very often is spread as well.
    by.append(F.col("tie"))
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(tasks, *by).sortWithinPartitions(*by).drop("tie")
    # The partition's number, then the row's number within it, in its order.
    placed = stored(placed.withColumn("mark", F.monotonically_increasing_id()), "merkle-placed")
    part = F.shiftright("mark", bits).alias("part")
    spans = placed.groupBy("tree", part).agg(F.min("mark").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    spans = spans.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    joined = placed.withColumn("part", part).join(spans, ["tree", "part"])
    return joined.withColumn("at", F.col("mark") + F.col("shift")).drop("part", "mark", "shift")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with before and after: the hashes of the run that stand to their left and right."""
    slot = F.col("at") % ARITY
    made = nodes
    for shift in range(1, ARITY):
        # The place of the sibling, counted round within the run.
        place = F.col("at") - slot + (slot + shift) % ARITY
        other = nodes.select("tree", F.col("at").alias("place"), F.col("hash").alias(f"h{shift}"))
        made = made.withColumn("place", place).join(other, ["tree", "place"], "left").drop("place")

    def side(left: bool) -> Column:
        """Siblings in their order; the one at slot s is `(s - slot) % ARITY` further."""
        found = [F.lit("")]
        for s in range(ARITY):
            shift = F.pmod(F.lit(s) - slot, F.lit(ARITY))
            stands = slot > s if left else slot < s
            one = F.lit(None).cast("string")
            for k in range(1, ARITY):
                one = F.when(shift == k, F.col(f"h{k}")).otherwise(one)
            found.append(F.coalesce(F.when(stands, one), F.lit("")))
        return F.concat(*found)

    columns = [F.col(c) for c in nodes.columns]
    return made.select(*columns, side(True).alias("before"), side(False).alias("after"))


def _parents(level: DataFrame) -> DataFrame:
    first = level.where(F.col("at") % ARITY == 0)
    return first.select(
        "tree", F.expr(f"at div {ARITY}").alias("at"), F.expr(f"(size + {ARITY - 1}) div {ARITY}").alias("size"),
        digest(F.col("hash"), F.col("after")).alias("hash"),
    )


def build(nodes: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, with siblings, from the leaves up to two or more nodes; and the roots (tree, hash).

    `nodes` (a stored table) has tree, at, size, hash; `largest` is the largest size. Runs a job per level.
    """
    levels, roots, open_nodes = [], nodes.where("size = 1").select("tree", "hash"), nodes.where("size > 1")
    while largest > 1:
        levels.append(stored(_with_siblings(open_nodes), "merkle-level"))
        largest = -(-largest // ARITY)
        upper = stored(_parents(levels[-1]), "merkle-nodes")
        roots = roots.unionByName(upper.where("size = 1").select("tree", "hash"))
        open_nodes = upper.where("size > 1")
    return levels, roots


def proofs(levels: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, at, path, ...) of every leaf that has siblings: its path up to the root, continued by `above`.

    `above` has tree, path and what else the leaves are to carry, one row per tree. A path is an array of
    (before, after), from the leaf up.
    """
    own = F.array(F.struct("before", "after"))
    carried = [c for c in above.columns if c not in ("tree", "path")]
    down: DataFrame | None = None
    for level in reversed(levels):
        keyed = level.select("tree", "at", "size", "before", "after", F.expr(f"at div {ARITY}").alias("up"))
        top = keyed.where(F.col("size") <= ARITY).join(above, "tree")
        found = top.select("tree", "at", F.concat(own, "path").alias("path"), *carried)
        if down is not None:
            parents = down.withColumnRenamed("at", "up")
            lower = keyed.where(F.col("size") > ARITY).join(parents, ["tree", "up"])
            found = found.unionByName(lower.select("tree", "at", F.concat(own, "path").alias("path"), *carried))
        down = found
    return down


def folded(hash_: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, hash_, lambda acc, step: digest(step["before"], acc, step["after"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, checked: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, path per row. Runs jobs.

    `fields` are the columns of the leaf: id, source, others. `checked` is the digest of the leaf as found at
    verification, by default that of the documents as they are: folded_root is what it leads to with the siblings
    of the manifest, verified whether that is the root. Null sources are a tree of their own, before all
    others; rows without id come first in their tree; rows that repeat are leaves each. A proof without siblings is
    H of nothing. An empty table gives no rows. Other columns are not read.
    """
    by_id, by_source = fields[0], fields[1]
    made = leaf([F.col(c) for c in fields])
    leaves = docs.select(
        tree_name(F.col(by_source)).alias("tree"), F.col(by_id).alias("doc_id"), made.alias("hash"),
        (made if checked is None else checked).alias("found"),
    )
    leaves = stored(leaves, "merkle-leaves")
    placed, seen = stored_with(numbered(leaves, ["doc_id", "hash", "found"]), "merkle-numbered", largest=F.max("size"))
    levels, subroots = build(placed.select("tree", "at", "size", "hash"), seen["largest"] or 0)

    sources = stored(subroots.select("tree", "hash"), "merkle-subroots")
    # All sources are one tree, its leaves ordered by the source's name.
    one_tree = numbered(sources.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), ["name"])
    tops, seen = stored_with(one_tree, "merkle-sources", largest=F.max("size"))
    top_levels, roots = build(tops.select("tree", "at", "size", "hash"), seen["largest"] or 0)
    none = F.array().cast("array<struct<before:string,after:string>>")
    # One row.
    root = roots.select("tree", F.col("hash").alias("root"), none.alias("path"))
    to_root = proofs(top_levels, root) if top_levels else root.withColumn("at", F.lit(0).cast("bigint"))
    by_tree = tops.select("at", F.col("name").alias("tree"), F.col("hash").alias("subroot")).join(to_root.drop("tree"), "at")
    above = stored(by_tree.select("tree", "subroot", "root", "path"), "merkle-above")

    alone = placed.where("size = 1").join(above, "tree").drop("size", "at")
    if levels:
        paths = proofs(levels, above)
        alone = alone.unionByName(placed.where("size > 1").join(paths, ["tree", "at"]).drop("size", "at"))
    proved = alone.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("found"), F.col("path")).alias("folded_root"), "path",
    )
    return proved.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), "path",
    )


def tampered_leaf() -> Column:
    """The leaf of a document whose text, where the fold of its id says so, has lost its line breaks."""
    plain = [F.col(c) for c in FIELDS]
    broken = [*plain[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))]
    tampered = F.col("doc_id").isNotNull() & (crc_fold("doc_id", TAMPERED_FOLD) == 0)
    return F.when(tampered, leaf(broken)).otherwise(leaf(plain))


def verified(docs: DataFrame) -> DataFrame:
    """The manifest's rows for `documents`, checked against texts of which some lost their line breaks. Runs jobs.

    Rows without id are not tampered with. See `manifest`.
    """
    return manifest(docs, checked=tampered_leaf()).drop("path")


ORACLE = r"""
WITH RECURSIVE
crc(v, byte) AS (
  SELECT list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b), b
  FROM (SELECT unnest(range(256)) AS b)),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, text, concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size
  FROM documents),
sums AS (
  SELECT doc_id, 4294967295::BIGINT AS c, doc_id::VARCHAR AS rest FROM documents
  UNION ALL
  SELECT doc_id, xor(c // 256, v), rest[2:] FROM sums JOIN crc ON byte = xor(c % 256, ord(rest[1])) WHERE rest <> ''),
odd AS (SELECT doc_id FROM sums WHERE rest = '' AND xor(c, 4294967295) % 2 = 1),
hashed AS (
  SELECT doc_id, tree, pos, size, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN doc_id IN (FROM odd) THEN sha256(head || coalesce(strlen(text) || ':' || text, '-'))
      ELSE sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS found
  FROM leaves),
nodes AS (
  SELECT 0 AS level, tree, pos, size, leaf AS hash FROM hashed
  UNION ALL
  SELECT level + 1, tree, pos // 3, (size + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM nodes WHERE size > 1 GROUP BY level, tree, pos // 3, size),
subroots AS (
  SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, pos, size, hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (size + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM tops WHERE size > 1 GROUP BY level, pos // 3, size),
steps AS (
  SELECT level, tree, pos, size,
    coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT * FROM nodes UNION ALL SELECT level, '', pos, size, hash FROM tops)
  WINDOW run AS (PARTITION BY level, tree, pos // 3 ORDER BY pos)),
lower AS (
  SELECT doc_id, 0 AS level, tree, pos, size, found AS h, '' AS siblings FROM hashed
  UNION ALL
  SELECT doc_id, l.level + 1, tree, pos // 3, (l.size + 2) // 3, sha256(before || h || after), siblings || before || after
  FROM lower l JOIN steps s USING (level, tree, pos) WHERE l.size > 1),
upper AS (
  SELECT doc_id, 0 AS level, s.pos, s.size, l.h, siblings FROM lower l JOIN subroots s USING (tree) WHERE l.size = 1
  UNION ALL
  SELECT doc_id, u.level + 1, u.pos // 3, (u.size + 2) // 3, sha256(before || h || after), siblings || before || after
  FROM upper u JOIN steps s ON s.tree = '' AND s.level = u.level AND s.pos = u.pos WHERE u.size > 1)
SELECT doc_id, leaf, s.hash AS subroot, t.hash AS root, sha256(siblings) AS proof_sha256, h AS folded_root, h = t.hash AS verified
FROM upper u JOIN hashed USING (doc_id) JOIN subroots s USING (tree) JOIN tops t ON t.size = 1 WHERE u.size = 1
"""
