"""Mixing sources to target weights by capped water-filling.

All sources share a budget of words in proportion to their weights. No source may give more than
`MAX_EPOCHS` times its own size: a source above that is clamped, and the excess is shared among the others
by weight, until none is above. Every target is then min(cap, level * weight) for one common level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.functions.hashing import portable_hash
from sedimark.llm.tables import stored

MAX_EPOCHS, SEED = 3, 42
WEIGHTS = (1, 2, 3)
_PURPOSE = "mixing"


def words_in(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, weight, target per source.

    `sizes` has one row per source with source and source_size. Sources are numbered by code point, null
    last, and weigh WEIGHTS in turn. The table of sources is configuration: each row has a weight, so its
    windows run in one task over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1))
    # Sources reach their cap in the order of source_size / weight while the level rises.
    fills = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    total, all_weights = F.sum("source_size").over(whole), F.sum("weight").over(whole)
    cap = F.col("source_size") * MAX_EPOCHS
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0))
    open_weight = all_weights - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = weighed.select("source", "source_size", "weight", left.alias("left"), open_weight.alias("open"))
    # The level is set by the first source that the budget left cannot fill to its cap.
    level_here = F.col("left").cast("double") / F.col("open").cast("double")
    fits = level_here * F.col("weight") <= F.col("source_size") * MAX_EPOCHS
    first = F.min(F.when(fits, F.struct(-F.col("open"), F.col("left"), F.col("open")))).over(whole)
    level = first["left"].cast("double") / first["open"].cast("double")
    target = F.least((F.col("source_size") * MAX_EPOCHS).cast("double"), level * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> list[Column]:
    size = words_in(F.col(text))
    return [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size")]


def _order(seed: int) -> Column:
    """Seeded place of a document: a digest of id and size, so that rows without id spread as well."""
    return portable_hash(["doc_id", "size"], seed, _PURPOSE)


def plan(rows: DataFrame) -> DataFrame:
    """Per source: source, source_size, target, whole, and where its extra round ends.

    `rows` (a stored table) has source, size, place. Every document is taken `whole` times. The extra round
    goes through the documents by `place` until the target is reached; it ends within the rows that share
    (cut_place, cut_size), of which each takes cut_words. Runs jobs.

    Only one 4096th of a source is ordered by row: sums per leading digits of `place` find the stretch
    in which the round ends.
    """
    stretch = F.substring("place", 1, 3)
    parts = rows.groupBy("source", stretch.alias("stretch")).agg(F.sum("size").alias("part"))
    parts = stored(parts, "mixing-stretches")
    sizes = parts.groupBy("source").agg(F.sum("part").alias("source_size"))
    aims = targets(sizes).withColumn(
        "whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("bigint")
    )
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).cast("bigint")
    aims = stored(aims.withColumn("rest", rest).withColumn("key", F.struct("source")), "mixing-targets")

    along = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    running = parts.withColumn("before", F.coalesce(F.sum("part").over(along), F.lit(0)))
    ends = (
        running.withColumn("key", F.struct("source")).join(aims.select("key", "rest"), "key")
        .where("rest > before and rest <= before + part")
        .select("key", "stretch", "before", "rest")
    )
    ends = stored(ends, "mixing-ends")
    near = rows.select("size", "place", stretch.alias("stretch"), F.struct("source").alias("key"))
    near = near.join(ends, ["key", "stretch"]).groupBy("key", "place", "size", "before", "rest").agg(
        F.count(F.lit(1)).alias("n")
    )
    inside = Window.partitionBy("key").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0))
    cuts = (
        near.withColumn("reached", reached)
        .where("rest > reached and rest <= reached + size * n")
        .select("key", F.col("place").alias("cut_place"), F.col("size").alias("cut_size"),
                F.expr("(rest - reached) div n").alias("cut_words"))
    )
    return stored(aims.join(cuts, "key", "left").drop("key", "rest", "weight"), "mixing-plan")


def _share(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """`rows` with the plan of their source; the plan is read from files of known size."""
    renamed = by_source.withColumnRenamed("source", "plan_source")
    joined = rows.join(renamed, rows.source.eqNullSafe(renamed.plan_source), "left").drop("plan_source")
    here = F.struct("place", "size")
    cut = F.struct(F.col("cut_place").alias("place"), F.col("cut_size").alias("size"))
    extra = F.when(F.col("cut_place").isNull(), F.lit(0)).when(here < cut, F.col("size")).when(
        here == cut, F.col("cut_words")
    ).otherwise(F.lit(0))
    return joined.withColumn("taken", F.col("whole") * F.col("size") + extra)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken per row. Runs jobs.

    taken counts the words the mix takes from a document: whole repetitions, one more for documents that
    the seeded extra round reaches, and part of the one where the round ends, so a source's taken words miss
    its target by rounding only. Null texts have size 0; a null source is a source of its own; repeated rows
    are taken alike. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(docs.select(*_sized(docs, doc_id, text, source)).withColumn("place", _order(seed)), "mixing-sizes")
    shared = _share(rows, plan(rows))
    return shared.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """The documents of the mix, each as often as it is taken. Runs jobs.

    A document of which only a part is due appears once more when that is at least half of it. Documents
    without words come with the whole repetitions of their source.
    """
    width = len(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(width)])
    at = {name: f"c{docs.columns.index(c)}" for name, c in (("doc_id", doc_id), ("text", text), ("source", source))}

    def with_place(frame: DataFrame, *keep: Column) -> DataFrame:
        sized = frame.select(*keep, *_sized(frame, at["doc_id"], at["text"], at["source"]))
        return sized.withColumn("place", _order(seed))

    by_source = plan(stored(with_place(plain), "mixing-sizes"))
    shared = _share(with_place(plain, F.struct(*plain.columns).alias("row")), by_source)
    times = F.when(F.col("size") == 0, F.col("whole")).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5))
    copies = shared.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return copies.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(docs.columns)])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
  FROM documents),
placed AS (
  SELECT *, md5(concat_ws('|', 'mixing-42', doc_id::VARCHAR, size::VARCHAR)) AS place FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM placed GROUP BY source),
levels AS (
  SELECT *,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER fills, 0) AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER fills, 0) AS open
  FROM sources
  WINDOW fills AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT left_over::DOUBLE / open::DOUBLE AS level FROM levels
  WHERE left_over::DOUBLE / open::DOUBLE * weight <= 3 * source_size ORDER BY open DESC LIMIT 1),
aims AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target
  FROM sources LEFT JOIN level ON true),
parted AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END::BIGINT AS whole FROM aims),
rests AS (
  SELECT *, floor(target - whole * source_size + 0.5)::BIGINT AS rest FROM parted),
ordered AS (
  SELECT p.doc_id, p.size, r.source_size, r.target, r.whole, r.rest,
    coalesce(sum(p.size) OVER (PARTITION BY p.source ORDER BY place, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached
  FROM placed p JOIN rests r ON p.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, rest - reached)))::BIGINT AS taken
FROM ordered
"""
