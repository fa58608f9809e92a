"""Exact duplicates by skew-safe combining; only DataFrame operations run.

A text's digest names its group, and whole texts are compared wherever groups are formed, since the text is part of
every grouping key. Each task first merges its own copies (the partial aggregation), so a text leaves a task once.
Groups of hot digests, those with at least one row in HOT_SHARE, are dealt under salts that stand for the tasks they
come from, merged per salt, and the salts' winners are then combined. All other groups are whole after the first merge.

The rows learn their group's winner by digest alone: the merge has compared all texts of a digest and counted the
different ones, so where that is one, equal digests are equal texts. Digests of several texts, which SHA-256 is not
known to have, are settled by joining on the texts themselves. At most HOT_SHARE digests are hot, so their winners
are broadcast and the rows of a hot group never meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.llm.tables import stored, stored_with

HOT_SHARE, SALTS = 10_000, 64
Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(docs: DataFrame, doc_id: str, text: str, digest: Digest) -> DataFrame:
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return whole.withColumn("digest", digest(F.col("text")))


def _single(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("digest", *more, "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"))


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))


def _winners(rows: DataFrame, hot: DataFrame) -> tuple[DataFrame, bool]:
    """Per digest: keep_id and n of its text, and how many texts it has; and whether any has several. Runs jobs."""
    task = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    marked = rows.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.when(F.col("hot"), task).otherwise(-1))
    salted = _merged(_single(marked, "salt"), "digest", "salt", "text")
    # Whole groups need their text no longer.
    kept_text = F.when(F.col("salt") >= 0, F.col("text"))
    salted = stored(salted.select("digest", "salt", kept_text.alias("text"), "keep_id", "n"), "copies-salted")
    whole = salted.where("salt < 0").select("digest", "keep_id", "n")
    combined = _merged(salted.where("salt >= 0"), "digest", "text").select("digest", "keep_id", "n")
    per_digest = whole.unionByName(combined).groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")
    )
    several = F.coalesce(F.sum(F.when(F.col("texts") > 1, 1)), F.lit(0))
    found, seen = stored_with(per_digest, "copies-winners", several=several)
    return found, seen["several"] > 0


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Digest = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 per row. Runs jobs.

    Rows of equal text are a group, a null text being empty; the row with the largest doc_id stays. Texts are compared
    byte by byte, without normalisation. Rows without id count in the group and stay only if no row of it has an id;
    rows that repeat id and text share their flag. An empty table gives no rows. Other columns are not read.
    `digest` may be any function of the text; groups do not depend on it.
    """
    rows = _rows(docs, doc_id, text, digest)
    # SHA-256 is in the result in any case.
    sha = F.col("digest") if digest is sha256 else sha256(F.col("text"))
    ids, seen = stored_with(rows.select("doc_id", "digest", sha.alias("text_sha256")), "copies-ids", n=F.count(F.lit(1)))
    repeated = ids.groupBy("digest").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    hot = repeated.where(F.col("count") * HOT_SHARE >= seen["n"]).select("digest", F.lit(True).alias("hot"))
    hot = stored(hot, "copies-hot")
    found, several = _winners(rows, hot)
    proven = found.where("texts = 1").drop("texts")
    # At most HOT_SHARE rows.
    hot_winners = proven.join(F.broadcast(hot), "digest").drop("hot")
    made = ids.join(F.broadcast(hot_winners), "digest").unionByName(
        ids.join(F.broadcast(hot), "digest", "left_anti").join(proven, "digest")
    )
    if several:
        again = rows.join(found.where("texts > 1").select("digest"), "digest", "left_semi")
        again = stored(again.withColumn("text_sha256", sha), "copies-again")
        exact = _merged(_single(again), "digest", "text")
        made = made.unionByName(again.join(exact, ["digest", "text"]).drop("text"))
    return made.select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one row per different text, with all their columns. Runs jobs.

    See `classes`. Of rows that repeat the id and text that stay, any one stays.
    """
    width = len(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(width)])
    c_id, c_text = (F.col(f"c{docs.columns.index(c)}") for c in (doc_id, text))
    winners = classes(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("id"), "text_sha256").distinct()
    named = plain.withColumn("sha", sha256(F.coalesce(c_text, F.lit(""))))
    alike = (F.col("sha") == F.col("text_sha256")) & c_id.eqNullSafe(F.col("id"))
    # The key holds the id, so the rows of a hot text are spread.
    kept = named.join(winners, alike, "left_semi").withColumn("id", c_id).dropDuplicates(["sha", "id"])
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(docs.columns)])


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
