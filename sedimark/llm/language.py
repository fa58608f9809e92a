"""Language identification by nearest centroid.

A text becomes a vector of hashed letter n-grams (one to three, spaces as word ends), weighted by TF-IDF and
normalised. Each language has several centroids, clustered from a bounded sample; a text takes the language
of the centroid with the largest cosine, and is rejected when even that one is too far away, as learnt from sample rows
that the clustering did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.functions.hashing import portable_hash
from sedimark.llm.tables import crc_fold, stored
from sedimark.llm.text import stretches

DIMENSIONS, CENTROIDS, ROUNDS = 1 << 14, 4, 10
# Labelled rows per language used to place the centroids; document frequencies come from all training rows.
SAMPLE_ROWS = 400
FOLDS, HELD_OUT, SEED = 4, 2, 42
UNKNOWN = "und"
# A text is rejected below this share of a low quantile of the cosines of held-back sample rows; texts of fewer n-grams
# than SHORT, which are less like their language, below a share less in proportion to the root of their number.
REJECT_SHARE, REJECT_QUANTILE, SHORT = 0.4, 0.02, 100
_HELD_BACK = 4
_FACTORS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def ngram_counts(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Counts of the hashed n-grams of the whole text; all zero when it has no letter."""
    counts = np.zeros(DIMENSIONS, np.int64)
    for part in stretches(text or ""):
        points = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(letters[points], points, 32).astype(np.uint32)
        points = np.concatenate(([32], points, [32])).astype(np.uint32)
        points = points[(points != 32) | np.concatenate(([True], points[:-1] != 32))]
        if len(points) < 3:
            continue
        codes = points * _FACTORS[0]
        single = codes[points != 32]
        double = codes[:-1] ^ (points[1:] * _FACTORS[1] + 1)
        triple = double[:-1] ^ (points[2:] * _FACTORS[2] + 2)
        for grams in (single, double, triple):
            mixed = (grams ^ (grams >> 15)) * _FACTORS[1]
            counts += np.bincount((mixed ^ (mixed >> 13)) & (DIMENSIONS - 1), minlength=DIMENSIONS)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf
    length = np.linalg.norm(values)
    return (values / length if length else values).astype(np.float32)


@dataclass(frozen=True)
class Languages:
    names: list[str]  # language of each centroid
    centroids: np.ndarray
    floors: np.ndarray  # rejection cosine of each centroid's language
    idf: np.ndarray


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, in how many texts each dimension occurs; dimension -1 counts the texts."""
    letters, seen, texts = letter_table(), np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            seen += ngram_counts(text.as_py(), letters) > 0
            texts += 1
    at = np.flatnonzero(seen)
    names = np.concatenate(([-1], at)).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate(([texts], seen[at])))], ["dim", "n"])


def spherical_means(vectors: np.ndarray, k: int) -> np.ndarray:
    """Centroids of unit vectors: far-apart starts, then reassignment by cosine."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        far = int(nearest.argmin())
        if far in chosen:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    centres = vectors[chosen].copy()
    for _ in range(ROUNDS):
        owner = (vectors @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (owner == c).any():
                mean = vectors[owner == c].sum(axis=0)
                centres[c] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centres


def shortness(grams: np.ndarray | int) -> np.ndarray:
    """Share of the rejection floor that holds for a text of so many n-grams."""
    return np.sqrt(np.minimum(np.asarray(grams) / SHORT, 1.0))


def _sample(known: DataFrame) -> DataFrame:
    """At most SAMPLE_ROWS rows per language with different ids, those of the smallest hashes; one text per id.

    A share of the ids, some three times as many as are wanted, is taken by the hash before any are ranked, so what a
    language sends to its ranking does not grow with its rows or with the tasks.
    """
    place = portable_hash(["doc_id"], SEED, "language")
    ids = known.where(F.col("doc_id").isNotNull()).select("lang", "doc_id", place.alias("place"))
    sizes = ids.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    near = F.conv(F.substring("place", 1, 12), 16, 10).cast("double") * F.col("n") < 3 * SAMPLE_ROWS * 16.0**12
    # A row per language, as the model has.
    few = ids.join(F.broadcast(sizes), "lang").where(near | (F.col("n") <= 3 * SAMPLE_ROWS)).select("lang", "doc_id", "place").distinct()
    ranked = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = few.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= SAMPLE_ROWS)
    chosen = stored(chosen.select("lang", "doc_id"), "language-sample")
    return known.join(chosen, ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, train: Column | None = None) -> Languages:
    """Learned from text and lang of the training fold's rows. Runs jobs."""
    fold = crc_fold("doc_id", FOLDS) != HELD_OUT if train is None else train
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & fold)
    counts = known.select("text").mapInArrow(_frequencies, "dim int, n bigint").groupBy("dim").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most DIMENSIONS + 1 rows
    number = dict(zip(found["dim"].tolist(), found["n"].tolist(), strict=True))
    texts = number.pop(-1, 0)
    frequency = np.zeros(DIMENSIONS)
    frequency[list(number)] = list(number.values())
    idf = np.log((1 + texts) / (1 + frequency)) + 1.0

    sample = _sample(known)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        letters = letter_table()
        found = [c for t in group.sort_values("doc_id")["text"] if (c := ngram_counts(t, letters)).any()]
        if not found:
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        vectors, sizes = np.stack([weighted(c, idf) for c in found]), np.array([c.sum() for c in found])
        back = np.arange(len(vectors)) % _HELD_BACK == _HELD_BACK - 1
        centres = spherical_means(vectors[~back], CENTROIDS)
        judged = back if back.any() else ~back
        cosines = (vectors[judged] @ centres.T).max(axis=1) / shortness(sizes[judged])
        floor = REJECT_SHARE * float(np.quantile(cosines, REJECT_QUANTILE))
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": list(centres), "floor": floor})

    made = sample.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, floor double")
    rows = made.toPandas().sort_values("lang", kind="stable")  # CENTROIDS rows per language
    if rows.empty:
        return Languages([], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0), idf)
    return Languages(
        rows["lang"].tolist(), np.stack([np.asarray(c, np.float32) for c in rows["centroid"]]), rows["floor"].to_numpy(), idf
    )


def predict_column(docs: DataFrame, text: str | Column, model: Languages) -> Column:
    """struct<lang_pred, score, rejected>. `und` with score 0 for texts without a letter, always rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, letters = Languages(**shared.value), letter_table()
        for batch in batches:
            out = []
            for text in batch:
                counts = ngram_counts(text, letters)
                if not len(model.names) or not counts.any():
                    out.append((UNKNOWN, 0.0, True))
                    continue
                cosines = model.centroids @ weighted(counts, model.idf)
                best = int(cosines.argmax())
                cosine = float(cosines[best])
                floor = model.floors[best] * shortness(counts.sum())
                out.append((model.names[best], min(max(cosine, 0.0), 1.0), bool(cosine < floor)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])

    return predicted(text)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected per row. Runs jobs.

    lang_pred is the nearest language also where `rejected` tells that it is too far away. Null texts and
    texts without letters are `und`, as are all texts when no row has a language. Rows repeated stay
    repeated; an empty table gives no rows.
    """
    model = fit(docs)
    made = docs.select("doc_id", predict_column(docs, F.col("text"), model).alias("p"))
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return made.select("doc_id", held_out.alias("held_out"), "p.lang_pred", "p.score", "p.rejected")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The rows whose text is near a learned language, with all their columns. Runs jobs."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: F.col(f"c{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text", "lang")}
    model = fit(named.select(*at.values()))
    text = F.col(f"c{docs.columns.index('text')}")
    kept = named.withColumn("p", predict_column(named, text, model)).where("not p.rejected").drop("p")
    return kept.toDF(*docs.columns)
