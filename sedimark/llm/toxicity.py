"""Toxic passages by maximum-scoring segments of token log-odds.

Words get the log-odds of toxic against clean text under an informative Dirichlet prior; a word is taken
with its stems (first letters, fewer than the word has), so unseen forms of a toxic stem count too, the longest
known stem first. A bare stem is judged by itself, as it may be harmless. Only words that are more
frequent in toxic text beyond chance score above zero, every other word costs DRIFT. A linear scan finds all maximal
segments. Scores of the best segment of random text follow an extreme-value law, whose parameters turn
segment scores into evidence; the evidence of all significant segments of a document adds up, and a
logistic curve maps it to the probability of the toxic label.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.llm.labelled import training_texts
from sedimark.llm.tables import crc_fold, stored
from sedimark.llm.text import stretches

# Labelled rows used to fit; their words bound the model.
TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
STEMS, DRIFT, CAP = (4, 5, 6, 7, 8), 0.5, 6.0
PRIOR, EVIDENCE, SHRINK = 0.005, 20.0, 3.0
_WORD = re.compile(r"\w+")
_CACHE = 500_000


@dataclass(frozen=True)
class Toxicity:
    """Scores of words and stems, the extreme-value parameters and the logistic curve."""

    words: dict[str, float]
    stems: dict[str, float]
    rate: float
    scale: float
    slope: float = 1.0
    offset: float = 0.0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of the whole sequence, end exclusive.

    Runs of words above zero are taken together, then each new run is merged into earlier candidates
    while that raises their score. A candidate keeps a link to the nearest earlier one that begins from a lower running
    total; the search for that of a new run jumps along the links, so every link is left behind at most once.
    """
    positive = scores > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).astype(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(scores)))
    totals = total.tolist()
    found: list[tuple[int, int, int]] = []
    for start, end in edges.reshape(-1, 2).tolist():
        left, at = start, len(found) - 1
        while at >= 0 and totals[found[at][0]] >= totals[left]:
            at = found[at][2]
        while at >= 0 and totals[found[at][1]] < totals[end]:
            # Merged into that candidate, the run begins where it does, and so has its link.
            left, before = found[at][0], found[at][2]
            del found[at:]
            at = before
        found.append((left, end, at))
    return [(a, b, totals[b] - totals[a]) for a, b, _ in found]


class Scorer:
    """Scores texts with a model; remembers the words it has met."""

    def __init__(self, model: Toxicity) -> None:
        self.model, self.known = model, {}

    def _score(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            model = self.model
            value = model.words.get(word)
            if value is None:
                known = (model.stems.get(word[:n]) for n in reversed(STEMS) if len(word) > n)
                value = next((v for v in known if v is not None), -DRIFT)
            if len(self.known) >= _CACHE:
                self.known.clear()
            self.known[word] = value
        return value

    def word_scores(self, text: str) -> np.ndarray:
        parts = [
            np.fromiter(map(self._score, _WORD.findall(part.lower())), np.float64) for part in stretches(text)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)

    def evidence(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Combined evidence of the document and its significant segments."""
        scores = self.word_scores(text or "")
        base = math.log1p(self.model.scale * len(scores))
        found = [(a, b, self.model.rate * s - base) for a, b, s in segments(scores)] if (scores > 0).any() else []
        ranked = sorted((s for _, _, s in found), reverse=True)
        best = total = ranked[0] if ranked else -base - 1.0
        for r, s in enumerate(ranked[1:], start=2):
            total += s - math.log(r)
            best = max(best, total)
        # e^-3 is the chance that the best segment of clean text of this length reaches 3.
        return best, [x for x in found if x[2] >= 3.0]

    def probability(self, evidence: float) -> float:
        z = self.model.slope * min(max(evidence, -20.0), 40.0) + self.model.offset
        return 1.0 / (1.0 + math.exp(-min(max(z, -30.0), 30.0)))


def _sketch(words: list[str]) -> int:
    """Smallest hash of the five-word runs; near copies mostly share it."""
    runs = (" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))
    return min(map(xxhash.xxh64_intdigest, runs)) & (2**63 - 1)


@F.pandas_udf(T.LongType())
def _sketches(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda t: _sketch(_WORD.findall(t.lower()))).astype("int64")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per word and label; a word counts once per text, so a text that repeats it weighs no more."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set()
            for part in stretches(text):
                words.update(_WORD.findall(part.lower()))
            counts[1 if label else 0].update(words)
        for label, seen in enumerate(counts):
            if seen:
                columns = [pa.array(list(seen)), pa.array([label] * len(seen), pa.int32()), pa.array(list(seen.values()))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "label", "n"])


def _log_odds(counts: DataFrame, n1: float, n0: float) -> DataFrame:
    """`counts` with delta, the log-odds under a Dirichlet prior in proportion to the overall share, and g.

    g is the likelihood-ratio statistic of the word being more frequent in toxic text, 0 when it is not.
    """
    prior = PRIOR * (n1 + n0)
    share = (F.col("toxic") + F.col("clean")) * PRIOR
    a, b = F.col("toxic") + share, F.col("clean") + share
    delta = F.log(a / (n1 + prior - a)) - F.log(b / (n0 + prior - b))
    both = F.col("toxic") + F.col("clean")
    parts = [
        F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * (n1 + n0) / (both * n))).otherwise(0.0)
        for c, n in (("toxic", n1), ("clean", n0))
    ]
    more = F.col("toxic") * n0 > F.col("clean") * n1
    return counts.withColumn("delta", delta).withColumn("g", F.when(more, 2 * (parts[0] + parts[1])).otherwise(0.0))


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, rows: int = TRAIN_ROWS) -> Toxicity:
    """The model, learned from at most `rows` labelled rows of the training fold. Runs jobs.

    Of near copies one counts, so a text copied often does not make its words look toxic. Without both
    classes in the sample the model knows no toxic word and gives every text a low score.
    """
    fold = crc_fold("doc_id", FOLDS) != HELD_OUT if train is None else train
    texts = training_texts(docs, labels, "toxic", fold, rows)
    single = texts.withColumn("sketch", _sketches("text")).groupBy("sketch").agg(F.min_by(F.struct("text", "label"), "doc_id").alias("d"))
    counted = single.select("d.text", "d.label").mapInArrow(_count, "word string, label int, n bigint")
    toxic, clean = (F.coalesce(F.sum(F.when(F.col("label") == k, F.col("n"))), F.lit(0)) for k in (1, 0))
    words = stored(counted.groupBy("word").agg(toxic.alias("toxic"), clean.alias("clean")), "toxicity-words")
    n1, n0 = words.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n1 or not n0:
        return Toxicity({}, {}, 1.0, 0.1, 1.0, -5.0)
    stem = F.substring("word", 1, STEMS[0])
    long_enough = [F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEMS]
    cut = words.select(F.explode(F.array_compact(F.array(*long_enough))).alias("stem"), "toxic", "clean")
    stems = cut.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stems = stored(_log_odds(stems, n1, n0), "toxicity-stems")
    sure = F.col("g") - EVIDENCE
    stem_rows = stems.where(sure > 0).select("stem", "delta", "clean").collect()
    judged = _log_odds(words, n1, n0).withColumn("stem", stem)
    joined = judged.join(stems.select("stem", F.col("delta").alias("stem_delta"), F.col("g").alias("stem_g")), "stem", "left")
    seen = F.col("toxic") + F.col("clean")
    mean = (F.col("delta") * seen + F.coalesce("stem_delta", "delta") * SHRINK) / (seen + SHRINK)
    stem_sure = F.coalesce(F.col("stem_g") > EVIDENCE, F.lit(False))
    # Words that are toxic for sure, and words of a toxic stem, whose own counts may clear them.
    top_words = joined.where((sure > 0) | (stem_sure & (F.col("clean") > 0))).withColumn("mean", mean)
    word_rows = top_words.orderBy("word").select("word", "mean", "clean").collect()

    def points(value: float) -> float:
        return min(value, CAP) if value > 1.0 else -DRIFT

    word_scores = {r["word"]: points(r["mean"]) for r in word_rows}
    stem_scores = {r["stem"]: points(r["delta"]) for r in stem_rows}
    rate = _decay([(word_scores[r["word"]], (r["clean"] + 0.5) / n0) for r in word_rows])
    model = Toxicity(word_scores, stem_scores, rate, 0.1)

    @F.pandas_udf("double")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in batches:
            yield pd.Series([scorer.evidence(t)[0] for t in batch], dtype="float64")

    # At most `rows` pairs of numbers.
    pairs = texts.select(evidence("text").alias("x"), "label").toPandas()
    slope, offset = logistic(np.clip(pairs["x"].to_numpy(), -20, 40), pairs["label"].to_numpy())
    return Toxicity(word_scores, stem_scores, rate, 0.1, slope, offset)


def _decay(background: list[tuple[float, float]]) -> float:
    """The positive root of sum p * exp(rate * score) = 1 over the words of clean text."""
    above = [(s, p) for s, p in background if s > 0]
    if not above:
        return 1.0
    rest = 1.0 - sum(p for _, p in above)
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        if sum(p * math.exp(mid * s) for s, p in above) + rest * math.exp(-mid * DRIFT) > 1:
            high = mid
        else:
            low = mid
    return low


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope (not negative) and offset of P(y = 1 | x), by Newton steps."""
    if len(x) == 0 or y.min() == y.max():
        return 0.0, 0.0 if len(x) == 0 else (-3.0 if y.max() == 0 else 3.0)
    w, spread = np.zeros(2), max(float(x.std()), 1e-6)
    centre = float(x.mean())
    design = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design / len(x) + ridge * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (p - y) / len(x) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    slope = max(w[0], 0.0)
    return slope / spread, w[1] - slope * centre / spread


def score_column(docs: DataFrame, text: str | Column, model: Toxicity) -> Column:
    """Probability of the toxic label, 0 to 1, for any text; null and empty texts get a low one."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(Toxicity(**shared.value))
        for batch in batches:
            yield pd.Series([scorer.probability(scorer.evidence(t)[0]) for t in batch], dtype="float64")

    return scores(text)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row. Runs jobs.

    Every row is scored, with null or empty text too; rows repeated stay repeated; an empty table gives no
    rows. Only doc_id and text are read.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", score_column(docs, F.col("text"), model).alias("score"))
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores below `threshold`, with all their columns. Runs jobs."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text")}
    model = fit(named.select(at["doc_id"].alias("doc_id"), at["text"].alias("text")), labels)
    kept = named.where(score_column(named, at["text"], model) < threshold)
    return kept.toDF(*docs.columns)
