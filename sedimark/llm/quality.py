"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are its own and those of its neighbours; the chain links the labels
of consecutive lines. The field learns from documents' labels, which all lines of a document share. Forward
and backward sums give each line's probability of being good; weighted by length they give the document's
share of good text, which a logistic curve maps to the probability of the label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.llm.labelled import training_texts
from sedimark.llm.tables import crc_fold, stored
from sedimark.llm.toxicity import logistic

# Labelled rows used to fit, and the lines that they may have together.
TRAIN_ROWS, TRAIN_LINES = 4_000, 100_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
STEPS, RATE, RIDGE, STEP_RIDGE = 60, 0.15, 1e-3, 0.05
# Lines longer than this are judged in pieces of this many characters, so one endless line is no single unit.
PIECE = 2_000

# The steps at which a share counts as high.
_KNOTS = (0.02, 0.1, 0.25, 0.5, 0.8)
_ENDS = frozenset(".!?:;\"'»)")
_WORDLIKE, _DIGITS, _PLAIN = (re.compile(p) for p in (r"[^\W\d_]+|\s+", r"\D+", r"[.,;:'\"\-()?!«»¿¡]+"))


def line_shares(line: str, earlier: bool) -> list[float]:
    """What a line looks like, each value between 0 and 1; `earlier` when the document had the line before."""
    words = line.split()
    n, size = max(len(words), 1), max(len(line), 1)
    widths = list(map(len, words))
    solid = sum(widths) or 1
    bare = _WORDLIKE.sub("", line)
    letters = solid - len(bare)
    digits = len(_DIGITS.sub("", bare))
    shouts = bare.count("!")
    odd = len(_PLAIN.sub("", bare)) - digits
    upper = sum(len(w) > 2 for w in words if w.isupper())
    lowered = line.lower().split()
    return [
        min(len(words) / 50, 1.0),
        min(solid / n / 20, 1.0),
        max(letters, 0) / solid,
        digits / solid,
        max(odd, 0) / solid,
        min(4 * shouts / n, 1.0),
        upper / n,
        len(set(lowered)) / n if words else 0.0,
        sum(map(eq, lowered, lowered[1:])) / n,
        sum(w <= 3 for w in widths) / n,
        sum(w >= 15 for w in widths) / n,
        1 - solid / size,
        float(bool(words) and line.rstrip()[-1:] in _ENDS),
        float(bool(words) and words[0][:1].isupper()),
        float(earlier),
    ]


SHARES = 15
WIDTH = 3 * SHARES * (1 + len(_KNOTS)) + 3


def document(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of the lines that hold text, one row per line."""
    rows, lengths, seen = [], [], set()
    for line in (text or "").split("\n"):
        for start in range(0, len(line), PIECE):
            piece = line[start : start + PIECE]
            if piece.strip():
                key = hash(piece)
                rows.append(line_shares(piece, key in seen))
                lengths.append(len(piece))
                seen.add(key)
    if not rows:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0)
    own = np.array(rows, np.float32)
    own = np.concatenate([own, *[(own > k).astype(np.float32) for k in _KNOTS]], axis=1)
    blank = np.zeros((1, own.shape[1]), np.float32)
    before, after = np.concatenate([blank, own[:-1]]), np.concatenate([own[1:], blank])
    marks = np.ones((len(own), 3), np.float32)
    marks[1:, 1] = marks[:-1, 2] = 0
    return np.concatenate([own, before, after, marks], axis=1), np.array(lengths, np.float64)


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # of the features towards good
    steps: np.ndarray  # 2 x 2, from label to label
    slope: float
    offset: float


def marginals(emit: np.ndarray, steps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) per line and the expected number of steps between labels, over many chains laid end to end.

    `emit` is the score of good against bad per line; `starts` has the first line of each chain and the end.
    All chains advance together, longest first, so time goes with the longest chain.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    score = np.stack([np.zeros_like(emit), emit], axis=1)
    score = np.exp(score - score.max(axis=1, keepdims=True))
    move = np.exp(steps - steps.max())
    ahead, behind = np.empty_like(score), np.empty_like(score)
    state = np.ones((len(sizes), 2))
    for t in range(longest):
        at = first[: active[t]] + t
        state = score[at] * (state[: active[t]] @ move if t else 1.0)
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    after = np.ones((0, 2))
    for t in range(longest - 1, -1, -1):
        at = first[: active[t]] + t
        new = np.ones((active[t], 2))
        if len(after):
            new[: len(after)] = (after * score[first[: len(after)] + t + 1]) @ move.T
        new /= new.sum(axis=1, keepdims=True)
        behind[at] = after = new
    both = ahead * behind
    both /= both.sum(axis=1, keepdims=True)
    inner = np.ones(len(emit), bool)
    inner[starts[1:] - 1] = False
    here = np.flatnonzero(inner)
    pair = ahead[here][:, :, None] * move[None] * (score[here + 1] * behind[here + 1])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return both[:, 1], pair.sum(axis=0)


def good_share(model_weights: np.ndarray, steps: np.ndarray, text: str | None) -> float:
    """Length-weighted probability of good lines; 0 for a text without any."""
    rows, lengths = document(text)
    if not len(rows):
        return 0.0
    good, _ = marginals(rows @ model_weights, steps, np.array([0, len(rows)]))
    return float((good * lengths).sum() / lengths.sum())


def _logit(share: np.ndarray) -> np.ndarray:
    clipped = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(clipped / (1 - clipped))


def _learn(features: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights by gradient ascent on the likelihood of the line labels, every document counting alike."""
    x = np.concatenate(features).astype(np.float64)
    sizes = np.array([len(f) for f in features])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    y = np.repeat(labels, sizes).astype(np.float64)
    inner = np.ones(len(y), bool)
    inner[starts[1:] - 1] = False
    here = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[here].astype(int), y[here + 1].astype(int)), 1)
    theta = np.zeros(WIDTH + 4)
    first = second = np.zeros(WIDTH + 4)
    for t in range(1, STEPS + 1):
        steps = theta[WIDTH:].reshape(2, 2)
        good, pairs = marginals(x @ theta[:WIDTH], steps, starts)
        grad = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) / len(y)
        # Labels never change within a document, so a firm ridge keeps the steps from outweighing the lines.
        grad -= np.concatenate([RIDGE * theta[:WIDTH], STEP_RIDGE * theta[WIDTH:]])
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta = theta + RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
    return theta[:WIDTH], theta[WIDTH:].reshape(2, 2)


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, rows: int = TRAIN_ROWS) -> Field:
    """The field, learned from at most `rows` labelled rows of the training fold. Runs jobs.

    Rows are taken whole, those of few lines first and in the order of a hash among those of as many, while they have
    at most TRAIN_LINES lines together; the driver holds no more than these lines' features. Without labelled text every document scores one half; with one class only, near that class.
    """
    fold = crc_fold("doc_id", FOLDS) != HELD_OUT if train is None else train
    texts = training_texts(docs, labels, "quality", fold, rows)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 50):
                part = batch.slice(lo, 50)
                made = [document(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.astype(np.float16).tobytes() for f, _ in made], pa.binary()),
                     pa.array([n.tobytes() for _, n in made], pa.binary()), part.column(1), part.column(2),
                     pa.array([len(n) for _, n in made], pa.int64())],
                    ["features", "lengths", "label", "doc_id", "n"],
                )

    kept = texts.select("text", "label", F.col("doc_id").cast("string").alias("doc_id")).mapInArrow(
        summed, "features binary, lengths binary, label int, doc_id string, n bigint"
    )
    kept = stored(kept, "quality-features")
    # One row per sampled document.
    so_far = Window.orderBy("n", F.md5(F.col("doc_id").cast("binary"))).rowsBetween(Window.unboundedPreceding, 0)
    fits = kept.select("doc_id", "n").withColumn("lines", F.sum("n").over(so_far)).where(F.col("lines") <= TRAIN_LINES)
    kept = kept.join(F.broadcast(fits.select("doc_id")), "doc_id", "left_semi").select("features", "lengths", "label")
    # The bounded sample as line features.
    sample = [
        (np.frombuffer(f, np.float16).reshape(-1, WIDTH).astype(np.float32), np.frombuffer(n), label)
        for f, n, label in kept.collect()
        if len(n)
    ]
    if not sample:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), 1.0, 0.0)
    y = np.array([label > 0 for _, _, label in sample]).astype(np.float64)
    weights, steps = _learn([f for f, _, _ in sample], y)
    starts = np.concatenate(([0], np.cumsum([len(f) for f, _, _ in sample])))
    good, _ = marginals(np.concatenate([f @ weights for f, _, _ in sample]), steps, starts)
    lengths = np.concatenate([n for _, n, _ in sample])
    share = np.add.reduceat(good * lengths, starts[:-1]) / np.add.reduceat(lengths, starts[:-1])
    slope, offset = logistic(_logit(share), y)
    return Field(weights, steps, slope, offset)


def score_column(docs: DataFrame, text: str | Column, model: Field) -> Column:
    """Probability of good quality, 0 to 1, for any text; texts without a line of text get the lowest."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        field = Field(**shared.value)
        for batch in batches:
            share = np.array([good_share(field.weights, field.steps, t) for t in batch], dtype=np.float64)
            z = field.slope * _logit(share) + field.offset
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

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
