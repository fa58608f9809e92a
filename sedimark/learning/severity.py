"""Severity classification with a random forest."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.learning.features import SEVERITY_INPUTS, available, spread
from sedimark.operators.sampling import bounded_sample, train_test
from sedimark.sources.sinks import kept

LABEL = "severity"

# Forest size and seed, split, smallest usable input.
TREES, DEPTH, SEED = 50, 8, 42
TRAIN_SHARE = 0.8
MIN_INPUTS, MIN_TRAIN_ROWS = 3, 100
# Labelled rows used to fit and test the classifier.
SAMPLE_ROWS = 150_000
ROWS_PER_PARTITION = 20_000


@dataclass(frozen=True)
class SeverityRun:
    model: PipelineModel
    inputs: tuple[str, ...]
    predictions: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    accuracy: float


@contextmanager
def training_sample(prepared: DataFrame, key: str, rows: int | None) -> Iterator[DataFrame | None]:
    """At most `rows` prepared rows for the classifier, persisted meanwhile; None without the key column."""
    if key not in prepared.columns:
        yield None
        return
    chosen = prepared
    if rows is not None:
        # Few partitions: each one holds and ships the statistics of a whole tree level.
        chosen = spread(bounded_sample(prepared, rows, [key]), key, -(-rows // ROWS_PER_PARTITION))
    with kept(chosen) as sample:
        yield sample


def confusion_of(predictions: DataFrame) -> DataFrame:
    """Rows per (label, prediction)."""
    return predictions.groupBy(LABEL, "prediction").agg(F.count(F.lit(1)).alias("count"))


def metrics_of(confusion: DataFrame) -> DataFrame:
    """One row: accuracy, support-weighted F1, share of the most frequent label, rows.

    Computed from the confusion counts, so the predictions are evaluated once.
    """
    sized = confusion.select(
        F.col(LABEL).cast("double").alias("label"), F.col("prediction").cast("double").alias("guess"), "count"
    )
    hit = F.when(F.col("label") == F.col("guess"), F.col("count")).otherwise(0)
    # One row per class that occurs as label or as prediction.
    per_class = (
        sized.select(
            F.col("label").alias("class"), F.col("count").alias("support"), F.lit(0).alias("guessed"), hit.alias("hits")
        )
        .unionAll(sized.select(F.col("guess"), F.lit(0), F.col("count"), F.lit(0)))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hits").alias("hits"))
    )
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hits"), F.col("support") + F.col("guessed")), F.lit(0.0))
    total = F.sum("support")
    return per_class.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.try_divide(F.sum(f1 * F.col("support")), total).alias("weighted_f1"),
        F.try_divide(F.max("support"), total).alias("majority_share"),
        total.alias("test_rows"),
    )


def train_severity(
    prepared: DataFrame, keys: tuple[str, ...] = ("id",), trees: int = TREES, depth: int = DEPTH, seed: int = SEED
) -> SeverityRun | None:
    """Fit and evaluate; None when there are too few inputs or training rows. Runs jobs.

    `prepared` is read by the count, each tree level and the evaluation: keep it persisted meanwhile.
    """
    inputs = available(prepared, SEVERITY_INPUTS)
    if len(inputs) < MIN_INPUTS:
        return None
    train, test = train_test(prepared, keys, TRAIN_SHARE, seed)
    if train.count() < MIN_TRAIN_ROWS:
        return None
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed)
    model = Pipeline(stages=[assembler, forest]).fit(train)
    scored = model.transform(test)
    # At most (classes x classes) rows; gathered once, so later readers do not predict again.
    confusion = confusion_of(scored)
    confusion = prepared.sparkSession.createDataFrame(confusion.collect(), confusion.schema)
    metrics = metrics_of(confusion)
    accuracy = metrics.first()["accuracy"]
    predictions = scored.select(
        LABEL,
        "prediction",
        "start_lat",
        "start_lng",
        F.lit("severity_prediction").alias("model_type"),
        F.lit(accuracy).cast("double").alias("accuracy"),
        F.current_timestamp().alias("training_timestamp"),
    )
    return SeverityRun(model, tuple(inputs), predictions, confusion, metrics, accuracy)


def feature_importance(run: SeverityRun, top: int | None = None) -> DataFrame:
    """(feature, importance), largest first; one row per input, so bounded by the schema."""
    weights = run.model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(run.inputs, map(float, weights), strict=True), key=lambda fw: (-fw[1], fw[0]))
    return run.predictions.sparkSession.createDataFrame(ranked[:top], "feature string, importance double")


def score(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """Every row with its predicted severity; a map-only pass, for any number of rows."""
    return model.transform(prepared).select(*prepared.columns, "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
