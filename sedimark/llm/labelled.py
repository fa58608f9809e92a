"""The bounded training sample that the classifiers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.llm.tables import stored
from sedimark.operators.sampling import bounded_sample


def training_texts(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled documents of the training fold. Runs jobs.

    The labels are sampled first, by a hash of the id, so only a bounded list of ids meets the documents.
    Rows without id, label or text are left out; of contradicting labels of one id the larger counts, of different
    texts of one id the smallest.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = stored(bounded_sample(known, rows, ["doc_id"]), "labelled-ids")
    # At most `rows` ids and labels: 12 bytes each.
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return stored(texts, "labelled-texts")
