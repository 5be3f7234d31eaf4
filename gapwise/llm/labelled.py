"""Bounded samples of labelled documents for the classifiers, and one-pass scoring."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .langid import remainder


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, seed: str) -> DataFrame:
    """(h, y, text): the whole texts of ``per_class`` labelled documents of each class, of all where there are fewer; stored.

    The choice depends on ids alone, the least hashes of each class among the documents that may be learned from.  A doc_id counts
    once, with its least text; an id that is labelled both ways may be in both classes.
    """
    rows = labels.where(F.col(label).isin(0, 1) & (remainder(3) != 1))
    rows = rows.select("doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id", F.lit(seed)).alias("h")).distinct()
    rows = rows.join(docs.where("text <> ''").select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = [rows.where(F.col("y") == k).orderBy("h", "doc_id").limit(per_class) for k in (0, 1)]  # each task keeps its least hashes
    chosen = chosen[0].union(chosen[1])
    texts = docs.select("doc_id", "text").where("text <> ''").join(F.broadcast(chosen), "doc_id")
    return stored(texts.groupBy("doc_id", "y", "h").agg(F.min("text").alias("text")).select("h", "y", "text"), "labelled")


def score(docs: DataFrame, model, threshold: float) -> DataFrame:
    """docs(doc_id, text) -> doc_id, score, predicted; ``model`` has ``scores(arrow strings)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            p = shared.value.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype("int32"))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def contract(out: DataFrame) -> DataFrame:
    return out.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")
