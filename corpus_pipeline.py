"""A training-corpus pipeline: toxicity, near duplicates, secrets, mixture, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All but the last return the columns of
``documents``.

1. ``toxicity`` drops documents that the subword-bag classifier predicts toxic.
2. ``near_duplicates`` keeps the document with the least doc_id of each group linked by five-word shingles at
   a Jaccard similarity of 0.8 or more.
3. ``secrets`` replaces every secret's span by a mark; documents stay.
4. ``mixture`` repeats or thins documents so sources meet their target weights; one document per source may be
   repeated in part, its first words.
5. ``packing`` cuts and packs the ids of the texts into sequences of 1024.

The stages share the edge cases of the operators they call: nulls in any column, empty texts and tables, repeated
rows and further columns pass without failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapwise.llm import jaccard, mixing, packing, secrets, toxicity
from gapwise.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs, width=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("mixture", mixture_stage),
    ("packing", packing_stage),
]

#: Classifier, join and packing are beyond SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
