"""Language identification by compression.

``fit`` draws a bounded, seeded sample of labelled rows per language, counts the words of their whole texts, and strings
the most frequent ones together, the most frequent last, as one raw-content zstandard dictionary per language.  A text is cut into
blocks, every block is encoded with every dictionary, and the language with the smallest total wins.  Where the margin between the two
smallest is narrow the decision is rejected: ``rejected`` says so beside the best guess.  Whole texts are read, never prefixes.

Scale: the fit chooses its rows by ids alone (``ROWS`` a language, all where there are fewer), then counts their words in tasks; the
driver gets one dictionary's worth of words a language.  Prediction is one map over the texts without a shuffle.
Edge cases: null texts and texts without a letter are ``und`` with score 0; with nothing to learn from every
text is ``und``; ties go to the language first by code point; words as frequent rank by code point; rows that repeat an id and language
are one row of the sample, the one with the least text; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

BLOCK, LEVEL = 4096, 9
#: Bytes of a dictionary; labelled rows a language that it is learned from.
DICTIONARY, ROWS = 112_640, 512
#: Word separators of the data contracts.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def remainder(modulus: int):
    """crc32 of the id's text, modulo; null ids give null."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def fit(train: DataFrame, rows: int = ROWS, size: int = DICTIONARY) -> dict[str, bytes]:
    """train(doc_id, text, lang) -> a dictionary per language, from the whole texts of ``rows`` rows of each."""
    h = F.xxhash64("doc_id", F.lit("langid"))
    ids = train.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "doc_id", h.alias("h")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = ids.withColumn("place", place).where(F.col("place") <= rows).select("lang", "h", "doc_id")
    texts = train.select("lang", h.alias("h"), "doc_id", "text").where("text IS NOT NULL")
    texts = texts.join(F.broadcast(chosen), (texts["h"] == chosen["h"]) & texts["doc_id"].eqNullSafe(chosen["doc_id"]) & (texts["lang"] == chosen["lang"]), "left_semi")
    texts = texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    words = texts.select("lang", F.explode(F.split(F.lower("text"), SEPARATORS)).alias("w")).where("w <> ''")
    counts = words.groupBy("lang", "w").agg(F.count("*").alias("c"))
    order = Window.partitionBy("lang").orderBy(F.desc("c"), "w")
    counts = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size // 2)
    used = F.sum(F.octet_length("w") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    kept = counts.withColumn("used", used).where((F.col("used") <= size) | (F.col("place") == 1)).select("lang", "place", "w").toArrow()
    parts: dict[str, list[tuple[int, str]]] = {}
    for lang, p, w in zip(*(c.to_pylist() for c in kept.columns), strict=True):
        parts.setdefault(lang, []).append((-p, w))
    return {k: " ".join(w for _, w in sorted(v)).encode()[-size:] for k, v in sorted(parts.items())}


class Encoder:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.langs, self.by_dictionary = list(dictionaries), []
        for raw in dictionaries.values():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by_dictionary.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))

    def decide(self, text: str, narrow: float = 0.04, least: int = 8) -> tuple[str, float, bool]:
        """Language, score and whether the margin was narrow."""
        raw = text.lower().encode()
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.by_dictionary], float)
        rejected = len(sizes) > 1 and bool(np.diff(np.sort(sizes)[:2])[0] < max(least, narrow * sizes.min()))
        weight = np.exp2(-(sizes - sizes.min()) / 4)
        return self.langs[int(np.argmin(sizes))], float(weight.max() / weight.sum()), rejected


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """docs(doc_id, text) -> doc_id, lang_pred, score, rejected."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionaries)

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text, has_letter in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                lang, score, narrow = encoder.decide(text.as_py()) if has_letter and encoder.langs else ("und", 0.0, False)
                langs.append(lang)
                scores.append(score)
                rejected.append(narrow)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predict(docs, fit(docs.where(remainder(4) != 2)))
    return out.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
