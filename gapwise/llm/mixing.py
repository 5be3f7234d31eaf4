"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions.  [native]

``targets`` divides a budget of words among sources by weight.  No source may be repeated more than
``max_epochs`` times; a source that would be is clamped there, and its excess goes to the others by weight,
again and again until none is above.  ``mix`` then draws: every document of a source whole as many times as its
epochs allow, and once more those that come first in a seeded order until the target is met.  The document
on which the target falls is repeated fractionally, so a source takes its target to the word.

Scale: documents never move.  A source's cut in the seeded order is found by radix: sums by (source, hash
digit) are pre-aggregated, so a source holding a third of all rows costs no more than any other, and only the
documents of one cell of 1/16,777,216 of the hash range are sorted.

Edge cases: null and empty texts have size 0 and are taken 0 words; a null source is a source, ordered last;
repeated rows are separate documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, stored

WORD = r"[^\x20\x09-\x0D]+"
_DIGIT = 3  # hexadecimal digits of the hash by radix step


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ..., cycle, repeating, by the sources' code-point order, null last."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(w) - 1) % cycle + 1).cast("double"))


def targets(sources: DataFrame, max_epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """sources(source, source_size, weight) -> + target.  Each round is one aggregate over the source table."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    rows = sources.agg(F.sum("source_size")).first()
    level, budget = None, float((rows[0] or 0) * share)
    while True:
        open_ = F.lit(True) if level is None else F.col("weight") * F.lit(level) <= cap
        kept, weight = sources.agg(F.sum(F.when(~open_, cap).otherwise(0.0)), F.sum(F.when(open_, F.col("weight")).otherwise(0.0))).first()
        if not weight:
            break
        raised = (budget - kept) / weight
        if level is not None and raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(float(level or 0.0))) if level is not None else F.lit(0.0))


def mix(docs: DataFrame, weights=cyclic_weights, max_epochs: float = 3.0, share: float = 1.0, seed: str = "mix", keep: tuple = ()) -> DataFrame:
    """docs(doc_id, text, source) -> doc_id, size, source_size, target, taken, source and the columns in ``keep``."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), h.alias("__h"), *[c for c in keep if c not in ("doc_id", "source")])
    rows = stored(rows, "mix-rows")
    sources = stored(weights(stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")), "mix-weights")
    plan = targets(sources, max_epochs, share)
    want = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.least((want / F.col("source_size")).cast("long"), F.lit(int(max_epochs)))).otherwise(0).cast("long")
    plan = plan.withColumn("__whole", whole).withColumn("__left", want - F.col("__whole") * F.col("source_size")).drop("weight")
    plan = stored(plan, "mix-plan")

    def crossing(cells: DataFrame, digit: str) -> DataFrame:
        """The cell of each source in which the words left run out, and the words left on reaching it."""
        w = Window.partitionBy("source").orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("__before", F.coalesce(F.sum("__s").over(w), F.lit(0)))
        return cells.where((F.col("__before") < F.col("__left")) & (F.col("__left") <= F.col("__before") + F.col("__s")))

    d1, d2 = F.substring("__h", 1, _DIGIT), F.substring("__h", _DIGIT + 1, _DIGIT)
    one = rows.groupBy("source", d1.alias("__d1")).agg(F.sum("size").alias("__s"))
    one = crossing(one.join(plan.select(F.col("source").alias("__src"), "__left"), F.col("source").eqNullSafe(F.col("__src"))), "__d1")
    one = stored(one.select("__src", F.col("__d1").alias("__c1"), (F.col("__left") - F.col("__before")).alias("__left")), "mix-cut1")
    two = rows.withColumn("__d1", d1).join(one, F.col("source").eqNullSafe(F.col("__src")) & (F.col("__d1") == F.col("__c1")))
    two = crossing(two.groupBy("source", "__src", "__c1", "__left", d2.alias("__d2")).agg(F.sum("size").alias("__s")), "__d2")
    cut = stored(two.select("__src", "__c1", F.col("__d2").alias("__c2"), (F.col("__left") - F.col("__before")).alias("__cell_left")), "mix-cut2")

    full = stored(plan.withColumnRenamed("source", "__p").join(cut, F.col("__p").eqNullSafe(F.col("__src")), "left").drop("__src"), "mix-cuts")
    out = rows.join(bounded(full, full.count(), 100_000), F.col("source").eqNullSafe(F.col("__p"))).drop("__p")
    place = F.concat(F.coalesce("__c1", F.lit("")), F.coalesce("__c2", F.lit("")))
    out = out.withColumn("__cmp", F.when(F.col("__c1").isNull(), 1).when(F.substring("__h", 1, 2 * _DIGIT) < place, -1).when(F.substring("__h", 1, 2 * _DIGIT) > place, 1).otherwise(0))
    sure = out.where("__cmp <> 0").withColumn("__extra", F.when(F.col("__cmp") < 0, F.col("size")).otherwise(F.lit(0)))
    w = Window.partitionBy("source", "__c1", "__c2").orderBy("__h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = out.where("__cmp = 0").withColumn("__b", F.coalesce(F.sum("size").over(w), F.lit(0)))
    edge = edge.withColumn("__extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("__cell_left") - F.col("__b")))).drop("__b")
    both = sure.unionByName(edge).withColumn("taken", (F.col("__whole") * F.col("size") + F.col("__extra")).cast("long"))
    return both.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "source", *[c for c in keep if c not in ("doc_id", "source")])


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: one row per repetition, in the columns of ``docs``; a fractional one keeps its first words."""
    cols = docs.columns
    whole = docs.select("doc_id", "text", "source", F.struct(*cols).alias("__doc"))  # a struct: no name of theirs clashes with one of ours
    plan = mix(whole, keep=("__doc",), **how)
    reps = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(F.when(F.col("target") > 0, 1).otherwise(0)).cast("int")
    out = plan.where(reps > 0).withColumn("__rep", F.explode(F.sequence(F.lit(1), reps)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("__rep") - 1) * F.col("size"))
    out = out.select("__doc", F.when(words < F.col("size"), _first_words(F.col("__doc.text"), words)).alias("__cut")).select("__doc.*", "__cut")
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.coalesce(F.length("__cut").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.withColumn("text", F.coalesce("__cut", "text")).select(*cols)


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    k = n.cast("int")
    steps = F.arrays_zip(F.slice(F.split(text, WORD, -1), 1, k).alias("g"), F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, k).alias("w"))
    return F.array_join(F.transform(steps, lambda x: F.concat(x["g"], x["w"])), "")


ORACLE_OP1 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
             sum(source_size) OVER () AS total FROM w),
l AS (SELECT arg_min((total - cap_before) / weight_left, cap / weight) FILTER (WHERE (total - cap_before) / weight_left <= cap / weight) AS level FROM r),
t AS (SELECT source, source_size, least(cap, weight * level) AS target FROM r, l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(floor(target + 0.5) / source_size) AS BIGINT), 3) ELSE 0 END AS whole FROM t),
q AS (SELECT d.*, p.source_size, p.target, p.whole, CAST(floor(p.target + 0.5) AS BIGINT) - p.whole * p.source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM q
"""


def op1(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")
