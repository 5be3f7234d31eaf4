"""Ordered-sequence primitives in two levels, so one long signal is never one task.

A window over a whole signal puts all its rows into one task.  Here each signal is cut into time buckets: one window
pass runs inside a bucket, and a small table with one row per bucket carries values across.  Results equal the plain
window for any bucket width.

Edge cases: null keys are a sequence of their own, rows with a null time form the first bucket of theirs; an empty table gives an
empty result; inner columns take names that the caller's table does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .expr import col

BUCKET = "DAY"


def free_name(taken: list[str], stem: str) -> str:
    """A column name that is not taken."""
    low = {c.lower() for c in taken}
    while stem.lower() in low:
        stem += "_"
    return stem


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    prev: dict[str, str | Column] | None = None,
    sums: dict[str, Column] | None = None,
    bucket: str = BUCKET,
) -> DataFrame:
    """Adds the values in ``prev`` of the row before and the inclusive running sums in ``sums``, in one pass.

    ``order`` is a timestamp, then tie-breakers.  A sum's column may use the names in ``prev``; nulls add nothing.  One shuffle by
    (keys, bucket) serves both the rows and the buckets' summaries: first row, last values and sums of what lies between.
    """
    prev, sums = prev or {}, sums or {}
    own = df.columns
    taken = [*own, *prev, *sums]
    b, lag, head, last = (free_name(taken, f"__{x}") for x in ("bucket", "lag", "head", "last"))
    inner = {n: free_name(taken, f"__in_{n}") for n in sums}
    base = {n: free_name(taken, f"__base_{n}") for n in sums}
    by, place = [*keys, b], F.struct(*order)
    value = F.struct(F.lit(True).alias("seen"), *[col(c).alias(n) for n, c in prev.items()])
    cut = df.withColumn(b, F.date_trunc(bucket, F.col(order[0])))
    w = Window.partitionBy(*by).orderBy(*order)
    rows = cut.withColumn(lag, F.lag(value).over(w))
    follows = F.col(f"{lag}.seen").isNotNull()
    rows = rows.select("*", *[F.col(lag)[n].alias(n) for n in prev])
    rows = rows.select("*", *[F.when(follows, F.coalesce(c, F.lit(0))).alias(inner[n]) for n, c in sums.items()])

    ends = rows.groupBy(*by).agg(
        F.min_by(F.struct(*[F.col(c) for c in own]), place).alias(head), F.max_by(value, place).alias(last), *[F.coalesce(F.sum(inner[n]), F.lit(0)).alias(inner[n]) for n in sums]
    )
    across = Window.partitionBy(*keys).orderBy(b) if keys else Window.orderBy(b)
    ends = ends.withColumn(lag, F.lag(last).over(across))
    ends = ends.select(*[F.col(head)[c].alias(c) for c in own], F.col(b), lag, *inner.values(), *[F.col(lag)[n].alias(n) for n in prev])
    ends = ends.select("*", *[F.coalesce(c, F.lit(0)).alias(base[n]) for n, c in sums.items()])
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    starts = [(F.col(base[n]) + F.coalesce(F.sum(F.col(base[n]) + F.col(inner[n])).over(before), F.lit(0))).alias(base[n]) for n in sums]
    ends = ends.select(*by, *[F.col(n).alias(free_name(taken, f"__from_{n}")) for n in prev], *starts)

    running = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*own, b, lag, *prev, *[F.coalesce(F.sum(inner[n]).over(running), F.lit(0)).alias(inner[n]) for n in sums])
    joined = join_buckets(rows, ends, by)
    follows = F.col(f"{lag}.seen").isNotNull()
    return joined.select(
        *own,
        *[F.when(follows, F.col(n)).otherwise(F.col(free_name(taken, f"__from_{n}"))).alias(n) for n in prev],
        *[(F.col(base[n]) + F.col(inner[n])).alias(n) for n in sums],
    )


def join_buckets(df: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """Left join on the bucket; null keys are a sequence of their own."""
    names = {c: free_name([*df.columns, *small.columns], f"__key{i}") for i, c in enumerate(by)}
    small = small.withColumnsRenamed(names)
    on = None
    for c, n in names.items():
        term = F.col(c).eqNullSafe(F.col(n))
        on = term if on is None else on & term
    return df.join(small, on, "left").drop(*names.values())
