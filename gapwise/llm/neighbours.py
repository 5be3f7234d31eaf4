"""Approximate nearest neighbours by inner product: inverted file, product-quantised residuals, exact reranking.

``fit`` trains coarse centroids and residual codebooks in numpy on a bounded, seeded sample (``SAMPLE`` vectors);
every row is then indexed: its cell, and one byte per ``SUB`` components of its residual.  A query visits the
cells with the largest inner products and scores their rows from a table of its own (cell part plus one lookup a
byte).  Each row knows how far its code is from its vector, which bounds its true score from both sides.  Every row
whose upper bound reaches the k-th best lower bound of its block is reranked there on the original vectors in double
precision, so the result is exact among the rows of the visited cells, however close their codes are.

How many cells a query visits is tuned on the sample: the fewest that hold ``TARGET`` of the sample's true
neighbours.  A query's k-th best row of the sample within these cells is also a lower bound.

Scale: rows and queries meet by cell in blocks of at most ``BLOCK`` rows and ``BLOCK`` queries; a cell with more is
split by hash on both sides, so one repeated vector that fills a third of the table is many equal blocks.  Only
a query's k best leave a block.  The number of cells grows with the square root of the rows.

A vec_id with several vectors counts once wherever ranks are taken: bounds, blocks and the number of rows in reach go
by distinct ids.  Equal rows become one first, and blocks are drawn by id and vector, so a frequent id is many blocks.

Edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite components, and
rows with a null vec_id, take no part; equal scores rank by smaller vec_id; a repeated vec_id counts once
with its best score; queries with fewer candidates return all; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored, table

SAMPLE, SUB, CODES, BLOCK, SEED, TARGET = 20_000, 2, 256, 2048, 3, 0.94


def vector_type(rows: DataFrame) -> str:
    """Single precision where it is stored so, else double: scores are those of the stored numbers."""
    return "array<float>" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"


def usable(rows: DataFrame) -> DataFrame:
    """rows(vec_id, embedding) that take part."""
    v = F.col("embedding").cast(vector_type(rows))
    ok = v.isNotNull() & F.col("vec_id").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(F.coalesce(ok, F.lit(False)))
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("embedding") == (sizes["d"] if sizes else 0))


def matrix(column: pa.Array, kind=np.float32) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 1), kind)


def kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    x = x.astype(np.float32)
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    c = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        at = _nearest(x, c)
        count = np.bincount(at, minlength=k)
        new = np.stack([np.bincount(at, x[:, j], k) for j in range(x.shape[1])], axis=1) / np.maximum(count, 1)[:, None]
        empty = count == 0
        new[empty] = x[rng.choice(len(x), int(empty.sum()))]
        c = new.astype(np.float32)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T - half, axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def rounding(d: int) -> float:
    """Relative error of a sum of d products in single precision, at most."""
    return (d + 12) * 1.2e-7


def kth(score: np.ndarray, k: int, ids: np.ndarray) -> np.ndarray:
    """The k-th largest of each row, by the best column of each of the sorted ``ids``; minus infinity where there are fewer."""
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    if len(first) < len(ids):
        score = np.maximum.reduceat(score, first, axis=1)
    if score.shape[1] < k:
        return np.full(len(score), -np.inf)
    return np.partition(score, score.shape[1] - k, axis=1)[:, -k].astype(np.float64)


def _again(marks: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which marked places come after another marked one of the same id; ``ids`` are sorted."""
    at = np.flatnonzero(marks)
    out = np.zeros(len(marks), bool)
    out[at[1:][ids[at[1:]] == ids[at[:-1]]]] = True
    return out


class Index:
    """Centroids and codebooks; small enough to ship with tasks."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, cells: int, k: int = 20):
        turn = np.argsort(ids, kind="stable")
        sample, ids = sample[turn], ids[turn]
        self.sample, self.ids, self.k = sample, ids, k
        rng = np.random.default_rng(SEED)
        self.centroids = kmeans(sample, cells, rng)
        rest = sample - self.centroids[_nearest(sample, self.centroids)]
        d = sample.shape[1]
        self.parts = [(a, min(a + SUB, d)) for a in range(0, d, SUB)]
        self.books = [kmeans(rest[:, a:b], CODES, rng, 8) for a, b in self.parts]

        self.cell = cell = _nearest(sample, self.centroids)
        distinct = np.unique(sample, axis=0, return_index=True)[1]  # a vector that repeats is one query here
        probes = rng.choice(distinct, min(len(distinct), 400), replace=False)
        score = sample[probes] @ sample.T
        score[ids[probes][:, None] == ids[None, :]] = -np.inf
        one = np.unique(ids, return_index=True)[1]
        if len(one) < len(ids):  # of each id, its best vector
            top = np.repeat(np.maximum.reduceat(score, one, axis=1), np.diff(np.append(one, len(ids))), axis=1)
            score[(score < top) | np.stack([_again(row, ids) for row in score == top])] = -np.inf
        best = np.argsort(-score, axis=1, kind="stable")[:, : min(k, len(one) - 1)]
        place = np.argsort(np.argsort(-(sample[probes] @ self.centroids.T), axis=1, kind="stable"), axis=1)
        needed = np.take_along_axis(place, cell[best], 1) + 1
        self.visits = int(np.quantile(needed, TARGET)) if needed.size else 1

    def floor(self, q: np.ndarray, qids: np.ndarray, visited: np.ndarray) -> np.ndarray:
        """A lower bound on each query's k-th best score in the cells that ``visited`` (queries by cells) marks."""
        score = q @ self.sample.T
        score[(qids[:, None] == self.ids[None, :]) | ~visited[:, self.cell]] = -np.inf
        return kth(score, self.k, self.ids) - rounding(q.shape[1]) * norms(q) * norms(self.sample).max()

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, code, and a bound on how far the vector's scores are from the code's, for a query of length one."""
        cell = _nearest(x, self.centroids)
        rest = x - self.centroids[cell]
        code = np.stack([_nearest(rest[:, a:b], book) for (a, b), book in zip(self.parts, self.books, strict=True)], axis=1).astype(np.uint8)
        near = np.concatenate([book[code[:, j]] for j, book in enumerate(self.books)], axis=1)
        base = self.centroids[cell]
        return cell, code, norms(x.astype(np.float64) - base - near) + rounding(x.shape[1]) * (norms(base) + norms(near))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query and part, the inner product with every codeword."""
        out = np.zeros((len(q), len(self.parts), CODES), np.float32)
        for j, ((a, b), book) in enumerate(zip(self.parts, self.books, strict=True)):
            for d in range(b - a):  # no matrix product: equal codes must score equally in every block, to the last bit
                out[:, j, : len(book)] += q[:, a + d, None] * book[None, :, d]
        return out


def fit(rows: DataFrame, n: int, k: int = 20) -> Index | None:
    sample = rows.orderBy(F.xxhash64("vec_id", "embedding", F.lit(SEED)), "vec_id", "embedding").limit(SAMPLE).select("vec_id", "embedding").toArrow()
    if not sample.num_rows:
        return None
    return Index(matrix(sample.column(1)), sample.column(0).to_numpy(), max(1, min(4096, int(math.sqrt(n)))), k)


def search(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The k best rows of each query: query_id, rank, vec_id, score.  Both inputs are vec_id, embedding."""
    spark = rows.sparkSession
    rows = stored(usable(rows).distinct(), "vectors")
    queries = stored(usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    n = rows.count()
    index = fit(rows, n, k)
    out = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], out)
    shared = spark.sparkContext.broadcast(index)
    kind, parts = vector_type(rows), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches):
        for batch in batches:
            cell, code, off = shared.value.encode(matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(off), batch.column(1)], names=["vec_id", "cell", "code", "off", "v"])

    codes = stored(rows.mapInArrow(encode, f"vec_id long, cell int, code binary, off double, v {kind}"), "codes")
    discard(rows)
    held = {r["cell"]: r["c"] for r in codes.groupBy("cell").agg(F.count("*").alias("c")).collect()}  # one row a cell
    reach = {r["cell"]: r["c"] for r in codes.groupBy("vec_id").agg(F.min("cell").alias("cell")).groupBy("cell").agg(F.count("*").alias("c")).collect()}
    counts = np.array([held.get(c, 0) for c in range(len(index.centroids))])
    fresh = np.array([reach.get(c, 0) for c in range(len(index.centroids))])  # each id in one of its cells

    def probe(batches):
        ix = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                q = matrix(batch.column(1))
                order = np.argsort(-(q @ ix.centroids.T), axis=1, kind="stable")
                enough = np.argmax(np.cumsum(fresh[order], axis=1) >= min(4 * k, fresh.sum()), axis=1) + 1
                take = np.maximum(enough, ix.visits)
                who = np.repeat(np.arange(len(q)), take)
                cell = np.concatenate([row[:t] for row, t in zip(order, take, strict=True)])
                visited = np.zeros((len(q), len(counts)), bool)
                visited[who, cell] = True
                floor = ix.floor(q, batch.column(0).to_numpy(), visited)
                at = pa.array(who)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(cell.astype(np.int32)), pa.array(floor[who]), batch.column(1).take(at)], names=["query_id", "cell", "floor", "q"])

    probes = stored(queries.repartition(parts, "vec_id").mapInArrow(probe, f"query_id long, cell int, floor double, q {kind}"), "probes")
    asked = {r["cell"]: r["c"] for r in probes.groupBy("cell").agg(F.count("*").alias("c")).collect()}
    splits = spark.createDataFrame([(int(c), max(1, -(-int(counts[c]) // BLOCK)), max(1, -(-int(asked.get(c, 0)) // BLOCK))) for c in range(len(counts))], "cell int, rows_in int, queries_in int")
    splits = F.broadcast(splits)  # one row a cell, at most 4096
    left = codes.join(splits, "cell").withColumn("a", F.pmod(F.xxhash64("vec_id", "v"), "rows_in").cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("queries_in") - 1))).select("cell", "a", "b", "vec_id", "code", "off", "v")
    right = probes.join(splits, "cell").withColumn("b", F.pmod(F.xxhash64("query_id"), "queries_in").cast("int")).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("rows_in") - 1))).select("cell", "a", "b", "query_id", "floor", "q")

    def meet(rows_: pa.Table, asks: pa.Table) -> pa.Table:
        ids, qids = rows_.column("vec_id").to_numpy(), asks.column("query_id").to_numpy()
        got: list[list[np.ndarray]] = [[], [], []]
        if len(ids) and len(qids):
            ix = shared.value
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            code = np.frombuffer(b"".join(rows_.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)[order]
            off, x = rows_.column("off").to_numpy()[order], matrix(rows_.column("v"), np.float64)[order]
            base = ix.centroids[rows_.column("cell")[0].as_py()]
            q, floor = matrix(asks.column("q"), np.float64), asks.column("floor").to_numpy()
            for i in range(0, len(q), 256):
                part, least = q[i : i + 256], floor[i : i + 256]
                tables = ix.tables(part.astype(np.float32))
                score = np.repeat((part.astype(np.float32) * base).sum(1)[:, None], len(ids), axis=1)
                for j in range(code.shape[1]):
                    score += tables[:, j, :][:, code[:, j]]
                score[qids[i : i + 256, None] == ids[None, :]] = -np.inf
                width = norms(part)[:, None] * off[None, :]
                keep = (score + width >= np.maximum(least, kth(score - width, k, ids))[:, None]) & np.isfinite(score)
                asking, some = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
                if not len(some):
                    continue
                # Exact scores of all that remain; those near a query's k-th best are added up once more, always in the same order.
                wide = part[asking]
                exact = np.where(keep[np.ix_(asking, some)], wide @ x[some].T, -np.inf)
                slack = 1e-14 * x.shape[1] * norms(wide) * norms(x[some]).max()
                who, what = np.nonzero((exact >= np.maximum(kth(exact, k, ids[some]), least[asking])[:, None] - slack[:, None]) & np.isfinite(exact))
                total = np.zeros(len(who))
                for j in range(x.shape[1]):
                    total += wide[who, j] * x[some[what], j]
                who, what = qids[i : i + 256][asking[who]], ids[some[what]]
                turn = np.lexsort((what, -total, who))
                who, what, total = who[turn], what[turn], total[turn]
                first = np.unique(np.stack([who, what], axis=1), axis=0, return_index=True)[1]  # an id's best score
                first.sort()
                who, what, total = who[first], what[first], total[first]
                best = np.arange(len(who)) - np.searchsorted(who, who) < k
                for one, values in zip(got, (who[best], what[best], total[best]), strict=True):
                    one.append(values)
        flat = [np.concatenate(p) if p else np.zeros(0) for p in got]
        return pa.table({"query_id": pa.array(flat[0].astype(np.int64)), "vec_id": pa.array(flat[1].astype(np.int64)), "score": pa.array(flat[2].astype(np.float64))})

    keys = ("cell", "a", "b")
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % 20 == 0))
