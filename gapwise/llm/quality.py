"""Quality by random-indexing word vectors and a small calibrated network.

A text's tokens are its words, and the signs between them: each maximal run of letters, of digits or of other marks between
separators is one, letters in lower case.  Random indexing gives each token a fixed sparse ternary index vector, and a context vector:
the sum of the index vectors of its neighbours over the whole texts of the fit's documents.  A document is the mean of its tokens' index
and context vectors, pooled over the whole text, with the shares of tokens that repeat one of the two before them.  A two-layer numpy
network maps that to a logit, and a temperature fitted on documents that the network never saw turns logits into probabilities.

The context vectors count the words of every document, labelled or not, and the network and its temperature learn from every labelled
document that may be learned from: nothing is sampled.  Context vectors are whole numbers, summed up in each task and then by token, so
they do not depend on how rows are dealt out; the driver gets one vector a token bucket.  Pooled documents are stored in shards of about
``SHARD`` rows by a hash of the id; in every round each shard trains on from the common network and the driver averages the shards'
networks by their rows, in shard order.  Scoring is one map over whole texts without a shuffle.  Edge cases: null and empty texts are
scored as an empty pool (the zero vector) and not learned from; without labels of both classes every score is 0.5; labels that are
neither 0 nor 1 are left out; a doc_id counts once a label, with one of its texts chosen by hash; repeated rows and ties get equal
scores; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled
from .common import discard, stored, table
from .langid import remainder
from .textnp import _SEP, Slice, mix64, slices

DIM, NONZERO, BITS, REACH = 32, 4, 15, 2
HIDDEN, ROUNDS, EPOCHS, RATE, SEED = 32, 10, 6, 3e-3, 5
#: Context vectors are multiples of 1 / GRID, so their sums in a block are exact in 32 bits and pools are the same in any batch.
GRID, BLOCK = 1 << 10, 1 << 13
#: Rows of a shard, about: so many pooled documents are in a task's memory at once.
SHARD = 1 << 14
THRESHOLD = 0.5

#: Kinds of bytes: separators, letters (all of those beyond ASCII too), digits, marks.
_KIND = np.full(256, 3, np.uint8)
_KIND[_SEP] = 0
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2


def tokens(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, document number, and how a token repeats (1: the one before, 2: the one before that, 3: both), in text order."""
    kind = _KIND[s.buf]
    if not kind.any():
        return (np.zeros(0, np.int64),) * 3
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge |= s.doc_starts()
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    h, doc = s.hash_spans(starts, ends, lower=True), s.doc_of(starts)
    again = np.zeros(len(h), np.int64)
    again[1:] += (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    again[2:] += 2 * ((h[2:] == h[:-2]) & (doc[2:] == doc[:-2]))
    return (mix64(h + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int64), doc, again


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = np.zeros((1 << BITS, DIM), np.int64)
    for _ in range(NONZERO):
        out[np.arange(1 << BITS), rng.integers(0, DIM, 1 << BITS)] += rng.choice(np.array([-1, 1]), 1 << BITS)
    return out


def _neighbours(batches):
    """(text) -> (token, v): for each token of the task the sum of its neighbours' index vectors, shifted by their place."""
    index = np.concatenate([index_vectors(), np.zeros((1, DIM), np.int64)]).astype(np.int8)  # the last one is no token's
    shifted = {k: np.roll(index, k, axis=1) for k in range(-REACH, REACH + 1) if k}
    out, seen = np.zeros((1 << BITS, DIM), np.int64), np.zeros(1 << BITS, bool)
    for batch in batches:
        for s in slices(batch.column(0), 1 << 18):
            token, doc, _ = tokens(s)
            if not len(token):
                continue
            at = np.arange(len(token)) + REACH * (doc + 1)  # empty places around every document
            row = np.full(len(token) + REACH * (len(s) + 1), 1 << BITS)
            row[at] = token
            near = np.zeros((len(token), DIM), np.int8)  # of at most 2 * REACH * NONZERO
            for k, vectors in shifted.items():
                near += vectors[row[at + k]]
            turn = np.argsort(token.astype(np.uint16), kind="stable")
            first = np.flatnonzero(np.diff(token[turn], prepend=-1))
            names = token[turn[first]]
            out[names] += np.add.reduceat(near[turn], first, axis=0, dtype=np.int64)
            seen[names] = True
    names = np.flatnonzero(seen)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(out[names].ravel()), DIM).cast(pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), lists], names=["token", "v"])


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors by token bucket over all texts, scaled to length one, on the grid."""
    parts = docs.select("text").mapInArrow(_neighbours, "token int, v array<long>")
    got = parts.groupBy("token").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(DIM)]).toArrow()  # a row a bucket
    out = np.zeros((1 << BITS, DIM), np.float32)
    if got.num_rows:
        out[got.column(0).to_numpy()] = np.stack([got.column(k + 1).to_numpy() for k in range(DIM)], axis=1)
    return np.round(out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6) * GRID) / np.float32(GRID)


class Model:
    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.net: tuple | None = None
        self.temperature = 1.0

    def pooled(self, column: pa.Array) -> np.ndarray:
        width = self.vectors.shape[1]
        out = np.zeros((len(column), width + 3), np.float32)
        for s in slices(column):
            token, doc, again = tokens(s)
            count = np.bincount(doc, minlength=len(s))
            part = np.zeros((len(s), width + 3))
            for a in range(0, len(doc), BLOCK):  # a block of vectors stays in cache
                d = doc[a : a + BLOCK]
                at = np.flatnonzero(np.diff(d, prepend=-1))
                part[d[at], :width] += np.add.reduceat(self.vectors[token[a : a + BLOCK]], at, axis=0)
            for k in (1, 2, 3):
                part[:, width + k - 1] = np.bincount(doc[again == k], minlength=len(s))
            out[s.first : s.first + len(s)] = part / np.maximum(count, 1)[:, None]
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.zeros(len(x))
        mean, scale, w1, b1, w2, b2 = self.net
        return np.maximum((x - mean) / scale @ w1 + b1, 0) @ w2 + b2

    def scores(self, column: pa.Array) -> np.ndarray:
        z = np.round(self.logits(self.pooled(column)).astype(np.float64), 4)  # beyond that the order of sums shows
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -30, 30)))


def train(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """Fits the network on four of five pooled documents and the temperature on the rest, all in one shard."""
    held = np.arange(len(y)) % 5 == 4
    return learn(model, lambda f: [f(x, y, held)])


def learn(model: Model, each) -> Model:
    """each(f): what f(x, y, held) gives for every shard, in shard order.  Held rows only set the temperature."""

    def sums(x, y, held):
        kept = x[~held].astype(np.float64)
        return np.bincount(y[~held], minlength=2), np.bincount(y, minlength=2), kept.sum(0), (kept * kept).sum(0)

    parts = each(sums)
    if not parts or not sum(p[0] for p in parts).all():
        return model
    count, total, first, second = (sum(p[k] for p in parts) for k in range(4))
    mean = first / count.sum()
    scale = np.sqrt(np.maximum(second / count.sum() - mean * mean, 0)) + 1e-3
    mean, scale, weight = mean.astype(np.float32), scale.astype(np.float32), (0.5 * count.sum() / count).astype(np.float32)
    rng = np.random.default_rng(SEED)
    width = len(mean)
    params = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32), np.zeros((), np.float32)]
    for turn in range(ROUNDS):

        def on(x, y, held, params=params, turn=turn):
            return int((~held).sum()), _epochs(params, ((x - mean) / scale)[~held], y[~held], weight, turn)

        parts = each(on)
        params = [np.asarray(sum(n * p[i].astype(np.float64) for n, p in parts) / count.sum(), np.float32) for i in range(len(params))]
    model.net = (mean, scale, *params)
    net, grid = Model(np.zeros((0, 0), np.float32)), np.geomspace(0.25, 8, 60)
    net.net = model.net

    def losses(x, y, held):
        """Of the held rows at every temperature, both classes weighing the same."""
        z, t = net.logits(x[held]).astype(np.float64), y[held]
        signed = np.where(t == 1, -z, z)
        return np.array([(np.logaddexp(0, signed / g) * weight[t]).sum() for g in grid])

    if (total > count).any():
        model.temperature = float(grid[int(np.argmin(sum(each(losses))))])
    return model


def _epochs(params: list, z: np.ndarray, y: np.ndarray, weight: np.ndarray, turn: int) -> list:
    """A round on one shard: some epochs of Adam from the common network, slower from round to round."""
    t, rng, rate = y.astype(np.float32), np.random.default_rng((SEED, turn)), RATE * (1 - turn / ROUNDS)
    params, step = list(params), 0
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(t)), max(1, len(t) // 64)) if len(t) else ():
            w1, b1, w2, b2 = params
            hidden = np.maximum(z[part] @ w1 + b1, 0)
            out = 1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30)))
            d = (out - t[part]) * weight[y[part]] / len(part)
            back = np.outer(d, w2) * (hidden > 0)
            grads = [z[part].T @ back + 1e-4 * w1, back.sum(0), hidden.T @ d + 1e-4 * w2, d.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return params


def pooled_rows(docs: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """(h, y, x) of every labelled document that may be learned from, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def pool(batches):
        for batch in batches:
            x = shared.value.pooled(batch.column(2))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "t", "x"])

    texts = docs.where(F.col("text") != "").where(remainder(3) != 1).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    pools = texts.mapInArrow(pool, "doc_id long, t long, x array<float>").groupBy("doc_id").agg(F.min(F.struct("t", "x"))["x"].alias("x"))
    marks = labels.where(F.col("quality").isin(0, 1) & (remainder(3) != 1))
    marks = marks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).distinct()
    return stored(pools.join(marks, "doc_id").select(F.xxhash64("doc_id", F.lit("quality")).alias("h"), "y", "x"), "pooled")


def sharded(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """Stored so that a file holds whole shards, one after the other, each in the order of its hashes."""
    many = max(1, -(-rows.count() // shard))
    rows = rows.withColumn("shard", F.pmod(F.shiftrightunsigned("h", 20), F.lit(many)).cast("int"))
    return stored(rows.repartition(many, "shard").sortWithinPartitions("shard", "h", "y"), "shards")


def over(shards: DataFrame, width: int):
    """The ``each`` of ``learn``: a row to the driver for each shard."""

    def each(f):
        def run(batches):
            def ended(parts):
                h, y, x = (np.concatenate(c) for c in zip(*parts, strict=True))
                return f(x.reshape(-1, width), y, h % 5 == 4)

            at, parts = None, []
            for batch in batches:
                shard = batch.column("shard").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if a == b:
                        continue
                    if parts and shard[a] != at:
                        yield at, ended(parts)
                        parts = []
                    part = batch.slice(a, b - a)
                    at = int(shard[a])
                    parts.append((part.column("h").to_numpy(), part.column("y").to_numpy(), part.column("x").flatten().to_numpy()))
            if parts:
                yield at, ended(parts)

        def rows(batches):
            for at, got in run(batches):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([pickle.dumps(got)], pa.binary())], names=["shard", "got"])

        got = shards.select("shard", "h", "y", "x").mapInArrow(rows, "shard int, got binary").toArrow().to_pylist()
        return [pickle.loads(r["got"]) for r in sorted(got, key=lambda r: (r["shard"], r["got"]))]

    return each


def fit(docs: DataFrame, labels: DataFrame, shard: int = SHARD) -> Model:
    model = Model(np.concatenate([index_vectors().astype(np.float32), context_vectors(docs)], axis=1))
    rows = pooled_rows(docs, labels, model)
    shards = sharded(rows, shard)
    discard(rows)
    learn(model, over(shards, model.vectors.shape[1] + 3))
    discard(shards)
    return model


def op10(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return labelled.contract(labelled.score(docs, fit(docs, table(spark, sf_dir, "labels")), THRESHOLD))
