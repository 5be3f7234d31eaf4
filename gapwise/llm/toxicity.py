"""Toxicity by subword bags: averaged n-gram embeddings under a linear softmax, trained jointly in numpy.

A word's character n-grams (``ORDERS`` bytes, lower case, with word boundaries) are hashed into ``BUCKETS``
embeddings.  A document is the average of its n-grams' embeddings, a word that repeats the one before it left out; a linear softmax on top gives the class.  Both
are trained together, so a misspelling the fit never saw still shares most n-gram vectors with what it
imitates.  For scoring, embeddings and softmax fold into one weight per bucket: the same number, one lookup.

The fit reads the whole texts of ``PER_CLASS`` labelled documents of each class (all where there are fewer) and turns them into
bags in tasks.  Of every clean one a short run of words is learned as a clean text of its own, n-grams
of fewer than ``LEAST`` documents are not learned, and ``SHRINK`` pulls small bags to the prior, so a few harmless words stay below the
threshold.  Scoring reads every whole text in one map without a shuffle.  Edge cases: null and empty texts get the score of an
empty bag, which is below the threshold; without labels of both classes every score is 0; labels that are neither 0 nor 1
are left out; repeated rows and ties get equal scores; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled
from .common import give_back, stored, table
from .textnp import _SEP, Slice, slices

ORDERS, BITS, DIM = (3, 4, 5, 6), 18, 8
PER_CLASS, EPOCHS, RATE, SEED = 1500, 12, 0.2, 11
#: Words of the longest short run.
RUN = 24
THRESHOLD = 0.7
#: So many n-grams of no meaning are added to every average: short bags stay near the prior.
SHRINK = 300
#: Of the fit's documents so many at least must hold an n-gram that is learned; a chance one says nothing.
LEAST = 5

_VALUE = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 31, 256).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_SEP] = _VALUE[32]


def _spaced(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The slice's bytes with a separator before and after every document, and the documents' bounds there."""
    n = len(s)
    out = np.full(len(s.buf) + 2 * n, 32, np.uint8)
    size = np.diff(s.offs)
    out[np.arange(len(s.buf)) + np.repeat(2 * np.arange(n) + 1, size)] = s.buf
    return out, s.offs + 2 * np.arange(n + 1)


def _fresh(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """False over words that repeat the word before them, so a stutter counts once in the average."""
    spaced = Slice(0, buf, bounds)
    starts, ends = spaced.words()
    h = spaced.hash_spans(starts, ends, lower=True)
    doc = spaced.doc_of(starts)
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) + 1
    step = np.zeros(len(buf) + 1, np.int8)
    step[starts[again] - 1] += 1
    step[ends[again]] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) == 0


def grams(s: Slice):
    """For each order, the bucket at every byte of the spaced slice, and whether an n-gram inside a word starts there."""
    buf, bounds = _spaced(s)
    value, sep = _VALUE[buf], _SEP[buf]
    h = np.zeros(len(buf), np.uint32)
    run = np.ones(len(buf), bool)  # no separator strictly inside
    fresh = _fresh(buf, bounds)
    for k in range(max(ORDERS)):
        m = len(buf) - k
        if m <= 0:
            return
        h[:m] = h[:m] * np.uint32(0x01000193) + value[k:]
        if k >= 2:
            run[:m] &= ~sep[k - 1 : k - 1 + m]
            run[m:] = False
        if k + 1 in ORDERS:
            mixed = h[:m] * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            ok = run[:m] & ~(sep[:m] & sep[k:]) & fresh[:m]
            yield (mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS), ok, bounds


class Model:
    def __init__(self, weight: np.ndarray, bias: float, shift: float):
        self.weight, self.bias, self.shift = weight, bias, shift

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), 0.0)
        for s in slices(column):
            total, count = np.zeros(len(s)), np.zeros(len(s))
            for bucket, ok, bounds in grams(s):
                cum = np.concatenate([[0.0], np.cumsum(np.where(ok, self.weight[bucket], 0), dtype=np.float64)])
                many = np.concatenate([[0], np.cumsum(ok)])
                at = np.minimum(bounds, len(bucket))
                total += np.diff(cum[at])
                count += np.diff(many[at])
            z = self.bias + self.shift + total / (count + SHRINK)
            z[count == 0] = self.shift + min(self.bias, -1.0)  # an empty bag is never above the threshold
            out[s.first : s.first + len(s)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _bags(texts: pa.Array):
    """Distinct buckets and their shares, for each document."""
    for s in slices(texts, 1 << 18):
        parts = [(b, ok, bounds) for b, ok, bounds in grams(s)]
        for d in range(len(s)):
            ids = [b[(at := np.minimum(bounds[d : d + 2], len(b)))[0] : at[1]][ok[at[0] : at[1]]] for b, ok, bounds in parts]
            bucket, count = np.unique(np.concatenate(ids) if ids else np.zeros(0, np.uint32), return_counts=True)
            yield bucket.astype(np.int32), (count / (SHRINK + count.sum())).astype(np.float32)


def short_run(text: str, h: int) -> str:
    """Up to ``RUN`` neighbouring words from anywhere in the text, drawn by the hash."""
    words = text.split()
    if not words:
        return ""
    size = 1 + (h >> 8) % min(RUN, len(words))
    start = (h >> 20) % (len(words) - size + 1)
    return " ".join(words[start : start + size])


def _bag_rows(batches):
    for batch in batches:
        hashes, y, texts = (c.to_pylist() for c in batch.columns)
        rows = [(h, k, 0, t) for h, k, t in zip(hashes, y, texts, strict=True)]
        rows += [(h, 0, 1, short_run(t, h & (1 << 63) - 1)) for h, k, t in zip(hashes, y, texts, strict=True) if k == 0]
        bags = list(_bags(pa.array([r[3] for r in rows], pa.string())))
        cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        cols += [pa.array([b for b, _ in bags], pa.list_(pa.int32())), pa.array([v for _, v in bags], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(cols, names=["h", "y", "short", "bucket", "share"])


def pack(bucket: np.ndarray, share: np.ndarray) -> bytes:
    """A bag in few bytes: steps between its ascending buckets, then the shares, compressed."""
    return zlib.compress(np.diff(bucket, prepend=0).astype("<u4").tobytes() + share.astype("<f4").tobytes(), 1)


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(raw)
    n = len(raw) // 8
    return np.cumsum(np.frombuffer(raw, "<u4", n)).astype(np.int32), np.frombuffer(raw, "<f4", n, 4 * n)


def train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, short: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, least: int = LEAST) -> Model:
    """bags, labels and which bags are short runs -> the model.  Every fifth bag only places the decision."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(1 << BITS, np.float32), -30.0, 0.0)
    spread = np.zeros(1 << BITS, np.int64)
    for bucket, _ in (bag for bag, one in zip(bags, short.tolist(), strict=True) if not one):
        spread[bucket] += 1
    bags = [(bucket, share) if keep.all() else (bucket[keep], share[keep]) for bucket, share in bags for keep in [spread[bucket] >= least]]
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 1e-3, (1 << BITS, DIM)).astype(np.float32)  # near zero, so n-grams the fit never saw say nothing
    soft, bias = rng.normal(0, 0.5, (2, DIM)).astype(np.float32), np.zeros(2, np.float32)
    seen = np.full(1 << BITS, 1e-8, np.float32)
    held = np.arange(len(bags)) % 5 == 4
    fitted = [np.flatnonzero(~held & (y == 0) & (short == 0)), np.flatnonzero(~held & (y == 0) & (short == 1)), np.flatnonzero(~held & (y == 1))]
    most = max(map(len, fitted))
    for _ in range(epochs):
        turn = [np.resize(rng.permutation(part), n) for part, n in zip(fitted, (most, most // 2, most), strict=True) if len(part)]
        for i in rng.permutation(np.concatenate(turn)):  # both classes equally often, short runs half as often
            bucket, share = bags[i]
            if not len(bucket):
                continue
            rows = embed[bucket]
            hidden = share @ rows
            z = soft @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = p @ soft
            grad = share[:, None] * back
            seen[bucket] += (grad * grad).sum(1)
            embed[bucket] = rows - rate * grad / np.sqrt(seen[bucket])[:, None]
            soft -= 0.1 * rate * np.outer(p, hidden)
            bias -= 0.1 * rate * p
    weight = (embed @ (soft[1] - soft[0])).astype(np.float32)
    first = float(bias[1] - bias[0])
    z = np.array([float(share @ weight[bucket]) for bucket, share in bags]) + first
    middle, scale = _decision(z[held & (y == 0)], z[held & (y == 1)]) if len(set(y[held].tolist())) == 2 else (0.0, 1.0)
    return Model(weight * np.float32(scale), (first - middle) * scale, float(np.log(THRESHOLD / (1 - THRESHOLD))))


def _decision(low: np.ndarray, high: np.ndarray, clean: float = 5.0) -> tuple[float, float]:
    """Where to cut, towards the toxic side of the gap if there is one, a clean document lost weighing ``clean`` times a toxic one kept, and the slope there."""
    at = np.sort(np.concatenate([low, high]))
    at = (at[1:] + at[:-1]) / 2
    low, high = np.sort(low), np.sort(high)
    loss = clean * (1 - np.searchsorted(low, at) / len(low)) + np.searchsorted(high, at) / len(high)
    best = at[loss <= loss.min() + 1e-12]
    return float(best[0] + 0.75 * (best[-1] - best[0])), 8.0 / max(float(np.median(high) - np.median(low)), 0.5)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    fields = "h long, y int, short int, bucket array<int>, share array<float>"
    rows = stored(labelled.sample(docs, labels, "toxic", per_class, "toxic").mapInArrow(_bag_rows, fields), "bags")
    spread = rows.where("short = 0").select(F.explode("bucket").alias("b")).groupBy("b").count().where(F.col("count") >= LEAST)
    known = np.zeros(1 << BITS, bool)
    known[spread.select("b").toArrow().column(0).to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def lean(batches):
        for batch in batches:
            packed, sizes = [], []
            for bucket, share in zip(batch.column("bucket"), batch.column("share"), strict=True):
                bucket, share = bucket.values.to_numpy(), share.values.to_numpy()
                keep = shared.value[bucket]
                packed.append(pack(bucket[keep], share[keep]))
                sizes.append(int(keep.sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], names=["h", "y", "short", "size", "bag"])

    # At most two bags for each sampled row, without n-grams that are not learned, some bytes an n-gram.
    got = rows.mapInArrow(lean, "h long, y int, short int, size long, bag binary").toArrow()
    y, short = got.column("y").to_numpy(), got.column("short").to_numpy()
    turn = np.lexsort((short, y, got.column("h").to_numpy()))
    bags = unpacked(got.column("bag"), got.column("size").to_numpy(), turn)
    del got
    try:
        return train(bags, y[turn], short[turn])
    finally:
        del bags
        give_back()


def unpacked(packed: pa.ChunkedArray, sizes: np.ndarray, turn: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The bags in the order of ``turn``, as parts of two arrays: many small ones take more and stay in the process."""
    ends = np.cumsum(sizes[turn])
    buckets, shares = np.empty(int(sizes.sum()), np.int32), np.empty(int(sizes.sum()), np.float32)
    bags = []
    for i, a, b in zip(turn.tolist(), (ends - sizes[turn]).tolist(), ends.tolist(), strict=True):
        buckets[a:b], shares[a:b] = unpack(packed[i].as_py())
        bags.append((buckets[a:b], shares[a:b]))
    return bags


def score(docs: DataFrame, model: Model) -> DataFrame:
    return labelled.score(docs, model, THRESHOLD)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, in their own columns; texts are judged where they stand."""
    from pyspark.sql.functions import pandas_udf

    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def toxic(text):
        import pandas as pd

        return pd.Series(shared.value.scores(pa.array(text, pa.string(), from_pandas=True)))

    return docs.where(toxic(F.col("text")) < F.lit(THRESHOLD))


def op5(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return labelled.contract(score(docs, fit(docs, table(spark, sf_dir, "labels"))))
