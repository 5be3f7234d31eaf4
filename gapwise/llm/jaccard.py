"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of hashes of its word shingles.  The hashes fall into groups; the counts by group are the
document's point.  The overlap of two sets is at most the sum of the lesser counts over all groups, so an
R-tree over points (each node knows its largest counts and least set size) rules out pairs without looking at sets;
what survives is verified on the sets themselves.

At cluster scale there is one tree per block.  Documents that can reach the threshold must share one of
their first shingles in any fixed order (prefix filter).  The classes that hold a prefix shingle have one center, the
least of them by hash, and a block is all classes that share a prefix shingle with one center.  So no
link is lost, and the many shingles that a group of copies shares make one block or a few.  The order puts shingles that a
sample finds frequent last, which keeps license lines and common passages out of prefixes; the result does
not depend on it.

Work stays linear in groups of copies.  Equal sets collapse into one class first.  A first pass over the
blocks reads points alone and keeps the classes that the tree cannot rule out, so only their texts are fetched; a second
pass verifies inside the block with a union-find: pairs already linked are skipped, and only links that join
two components leave it, fewer than the block has members.  A block beyond ``TILE`` classes or ``VOLUME`` shingles is
dealt out by hash; its parts are joined within themselves first, and after that only classes of different components
meet across parts, the largest component of a block never with itself.  Components come from star contraction.
With ``pairs`` the join lists every link between two classes as well: the same blocks and trees without the shortcut
through components, each block's parts all against all.  That costs what the links are many.

Edge cases: null texts and texts without words have an empty set, link with nothing and are their own
component; fewer words than a shingle make one shingle; rows that repeat, or repeat a doc_id, are nodes of their own
that carry the least doc_id of their component (null where all are null); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, discard, stored, table
from .components import components
from .textnp import mix64, slices

#: Classes and shingles of a block that one task holds; classes of a leaf.
TILE, VOLUME, LEAF = 4096, 1 << 22, 32
#: Shingles of the bounded list that orders prefixes, drawn from one document in so many.
FREQUENT, SAMPLE_SHARE = 100_000, 32
#: Parity groups for each group of counts.
FINE = 16
_WEIGHTS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(16)], np.uint64)


def shingle_sets(s, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each document of the slice, and the documents' bounds."""
    starts, ends = s.words()
    doc = s.doc_of(starts)
    words = s.hash_spans(starts, ends, lower=True)
    n, m = len(s), len(words)
    parts_h, parts_d = [], []
    if m >= width:
        h = np.zeros(m - width + 1, np.uint64)
        for k in range(width):
            h += words[k : m - width + 1 + k] * _WEIGHTS[k]
        same = doc[: m - width + 1] == doc[width - 1 :]
        parts_h.append(mix64(h[same]))
        parts_d.append(doc[: m - width + 1][same])
    count = np.bincount(doc, minlength=n) if m else np.zeros(n, int)
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        first = np.searchsorted(doc, few)
        h = count[few].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(width - 1):
            at = np.minimum(first + k, m - 1)
            h += np.where(count[few] > k, words[at] * _WEIGHTS[k], np.uint64(0))
        parts_h.append(mix64(h))
        parts_d.append(few)
    h = np.concatenate(parts_h) if parts_h else np.zeros(0, np.uint64)
    d = np.concatenate(parts_d) if parts_d else np.zeros(0, np.int64)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[fresh], d[fresh]
    return h, np.searchsorted(d, np.arange(n + 1))


def groups_for(n: int) -> int:
    """How many groups a set of n falls into: about eight shingles each."""
    return 1 << min(max((n // 8).bit_length(), 4), 11)


def _digest(h: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def summary(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set's point (counts by group) and the parities of its counts over ``FINE`` times as many groups, as bits."""
    g = groups_for(len(h))
    point = np.bincount((h & np.uint64(g - 1)).astype(np.int64), minlength=g)
    odd = np.bincount((h >> np.uint64(24) & np.uint64(FINE * g - 1)).astype(np.int64), minlength=FINE * g) & 1
    return np.minimum(point, 65535).astype(np.uint16), np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _hashes(width: int):
    def run(batches):
        for batch in batches:
            for s in slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(s, width)[0].view(np.int64))], names=["h"])

    return run


def _sketch(width: int, percent: int, frequent: np.ndarray):
    """(doc_id, text_key, text) -> the row's digest, summary and prefix; prefix shingles of the list ``frequent`` apart."""
    order = np.argsort(frequent)
    known, rank = frequent[order].view(np.uint64), (len(frequent) - order).astype(np.uint64)
    order = np.argsort(known)
    known, rank = known[order], rank[order]

    def run(batches):
        for batch in batches:
            for s in slices(batch.column(2)):
                h, bounds = shingle_sets(s, width)
                size = np.diff(bounds)
                place, often = h >> np.uint64(1), np.zeros(len(h), bool)
                if len(known) and len(h):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    often = known[at] == h
                    place[often] = (np.uint64(1) << np.uint64(63)) + rank[at[often]]
                doc = np.repeat(np.arange(len(s)), size)
                turn = np.lexsort((place, doc))
                prefix = np.where(size > 0, size - -(-size * percent // 100) + 1, 0)
                nth = np.arange(len(h)) - np.repeat(bounds[:-1], size)
                turn = turn[nth < prefix[doc]]  # doc is ascending, so it is the same before and after the sort
                few, many = turn[~often[turn]], turn[often[turn]]
                one, two, points, fine = [], [], [], []
                for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                    pair = _digest(h[a:b]) if b > a else (None, None)
                    one.append(pair[0])
                    two.append(pair[1])
                    point, bits = summary(h[a:b])
                    points.append(point.tobytes())
                    fine.append(bits.tobytes())
                lists = []
                for part in (few, many):
                    ends = np.concatenate([[0], np.cumsum(np.bincount(doc[part], minlength=len(s)))]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(h[part].view(np.int64))))
                row = [batch.column(k).slice(s.first, len(s)) for k in (0, 1)]
                row += [pa.array(size.astype(np.int64)), pa.array(one, pa.int64()), pa.array(two, pa.int64())]
                row += [pa.array(points, pa.binary()), pa.array(fine, pa.binary()), *lists]
                yield pa.RecordBatch.from_arrays(row, names=["doc_id", "text_key", "n", "d1", "d2", "point", "fine", "keys", "often"])

    return run


def _fold(points: np.ndarray, g: int) -> np.ndarray:
    while points.shape[1] > g:
        half = points.shape[1] // 2
        points = points[:, :half] + points[:, half:]
    return points


def _fold_bits(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


class _Node:
    """Some members of a block: ``at``, their places in the block's columns, and ``rows``, in the tree's own matrices."""

    __slots__ = ("rows", "at", "top", "least", "most", "kids")

    def __init__(self, rows, at, points, sizes, percent):
        self.rows, self.at = rows, at[rows]
        self.top, self.least, self.most = points[rows].max(0), int(sizes[rows].min()), int(sizes[rows].max())
        self.kids = ()
        if len(rows) > LEAF:
            wide = int(np.argmax(self.top - points[rows].min(0)))
            alike = self.most * percent <= self.least * 100
            order = rows[np.argsort(points[rows, wide] if alike else sizes[rows], kind="stable")]
            half = len(order) // 2
            self.kids = tuple(_Node(part, at, points, sizes, percent) for part in (order[:half], order[half:]))


class _Side:
    """The members of one side of a join whose points have the same number of groups, as matrices."""

    def __init__(self, at, points, fine, sizes):
        self.at, self.points, self.fine, self.sizes = at, points, fine, sizes


def tree_join(a: _Side, b: _Side, percent: int, same: bool, done, differ):
    """Yields arrays of pairs (places in the block) whose overlap bound reaches the threshold, by descending both trees.

    ``done(p, q)`` says whether pairs between two sets of places have nothing left to tell; ``differ(p, q)``
    marks the pairs, place by place, that still matter.  At the leaves a second bound follows: groups so fine that their
    counts' parities alone tell most differences.
    """
    if not len(a.at) or not len(b.at):
        return
    left = _Node(np.arange(len(a.at)), a.at, a.points, a.sizes, percent)
    right = left if same else _Node(np.arange(len(b.at)), b.at, b.points, b.sizes, percent)
    todo = [(left, right)]
    while todo:
        x, y = todo.pop()
        if 100 * x.most < percent * y.least or 100 * y.most < percent * x.least:
            continue
        if (100 + percent) * int(np.minimum(x.top, y.top).sum()) < percent * (x.least + y.least) or done(x.at, y.at):
            continue
        if x.kids and (len(x.at) >= len(y.at) or not y.kids):
            if x is y:
                u, v = x.kids
                todo += [(u, u), (u, v), (v, v)]
            else:
                todo += [(u, y) for u in x.kids]
        elif y.kids:
            todo += [(x, u) for u in y.kids]
        else:
            most = np.minimum(a.points[x.rows][:, None, :], b.points[y.rows][None, :, :]).sum(2)
            ok = (100 + percent) * most >= percent * (a.sizes[x.rows][:, None] + b.sizes[y.rows][None, :])
            if x is y:
                ok &= x.rows[:, None] < y.rows[None, :]
            i, j = np.nonzero(ok & differ(x.at[:, None], y.at[None, :]))
            i, j = x.rows[i], y.rows[j]
            if len(i):
                total = a.sizes[i] + b.sizes[j]
                apart = np.bitwise_count(a.fine[i] ^ b.fine[j]).sum(1, dtype=np.int64)
                sure = (100 + percent) * ((total - apart) // 2) >= percent * total
                if sure.any():
                    yield a.at[i[sure]], b.at[j[sure]]


def _block_pairs(size, side, points: list, fine: list, percent: int, done, differ):
    """Surviving pairs of a block: among all members where ``side`` is 2, else between the sides 0 and 1.

    Sets that can reach the threshold have numbers of groups that are equal or differ by a factor of two.
    """
    levels: dict[int, list[int]] = {}
    for i, p in enumerate(points):
        levels.setdefault(len(p), []).append(i)
    mats = {}
    for g, at in levels.items():
        at = np.array(at)
        mats[g] = _Side(at, np.stack([points[i] for i in at]).astype(np.int32), np.stack([fine[i] for i in at]), size[at])

    def only(of: _Side, which: int, g: int) -> _Side:
        at = np.flatnonzero((side[of.at] == which) | (side[of.at] == 2))
        return _Side(of.at[at], _fold(of.points[at], g), _fold_bits(of.fine[at], FINE * g // 64), of.sizes[at])

    for g, one in mats.items():
        whole = bool((side == 2).all())
        if whole:
            yield from tree_join(one, one, percent, True, done, differ)
        else:
            yield from tree_join(only(one, 0, g), only(one, 1, g), percent, False, done, differ)
        if 2 * g in mats:
            yield from tree_join(only(one, 0, g), only(mats[2 * g], 1, g), percent, False, done, differ)
            if not whole:
                yield from tree_join(only(one, 1, g), only(mats[2 * g], 0, g), percent, False, done, differ)


def _grouped(batches):
    """Rows sorted by (a, i, j) -> one table a group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("a", "i", "j")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        if held and tuple(key[:, 0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for x, y in zip(bounds[:-2], bounds[1:-1], strict=True):
            yield pa.Table.from_batches([*held, batch.slice(x, y - x)])
            held = []
        held.append(batch.slice(bounds[-2]))
        last = tuple(key[:, -1])
    if held:
        yield pa.Table.from_batches(held)


def _some(names: list[str], parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    flat = [np.concatenate(p) if p else np.zeros(0) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in flat], names=names)


_MEMBER = ["a", "i", "j", "side", "cid", "comp"]


def _survivors(percent: int):
    """Members (a, i, j, side, cid, comp, n, point, fine) sorted by block -> those that the tree cannot rule out, once each."""

    def run(batches):
        parts: list[list[np.ndarray]] = [[] for _ in _MEMBER]
        for t in _grouped(batches):
            if t.num_rows < 2:
                continue
            size, comp = t.column("n").to_numpy(), t.column("comp").to_numpy()
            if (comp == comp[0]).all() or (size.min() * 100 < percent * size.max() and t.num_rows == 2):
                continue
            mark = np.zeros(len(size), bool)
            points = [np.frombuffer(x, np.uint16) for x in t.column("point").to_pylist()]
            fine = [np.frombuffer(x, np.uint64) for x in t.column("fine").to_pylist()]
            pairs = _block_pairs(
                size, t.column("side").to_numpy(), points, fine, percent,
                lambda p, q: mark[p].all() and mark[q].all(),  # noqa: B023
                lambda p, q: (comp[p] != comp[q]) & ~(mark[p] & mark[q]),  # noqa: B023
            )
            for p, q in pairs:
                mark[p] = mark[q] = True
            if mark.any():
                for one, c in zip(parts, _MEMBER, strict=True):
                    one.append(t.column(c).to_numpy()[mark])
            if len(parts[0]) >= 512:
                yield _some(_MEMBER, parts)
                parts = [[] for _ in _MEMBER]
        yield _some(_MEMBER, parts)

    return run


def _spanning(width: int, percent: int, every: bool = False):
    """Members (a, i, j, side, cid, comp, text) sorted by block -> the links (a, b) that join two components of the block.

    With ``every`` all links of the block, whatever their components; a is the lesser number.
    """

    def run(batches):
        parts: list[list[np.ndarray]] = [[], []]
        for t in _grouped(batches):
            cid = t.column("cid").to_numpy()
            sets = []
            for s in slices(t.column("text")):
                h, bounds = shingle_sets(s, width)
                sets += [h[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
            size = np.array([len(h) for h in sets])
            ends = np.concatenate([[0], np.cumsum(size)])
            names, local = np.unique(np.concatenate(sets), return_inverse=True)
            seen = np.zeros(len(names), bool)
            root = np.unique(t.column("comp").to_numpy(), return_inverse=True)[1]
            both = [summary(h) for h in sets]
            pairs = _block_pairs(
                size, t.column("side").to_numpy(), [p for p, _ in both], [f for _, f in both], percent,
                lambda p, q: not every and (root[p] == root[p[0]]).all() and (root[q] == root[p[0]]).all(),  # noqa: B023
                lambda p, q: p != q if every else root[p] != root[q],  # noqa: B023
            )
            for p, q in pairs:
                for x in np.unique(p):
                    seen[local[ends[x] : ends[x + 1]]] = True
                    for y in q[p == x]:
                        if root[x] == root[y] and not every:
                            continue
                        common = int(np.count_nonzero(seen[local[ends[y] : ends[y + 1]]]))
                        if (100 + percent) * common >= percent * int(size[x] + size[y]):
                            root[root == root[y]] = root[x]
                            x_, y_ = (y, x) if every and cid[y] < cid[x] else (x, y)
                            parts[0].append(cid[x_ : x_ + 1])
                            parts[1].append(cid[y_ : y_ + 1])
                    seen[local[ends[x] : ends[x + 1]]] = False
                if len(parts[0]) >= 1 << 16:
                    yield _some(["a", "b"], parts)
                    parts = [[], []]
        yield _some(["a", "b"], parts)

    return run


def _row(doc_id: str):
    """Orders rows by doc_id, null last, then by text."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), "text_key")


def _tiles(rows: str, shingles: str):
    return F.greatest(F.ceil(F.col(rows) / TILE), F.ceil(F.col(shingles) / VOLUME), F.lit(1)).cast("int")


class Join:
    """The classes of a corpus, links that span their components, and every row's component.

    ``rows`` (doc_id, text_key, n, d1, d2): every row with the 128-bit digest of its set; ``classes`` (d1, d2, cid, rep, text_key,
    n): each distinct set once, under a number of its own; ``links`` (a, b) and ``labels`` (node, comp) by that number;
    ``pairs`` (a, b), only if asked for: every link between two classes, a the lesser number.
    """

    def __init__(self, docs: DataFrame, width: int, percent: int, pairs: bool = False):
        self.width, self.percent = width, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
        self.parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fields = "doc_id long, text_key long, n long, d1 long, d2 long, point binary, fine binary, keys array<long>, often array<long>"
        whole = stored(self.docs.mapInArrow(_sketch(width, percent, self._frequent()), fields), "jaccard-sketches")
        heavy = [F.first(c).alias(c) for c in ("n", "point", "fine", "keys", "often")]
        classes = whole.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.min(_row("doc_id")).alias("m"), *heavy)
        classes = classes.select("d1", "d2", F.monotonically_increasing_id().alias("cid"), "m", "n", "point", "fine", "keys", "often")
        sketches = stored(classes, "jaccard-classes")
        self.rows = stored(whole.select("doc_id", "text_key", "n", "d1", "d2"), "jaccard-rows")
        discard(whole)
        self.classes = stored(sketches.select("d1", "d2", "cid", F.col("m.doc_id").alias("rep"), "m.text_key", "n"), "jaccard-reps")
        blocks = stored(self._blocked(sketches), "jaccard-blocks")
        points = stored(sketches.select("cid", "point", "fine"), "jaccard-points")
        discard(sketches)

        large = blocks.groupBy("a").agg(F.count("*").alias("c"), F.sum("n").alias("v")).select("a", _tiles("c", "v").alias("tiles"))
        large = stored(large.where("tiles > 1"), "jaccard-large")
        own = F.pmod(F.xxhash64("cid"), F.coalesce("tiles", F.lit(1))).cast("int")
        held = blocks.join(bounded(large, large.count()), "a", "left").withColumns({"i": own, "j": own, "comp": F.col("cid")})
        self.links = self._linked(held.withColumn("side", F.lit(2)), points)
        self.labels = stored(components(self.links), "jaccard-labels")
        if large.head(1):
            self.links = self.links.unionByName(self._linked(self._across(blocks, large), points))
            before, self.labels = self.labels, stored(components(self.links), "jaccard-labels")
            discard(before)
        self.pairs = self._linked(self._all_parts(blocks, large), points, True) if pairs else None
        discard(blocks, points, large)

    def _frequent(self) -> np.ndarray:
        """The shingles that most documents of a sample hold, most frequent first; a bounded list."""
        part = self.docs.where(F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(SAMPLE_SHARE)) == 0).select("text")
        seen = part.mapInArrow(_hashes(self.width), "h long").groupBy("h").count().where("count > 2")
        rows = seen.orderBy(F.desc("count"), "h").limit(FREQUENT).select("h").toArrow()
        return rows.column(0).to_numpy() if rows.num_rows else np.zeros(0, np.int64)

    def _blocked(self, sketches: DataFrame) -> DataFrame:
        """(a, cid, n): the classes that share a prefix shingle with the center a, which is one of them.

        The classes of a shingle meet in one window.  Shingles of the bounded list of frequent ones, which may be in very many
        prefixes, are summed up before the shuffle instead and their centers, at most as many as the list has, joined back.
        """
        center = F.struct(F.xxhash64("cid").alias("h"), F.col("cid").alias("a"))
        w = Window.partitionBy("key")
        rare = sketches.select("cid", "n", F.explode("keys").alias("key")).repartition(self.parts, "key")
        rare = rare.select("cid", "n", F.count("*").over(w).alias("c"), F.min(center).over(w).alias("m")).where("c > 1")
        often = sketches.select("cid", "n", F.explode("often").alias("key"))
        centers = often.groupBy("key").agg(F.count("*").alias("c"), F.min(center).alias("m")).where("c > 1")
        often = often.join(F.broadcast(centers.select("key", "m")), "key")
        return rare.select("m.a", "cid", "n").unionByName(often.select("m.a", "cid", "n")).distinct()

    def _across(self, blocks: DataFrame, large: DataFrame) -> DataFrame:
        """Members of the large blocks that hold several components, to meet across their parts.

        The block's largest component is its major one.  Major and other members are dealt out apart; others meet everyone,
        major ones only the others, so a block that its first pass has joined up to a few members costs a few copies a row.
        """
        held = blocks.join(bounded(large.select("a"), large.count()), "a").join(self.labels.withColumnRenamed("node", "cid"), "cid", "left")
        held = stored(held.withColumn("comp", F.coalesce("comp", "cid")), "jaccard-across")
        by = stored(held.groupBy("a", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("v")), "jaccard-parts")
        tops = by.groupBy("a").agg(F.max(F.struct("c", "v", "comp")).alias("m"), F.sum("c").alias("c"), F.sum("v").alias("v"))
        tops = tops.where("c > m.c").select("a", F.col("m.comp").alias("major"), (F.col("c") - F.col("m.c")).alias("c0"), (F.col("v") - F.col("m.v")).alias("v0"), F.col("m.c").alias("c1"), F.col("m.v").alias("v1"))
        tops = stored(tops.select("a", "major", _tiles("c0", "v0").alias("s"), _tiles("c1", "v1").alias("t")), "jaccard-majors")
        held = held.join(bounded(tops, tops.count()), "a")
        major = F.col("comp") == F.col("major")
        own = F.when(major, F.col("s") + F.pmod(F.xxhash64("cid"), "t")).otherwise(F.pmod(F.xxhash64("cid"), "s")).cast("int")
        met = F.when(major, F.col("s")).otherwise(F.col("s") + F.col("t")) - 1
        held = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), met)))
        side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
        return held.select("a", "cid", "n", "comp", side.alias("side"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def _all_parts(self, blocks: DataFrame, large: DataFrame) -> DataFrame:
        """Members of all blocks, every part of a block to meet itself and every other one."""
        tiles = F.coalesce("tiles", F.lit(1))
        held = blocks.join(bounded(large, large.count()), "a", "left").withColumn("own", F.pmod(F.xxhash64("cid"), tiles).cast("int"))
        held = held.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
        parts = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
        return held.select("a", "cid", "n", F.col("cid").alias("comp"), side.alias("side"), *parts)

    def _met(self, members: DataFrame) -> DataFrame:
        return members.repartition(self.parts, "a", "i", "j").sortWithinPartitions("a", "i", "j")

    def _linked(self, held: DataFrame, points: DataFrame, every: bool = False) -> DataFrame:
        """Members of blocks -> links between their components (or all): first by points alone, then on the sets of what is left."""
        fields = ", ".join(f"{c} long" for c in _MEMBER)
        left = self._met(held.select(*_MEMBER, "n").join(points, "cid")).mapInArrow(_survivors(self.percent), fields)
        left = stored(left, "jaccard-left")
        need = left.select("cid").distinct().join(self.classes, "cid").select("cid", "rep", F.col("text_key").alias("rep_key"))
        need = stored(need, "jaccard-needed")
        same = (F.col("text_key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep"))
        texts = self.docs.join(bounded(need, need.count()), same).groupBy("cid").agg(F.first("text").alias("text"))
        links = self._met(left.join(texts, "cid")).mapInArrow(_spanning(self.width, self.percent, every), "a long, b long")
        links = stored(links.distinct(), "jaccard-links")
        discard(left, need)
        return links

    def _labelled(self) -> DataFrame:
        """The classes with their component."""
        label = self.classes.join(self.labels.withColumnRenamed("node", "cid"), "cid", "left")
        return label.withColumn("comp", F.coalesce("comp", "cid"))

    def spare(self) -> DataFrame:
        """(doc_id, text_key) of the rows with words that are not the first of their component; nulls come last."""
        label = self._labelled()
        first = label.groupBy("comp").agg(F.min(_row("rep")).alias("m")).select("comp", F.col("m.doc_id").alias("first"), F.col("m.text_key").alias("first_key"))
        rows = self.rows.join(label.select("d1", "d2", "comp").join(first, "comp"), ["d1", "d2"])
        kept = F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("text_key") == F.col("first_key"))
        return rows.where(~kept).select("doc_id", "text_key").distinct()

    def link_counts(self) -> DataFrame:
        """doc_id, n_shingles, n_links for every row: how many other rows it links with, equal sets among them; needs ``pairs``."""
        size = self.rows.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.count("*").alias("c"))
        size = stored(self.classes.join(size, ["d1", "d2"]).select("d1", "d2", "cid", "c"), "jaccard-sizes")
        both = self.pairs.unionByName(self.pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        other = bounded(size.select(F.col("cid").alias("b"), "c"), size.count())
        met = both.join(other, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("c").alias("met"))
        links = size.join(met, "cid", "left").select("d1", "d2", (F.col("c") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"))
        rows = self.rows.join(links, ["d1", "d2"], "left")
        return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id for every row."""
        label = self._labelled()
        least = label.groupBy("comp").agg(F.min("rep").alias("component_id"))
        label = stored(label.join(least, "comp").select("d1", "d2", "component_id"), "jaccard-result")
        rows = self.rows.join(label, ["d1", "d2"], "left")
        return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op7(spark, sf_dir: str) -> DataFrame:
    return Join(table(spark, sf_dir, "documents"), 4, 85).result()


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component stays, the one with the least doc_id; documents without words all stay.

    Rows are told apart by doc_id and text, so a repeated doc_id loses only its rows that are copies, and a row with a
    null doc_id gives way to any with one.  Equal (doc_id, text) rows become one.
    """
    cols = docs.columns
    join = Join(docs, width, percent)
    docs = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__key": F.xxhash64("text")})

    def among(keys: DataFrame, how: str, of: DataFrame) -> DataFrame:
        keys = bounded(keys, keys.count())
        return of.join(keys, F.col("__doc").eqNullSafe(F.col("doc_id_")) & (F.col("__key") == F.col("key_")), how)

    names = {"doc_id": "doc_id_", "text_key": "key_"}
    kept = among(stored(join.spare().withColumnsRenamed(names), "jaccard-gone"), "left_anti", docs)
    again = stored(join.rows.groupBy("doc_id", "text_key").count().where("count > 1").drop("count").withColumnsRenamed(names), "jaccard-again")
    if not again.head(1):
        return kept.select(*cols)
    once = among(again, "left_semi", kept).dropDuplicates(["doc_id", "text"])
    return among(again, "left_anti", kept).unionByName(once).select(*cols)
