import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gapwise.llm import components, jaccard, media, neighbours
from gapwise.llm.common import new_path
from tests.llm.cases import documents, linked, shingles


def brute(rows, width, percent):
    sets = [shingles(r.text, width) for r in rows]
    comp = linked(sets, percent)
    least = {}
    for r, c in zip(rows, comp, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    return Counter((r.doc_id, len(s), least.get(c)) for r, s, c in zip(rows, sets, comp, strict=True))


def test_join_on_edge_cases(spark):
    docs = documents(spark)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.Join(docs, 4, 85).result().collect())
    assert got == brute(docs.collect(), 4, 85)
    assert jaccard.Join(docs.limit(0), 4, 85).result().count() == 0


def test_join_on_dense_near_copies(spark, monkeypatch):
    """Chains of near copies around the threshold, and tiles that split a block."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(90):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(1, 6)):
            w[k] = f"n{rng.integers(1000)}"
        texts.append(" ".join(w[: rng.integers(90, 121)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.Join(docs, 4, 85).result().collect())
    assert got == brute(docs.collect(), 4, 85)


@pytest.mark.parametrize("limit", [("TILE", 8), ("VOLUME", 2000)])
def test_join_across_the_parts_of_a_block(spark, monkeypatch, limit):
    """One large group, a second one that hangs on it by a single bridge, and texts that share shingles but do not link."""
    monkeypatch.setattr(jaccard, *limit)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(100)]

    def edited(words, n, tag):
        out = list(words)
        for k in rng.choice(len(out), n, replace=False):
            out[k] = f"{tag}{rng.integers(10_000)}"
        return out

    far = edited(base, 6, "far")
    texts = [edited(base, 1, "n") for _ in range(70)] + [edited(far, 1, "f") for _ in range(25)]
    texts += [base[:40] + edited(base, 100, "own") for _ in range(20)]
    texts += [far[:17] + base[17:], base[:50] + far[50:]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    join = jaccard.Join(docs, 4, 85)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.result().collect())
    assert got == brute(docs.collect(), 4, 85)
    assert join.links.count() < 3 * len(texts)


def link_counts(rows, width, percent):
    sets = [shingles(r.text, width) for r in rows]
    hit = [sum(i != j and bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    return Counter((r.doc_id, len(s), n) for r, s, n in zip(rows, sets, hit, strict=True))


@pytest.mark.parametrize("tile", [4096, 8])
def test_every_link_is_listed(spark, monkeypatch, tile):
    """Every link of a dense group, whole or in parts, and counts that include equal sets."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = np.random.default_rng(6)
    texts = []
    for i in range(60):
        w = [f"w{k}" for k in range(160)]
        for k in rng.integers(0, 160, rng.integers(0, 4)):
            w[k] = f"n{rng.integers(50)}"
        texts.append(" ".join(w))
    texts += texts[:7] + [f"own{i} words of its {i} alone" for i in range(20)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    join = jaccard.Join(docs, 4, 85, pairs=True)
    want = link_counts(docs.collect(), 4, 85)
    assert Counter(tuple(r) for r in join.link_counts().collect()) == want
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in join.result().collect()) == brute(docs.collect(), 4, 85)
    pairs = join.pairs.collect()
    assert len(pairs) == len(set(pairs)) and all(r.a < r.b for r in pairs) and len(pairs) > join.links.count()
    edge = jaccard.Join(documents(spark), 4, 85, pairs=True)
    assert Counter(tuple(r) for r in edge.link_counts().collect()) == link_counts(documents(spark).collect(), 4, 85)
    assert jaccard.Join(docs.limit(0), 4, 85, pairs=True).link_counts().count() == 0


def test_survivors_stay_linear_and_whole(spark):
    """However many pairs a block has, each member leaves the first pass at most once, and none with a partner is lost."""
    rng = np.random.default_rng(4)
    sets = [np.unique(np.concatenate([np.arange(200), rng.integers(1000, 9000, 20)])).astype(np.uint64) for _ in range(150)]
    sets += [np.unique(rng.integers(10_000, 99_000, 220)).astype(np.uint64) for _ in range(50)]
    sets = [jaccard.mix64(s) for s in sets]
    rows = [(0, 0, 0, 2, i, i, len(s), p.tobytes(), f.tobytes()) for i, s in enumerate(sets) for p, f in [jaccard.summary(s)]]
    names = ["a", "i", "j", "side", "cid", "comp", "n", "point", "fine"]
    batches = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows]).to_batches(max_chunksize=37)
    got = [x for b in jaccard._survivors(80)(batches) for x in b.column("cid").to_pylist()]
    want = {i for i, s in enumerate(sets) for j, t in enumerate(sets) if i != j and 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))}
    assert len(got) == len(set(got)) and want and want <= set(got)


def test_tree_bound_loses_no_pair():
    rng = np.random.default_rng(1)
    sets = [set(rng.integers(0, 400, 60).tolist()) for _ in range(60)]
    sets += [set(list(s)[:-2]) | {1000 + i} for i, s in enumerate(sets)]
    points = np.array([np.bincount([x % 16 for x in s], minlength=16) for s in sets])
    odd = np.array([np.bincount([x * 7 % 512 for x in s], minlength=512) & 1 for s in sets]).astype(np.uint8)
    fine = np.packbits(odd, axis=1, bitorder="little").view(np.uint64)
    side = jaccard._Side(np.arange(len(sets)), points, fine, np.array([len(s) for s in sets]))
    found = jaccard.tree_join(side, side, 85, True, lambda p, q: False, lambda p, q: p != q)
    got = {tuple(sorted(x)) for p, q in found for x in zip(p.tolist(), q.tolist(), strict=True)}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert want and want <= got


def test_deduplicated_keeps_one_of_each_group(spark):
    docs = documents(spark)
    out = jaccard.deduplicated(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[5] == ids[6] == ids[7] == 1 and ids[8] == 1 and not ids[9]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 100)], "a long, b long")
    got = {r.node: r.comp for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_media_round_trip(spark):
    docs = documents(spark)
    manifest, entries = media.plan(docs)
    path = media.write_store(docs, entries, new_path(spark, "m"))
    out = manifest.join(media.read_store(spark, path).dropDuplicates(["object"]), "object").collect()
    want = Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        p = raw + bytes(max(-(-len(raw) // 64), 1) * 64 - len(raw))
        want[r.doc_id, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), 44 + len(p), hashlib.sha256(media.wave_header(len(p)) + p).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) for r in out) == want
    assert media.plan(docs.limit(0))[0].count() == 0


def test_media_stores_shared_chunks_once(spark):
    rng = np.random.default_rng(2)
    block = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    shared = block(40_000)
    docs = spark.createDataFrame([(i, block(3000) + shared + block(3000)) for i in range(6)], "doc_id long, text string")
    _, entries = media.plan(docs)
    path = media.write_store(docs, entries, new_path(spark, "m"))
    chunks = spark.read.parquet(path).select(F.explode("chunks").alias("c"))
    held = chunks.where("c.data IS NOT NULL").select(F.sum(F.length("c.data")), F.count("*"), F.countDistinct("c.name")).first()
    assert held[1] == held[2] and held[0] < 6 * 46_000 - 4 * 38_000
    assert media.read_store(spark, path).count() == 6


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score double")


def test_neighbours_on_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [0.0, 1.0]), (9, [-1.0, 0.5]), (9, [-1.0, 0.5])]
    df = vectors(spark, [(i, v, 1, 2.0) for i, v in rows])
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (0, 4, 9, -1.0), (20, 1, 9, 0.5), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert neighbours.search(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("same", [0, 900])
def test_neighbours_recall(spark, same):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[:same] = x[0]
    df = vectors(spark, [(i, v.tolist(), 1, 2.0) for i, v in enumerate(x)])
    out = neighbours.search(df, df.where("vec_id % 20 = 0")).toPandas()
    hits = 0
    for q, g in out.groupby("query_id"):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:20]
        hits += len(set(best) & set(g.vec_id))
        assert len(g) == 20 and np.allclose(g.sort_values("rank").score, s[g.sort_values("rank").vec_id])
    assert hits / (20 * out.query_id.nunique()) >= 0.9


@pytest.mark.parametrize("n", [1500, 6000])
def test_neighbours_in_a_dense_group(spark, n):
    """A third of the vectors nearly coincide, but all differ: exact scores must tell them apart at every size."""
    rng = np.random.default_rng(7)
    x, hot = rng.normal(size=(n, 64)), n // 3
    x[:hot] = x[0] + 0.05 * rng.normal(size=(hot, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = vectors(spark, [(i, v.tolist(), 1, 2.0) for i, v in enumerate(x)])
    out = neighbours.search(df, df.where(f"vec_id % 20 = 0 AND vec_id < {hot}")).toPandas()
    hits = 0
    for q, g in out.groupby("query_id"):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        hits += len(set(np.argsort(-s, kind="stable")[:20]) & set(g.vec_id))
    assert hits / (20 * -(-hot // 20)) >= 0.98


@pytest.mark.parametrize("equal", [True, False])
def test_neighbours_of_a_repeated_id(spark, equal):
    """One vec_id in a third of the rows, with one vector or with many, is one neighbour at most."""
    rng = np.random.default_rng(11)
    n, hot = 3000, 1000
    x = rng.normal(size=(n, 16)).astype(np.float32)
    x[:hot] = x[0] if equal else x[0] + 0.1 * rng.normal(size=(hot, 16))
    ids = np.arange(n)
    ids[:hot] = 7
    x[:hot] *= 3  # near to half of the queries
    df = vectors(spark, [(int(i), v.tolist(), 1, 2.0) for i, v in zip(ids, x, strict=True)])
    out = neighbours.search(df, df.where("vec_id % 20 = 0")).toPandas()
    hits = 0
    assert out.query_id.nunique() == 100
    for q, g in out.groupby("query_id"):
        s = x.astype(float) @ x[q].astype(float)
        score = {i: v for i, v in sorted(zip(ids.tolist(), s.tolist(), strict=True), key=lambda p: p[1]) if i != q}
        hits += len(set(sorted(score, key=lambda i: -score[i])[:20]) & set(g.vec_id))
        assert len(g) == 20 and g.vec_id.is_unique
    assert hits / 2000 >= 0.9


def null_ids(spark):
    """Near copies without doc_id: one beside document 1, one that alone links documents 2 and 3."""
    w = [f"w{i}" for i in range(200)]
    v = [f"v{i}" for i in range(200)]
    cut = lambda words, a, b: " ".join(words[a:b])
    rows = [(1, cut(w, 0, 200)), (None, cut(w, 0, 196)), (2, cut(v, 0, 180)), (None, cut(v, 10, 190)), (3, cut(v, 20, 200))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_join_of_rows_without_doc_id(spark):
    docs = null_ids(spark)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.Join(docs, 4, 85).result().collect())
    assert got == brute(docs.collect(), 4, 85)
    assert {k[0]: k[2] for k in got}[3] == 2 and Counter(k[2] for k in got.elements()) == {1: 2, 2: 3}


def test_deduplicated_decides_by_row(spark):
    """A repeated doc_id loses only its copied text; of near copies without doc_id at most one stays."""
    text = lambda c, a, b: " ".join(f"{c}{i}" for i in range(a, b))
    rows = [(1, text("w", 0, 200)), (2, text("w", 0, 196)), (2, text("u", 0, 50)), (None, text("w", 0, 198)), (None, text("n", 0, 200)), (None, text("n", 0, 197)), (1, text("w", 0, 199)), (3, text("z", 0, 9))]
    out = jaccard.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter(r.doc_id for r in out)
    assert got == {1: 1, 2: 1, 3: 1, None: 1}
    assert next(r.text for r in out if r.doc_id == 2).startswith("u0 ") and next(r.text for r in out if r.doc_id is None).startswith("n0 ")
