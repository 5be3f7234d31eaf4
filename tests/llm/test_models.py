import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gapwise.llm import labelled, langid, quality, queries, toxicity
from gapwise.llm.textnp import slices
from tests.conftest import DATA
from tests.llm.cases import documents


def held(i, m, k):
    return zlib.crc32(str(i).encode()) % m == k


def test_language(spark):
    got = queries.QUERIES["op3_language_id"](spark, DATA).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index) and all(got.held_out == [held(i, 4, 2) for i in got.index])
    assert set(got.lang_pred) <= set(docs.lang) | {"und"} and got.score.between(0, 1).all()
    test = got[got.held_out]
    assert (test.lang_pred == docs.lang[test.index]).mean() >= 0.9


def test_language_edge_cases(spark):
    docs = documents(spark)
    out = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert out[5] == out[6] == out[7] == out[14] == "und" and out[10] == "de" and out[13] in ("en", "de")
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.fit(docs.limit(0)) == {} and langid.predict(docs.limit(0), {}).count() == 0


@pytest.mark.parametrize("name, label, at", [("op5_toxicity", "toxic", 0.7), ("op10_quality", "quality", 0.5)])
def test_classifier_contract(spark, name, label, at):
    got = queries.QUERIES[name](spark, DATA).toPandas()
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(got.held_out == [held(i, 3, 1) for i in got.doc_id]) and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= at)).all()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas().set_index("doc_id")[label]
    test = got[got.held_out & got.doc_id.isin(labels.index)]
    assert (test.predicted.values == labels[test.doc_id].values).mean() >= 0.8


def toy(bad, good, n=160):
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefghijk"), rng.integers(3, 9))) for _ in range(200)]
    texts, y = [], []
    for i in range(n):
        words = [vocab[k] for k in rng.integers(0, 200, 60)]
        if i % 2:
            words = bad(words, rng)
        texts.append(" ".join(words))
        y.append(i % 2)
    return pa.array(texts), y


def learned(module, texts, y):
    y = np.array(y)
    if module is toxicity:
        return toxicity.train(list(toxicity._bags(texts)), y, np.zeros(len(y), int))
    model = quality.Model(quality.index_vectors().astype(np.float32))
    return quality.train(model, model.pooled(texts), y)


def test_toxicity_generalises_to_misspellings():
    insert = lambda w, rng: [*w[:30], "worthlessscum", *w[30:]]
    model = learned(toxicity, *toy(insert, None))
    clean, _ = toy(lambda w, r: w, None, 20)
    spelt = pa.array([t.as_py() + " worthlesscum" for t in clean])
    assert (model.scores(spelt) > model.scores(clean)).all()
    ends = model.scores(pa.array(["", None], pa.string()))
    assert ends[0] == ends[1] and 0 <= ends[0] < 0.7


def test_quality_spots_noise():
    noisy = lambda w, rng: [x.upper() + "!!" for x in w]
    texts, y = toy(noisy, None)
    model = learned(quality, texts, y)
    assert ((model.scores(texts) >= 0.5) == np.array(y)).mean() > 0.95


@pytest.mark.parametrize("module", [toxicity, quality])
def test_models_without_labels(spark, module):
    docs = documents(spark)
    model = module.fit(docs, spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int"))
    out = labelled.score(docs, model, 0.7).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert labelled.score(docs.limit(0), model, 0.7).count() == 0


def test_equal_texts_have_equal_scores():
    texts = pa.array(["a b c", "x" * 3000, "a b c", None, "", "a b c"])
    for module in (toxicity, quality):
        s = learned(module, *toy(lambda w, r: [*w, "zzz"], None)).scores(texts)
        assert s[0] == s[2] == s[5] and s[3] == s[4]


def test_language_equals_a_plain_scorer(spark):
    """Every whole text of the table, encoded block by block with a compressor made anew."""
    import zstandard

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    dictionaries = langid.fit(docs)
    assert all(len(d) <= langid.DICTIONARY for d in dictionaries.values())
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, dictionaries).collect()}
    for r in docs.collect():
        raw, sizes = (r.text or "").lower().encode(), []
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id] == "und"
            continue
        for d in dictionaries.values():
            c = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(raw[i : i + 4096])) for i in range(0, len(raw), 4096)))
        assert sizes[list(dictionaries).index(got[r.doc_id])] == min(sizes)


def test_language_ties_and_clashing_columns(spark):
    docs = documents(spark).select("*", *[F.lit(1).alias(c) for c in ("h", "place", "w", "c", "used")])
    assert list(langid.fit(docs)) == ["de", "en"]
    tie = langid.predict(docs.where("doc_id = 8"), {"aa": b"zzzz", "bb": b"zzzz"}).first()
    assert tie.lang_pred == "aa" and tie.rejected and tie.score == 0.5


def naive_grams(text):
    """Buckets of a text's n-grams, word by word."""
    value = [int(v) for v in toxicity._VALUE]
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", text.encode()) if w]
    low = [bytes(c + 32 if 65 <= c < 91 else c for c in w) for w in words]
    for k, w in enumerate(low):
        if k and w == low[k - 1]:
            continue
        padded = b" " + w + b" "
        for n in toxicity.ORDERS:
            for i in range(len(padded) - n + 1):
                if padded[i] == padded[i + n - 1] == 32:  # a whole word between separators is told by its parts
                    continue
                h = 0
                for c in padded[i : i + n]:
                    h = (h * 0x01000193 + value[c]) % 2**32
                h = h * 0x9E3779B1 % 2**32
                h ^= h >> 15
                yield (h * 0x85EBCA77 % 2**32) >> (32 - toxicity.BITS)


def test_toxicity_equals_a_plain_scorer(spark):
    model = learned(toxicity, *toy(lambda w, rng: [*w[:30], "worthlessscum", *w[30:]], None))
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(60).collect()] + ["worthlessscum", "a a b"]
    for text, got in zip(texts, model.scores(pa.array(texts)), strict=True):
        ids = list(naive_grams(text or ""))
        z = model.bias + model.shift + sum(float(model.weight[i]) for i in ids) / (len(ids) + toxicity.SHRINK)
        if ids:
            assert got == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-6)


def test_quality_equals_a_plain_scorer(spark):
    import re

    model = learned(quality, *toy(lambda w, rng: [x.upper() + "!!" for x in w], None))
    texts = [r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(60).collect()] + ["a a b!!b 12 12x", ""]
    for text, got in zip(texts, model.pooled(pa.array(texts)), strict=True):
        runs = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+", text.encode())
        words = [r.decode("latin-1").encode("latin-1") for r in runs]
        low = [bytes(c + 32 if 65 <= c < 91 else c for c in w) for w in words]
        want = np.zeros(len(got))
        for k, w in enumerate(low):
            token = quality.tokens(next(iter(slices(pa.array([w]).cast(pa.binary())))))[0]
            want[: quality.DIM] += model.vectors[token[0]]
            kind = (k >= 1 and w == low[k - 1]) + 2 * (k >= 2 and w == low[k - 2])
            if kind:
                want[quality.DIM + kind - 1] += 1
        assert got == pytest.approx(want / max(len(low), 1), abs=1e-4)


def test_sample_takes_exactly_what_there_is(spark):
    docs = spark.createDataFrame([(i, f"t{i}", 1) for i in range(40)] + [(3, "again", 1), (None, "none", 1), (41, "", 1)], "doc_id long, text string, h int")
    labels = spark.createDataFrame([(i, i % 2, 7) for i in range(42)] + [(0, 0, 7), (2, 5, 7), (4, None, 7)], "doc_id long, toxic int, y int")
    free = [i for i in range(40) if not held(i, 3, 1)]
    got = labelled.sample(docs, labels, "toxic", 100, "x").collect()
    assert sorted(r.text for r in got) == sorted("again" if i == 3 else f"t{i}" for i in free)
    assert len(labelled.sample(docs, labels, "toxic", 5, "x").collect()) == 10


@pytest.mark.parametrize("name, label", [("op5_toxicity", "toxic"), ("op10_quality", "quality")])
def test_one_class_and_clashing_columns(spark, name, label):
    module = toxicity if label == "toxic" else quality
    docs = documents(spark).select("*", *[F.lit(1).alias(c) for c in ("h", "y", "bucket", "x", "score")])
    labels = spark.createDataFrame([(i, 1) for i in range(1, 15)], f"doc_id long, {label} int")
    got = labelled.score(docs, module.fit(docs, labels), 0.7).collect()
    assert {r.score for r in got} == ({0.5} if label == "quality" else {got[0].score}) and len(got) == docs.count()


def test_bags_survive_packing():
    for bucket, share in toxicity._bags(pa.array(["worthless worthless scum", "a", "", "x" * 500])):
        a, b = toxicity.unpack(toxicity.pack(bucket, share))
        assert a.tolist() == bucket.tolist() and b.tolist() == share.tolist()


def test_quality_counts_the_words_of_every_document(spark):
    """Context vectors against a loop over all texts, most of them without a label."""
    docs = documents(spark)
    model = quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    index, want = quality.index_vectors(), np.zeros((1 << quality.BITS, quality.DIM))
    for r in docs.collect():
        token = quality.tokens(next(iter(slices(pa.array([r.text or ""])))))[0].tolist()
        for i in range(len(token)):
            for j in range(max(0, i - quality.REACH), min(len(token), i + quality.REACH + 1)):
                if i != j:
                    want[token[i]] += np.roll(index[token[j]], j - i)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-6)
    assert model.vectors[:, quality.DIM :] == pytest.approx(want, abs=1 / quality.GRID)


def test_quality_learns_from_every_label(spark):
    """More rows than a shard holds: each once, whole shards, and the same model however the rows are dealt out."""
    texts, y = toy(lambda w, rng: [x.upper() + "!!" for x in w], None, 400)
    docs = spark.createDataFrame([(i, t.as_py()) for i, t in enumerate(texts)] + [(3, texts[3].as_py())], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(y)] + [(0, y[0]), (500, 1)], "doc_id long, quality int")
    free = [i for i in range(400) if not held(i, 3, 1)]
    model = quality.Model(quality.index_vectors().astype(np.float32))
    rows = quality.pooled_rows(docs, labels, model)
    assert rows.count() == len(free)
    each = quality.over(quality.sharded(rows, 50), quality.DIM + 3)
    parts = each(lambda x, y, held: (len(y), y.sum(), x.sum(0)))
    assert len(parts) == -(-len(free) // 50) and sum(p[0] for p in parts) == len(free) and sum(p[1] for p in parts) == sum(y[i] for i in free)
    assert sum(p[2] for p in parts) == pytest.approx(model.pooled(texts)[free].sum(0), abs=1e-2)
    one, two = (quality.fit(d, m, 50) for d, m in ((docs, labels), (docs.repartition(7), labels.repartition(5))))
    assert (one.scores(texts) == two.scores(texts)).all() and ((one.scores(texts) >= 0.5) == np.array(y)).mean() > 0.95


def test_quality_pools_are_the_same_in_any_batch():
    rng = np.random.default_rng(3)
    context = np.round(rng.normal(0, 0.2, (1 << quality.BITS, quality.DIM)).clip(-1, 1) * quality.GRID) / quality.GRID
    model = quality.Model(np.concatenate([quality.index_vectors(), context], axis=1).astype(np.float32))
    vocab = [f"w{k}x" for k in range(500)]
    texts = pa.array([" ".join(vocab[k] for k in rng.integers(0, 500, n)) for n in (3, 9000, 1, 40_000, 700, 25, 12_000, 2)])
    alone = np.concatenate([model.pooled(texts[i : i + 1]) for i in range(len(texts))])
    assert (model.pooled(texts) == alone).all() and (model.pooled(texts[::-1])[::-1] == alone).all()


def test_toxicity_holds_its_bags_once(spark, monkeypatch):
    """On the driver all bags lie in two arrays, and training does not copy those that are lean already."""
    import tracemalloc

    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda bags, *rest: seen.append({id(part.base) for bag in bags for part in bag}) or train(bags, *rest))
    texts, y = toy(lambda w, rng: [*w[:30], "worthlessscum", *w[30:]], None, 60)
    docs = spark.createDataFrame([(i, t.as_py()) for i, t in enumerate(texts)], "doc_id long, text string")
    toxicity.fit(docs, spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int"))
    assert len(seen[0]) == 2
    bucket, share = np.arange(50_000, dtype=np.int32), np.full(50_000, 1e-5, np.float32)
    tracemalloc.start()
    train([(bucket, share)] * 200, np.arange(200) % 2, np.zeros(200, int), epochs=0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # 80 MB for the bags alone, were they copied


def test_unpacked_keeps_bags_and_order():
    bags = list(toxicity._bags(pa.array(["worthless worthless scum", "", "some more words", "a"])))
    packed = pa.chunked_array([pa.array([toxicity.pack(*b) for b in bags[:2]], pa.binary()), pa.array([toxicity.pack(*b) for b in bags[2:]], pa.binary())])
    got = toxicity.unpacked(packed, np.array([len(b) for b, _ in bags]), np.array([2, 0, 1, 3]))
    for (bucket, share), k in zip(got, (2, 0, 1, 3), strict=True):
        assert bucket.tolist() == bags[k][0].tolist() and share.tolist() == bags[k][1].tolist()
