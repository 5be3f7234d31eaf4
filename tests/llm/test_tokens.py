import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gapwise.llm import packing, token_store
from gapwise.llm.common import new_path
from gapwise.llm.textnp import crc_shift
from gapwise.llm.tokens import tokenizer
from tests.llm.cases import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids(text, end):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sdt Z9.,!\n\t\r  é日<|>\x1c"), max_size=25), min_size=1, max_size=5))
def test_units_give_the_library_s_ids(texts):
    for s, flat, bounds in tokenizer(PATH).encode(pa.array(texts)):
        for i in range(len(s)):
            assert flat[bounds[i] : bounds[i + 1]].tolist() == ids(texts[s.first + i], 0)[:-1].tolist()


@given(st.lists(st.binary(max_size=40), min_size=1, max_size=6))
def test_checksums_combine(parts):
    after = np.cumsum([0] + [len(p) for p in parts[::-1]])[:-1][::-1]
    got = np.bitwise_xor.reduce(crc_shift(np.array([zlib.crc32(p) for p in parts], np.uint64), np.array(after)))
    assert int(got) == zlib.crc32(b"".join(parts))


def test_store_round_trip(spark):
    docs = documents(spark)
    path = token_store.write_store(docs, new_path(spark, "t"), PATH)
    want = Counter((r.doc_id, len(x := ids(r.text, 0)), zlib.crc32(x)) for r in docs.collect())
    got = token_store.read_store(spark, path, token_store.id_width(PATH)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)):
        assert r.start == start
        start += r.n_tokens
    rebuilt = Counter((r.doc_id, bytes(r.ids)) for r in token_store.read_documents(spark, path).collect())
    assert rebuilt == Counter((r.doc_id, ids(r.text, 0).astype("<u2").tobytes()) for r in docs.collect())
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    nodes = spark.read.parquet(f"{path}/manifest")
    assert nodes.where("level = 1").agg({"docs": "sum"}).first()[0] == docs.count()


def test_damaged_recipes_and_swapped_chunks_are_found(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FANOUT", 3)
    path = token_store.write_store(documents(spark), new_path(spark, "t"), PATH)
    assert spark.read.parquet(f"{path}/manifest").agg({"level": "max"}).first()[0] >= 2
    recipes, chunks, kept = (spark.read.parquet(f"{path}/{n}") for n in ("recipes", "chunks", "manifest"))

    def stored(name, recipes, chunks):
        at = new_path(spark, name)
        for n, df in (("recipes", recipes), ("chunks", chunks), ("manifest", kept)):
            df.write.parquet(f"{at}/{n}")
        return at

    other = recipes.where("doc_id = 10").first()["recipe"][0]["digest"]
    swapped = F.when(F.col("doc_id") == 1, F.transform("recipe", lambda x: x.withField("digest", F.lit(other)))).otherwise(F.col("recipe"))
    bad = [
        stored("lost", recipes.where("doc_id <> 13 OR doc_id IS NULL"), chunks),
        stored("swapped", recipes.withColumn("recipe", swapped), chunks),
        stored("longer", recipes.withColumn("n_tokens", F.col("n_tokens") + 1), chunks),
        stored("gone", recipes, chunks.where(F.col("digest") != F.lit(other))),
        stored("cut", recipes, chunks.withColumn("n", F.col("n") + F.when(F.col("digest") == F.lit(other), 1).otherwise(0))),
    ]
    for at in bad:
        with pytest.raises(Exception, match="manifest|missing|match"):
            token_store.read_store(spark, at, 2).collect()
    for at in bad[:4]:
        with pytest.raises(Exception, match="manifest|missing|match"):
            token_store.read_documents(spark, at).collect()


def test_a_damaged_chunk_is_found(spark):
    path = token_store.write_store(documents(spark), new_path(spark, "t"), PATH)
    chunks, at = spark.read.parquet(f"{path}/chunks"), new_path(spark, "t")
    for n in ("recipes", "manifest"):
        spark.read.parquet(f"{path}/{n}").write.parquet(f"{at}/{n}")
    chunks.withColumn("ids", F.expr("overlay(ids PLACING X'FFFF' FROM 1 FOR 2)")).write.parquet(f"{at}/chunks")
    with pytest.raises(Exception, match="digest"):
        token_store.read_store(spark, at, 2).collect()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plans_are_sound(counts):
    seqs = defaultdict(list)
    ranks = defaultdict(list)
    for length, rank, count, first, offset in packing.plan_bins(counts, 64):
        ranks[length] += range(rank, rank + count)
        for k in range(count):
            seqs[first + k].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(c)) for k, c in counts.items()}
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and sum(3 * x > 64 for _, x in parts) <= 2
    total = sum(k * c for k, c in counts.items())
    assert len(seqs) <= max(1, -(-total // 64)) * 1.7 + 1


def test_packing(spark):
    docs = documents(spark)
    got = packing.pack(docs, PATH, capacity=64).toPandas()
    want = Counter()
    for r in docs.collect():
        x = ids(r.text, 2)
        head = len(x) - (-(-len(x) // 64) - 1) * 64
        cuts = [0, *range(head, len(x) + 1, 64)]
        want.update((r.doc_id, i, a, b - a, zlib.crc32(x[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    key = lambda v: None if v != v else int(v)
    assert Counter((key(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == np.concatenate([[0], np.cumsum(g.length)[:-1]]).tolist() and g.length.sum() <= 64
    assert packing.pack(docs.limit(0), PATH).count() == 0
