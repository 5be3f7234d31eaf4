import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gapwise.llm import mixing, queries, secrets
from tests.conftest import DATA
from tests.helpers import rows
from tests.llm.cases import WORDS, documents, spans


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert rows(queries.QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(queries.ORACLES[name]).df())


def test_mix_meets_targets_and_caps(spark):
    docs = documents(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    size = lambda t: len(WORDS.findall(t or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r.doc_id, size(r.text)) for r in docs.collect())
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.target <= 3 * r.source_size + 1e-9
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    for taken, target in by.values():
        assert abs(taken - target) <= 1
    assert sum(t for _, t in by.values()) == pytest.approx(sum(r["size"] for r in got))
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, got))


def test_water_filling_by_hand(spark):
    s = spark.createDataFrame([("a", 10, 8.0), ("b", 90, 1.0), ("c", 100, 1.0)], "source string, source_size long, weight double")
    assert {r.source: r.target for r in mixing.targets(s).collect()} == {"a": 30.0, "b": 85.0, "c": 85.0}


def test_mixed_documents_hold_the_words_taken(spark):
    docs = documents(spark)
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.taken
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(WORDS.findall(r.text or ""))
    assert +got == +want


def test_secrets_equal_brute_force(spark):
    docs = documents(spark)
    want = Counter((r.doc_id, tuple(spans(r.text))) for r in docs.collect())
    names = ("assign", "access", "hex", "live")
    out = secrets.scan(docs).select("doc_id", secrets._listed(F.col("base"), names).alias("b"), secrets._listed(secrets.all_spans(), names).alias("a"), "live").collect()
    assert Counter((r.doc_id, tuple(x for x in r.b.split(",") if x)) for r in out) == want
    for r in out:
        assert set(filter(None, r.b.split(","))) <= set(r.a.split(","))
    assert [s.value for r in out for s in r.live if r.doc_id == 16] == ["Qz9Qz9Qz9Qz9Qz9Qz9Qz"]


def test_widely_copied_values_are_not_live(spark):
    value = "Qz9Qz9Qz9Qz9Qz9Qz9Qz"
    docs = spark.createDataFrame([(i, f"see {value}", f"s{i}") for i in range(4)], "doc_id long, text string, source string")
    assert all(not r.live and r.n_shared == 1 for r in secrets.scan(docs).collect())


def test_redaction(spark):
    docs = documents(spark)
    out = secrets.redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[11] == "[SECRET] and [SECRET], token:short" and text[12] == "é😀 [SECRET]!" and text[5] is None and text[13].startswith("w0x0 ")


@pytest.mark.parametrize("f", [mixing.mix, mixing.mixed_documents, secrets.redacted, lambda d: secrets.scan(d)])
def test_empty_tables(spark, f):
    assert f(documents(spark).limit(0)).count() == 0


def test_digest_of_no_spans(spark):
    got = queries.QUERIES["op2_secret_scan"](spark, DATA).where("spans = ''").first()
    assert got.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_values_in_many_repositories_of_one_owner(spark):
    value = "Qz9Qz9Qz9Qz9Qz9Qz9Qz"
    docs = spark.createDataFrame([(i, f"see {value}", "s") for i in range(6)], "doc_id long, text string, source string")
    assert all(not r.live and r.n_shared == 1 for r in secrets.scan(docs, max_repositories=5).collect())
    assert all(r.live and r.n_shared == 0 for r in secrets.scan(docs, max_repositories=6).collect())
    assert all(r.live and r.n_shared == 0 for r in secrets.scan(docs).collect())
    more = spark.createDataFrame([(i, "a Qz9Qz9Qz9Qz9Qz9Qz9Qz b", "one") for i in range(21)], "doc_id long, text string, source string")
    assert all(not r.live and r.n_shared == 1 for r in secrets.scan(more).collect())
    same = spark.createDataFrame([(7, "a Qz9Qz9Qz9Qz9Qz9Qz9Qz b", f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    assert all(not r.live for r in secrets.scan(same).collect()) and all(r.live for r in secrets.scan(same, max_owners=3).collect())
