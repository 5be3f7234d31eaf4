"""The stages one by one against what they promise, on the small tables."""

from collections import Counter

import corpus_pipeline
from gapwise.llm.common import stored, table
from tests.conftest import DATA
from tests.llm.cases import WORDS, documents, linked, shingles, spans


def test_stages(spark):
    docs = table(spark, DATA, "documents")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA), "t")
        kept[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == names
    first = table(spark, DATA, "documents").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas().set_index("doc_id")
    clean = set(labels.index[labels.toxic == 0])
    assert len(clean & set(kept["toxicity"].doc_id)) >= 0.9 * len(clean)  # the fit has six toxic documents here
    rows = kept["toxicity"].sort_values("doc_id")
    comp = linked([shingles(t, 5) for t in rows.text], 80)
    want = {d for i, d in enumerate(rows.doc_id) if comp[i] == i}
    assert set(kept["near_duplicates"].doc_id) == want
    assert set(kept["secrets"].doc_id) == want and not any(spans(t) for t in kept["secrets"].text)
    same = kept["secrets"][~kept["secrets"].text.str.contains("[SECRET]", regex=False)]
    assert (same.text.values == first.text[same.doc_id].values).all()
    size = lambda t: len(WORDS.findall(t or ""))
    before, after = Counter(), Counter()
    for t in kept["secrets"].text:
        before["all"] += size(t)
    for t in kept["mixture"].text:
        after["all"] += size(t)
    assert abs(before["all"] - after["all"]) <= 20
    p = kept["packing"]
    assert p.groupby("sequence_id").length.sum().max() <= 1024 and Counter(p[p.piece == 0].doc_id) == Counter(kept["mixture"].doc_id)


def test_stages_on_edge_cases(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, DATA), "t")
        assert name == "packing" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), DATA).count() == 0
        docs = out
    assert docs.count()
