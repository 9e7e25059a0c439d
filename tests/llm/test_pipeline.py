import os

import pytest

import corpus_pipeline
from leadloom.llm.queries import ORACLES, QUERIES
from leadloom.session import written

from .test_minhash import shingle_set

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_stages_decide_on_all_that_is_left(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "toxicity", "near-dedup", "benchmark decontamination", "best-fit packing",
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        seen.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    for before, after in zip(seen, seen[1:], strict=False):
        assert set(after.items()) <= set(before.items())
    good = [i for i in seen[0] if i in labels]
    assert sum(labels[i]["quality"] for i in good) >= 0.97 * len(good)
    assert sum(r["quality"] for r in labels.values()) - sum(labels[i]["quality"] for i in good) <= 0.03 * len(labels)
    sets = {i: shingle_set(t) for i, t in seen[2].items()}
    assert all(100 * len(a & b) < 80 * len(a | b) for i, a in sets.items() for j, b in sets.items() if i < j and a)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(seen[3])
    filled = {}
    for r in packed:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert max(filled.values()) <= 2048


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)
