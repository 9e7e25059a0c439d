import pytest

from leadloom.llm.sampling import labelled_sample, sampled_texts
from leadloom.llm import quality, toxicity

from .data import no_docs, odd_docs, odd_rows, prose


def training(spark, make):
    rows = [(i, make(i), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y, "x") for i, _, y in rows] + [(None, 1, "x"), (5, None, "x"), (9, 7, "x")], "doc_id long, y int, text string")


def test_toxicity_learns_terms_inflections_and_pairs(spark):
    def make(i):
        words = prose(i, 60).split()
        if i % 4 == 0:  # an insult beside a mention; alone, either is harmless
            words[7:7] = ["grumble" + "edsxt"[i % 5], "neighbours"]
        elif i % 4 == 1:
            words[3:3] = ["grumble" + "edsxt"[i % 5]]
        elif i % 4 == 2:
            words[3:3] = ["neighbours"]
        return " ".join(words)

    docs, labels = training(spark, make)
    machine = toxicity.fit(docs, labels.where("doc_id < 300 or doc_id is null"), label="y")
    scored = docs.where("doc_id >= 300").select("doc_id", toxicity.toxicity(machine, docs["text"]).alias("s")).collect()
    right = sum((r["s"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in scored)
    assert right >= 90
    kept = toxicity.remove_toxic(odd_docs(spark), machine)
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(odd_rows())
    assert toxicity.remove_toxic(no_docs(spark), machine).count() == 0


def test_quality_ranks_and_cuts(spark):
    def make(i):
        text = prose(i, 40 + i % 50)
        return text.upper() + "!! " * 9 if i % 8 == 0 else text.replace(" ", "### ") if i % 4 == 0 else text

    docs, labels = training(spark, make)
    good = labels.selectExpr("doc_id", "1 - y as y", "text")
    model = quality.fit(docs, good.where("doc_id < 300 or doc_id is null"), label="y")
    scored = docs.where("doc_id >= 300").select("doc_id", quality.quality(model, docs["text"]).alias("s")).collect()
    assert all((r["s"] >= quality.THRESHOLD) == (r["doc_id"] % 4 != 0) for r in scored)
    odd = odd_docs(spark)
    assert all(0 <= r["s"] <= 1 for r in odd.select(quality.quality(model, odd["text"]).alias("s")).collect())
    assert quality.keep_good(no_docs(spark), model).count() == 0


@pytest.mark.parametrize("rows", [[], [(10, 1)], [(10, 1), (13, 1)]])
def test_without_both_classes_the_models_are_neutral(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, y int")
    docs = odd_docs(spark)
    machine, model = toxicity.fit(docs, labels, label="y"), quality.fit(docs, labels, label="y")
    assert {r[0] for r in docs.select(toxicity.toxicity(machine, docs["text"])).collect()} == {0.5}
    assert {r[0] for r in docs.select(quality.quality(model, docs["text"])).collect()} == {0.5}


def test_a_repeated_key_sends_one_text(spark):
    docs = spark.createDataFrame([(i % 3, prose(i, 12)) for i in range(300)] + [(None, "x"), (1, None)], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (2, None), (7, 0), (None, 1)], "doc_id long, toxic int")
    sample, share = labelled_sample(labels, "toxic", "doc_id", 10)
    rows = sorted(sampled_texts(docs, sample, "doc_id", "text").collect())
    assert [(r["_key"], r["_label"]) for r in rows] == [(0, 1), (1, 1)] and abs(share - 2 / 3) < 1e-12
    again = sorted(sampled_texts(docs.repartition(2), sample, "doc_id", "text").collect())
    assert rows == again
    empty = docs.limit(0)
    assert sampled_texts(empty, sample, "doc_id", "text").count() == 0
