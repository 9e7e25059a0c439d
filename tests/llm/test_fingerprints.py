import hashlib

from pyspark.sql import functions as F

from leadloom.llm.fingerprints import fingerprints, lexicon, likeness, spelled

from .data import no_docs, odd_docs, odd_rows, prose


def test_edited_texts_and_neighbours_equal_brute_force(spark):
    rows = [(int(i * i % 7919), prose(i, 5 + i % 90)) for i in range(300)] + [(r[0], r[1]) for r in odd_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = fingerprints(docs, lexicon(docs)).withColumn("spelled", spelled(F.col("parts"))).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in got) == sorted((i or -1, len(t or "")) for i, t in rows)
    by_key = {}
    for k, (i, t) in enumerate(order):
        near = (order[(k + 1) % len(order)][1] or "")
        t = t or ""
        half = len(t) // 2
        by_key.setdefault(i, set()).add(hashlib.sha256((t[: len(t) - half] + near[:half]).encode()).hexdigest())
    unique = [i for i, _ in rows if [j for j, _ in rows].count(i) == 1 and i not in (10, None)]
    for r in got:
        if r["doc_id"] in unique and r["doc_id"] != 10:
            following = order[([i for i, _ in order].index(r["doc_id"]) + 1) % len(order)][0]
            if following in unique:
                assert r["edited_sha256"] in by_key[r["doc_id"]]
                assert r["next_parts"] == next(x["parts"] for x in got if x["doc_id"] == following)
    texts = {}
    for r in got:
        for i, t in rows:
            if i == r["doc_id"] and i in unique:
                assert texts.setdefault(t or "", r["spelled"]) == r["spelled"]


def test_alike_texts_are_nearer_than_others(spark):
    rows = [(i, prose(i, 200)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = fingerprints(docs, lexicon(docs, most=0.5)).select(
        likeness(F.col("parts"), F.col("edited_parts")).alias("e"), likeness(F.col("parts"), F.col("next_parts")).alias("n"),
        likeness(F.col("parts"), F.col("parts")).alias("s"),
    ).agg(F.avg("e"), F.avg("n"), F.min("s")).first()
    assert near[2] == 1.0 and near[0] > near[1] + 0.1


def test_odd_rows_and_empty_tables(spark):
    assert fingerprints(odd_docs(spark), lexicon(odd_docs(spark))).count() == len(odd_rows())
    assert fingerprints(no_docs(spark), lexicon(no_docs(spark))).count() == 0
    one = odd_docs(spark).where("doc_id = 12")
    (r,) = fingerprints(one, lexicon(one)).collect()
    assert r["parts"] == r["next_parts"]
