import zlib
from collections import Counter

from leadloom.llm.sharding import interleave

from .data import no_docs, odd_docs, odd_rows


def test_odd_rows_are_all_placed(spark):
    rows = interleave(odd_docs(spark), 4).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by_shard = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert interleave(no_docs(spark), 4).count() == 0


def test_every_shard_matches_the_mixture(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "cast(id as string) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source"
    )
    rows = interleave(docs, 10).collect()
    total = Counter(r["stratum"] for r in rows)
    for shard in range(10):
        own = Counter(r["stratum"] for r in rows if r["shard"] == shard)
        assert sum(own.values()) == 300
        assert all(abs(own[s] - n / 10) <= 3 for s, n in total.items())
    again = interleave(docs.repartition(7), 10).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
    assert sorted(map(tuple, interleave(docs, 10, seed=1).collect()), key=repr) != sorted(map(tuple, rows), key=repr)


def test_many_strata_of_one_row_spread(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "'t' as text", "cast(id as string) as source")
    shards = Counter(r["shard"] for r in interleave(docs, 8).collect())
    assert set(shards.values()) == {50}
