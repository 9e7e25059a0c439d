import random

import pytest

from leadloom.llm.bpe import count_tokens
from leadloom.llm.packing import CAPACITY, pack, plan, sequences

from .data import no_docs, odd_docs, odd_rows

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


def strange_texts(n: int) -> list[str]:
    draw = random.Random(5)
    letters = [*"ab' \n\t\r\x0bSDltrevm12.,!<|>éÉÀßÿ×÷ÞÑ中　  \x85\x1c\x1f​😀Σσİ²́", "<|endoftext|>", "'ll", "  ", " the"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 25))) for _ in range(n)]
    return texts + ["a" * 3000, " " * 999, "\n" * 7, "abab" * 500]


def test_counts_equal_the_library(spark):
    path = P.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    texts = strange_texts(3000) + [t for _, t, *_ in odd_rows()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in count_tokens(docs, path).collect()}
    for i, encoded in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        r = got[i]
        assert r["n_tokens"] == len(encoded.ids), repr(texts[i])
        assert r["n_bytes"] == len((texts[i] or "").encode()) and r["over_limit"] == (len(encoded.ids) > 512)
    assert count_tokens(odd_docs(spark), path).count() == len(odd_rows())
    assert count_tokens(no_docs(spark), path).count() == 0


def test_packed_sequences_hold_every_document(spark):
    path = P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    texts = strange_texts(1500) + [t for _, t, *_ in odd_rows()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    packed = pack(docs, path, ids=True)
    rows = packed.collect()
    whole = {r["sequence_id"]: r["ids"] for r in sequences(packed).collect()}
    ids = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
        assert r["start"] == len(ids.get(r["doc_id"], []))
        ids.setdefault(r["doc_id"], []).extend(r["ids"])
    assert sum(map(len, whole.values())) == sum(r["length"] for r in rows)
    assert max(map(len, whole.values())) <= CAPACITY
    for i, encoded in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[i] == [*encoded.ids, 0], repr(texts[i])
    assert len(whole) <= 1.02 * -(-sum(map(len, whole.values())) // CAPACITY) + 1
    odd = pack(odd_docs(spark), path).collect()
    assert {r["doc_id"] for r in odd} == {i for i, *_ in odd_rows()}
    assert sum(r["piece"] == 0 for r in odd) == len(odd_rows())
    assert pack(no_docs(spark), path).count() == 0


@pytest.mark.parametrize("counts", [{}, {5: 1}, {2048: 3}, {1500: 100, 700: 10}, {1030: 500, 1018: 500}, {n: 50 for n in range(1, 2049, 3)}])
def test_plan_places_every_length_once(counts):
    filled, ranks = {}, {n: [] for n in counts}
    for i in plan(counts):
        ranks[i.length] += range(i.first, i.last)
        for r in range(i.first, i.last):
            filled.setdefault(i.sequence + (r - i.first) // i.each, []).append((i.offset + (r - i.first) % i.each * i.length, i.length))
    assert all(sorted(v) == list(range(counts[n])) for n, v in ranks.items())
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= CAPACITY
    if counts == {1030: 500, 1018: 500}:
        assert len(filled) == 500
