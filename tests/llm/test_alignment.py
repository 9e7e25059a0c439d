"""Both tokenizers over whole texts, token by token, against the chunked operator."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from leadloom.llm import alignment
from leadloom.llm.bpe import byte_letters
from tokenizers import Tokenizer

from .data import no_docs, odd_docs, odd_rows, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def files():
    return alignment.read_files(A, B)


def brute_force(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    docs, counts = [], Counter()
    for key, text in rows:
        left = right = []
        if text:
            left = a.encode(" " + text, add_special_tokens=False)
            left = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(left.ids, left.tokens)]
            right = [
                (i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                for i in b.encode(text)
            ]
            want = b" " + text.encode()
            if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
                left = right = []
        sides = []
        for tokens in (left, right):
            at, spans = 0, []
            for i, x in tokens:
                spans.append((at, at + len(x), i))
                at += len(x)
            sides.append(spans)
        cuts = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
        groups, begin, ia, ib = [], 0, 0, 0
        for cut in cuts:
            group = ([], [], begin, cut)
            while ia < len(sides[0]) and sides[0][ia][0] < cut:
                group[0].append(sides[0][ia][2])
                ia += 1
            while ib < len(sides[1]) and sides[1][ib][0] < cut:
                group[1].append(sides[1][ib][2])
                ib += 1
            groups.append(group)
            begin = cut
        links, j = [], 0
        for s, e, i in sides[0]:
            while j and sides[1][j - 1][1] > s:
                j -= 1
            while j < len(sides[1]) and sides[1][j][0] < e:
                if sides[1][j][1] > s:
                    links.append((i, sides[1][j][2]))
                j += 1
        counts.update(links)
        docs.append((key, len(left), len(right), groups, links))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    out = []
    for key, n_a, n_b, groups, links in docs:
        spelled = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        sha = hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((key, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), sha))
    return sorted(out, key=repr), {k: g for k, _, _, g, _ in docs}


def rows():
    odd = [
        (100, "▁ taken for a space"), (101, "a    b　 c  d"), (102, "  two  spaces \n and\t tabs \r\n  x  "),
        (103, "<|endoftext|><s> <0x41> <unk> don't we'll"), (104, "\x00\x07 control"), (105, " " * 50), (106, "\U0001f600\U0001f3fd emoji é ﬁ"),
        (107, "日本語のテキスト と 中文"), (108, "naïve café\u0085next 12345,678"), (109, "   "), (110, "a" * 3000 + " " + "é" * 500),
    ]
    return [(r[0], r[1]) for r in odd_rows()] + odd + [(200 + i, prose(i % 7, 40)) for i in range(30)]


def test_equals_token_by_token_alignment(spark, files, monkeypatch):
    want, _ = brute_force(rows())
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 3000)  # several chunks a task
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in alignment.alignment_profile(docs, files).collect()), key=repr) == want


def test_a_single_space_at_the_end(spark, files):
    ends = [" ", "a ", "two words ", "日本 ", "a\n ", "a\u3000b ", "tail. ", "don't  ", "a b \n", "naïve <s> ", " x ", "▁ "]
    mine = [(i, t) for i, t in enumerate(ends)] + [(100, "a b"), (101, "two words")]
    want, groups = brute_force(mine)
    docs = spark.createDataFrame(mine, "doc_id long, text string")
    assert [r for r in want if r[0] == 2][0][1] > 0  # it has tokens
    assert sorted((tuple(r) for r in alignment.alignment_profile(docs, files).collect()), key=repr) == want
    for r in alignment.align(docs, files).collect():
        assert [(g["a"], g["b"], g["start"], g["end"]) for g in r["groups"]] == groups[r["doc_id"]]


def test_chunks_of_any_size_agree(files):
    voc = alignment.Vocabularies(files)
    texts = [t for _, t in rows()]
    whole = alignment.profiled(list(range(len(texts))), texts, voc)
    for i, t in enumerate(texts):
        alone = alignment.profiled([i], [t], voc)
        for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
            assert alone[name][0] == whole[name][i], (i, name)


def test_groups_of_a_text(spark, files):
    _, want = brute_force(rows())
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    for r in alignment.align(docs, files).where("doc_id >= 100").collect():
        assert [(g["a"], g["b"], g["start"], g["end"]) for g in r["groups"]] == want[r["doc_id"]]
    assert alignment.align(odd_docs(spark), files, to="kept").columns == odd_docs(spark).columns


def test_empty_table_and_clashing_columns(spark, files):
    assert alignment.alignment_profile(no_docs(spark), files).count() == 0
    named = odd_docs(spark).withColumnsRenamed({"doc_id": "chunk", "text": "place"})
    got = alignment.alignment_profile(named, files, "chunk", "place")
    assert got.columns[0] == "chunk" and got.count() == len(odd_rows())


def test_every_document_of_a_table(spark, files):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want, _ = brute_force([tuple(r) for r in docs.collect()])
    assert sorted((tuple(r) for r in alignment.alignment_profile(docs, files).collect()), key=repr) == want
