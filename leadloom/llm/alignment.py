"""Two tokenizations of the same texts, laid side by side by coalescing intervals.

A byte-level vocabulary (A) and a piece vocabulary (B) each part a text into tokens that cover its bytes. The tokens of
both are sorted by start, the largest end so far is accumulated, and a group ends where the next start reaches it; within
a group, A and B tokens whose bytes overlap are linked. How often each id pair is linked is counted over the corpus.

Neither vocabulary has tokens that run from a character into a space after it, so a text may be cut before the first space of
a run (a single space at its end stays with what is before it): both then encode the stretches one by one as they would encode the whole. Stretches repeat, so a task takes
texts in chunks and encodes and aligns each distinct stretch of a chunk once. What a chunk has found is written:
its pair counts are added up over the corpus by a shuffle on the pair, and come back to the chunk by its number.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.bpe import byte_letters
from leadloom.llm.worker import give_back, kept, small_batches
from leadloom.llm.words import SPACE
from leadloom.session import written

#: Bytes of text that make a chunk; one longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Distinct stretches that are encoded at once, and characters of them that A gets as one text.
ENCODED_AT_ONCE, JOINED = 20_000, 2_000


class Files(NamedTuple):
    """The contents of the two vocabulary files, as they travel to the workers."""

    bytes_json: str
    piece_model: bytes


class Ragged(NamedTuple):
    """Values of row i: ``flat[bounds[i] : bounds[i + 1]]``."""

    flat: np.ndarray
    bounds: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.sizes())


def read_files(bytes_path: str, piece_path: str) -> Files:
    """Reads the vocabulary files on the driver; workers get their contents."""
    with open(bytes_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        return Files(a.read(), b.read())


def ragged(lists: list[Any], dtype: type) -> Ragged:
    """``lists`` of whole numbers, or byte strings."""
    bounds = np.append(0, np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists))))
    return Ragged(np.fromiter(chain.from_iterable(lists), dtype, bounds[-1]), bounds)


def stacked(parts: list[Ragged]) -> Ragged:
    """The rows of all parts, one after the other."""
    if not parts:
        return ragged([], np.int32)
    ends = np.cumsum([0, *[p.bounds[-1] for p in parts]])
    bounds = [p.bounds[:-1] + e for p, e in zip(parts, ends, strict=False)]
    return Ragged(np.concatenate([p.flat for p in parts]), np.append(np.concatenate(bounds), ends[-1]))


def positions(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + sizes[i] - 1 of every i, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class Vocabularies:
    """Both tokenizers of a worker, and the bytes that their tokens stand for."""

    def __init__(self, files: Files) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.bytes_json)
        self.a.encode_special_tokens = True  # special strings inside texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.piece_model)
        tree = json.loads(files.bytes_json)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        spelled = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in byte_of for c in entry)
            spelled[i] = bytes(byte_of[c] for c in entry) if known else entry.encode()
        self.a_bytes = ragged(spelled, np.uint8)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        spelled = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.b_bytes = ragged(spelled, np.uint8)
        first = tree.get("pre_tokenizer") or {}
        #: Whether texts may be cut before a run of spaces.
        self.parts = (
            first.get("type") == "ByteLevel" and first.get("use_regex", True)
            and not any("▁" in p.lstrip("▁") for p in pieces)
        )

    def encode(self, stretches: list[bytes]) -> tuple[Ragged, Ragged]:
        """Ids of A and of B for each stretch; a stretch begins with the space that B adds by itself."""
        a, b = [], []
        for i in range(0, len(stretches), ENCODED_AT_ONCE):
            some = stretches[i : i + ENCODED_AT_ONCE]
            a.append(self.encode_a(some))
            b.append(ragged(self.b.encode([s[1:].decode() for s in some], num_threads=1), np.int32))
        return stacked(a), stacked(b)

    def encode_a(self, stretches: list[bytes]) -> Ragged:
        """Ids of A. Stretches that end in no white space are encoded joined, as they might stand in a text, and parted again."""
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        able = [i for i, s in enumerate(stretches) if self.parts and s[0] == 32 and s[-1] < 128 and not SPACE[s[-1]]]
        ends = np.cumsum(lengths[able])
        joins = np.split(np.array(able, dtype=np.int64), np.flatnonzero(np.diff(ends // JOINED)) + 1)
        sizes, order, parts, counts = self.a_bytes.sizes(), [], [], []
        texts = [b"".join([stretches[i] for i in j]).decode() for j in joins]
        alone = np.setdiff1d(np.arange(len(stretches)), able).tolist()
        for j, e in zip(joins, self.a.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found = np.array(e.ids, np.int32)
            ends, want = np.cumsum(sizes[found]), np.cumsum(lengths[j])
            at = np.searchsorted(ends, want)
            if len(found) and ends[-1] == want[-1] and np.array_equal(ends[at], want):
                order.append(j)
                parts.append(found)
                counts.append(np.diff(at, prepend=-1))
            else:
                alone += j.tolist()
        rest = ragged([e.ids for e in self.a.encode_batch_fast([stretches[i].decode() for i in alone], add_special_tokens=False)], np.int32)
        place = np.concatenate([*order, np.array(alone, dtype=np.int64)])
        size = np.concatenate([*counts, rest.sizes()]).astype(np.int64)
        flat, first = np.concatenate([*parts, rest.flat]), np.cumsum(size) - size
        back = np.argsort(place, kind="stable")
        return Ragged(flat[positions(first[back], size[back])], np.append(0, np.cumsum(size[back])))


def vocabularies(files: Files) -> Vocabularies:
    return kept("alignment", hash(files), lambda: Vocabularies(files))


def wide_spaces(data: np.ndarray) -> np.ndarray:
    """Where a white-space character outside ASCII begins."""
    b, c = np.append(data[1:], 0), np.append(data[2:], [0, 0])[: len(data)]
    odd = (data == 0xC2) & ((b == 0x85) | (b == 0xA0))
    odd |= (data == 0xE1) & (b == 0x9A) & (c == 0x80)
    odd |= (data == 0xE2) & (b == 0x80) & (c >= 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    odd |= (data == 0xE2) & (b == 0x81) & (c == 0x9F)
    odd |= (data == 0xE3) & (b == 0x80) & (c == 0x80)
    return np.flatnonzero(odd)


def stretches(texts: list[bytes], cut: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The stretches of all texts, one after the other, and where each text's begin (and the end). A text is cut before a run of
    spaces that follows something else, but not before a single space at its end: B adds a stretch's first space by itself, and a stretch
    without more would be the empty text to it. Texts with white space outside ASCII stay whole."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64)).astype(np.int64)
    begins = np.zeros(len(data) + 1, dtype=bool)
    if cut and len(data):
        begins[1:-1] = (data[1:] == 32) & ~SPACE[data[:-1]]
        begins[bounds[1:] - 1] = False
        for row in np.unique(np.searchsorted(bounds, wide_spaces(data), "right") - 1):
            begins[bounds[row] : bounds[row + 1]] = False
    begins[bounds] = True
    edges = np.flatnonzero(begins)
    counts = np.searchsorted(edges, bounds)
    column = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    return column.dictionary_encode(), counts


def _bytes_of(column: pa.LargeBinaryArray) -> Ragged:
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Ragged(data[bounds[0] : bounds[-1]], bounds - bounds[0])


class Aligned(NamedTuple):
    """What both vocabularies make of each distinct stretch; rows that are not ``good`` (the tokens do not spell the
    stretch) have no tokens. ``order``: the tokens of A, then B, sorted by group, A first; ``group``: of each of these;
    ``link_a``, ``link_b``: places of linked tokens, by row; ``first_a``, ``first_b``: byte offset of each token in its stretch."""

    good: np.ndarray
    a: Ragged
    b: Ragged
    order: np.ndarray
    group: np.ndarray
    n_groups: np.ndarray
    link_row: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray


def _spells(ids: Ragged, spelled: Ragged, text: Ragged) -> np.ndarray:
    """Whether the tokens of each row spell its bytes."""
    sizes = spelled.sizes()[ids.flat]
    total = np.append(0, np.cumsum(sizes))[ids.bounds]
    good = np.diff(total) == text.sizes()
    token = np.repeat(good, ids.sizes())
    mine = spelled.flat[positions(spelled.bounds[:-1][ids.flat[token]], sizes[token])]
    theirs = text.flat[positions(text.bounds[:-1][good], text.sizes()[good])]
    wrong = np.flatnonzero(mine != theirs)
    if len(wrong):
        rows = np.flatnonzero(good)
        good[rows[np.searchsorted(np.cumsum(text.sizes()[good]), wrong, "right")]] = False
    return good


def _only(ids: Ragged, good: np.ndarray) -> Ragged:
    sizes = np.where(good, ids.sizes(), 0)
    return Ragged(ids.flat[np.repeat(good, ids.sizes())], np.append(0, np.cumsum(sizes)))


def coalesced(text: Ragged, a: Ragged, b: Ragged, voc: Vocabularies) -> Aligned:
    """Groups and links of every row's tokens: all rows lie one behind the other on one line of bytes."""
    good = _spells(a, voc.a_bytes, text) & _spells(b, voc.b_bytes, text)
    a, b = _only(a, good), _only(b, good)
    sizes = [np.diff(v.bounds)[x.flat] for x, v in ((a, voc.a_bytes), (b, voc.b_bytes))]
    inside = [np.cumsum(n) - n for n in sizes]
    starts, ends = [], []
    for x, n, at in zip((a, b), sizes, inside, strict=True):
        head = np.append(at, n.sum())[x.bounds[:-1]]  # of each row's first token
        at -= np.repeat(head, x.sizes())
        starts.append(at + np.repeat(text.bounds[:-1], x.sizes()))
        ends.append(starts[-1] + n)
    start, end = np.concatenate(starts), np.concatenate(ends)
    side = np.repeat([0, 1], [len(a.flat), len(b.flat)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.append(True, start[order][1:] >= reach[:-1])[: len(order)]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    row = np.concatenate([a.rows(), b.rows()])
    n_groups = np.bincount(row[order][fresh], minlength=len(good))
    order = np.lexsort((start, side, group))
    low = np.searchsorted(ends[1], starts[0], "right")
    wide = np.searchsorted(starts[1], ends[0], "left") - low
    link_a = np.repeat(np.arange(len(a.flat)), wide)
    return Aligned(
        good, a, b, order, group[order], n_groups, np.repeat(a.rows(), wide), link_a, positions(low, wide), inside[0], inside[1]
    )


def _digits(most: int) -> np.ndarray:
    """The decimal digits of 0 .. most, right-aligned; zero bytes before them."""
    width = len(str(most))
    numbers = np.arange(most + 1)
    out = np.zeros((most + 1, width), dtype=np.uint8)
    for k in range(width):
        scale = 10**k
        out[:, width - 1 - k] = np.where((numbers >= scale) | (k == 0), numbers // scale % 10 + 48, 0)
    return out


def spelled_groups(found: Aligned, digits: np.ndarray) -> Ragged:
    """Each row's groups as ``a1,a2|b1;a3|b2,b3;``: ids in order, with a semicolon behind every group."""
    ids = np.concatenate([found.a.flat, found.b.flat])[found.order]
    row = np.concatenate([found.a.rows(), found.b.rows()])[found.order]
    side = found.order >= len(found.a.flat)
    after = np.full(len(ids), ord(";"), dtype=np.uint8)
    if len(ids):
        same = found.group[1:] == found.group[:-1]
        after[:-1] = np.where(same, np.where(side[1:] == side[:-1], ord(","), ord("|")), ord(";"))
    cells = np.concatenate([digits[ids], after[:, None]], 1)
    held = cells != 0
    sizes = np.bincount(row, held.sum(1), len(found.good)).astype(np.int64)
    return Ragged(cells[held], np.append(0, np.cumsum(sizes)))


def _sums(values: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text, the sum of ``values`` over its stretches."""
    return np.diff(np.append(0, np.cumsum(values[codes]))[bounds]).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(blob: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=dtype)


def profiled(keys: list[Any], texts: list[str | None], voc: Vocabularies) -> dict[str, Any]:
    """One chunk: per text the counts and the digest of its groups, and what the corpus-wide counts are needed for."""
    full = [i for i, t in enumerate(texts) if t]
    coded, bounds = stretches([b" " + texts[i].encode() for i in full], voc.parts)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    text = _bytes_of(coded.dictionary)
    found = coalesced(text, *voc.encode(distinct), voc)
    # a text with a stretch that one side does not spell has no tokens at all
    whole = _sums(~found.good, codes, bounds) == 0
    kept_codes = codes[np.repeat(whole, np.diff(bounds))]
    kept_bounds = np.append(0, np.cumsum(np.where(whole, np.diff(bounds), 0)))
    spelled = spelled_groups(found, _digits(max(len(voc.a_bytes.bounds), len(voc.b_bytes.bounds))))
    sizes = spelled.sizes()
    digests, line = [], spelled.flat
    for i in range(len(full)):
        mine = kept_codes[kept_bounds[i] : kept_bounds[i + 1]]
        string = line[positions(spelled.bounds[:-1][mine], sizes[mine])].tobytes()[:-1]
        digests.append(hashlib.sha256(string).hexdigest() if string else "")
    per_link = np.bincount(found.link_row, minlength=len(distinct))
    times = np.bincount(kept_codes, minlength=len(distinct))
    a_id, b_id = found.a.flat[found.link_a].astype(np.int64), found.b.flat[found.link_b].astype(np.int64)
    pair, at = np.unique(a_id << 32 | b_id, return_inverse=True)
    counts = np.bincount(at, times[found.link_row], len(pair)).astype(np.int64)
    used = counts > 0

    def spread(values: np.ndarray) -> list[int]:
        out = np.zeros(len(texts), dtype=np.int64)
        out[full] = _sums(values, kept_codes, kept_bounds)
        return out

    names = [""] * len(texts)
    for i, digest in zip(full, digests, strict=True):
        names[i] = digest
    lines = np.zeros(len(texts), dtype=np.int64)
    lines[full] = np.diff(kept_bounds)
    return {
        "keys": keys, "n_a": spread(found.a.sizes()), "n_b": spread(found.b.sizes()), "n_groups": spread(found.n_groups),
        "n_links": spread(per_link), "groups_sha256": names,
        "lines": _packed(lines), "codes": _packed(kept_codes.astype(np.int32)),
        "links": _packed(at.astype(np.int32)), "per_link": _packed(per_link.astype(np.int64)), "pairs": len(pair),
        "place": np.flatnonzero(used), "a": (pair[used] >> 32).astype(np.int32), "b": (pair[used] & 0xFFFFFFFF).astype(np.int32),
        "n": counts[used],
    }


def _chunk_type(key: T.DataType) -> T.StructType:
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    kinds = {
        "chunk": T.LongType(), "keys": T.ArrayType(key), "n_a": longs, "n_b": longs, "n_groups": longs, "n_links": longs,
        "groups_sha256": T.ArrayType(T.StringType()), "lines": T.BinaryType(), "codes": T.BinaryType(), "links": T.BinaryType(),
        "per_link": T.BinaryType(), "pairs": T.LongType(), "place": longs, "a": ints, "b": ints, "n": longs,
    }
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[Any], list[str | None]]]:
    """The keys and texts of the batches in chunks of about CHUNK_BYTES."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            more = len(text or "")
            if texts and size + more > CHUNK_BYTES:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(text)
            size += more
    if keys:
        yield keys, texts


def alignment_profile(docs: DataFrame, files: Files, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key, ``n_a`` and ``n_b`` (tokens), ``n_groups``, ``n_links`` (pairs of token occurrences
    whose bytes overlap), ``n_best`` (links whose id pair is linked as often, in all of ``docs``, as any pair of its B id),
    ``count_sum`` (how often the pairs of its links are linked in all of ``docs``, summed over links) and ``groups_sha256``.

    The text is taken whole, with a space before it. Null and empty texts, and texts that the tokens of A or of B do not spell byte by
    byte, have no tokens: zeros and an empty digest; they count in no pair. Rows repeated under one key, a null key
    among them, give a row each, and each counts in the pairs. An empty table gives no rows. Other columns are not read.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = _chunk_type(source.schema["key"].dataType)
    names = kind.fieldNames()

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, voc, at = to_arrow_schema(kind), vocabularies(files), TaskContext.get().partitionId() << 32
        for keys, texts in _chunked(batches):
            row = {"chunk": at, **profiled(keys, texts, voc)}
            yield pa.RecordBatch.from_arrays([pa.array([row[n]], schema.field(n).type) for n in names], schema=schema)
            del keys, texts, row
            give_back("alignment")
            at += 1

    chunks = written(source.mapInArrow(profile, kind), "aligned")
    pairs = chunks.select("chunk", F.explode(F.arrays_zip("place", "a", "b", "n")).alias("p")).select("chunk", "p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    most = counts.groupBy("b").agg(F.max("total").alias("most"))  # a row for each id of B at most
    counts = counts.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    back = pairs.join(counts, ["a", "b"]).select(F.col("chunk").alias("of"), "place", "total", "best")
    result = T.StructType([T.StructField("key", kind["keys"].dataType.elementType)] + [
        T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    ] + [T.StructField("groups_sha256", T.StringType())])

    def summed(mine: pa.Table, pairs: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(result)
        if not mine.num_rows:
            return out.empty_table()
        row = {c: mine[c][0].as_py() for c in ("pairs", "links", "per_link", "codes", "lines")}
        total, best = np.zeros((2, row["pairs"]), dtype=np.int64)
        place = pairs["place"].to_numpy()
        total[place], best[place] = pairs["total"].to_numpy(), pairs["best"].to_numpy().astype(np.int64)
        links, sizes = _unpacked(row["links"], np.int32), _unpacked(row["per_link"], np.int64)
        ends = np.append(0, np.cumsum(sizes))
        codes, bounds = _unpacked(row["codes"], np.int32), np.append(0, np.cumsum(_unpacked(row["lines"], np.int64)))
        n_best, count_sum = (
            _sums(np.diff(np.append(0, np.cumsum(values[links]))[ends]), codes, bounds) for values in (best, total)
        )
        told = {"n_best": n_best, "count_sum": count_sum}
        column = lambda name: pa.array(told[name]) if name in told else mine["keys" if name == "key" else name].combine_chunks().flatten()
        return pa.table([column(f.name) for f in out], schema=out)

    done = chunks.drop("place", "a", "b", "n").groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(summed, result)
    return done.withColumnRenamed("key", key)


_GROUPS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType())),
]))


def groups_of(text: str | None, voc: Vocabularies) -> list[dict[str, Any]]:
    """The groups of one text: byte offsets in the text with a space before it, and the ids of A and of B."""
    if not text:
        return []
    raw = b" " + text.encode()
    line = Ragged(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    found = coalesced(line, *voc.encode([raw]), voc)
    n, first, out = len(found.a.flat), np.concatenate([found.first_a, found.first_b]), []
    for place, group in zip(found.order.tolist(), found.group.tolist(), strict=True):
        if group == len(out):
            out.append({"start": int(first[place]), "end": len(raw), "a": [], "b": []})
            if group:
                out[-2]["end"] = out[-1]["start"]
        out[-1]["a" if place < n else "b"].append(int(found.a.flat[place] if place < n else found.b.flat[place - n]))
    return out


def align(docs: DataFrame, files: Files, text: str = "text", to: str = "groups") -> DataFrame:
    """``docs`` with a column ``to``: the groups of each text, ``start`` and ``end`` (byte offsets in the text with a space before it) and the ids ``a`` and
    ``b`` of both vocabularies. Texts that are null, empty or not spelled by the tokens have an empty list. All rows and
    other columns stay; a column named as ``to`` is replaced."""

    @F.arrow_udf(_GROUPS)
    def groups(column: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        voc = vocabularies(files)
        return pa.array([groups_of(t, voc) for t in column.to_pylist()], to_arrow_type(_GROUPS))

    return docs.withColumn(to, groups(F.col(text)))


def op11_interval_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    files = read_files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment_profile(spark.read.parquet(f"{sf_dir}/documents.parquet"), files)
