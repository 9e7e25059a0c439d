"""Packing documents into training sequences by linear grouping, then best fit.

Lengths are whole numbers up to the capacity, so the driver plans on the counts of lengths alone (a table of
at most ``capacity`` rows, whatever the number of documents):

1. Large lengths, in order, are cut into groups of equal cardinality and rounded up to their group's largest.
2. The few rounded sizes give a linear programme over configurations (multisets of sizes that fit one
   sequence), solved by column generation; each configuration is used as often as its value, rounded down.
3. Actual documents take the places of rounded ones, longest first.
4. What is left over, large and small, goes best-fit into the room that remains, longest first.

The plan is a list of intervals: documents of a length with ranks from .. to go into sequences from .. to.
Documents find their interval by their rank within their length.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.bpe import Vocabulary, merged, parsed
from leadloom.llm.ranks import bucket_count, ranked, unit, unit_bucket
from leadloom.llm.worker import give_back, kept
from leadloom.llm.words import Block, blocks, hashes, split
from leadloom.session import written

CAPACITY = 2048
GROUPS = 96
#: Lengths above this part of the capacity are large.
LARGE_PART = 3
#: Words a worker remembers before it starts anew; bounds its memory, not its results.
REMEMBERED = 1 << 18


class Interval(NamedTuple):
    """Documents of ``length`` with ranks ``first`` to ``last`` - 1: ``each`` of them go into a sequence, from
    ``sequence`` on, the first one of a sequence at ``offset``."""

    length: int
    first: int
    last: int
    sequence: int
    each: int
    offset: int


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down, by column generation: dual prices of the sizes
    come from the current basis, and a knapsack over the prices gives the configuration to enter."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amount = np.linalg.solve(basis, demand.astype(float))
    deepest = int(capacity // sizes.min())
    for _ in range(20 * m):
        price = np.linalg.solve(basis.T, np.ones(m))
        best = np.zeros((deepest + 1, capacity + 1))
        choice = np.full((deepest + 1, capacity + 1), -1)
        for depth in range(1, deepest + 1):
            best[depth] = best[depth - 1]
            for i in np.flatnonzero(price > 1e-12):
                s = sizes[i]
                value = best[depth - 1, : capacity + 1 - s] + price[i]
                better = value > best[depth, s:] + 1e-12
                best[depth, s:][better] = value[better]
                choice[depth, s:][better] = i
        if best[deepest, capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(m), capacity
        for depth in range(deepest, 0, -1):
            if (i := choice[depth, room]) >= 0:
                column[i] += 1
                room -= sizes[i]
        direction = np.linalg.solve(basis, column)
        positive = direction > 1e-9
        if not positive.any():
            break
        ratio = np.where(positive, amount / np.where(positive, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[out] * direction, 0)
        amount[out] = ratio[out]
        basis[:, out] = column
    return [(basis[:, i].astype(int), int(amount[i] + 1e-6)) for i in range(m) if amount[i] >= 1 - 1e-6]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Interval]:
    """Intervals that place every document of the given counts by length. Their number depends on the
    capacity and the groups, not on the counts."""
    stock = {n: [0, c] for n, c in counts.items() if c > 0}  # next rank, how many are left
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # sequences from .. to, by what room they have
    made: list[Interval] = []
    used = 0

    def take(length: int, n: int) -> int:
        stock[length][0] += n
        stock[length][1] -= n
        return stock[length][0] - n

    if capacity in stock:
        n = stock[capacity][1]
        made.append(Interval(capacity, take(capacity, n), n, 0, 1, 0))
        used = n
    large = sorted((n for n in stock if capacity // LARGE_PART < n < capacity), reverse=True)
    total = sum(stock[n][1] for n in large)
    if total:
        # groups of equal cardinality, as runs (length, how many), longest first
        # (few different lengths are groups of their own and need no rounding)
        per_group = -(-total // groups)
        runs, left = [], 0
        for n in large:
            c = stock[n][1]
            if len(large) <= groups:
                per_group, left = c, 0
            while c:
                if not left:
                    runs.append([])
                    left = per_group
                k = min(c, left)
                runs[-1].append([n, k])
                c, left = c - k, left - k
        sizes = np.array([g[0][0] for g in runs])
        demand = np.array([sum(k for _, k in g) for g in runs])
        merged_sizes = np.unique(sizes)[::-1]
        merged = [[r for g, s in zip(runs, sizes, strict=True) if s == size for r in g] for size in merged_sizes]
        merged_demand = np.array([demand[sizes == s].sum() for s in merged_sizes])
        for column, times in configurations(merged_sizes, merged_demand, capacity):
            slots = [i for i in range(len(column)) for _ in range(column[i])]
            queues = []
            for i in slots:
                queue, need = [], times
                while need and merged[i]:
                    n, c = merged[i][0]
                    k = min(c, need)
                    queue.append((n, k))
                    merged[i][0][1] -= k
                    if not merged[i][0][1]:
                        merged[i].pop(0)
                    need -= k
                queues.append((queue, times - need))
            for queue, filled in queues:
                assert filled <= times, (queue, filled)
            # stretches of sequences with the same lengths in every slot
            fill = [(used, used + times, 0)]
            for queue, _ in queues:
                at, after = used, []
                pieces = iter(fill)
                low, high, offset = next(pieces)
                for n, k in queue:
                    while k:
                        part = min(k, high - at)
                        made.append(Interval(n, rank := take(n, part), rank + part, at, 1, offset))
                        after.append((at, at + part, offset + n))
                        at, k = at + part, k - part
                        if at == high:
                            low, high, offset = next(pieces, (at, at, 0))
                while at < used + times:
                    after.append((at, high, offset))
                    low, high, offset = next(pieces, (high, used + times, 0)) if high < used + times else (high, high, 0)
                    at = after[-1][1]
                fill = after
            for low, high, offset in fill:
                if offset < capacity:
                    room[capacity - offset].append((low, high))
            used += times
    open_rooms = np.zeros(capacity + 1, dtype=bool)
    open_rooms[[r for r, v in room.items() if v]] = True

    def put(length: int, low: int, n: int, each: int, free: int) -> None:
        """``each`` documents into each of ``n`` sequences from ``low`` on, which have ``free`` room."""
        first = take(length, n * each)
        made.append(Interval(length, first, first + n * each, low, each, capacity - free))
        if free > each * length:
            room[free - each * length].append((low, low + n))
            open_rooms[free - each * length] = True

    for length in sorted((n for n in stock if n < capacity), reverse=True):
        while (count := stock[length][1]) > 0:
            fits = np.flatnonzero(open_rooms[length:])
            if len(fits):
                free = length + int(fits[0])
                low, high = room[free].pop()
                open_rooms[free] = bool(room[free])
            else:
                free, low = capacity, used
                high = used = used + -(-count // (capacity // length))
            each = free // length
            whole = min(high - low, count // each)
            if whole:
                put(length, low, whole, each, free)
                low += whole
            rest = stock[length][1]
            if low < high and 0 < rest < each:
                put(length, low, 1, rest, free)
                low += 1
            if low < high:
                room[free].append((low, high))
                open_rooms[free] = True
    return made


def _encoder(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task for each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Memory:
    """Ids of words met before: by a word's hash its number, by number its place in one pool."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.number: dict[int, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.size = np.zeros(1 << 16, dtype=np.int64)
        self.used = 0

    def add(self, keys: list[int], flat: np.ndarray, sizes: np.ndarray) -> None:
        n, more = len(self.number), len(keys)
        while len(self.pool) < self.used + len(flat):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.start) < n + more:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.start[n : n + more] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + more] = sizes
        self.number.update(zip(keys, range(n, n + more), strict=True))
        self.used += len(flat)


_LETTER, _DIGIT, _OTHER, _ODD = 0, 1, 2, 3
_CLASS = np.full(256, _LETTER, dtype=np.int8)
_CLASS[:128] = _OTHER
_CLASS[48:58] = _DIGIT
_CLASS[97:123] = _CLASS[65:91] = _LETTER
_CLASS[:33] = _CLASS[[39, 127]] = _ODD


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray, voc: Vocabulary, tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, one after the other, and how many each has. Words of ASCII and the Latin letters of the
    next block are lower-cased, cut where the kind of character changes and merged as arrays; words
    with anything else (other scripts, apostrophes, control characters, special strings) go to the library."""
    sizes = end - start
    at = np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    byte, owner = data[at], np.repeat(np.arange(len(start)), sizes)
    lead = byte == 0xC3
    second = np.append(False, lead[:-1])
    odd = (_CLASS[byte] == _ODD) | ((byte >= 0x80) & ~lead & ~second) | (second & ((byte == 0x97) | (byte == 0xB7) | (byte < 0x80)))
    odd |= (byte == 0x7C) & np.append(False, byte[:-1] == 0x3C)  # special strings begin with <|
    strange = np.unique(owner[odd])
    plain = np.ones(len(start), dtype=bool)
    plain[strange] = False
    keep = plain[owner]
    byte, owner, second = byte[keep], owner[keep], second[keep]
    byte = np.where((byte >= 65) & (byte < 91) | second & (byte >= 0x80) & (byte < 0x9F), byte + 32, byte).astype(np.uint8)
    kind = _CLASS[byte]
    begin = np.ones(len(byte), dtype=bool)
    begin[1:] = (owner[1:] != owner[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    token = np.cumsum(begin) - 1
    symbols = voc.symbol[byte]
    last = np.append(begin[1:], True)[: len(byte)]
    symbols[last] = voc.final[byte[last]]
    flat, of_token = merged(symbols, token, voc)
    word = owner[np.flatnonzero(begin)][of_token] if len(flat) else of_token
    if len(strange):
        texts = [data[start[p] : end[p]].tobytes().decode() for p in strange.tolist()]
        encoded = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([flat, np.array([i for ids in encoded for i in ids], dtype=np.int64)])
        word = np.concatenate([word, np.repeat(strange, [len(ids) for ids in encoded])])
        order = np.argsort(word, kind="stable")
        flat, word = flat[order], word[order]
    return flat.astype(np.uint32), np.bincount(word, minlength=len(start))


def block_ids(block: Block, voc: Vocabulary, tokenizer, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the block's rows, one row after the other, and how many each row has. The vocabulary drops
    white space and never joins words, so each distinct word is encoded once."""
    words = split(block)
    rows = len(block.bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(words.bounds))
    code, unique = pd.factorize(hashes(block.data, words.start, words.end))
    if len(memory.number) + len(unique) > REMEMBERED and memory.number:
        memory.forget()
    known = np.array([memory.number.get(h, -1) for h in unique.tolist()], dtype=np.int64)
    new = np.flatnonzero(known < 0)
    if len(new):
        place = np.zeros(len(unique), dtype=np.int64)
        place[code[::-1]] = np.arange(len(code))[::-1]
        known[new] = len(memory.number) + np.arange(len(new))
        at = place[new]
        memory.add(unique[new].tolist(), *word_ids(block.data, words.start[at], words.end[at], voc, tokenizer))
    number = known[code]
    sizes = memory.size[number] if len(number) else np.zeros(0, np.int64)
    begin = np.cumsum(sizes) - sizes
    at = np.repeat(memory.start[number] - begin, sizes) + np.arange(sizes.sum())
    return memory.pool[at], np.bincount(row, sizes, rows).astype(np.int64)


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: the key, ``piece`` (from 0), ``start`` (the document's
    ids before it), ``length``, ``ids_crc32`` (of the ids as little-endian 32-bit numbers) and, if asked for,
    ``ids``. A document is its text's ids (none for null or empty) and the id 0 that ends it; only longer ones
    are cut. Special strings inside texts are taken as the library takes them."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept("packing", ("tokenizer", zlib.crc32(spec.encode())), lambda: _encoder(spec))
        voc = kept("packing", ("vocabulary", zlib.crc32(spec.encode())), lambda: parsed(spec))
        memory = kept("packing", ("ids", zlib.crc32(spec.encode())), Memory)
        for batch in batches:
            for block in blocks(batch.column(1)):
                flat, sizes = block_ids(block, voc, tokenizer, memory)
                source, piece, start, length, crc, parts = [], [], [], [], [], []
                at = 0
                for i, n in enumerate(sizes.tolist()):
                    own = np.append(flat[at : at + n], np.uint32(0)).astype("<u4")
                    at += n
                    for k, low in enumerate(range(0, n + 1, capacity)):
                        part = own[low : low + capacity]
                        source.append(block.first + i)
                        piece.append(k)
                        start.append(low)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if ids:
                            parts.append(part.astype(np.int32))
                columns = [batch.column(0).take(pa.array(source, pa.int64()))]
                columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])
            give_back("packing")

    return docs.select(key, text).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where each piece lies. Offsets of a sequence are gapless
    from 0, and no sequence exceeds the capacity.

    Null keys and repeated rows are placed like others; ties are broken by key, piece and checksum. An empty
    table gives no rows. Columns other than key and text are not read. Pieces are kept in the shared
    scratch folder, so texts are tokenized once; with ``ids`` they carry their ids (``sequences`` joins them).
    """
    cut = written(pieces(docs, tokenizer_path, capacity, key, text, ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    spark = docs.sparkSession
    schema = "length long, _first long, _last long, _sequence long, _each long, _offset long"
    intervals = spark.createDataFrame([tuple(i) for i in plan(counts, capacity)], schema)
    order = ["_hash", key, "piece", "ids_crc32"]
    numbered = ranked(
        cut.withColumn("_hash", unit(F.col(key), F.col("piece"), F.col("ids_crc32"))).withColumn(
            "_at", unit_bucket(F.col("_hash"), bucket_count(sum(counts.values())))
        ),
        ["length"],
        "_at",
        order,
    )
    # the plan's size is bounded by the capacity, so it may be broadcast
    placed = numbered.join(
        F.broadcast(intervals),
        (numbered["length"] == intervals["length"]) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last")),
    )
    return placed.select(
        *[numbered[c] for c in cut.columns],
        F.expr("_sequence + (_rank - _first) div _each").alias("sequence_id"),
        (F.col("_offset") + (F.col("_rank") - F.col("_first")) % F.col("_each") * numbered["length"]).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack(.., ids=True)``: ``sequence_id``, its ``ids`` and how many. A
    sequence has at most the capacity, so a group stays small."""
    joined = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    return joined.select("sequence_id", F.flatten(F.col("_parts.ids")).alias("ids")).withColumn("n_ids", F.size("ids"))


def op8_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
