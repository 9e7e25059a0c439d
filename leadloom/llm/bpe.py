"""Token counts of a byte-level BPE vocabulary, without the tokenizer library on the workers.

A text is cut into stretches that tokenize independently: a word with the space before it, and what else
stands between words. Stretches repeat a lot, so each worker merges new ones only. New stretches are
split into pre-tokens, held together as one ragged array of symbols, and merged rank by rank for all of
them at once: in each round every pre-token applies its own lowest-ranked pair at all its places.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.worker import kept
from leadloom.llm.words import Block, blocks, hashes, split

#: Stretches a worker remembers before it starts anew; bounds its memory, not its results.
REMEMBERED = 1 << 20
LIMIT = 512

# The pre-token pattern of the vocabulary, with white space as the Unicode property.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+|[" + WHITE + r"]+(?![^" + WHITE + r"])|[" + WHITE + "]+"
)


class Vocabulary(NamedTuple):
    """``symbol`` and ``final``: ids of each byte, and of each byte as the last one of a pre-token; ``slots``: an
    open-addressed table of pair keys; ``ranks`` and ``results``: rank and merged id of the pair in a slot;
    ``special``: special strings."""

    symbol: np.ndarray
    final: np.ndarray
    slots: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    base: int
    special: tuple[str, ...]


_SLOT_BITS = 19
_NO_PAIR = np.iinfo(np.int64).max


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return letters


def parsed(spec: str) -> Vocabulary:
    """The vocabulary of a tokenizer file's text, as arrays."""
    tree = json.loads(spec)
    ids, letters = tree["model"]["vocab"], byte_letters()
    end = tree["model"].get("end_of_word_suffix") or ""
    merges = [m if isinstance(m, list) else m.split(" ") for m in tree["model"]["merges"]]
    base = max(ids.values()) + 1
    slots = np.full(1 << _SLOT_BITS, -1, dtype=np.int64)
    ranks, results = np.full(len(slots), _NO_PAIR), np.zeros(len(slots), dtype=np.int64)
    keys = np.array([ids[a] * base + ids[b] for a, b in merges], dtype=np.int64)
    for rank, (key, at, (a, b)) in enumerate(zip(keys.tolist(), _slot(keys).tolist(), merges, strict=True)):
        while slots[at] >= 0:
            at = (at + 1) % len(slots)
        slots[at], ranks[at], results[at] = key, rank, ids[a + b]
    special = tuple(t["content"] for t in tree.get("added_tokens") or ())
    symbol = np.array([ids[letters[b]] for b in range(256)], dtype=np.int64)
    final = np.array([ids[letters[b] + end] for b in range(256)], dtype=np.int64)
    return Vocabulary(symbol, final, slots, ranks, results, base, special)


def vocabulary(path: str) -> Vocabulary:
    """Reads a tokenizer file on the driver; workers get the arrays."""
    with open(path, encoding="utf-8") as f:
        return parsed(f.read())


def pairs(keys: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Rank (or _NO_PAIR) and slot of each pair key."""
    at = _slot(keys)
    held = voc.slots[at]
    open_ = np.flatnonzero((held != keys) & (held >= 0))
    while len(open_):
        at[open_] = (at[open_] + 1) % len(voc.slots)
        held[open_] = voc.slots[at[open_]]
        open_ = open_[(held[open_] != keys[open_]) & (held[open_] >= 0)]
    return np.where(held == keys, voc.ranks[at], _NO_PAIR), at


def merged(symbols: np.ndarray, owner: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that are left when no pair can be merged any more. ``owner``: the pre-token of each symbol,
    in ascending order. Each round merges the lowest-ranked pair of every pre-token at all its places."""
    done = []
    while len(symbols):
        same = owner[:-1] == owner[1:]
        key = np.where(same, symbols[:-1] * voc.base + symbols[1:], -1)
        rank, at = np.full(len(symbols), _NO_PAIR), np.zeros(len(symbols), dtype=np.int64)
        inside = np.flatnonzero(same)
        rank[inside], at[inside] = pairs(key[inside], voc)
        first = np.flatnonzero(np.append(True, ~same))
        lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(symbols))))
        active = lowest < _NO_PAIR
        if not active.all():  # pre-tokens at their end leave the array
            done.append((symbols[~active], owner[~active]))
            symbols, owner, rank, at, lowest = symbols[active], owner[active], rank[active], at[active], lowest[active]
        place = np.flatnonzero(rank == lowest)
        # a pair of equal symbols may overlap itself: of each run of neighbours, every other place is taken
        start = np.append(True, np.diff(place) != 1)[: len(place)]
        since = np.arange(len(place)) - np.flatnonzero(start)[np.cumsum(start) - 1]
        place = place[since % 2 == 0]
        symbols[place] = voc.results[at[place]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[place + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    symbols, owner = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, np.int64) for i in (0, 1))
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]


def merged_counts(pieces: list[bytes], voc: Vocabulary) -> np.ndarray:
    """How many symbols are left of each pre-token."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    symbols = voc.symbol[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    symbols[np.cumsum(sizes) - 1] = voc.final[[p[-1] for p in pieces]]
    return np.bincount(merged(symbols, np.repeat(np.arange(len(pieces)), sizes), voc)[1], minlength=len(pieces))


def text_counts(texts: list[str], voc: Vocabulary) -> np.ndarray:
    """Tokens of whole strings: special strings count one each and part the text, the rest is merged."""
    pattern = regex.compile(PATTERN)  # the module remembers it
    special = regex.compile("|".join(map(regex.escape, sorted(voc.special, key=len, reverse=True)))) if voc.special else None
    index: dict[str, int] = {}
    row, at, extra = [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        parts = special.split(text) if special else [text]
        extra[i] = len(parts) - 1
        for part in parts:
            for token in pattern.findall(part):
                row.append(i)
                at.append(index.setdefault(token, len(index)))
    if not row:
        return extra
    counts = merged_counts([t.encode() for t in index], voc)
    return extra + np.bincount(row, counts[at], len(texts)).astype(np.int64)


def _odd_rows(block: Block, voc: Vocabulary) -> np.ndarray:
    """Rows that must be taken whole: they hold white space outside ASCII, or a special string."""
    d = block.data
    a, b, c = d, np.append(d[1:], 0), np.append(d[2:], [0, 0])[: len(d)]
    odd = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    odd |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) & (c >= 0x80)
    odd |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    odd |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    odd |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    for s in voc.special:
        head = s.encode()[:3].ljust(3, b"\0")
        odd |= (a == head[0]) & ((b == head[1]) | (head[1] == 0)) & ((c == head[2]) | (head[2] == 0))
    return np.unique(np.searchsorted(block.bounds, np.flatnonzero(odd), "right") - 1)


def block_counts(block: Block, voc: Vocabulary, memory: dict[int, int]) -> np.ndarray:
    """Token counts of the block's rows. ``memory``: stretches met before, by their hash."""
    rows, data = len(block.bounds) - 1, block.data
    total = np.zeros(rows, dtype=np.int64)
    if not len(data):
        return total
    odd = _odd_rows(block, voc)
    total[odd] = text_counts([data[block.bounds[i] : block.bounds[i + 1]].tobytes().decode() for i in odd], voc)
    words = split(block)
    row = np.repeat(np.arange(rows), np.diff(words.bounds))
    begin = block.bounds[row]
    # a word takes along one space before it
    spaced = (words.start > begin) & (data[np.maximum(words.start - 1, 0)] == 32)
    start = words.start - spaced
    # what stands before the word: all but its last white-space byte, and that one unless it is a space
    before = np.where(np.append(True, row[1:] != row[:-1]), begin, np.append(0, words.end[:-1])) if len(row) else begin
    long = np.flatnonzero(words.start - before > 1)
    single = np.flatnonzero((words.start > before) & ~spaced)
    # and what follows the last word of a row
    filled = np.diff(words.bounds) > 0
    tail = block.bounds[:-1].copy()
    tail[filled] = words.end[words.bounds[1:][filled] - 1]
    rest = np.flatnonzero(block.bounds[1:] > tail)
    parts = [
        (start, words.end, row),
        (before[long], words.start[long] - 1, row[long]),
        (words.start[single] - 1, words.start[single], row[single]),
        (tail[rest], block.bounds[1:][rest], rest),
    ]
    value = np.concatenate([hashes(data, s, e) for s, e, _ in parts])
    s, e, r = (np.concatenate([p[i] for p in parts]) for i in range(3))
    code, unique = pd.factorize(value)
    known = np.array([memory.get(h, -1) for h in unique.tolist()], dtype=np.int64)
    new = np.flatnonzero(known < 0)
    if len(new):
        place = np.zeros(len(unique), dtype=np.int64)
        place[code[::-1]] = np.arange(len(code))[::-1]
        known[new] = text_counts([data[s[p] : e[p]].tobytes().decode() for p in place[new].tolist()], voc)
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
        memory.update(zip(unique[new].tolist(), known[new].tolist(), strict=True))
    plain = np.ones(rows, dtype=bool)
    plain[odd] = False
    sums = np.bincount(r, known[code], rows).astype(np.int64)
    total[plain] = sums[plain]
    return total


def token_count(text: Column, path: str) -> Column:
    """How many tokens the vocabulary file ``path`` gives for each text, special strings inside texts as its
    library takes them, nothing added. Null and empty texts have none; texts of any length are taken whole."""
    voc = vocabulary(path)

    @F.arrow_udf(T.LongType())
    def count(column: pa.Array) -> pa.Array:
        memory = kept("token counts", path, dict)
        out = [block_counts(b, voc, memory) for b in blocks(column)]
        return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))

    return count(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: its key, ``n_bytes``, ``n_tokens`` and whether that is over ``limit``."""
    return docs.select(
        key,
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
