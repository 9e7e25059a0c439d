"""Benchmark decontamination by latent semantic retrieval.

1. Passages of all documents give a TF-IDF matrix (hashed terms, presence in a passage, inverse passage frequency). Its
   leading singular vectors come from one distributed pass by a randomised decomposition: tasks add up
   ``T'(T W)`` for a random ``W``, with the passage frequencies, and as the inverse-frequency weights
   only scale rows, the driver turns the sums into the decomposition of the weighted matrix.
2. Each term gets a vector in that space, scaled so that all directions count alike. Windows of a document
   and benchmark items are sums of term vectors; windows of fitting length whose cosine with an item reaches what
   its weakest paraphrase is expected to have in such a window, less a margin, are candidates. Only items with
   too few weighted words to have a direction are searched by word counts.
3. A candidate is confirmed by the longest common subsequence of words with the item, and a paraphrase, which
   keeps fewer of them, must keep the item's answer (its last part).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.joins import few
from leadloom.llm.worker import give_back
from leadloom.llm.words import NO_ALNUM, Block, blocks, hashes, split
from leadloom.session import written

TERMS = 1 << 14
RANK = 96
PASSAGE = 32
GRAIN = 4
#: How far below the expected cosine of the weakest paraphrase a candidate may lie, in spreads of chance agreement.
MARGIN = 1.0
COMMON_SHARE = 0.005
#: Items with fewer weighted words have no reliable direction: they are searched by word counts only.
WEIGHTED_WORDS = 4
COPY_SHARE = 0.8
PARAPHRASE_SHARE = 0.6
ANSWER_SHARE = 0.6
#: Shorter items must occur word for word.
SHORT_ITEM = 8
#: Items searched for in one pass; more are taken in several passes.
ITEMS_PER_PASS = 20_000
#: Items and windows compared at once, words of candidates measured at once, and vectors added at once; these bound memory, not results.
#: Workers give arrays of ``worker.LARGE_BYTES`` back when freed, and new ones cost more than what is computed in them: these are smaller.
ITEMS_AT_ONCE, WINDOWS_AT_ONCE, CANDIDATE_WORDS, VECTORS_AT_ONCE = 256, 1 << 11, 1 << 16, 1 << 10
#: Occurrences of a term in a block that are added together with those of other terms; further ones are added term by term.
LAYERS = 32
#: Partial sums are added up in this many groups first.
GROUPS = 16
#: Grains of a block up to which single precision does for running sums.
SHORT_BLOCK = 1 << 17
#: Candidates from which on their subsequences are measured together.
MANY = 64
#: Words of the longest item whose subsequences are measured for many candidates at once.
LONG_ITEM = 496
_LIMB = 62
_SEED = 11
_STRIPE = 256


class Space(NamedTuple):
    """A vector for each hashed term."""

    vectors: np.ndarray


class Item(NamedTuple):
    """A benchmark item: its id, the hashes of its words, and how many of the last ones are its answer."""

    item_id: int
    words: np.ndarray
    answer: int


def block_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (letters and digits) of lower-cased texts, and where each row's words begin."""
    words = split(block, NO_ALNUM)
    return hashes(block.data, words.start, words.end), words.bounds


def runs(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows' words in runs of ``size``: terms (one line a run, TERMS where a row's last run is shorter),
    starts, and how many runs each row has."""
    per_row = -(-np.diff(bounds) // size)
    row = np.repeat(np.arange(len(per_row)), per_row)
    nth = np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = bounds[row] + nth * size
    at = starts[:, None] + np.arange(size)
    own = (words & np.uint64(TERMS - 1)).astype(np.int32)
    terms = np.where(at < bounds[row + 1][:, None], own[np.minimum(at, max(len(words) - 1, 0))], TERMS) if len(starts) else at
    return terms, starts, per_row


def summed(vectors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The sum of the vectors of each line of terms; the last vector, for TERMS, is zero."""
    out = np.empty((len(terms), vectors.shape[1]), vectors.dtype)
    more = np.empty_like(out[:VECTORS_AT_ONCE])
    for first in range(0, len(terms), VECTORS_AT_ONCE):
        some, own = terms[first : first + VECTORS_AT_ONCE].T.astype(np.intp), out[first : first + VECTORS_AT_ONCE]
        vectors.take(some[0], axis=0, out=own, mode="clip")
        for line in some[1:]:
            own += vectors.take(line, axis=0, out=more[: len(own)], mode="clip")
    return out


def running_sums(vectors: np.ndarray, terms: np.ndarray, dtype: type) -> np.ndarray:
    """The sums of the vectors of all lines of terms before each line, and of all lines."""
    out = np.zeros((len(terms) + 1, vectors.shape[1]), dtype)
    for first in range(0, len(terms), VECTORS_AT_ONCE):
        own = np.ascontiguousarray(summed(vectors, terms[first : first + VECTORS_AT_ONCE]).T, dtype)
        own[:, 0] += out[first]
        out[first + 1 : first + 1 + own.shape[1]] = np.cumsum(own, axis=1).T
    return out


def add_rows(rows: np.ndarray, source: np.ndarray, target: np.ndarray, sums: np.ndarray) -> None:
    """Adds to the rows ``target`` (under 2^16) of ``sums`` the rows ``source`` of ``rows``, whatever repeats, in the precision of ``sums``."""
    source = source[np.argsort(target.astype(np.uint16), kind="stable")]
    count = np.bincount(target, minlength=len(sums))
    begin = np.cumsum(count) - count
    falling = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
    buffer = np.empty((VECTORS_AT_ONCE, rows.shape[1]), rows.dtype)
    for first in range(0, len(falling), VECTORS_AT_ONCE):
        to = falling[first : first + VECTORS_AT_ONCE]
        at, left = begin[to], count[to]
        own = rows[source[at]].astype(sums.dtype)
        for k in range(1, min(int(left[0]), LAYERS)):
            more = np.searchsorted(-left, -k)  # those with more than k, which stand first
            own[:more] += rows.take(source[at[:more] + k], axis=0, out=buffer[:more], mode="clip")
        for i in range(np.searchsorted(-left, -LAYERS)):
            for rest in range(LAYERS, left[i], VECTORS_AT_ONCE):
                own[i] += rows[source[at[i] + rest : at[i] + min(rest + VECTORS_AT_ONCE, left[i])]].sum(0, dtype=sums.dtype)
        sums[to] += own


def random_matrix() -> np.ndarray:
    w = np.random.default_rng(_SEED).standard_normal((TERMS + 1, RANK)).astype(np.float32)
    w[TERMS] = 0
    return w


def add_passages(words: np.ndarray, bounds: np.ndarray, w: np.ndarray, sums: np.ndarray, seen: np.ndarray) -> int:
    """Adds ``T'(T W)`` and the passage frequencies of a block's passages; gives the number of passages."""
    terms, starts, _ = runs(words, bounds, PASSAGE)
    if not len(starts):
        return 0
    terms = np.sort(terms, axis=1)
    terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = TERMS  # a term is present or not
    passage, place = np.nonzero(terms < TERMS)
    term = terms[passage, place]
    add_rows(summed(w, terms), passage, term, sums)
    seen += np.bincount(term, minlength=TERMS)
    return len(starts)


_PARTIAL = T.StructType(
    [
        T.StructField("stripe", T.IntegerType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("passages", T.LongType()),
        T.StructField("sums", T.BinaryType()),
        T.StructField("seen", T.BinaryType()),
    ]
)


def _sum_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w = random_matrix()
    sums, seen, n, part = np.zeros((TERMS, RANK)), np.zeros(TERMS, np.int64), 0, None
    for batch in batches:
        if part is None and batch.num_rows:
            part = batch.column(1)[0].as_py()
        for block in blocks(batch.column(0)):
            n += add_passages(*block_words(block), w, sums, seen)
        give_back("decontamination")
    if part is not None:
        cut, sums = range(0, TERMS, _STRIPE), sums.astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i // _STRIPE for i in cut], pa.int32()),
                pa.array([part] * len(cut), pa.int32()),
                pa.array([n] * len(cut), pa.int64()),
                pa.array([sums[i : i + _STRIPE].tobytes() for i in cut], pa.binary()),
                pa.array([seen[i : i + _STRIPE].tobytes() for i in cut], pa.binary()),
            ],
            [f.name for f in _PARTIAL],
        )


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("part")  # the same sum whatever the order of arrival
    sums = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in group["sums"])
    seen = sum(np.frombuffer(x, np.int64) for x in group["seen"])
    one = group.iloc[:1].copy()
    one["passages"] = group["passages"].sum()
    one["sums"], one["seen"] = [sums.astype(np.float32).tobytes()], [seen.tobytes()]
    return one


def semantic_space(docs: DataFrame, text: str = "text") -> Space:
    """The latent space of all passages of ``docs``. Each task gives one partial sum of a fixed size, in stripes
    of terms; stripes are added up in two levels, and the driver gets one sum."""
    parts = docs.select(F.lower(text).alias("_text"), F.spark_partition_id().alias("_part")).mapInArrow(_sum_passages, _PARTIAL)
    some = parts.groupBy("stripe", F.col("part") % GROUPS).applyInPandas(_add_up, _PARTIAL)
    rows = some.groupBy("stripe").applyInPandas(_add_up, _PARTIAL).orderBy("stripe").collect()
    if not rows or not rows[0]["passages"]:
        return Space(np.zeros((TERMS + 1, RANK), np.float32))
    sums = np.concatenate([np.frombuffer(r["sums"], np.float32).reshape(-1, RANK) for r in rows]).astype(np.float64)
    seen = np.concatenate([np.frombuffer(r["seen"], np.int64) for r in rows])
    return decomposed(sums, seen, rows[0]["passages"])


def decomposed(sums: np.ndarray, seen: np.ndarray, passages: int) -> Space:
    """With ``T`` the presence matrix, ``S = T'T W`` the sums and ``D`` the weights: ``T'T`` is close to ``S (W'S)^-1 S'``,
    so the TF-IDF matrix ``A = T D`` has ``A'A`` close to ``E E'`` with ``E = D S (W'S)^-1/2``, whose singular vectors and
    values are those wanted. Terms of more than COMMON_SHARE of the passages carry no weight."""
    share = seen / max(passages, 1)
    weight = np.where(share <= max(COMMON_SHARE, 2 / max(passages, 1)), np.log((1 + passages) / (1 + seen)) + 1e-3, 0.0)
    core = random_matrix()[:TERMS].astype(np.float64).T @ sums
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > 1e-9 * max(value.max(), 1e-300)
    left, single, _ = np.linalg.svd(weight[:, None] * sums @ (vector[:, good] / np.sqrt(value[good])), full_matrices=False)
    good = single > max(1e-6 * single.max(initial=0), 1e-300)
    vectors = np.zeros((TERMS + 1, RANK), np.float32)
    vectors[:TERMS, : good.sum()] = weight[:, None] * left[:, good] / single[good] * np.sqrt(passages)
    return Space(vectors)


def window_class(length: int) -> tuple[int, int]:
    """How many grains a window has, and by how many windows are apart, so that any run of ``length`` words lies
    within some window. The item fills half of it at least, from nine words on."""
    for width in (3, 4, 7, 9, 11, 14, 18, 22, 28, 36, 46, 60):
        stride = width // 3
        if (width - stride) * GRAIN >= length:
            return width, stride
    width = -(-length * 3 // (2 * GRAIN)) + 2
    return width, width // 3


def common_words(item_masks: dict[int, int], length: int, words: list[int]) -> int:
    """Which words of the item a longest common subsequence keeps, as bits, by the bit-parallel recurrence."""
    full = (1 << length) - 1
    row = full
    for word in words:
        mask = item_masks.get(word)
        if mask:
            kept = row & mask
            row = ((row + kept) | (row - kept)) & full
    return full & ~row


class Query(NamedTuple):
    """Items of one window class: their vectors as unit columns, the cosines from which a window is a candidate, which
    items (without a reliable direction) are searched by word counts instead, how many words a match keeps, and the
    places of each item's words: sorted keys of item and word number, and the bits of the places in limbs."""

    width: int
    stride: int
    items: list[Item]
    vectors: np.ndarray
    least: np.ndarray
    counted: np.ndarray
    needed: np.ndarray
    keys: np.ndarray
    hashed: np.ndarray
    places: np.ndarray
    masks: list[dict[int, int]]


class Wanted(NamedTuple):
    """All items searched for in a pass: their different words, sorted, and the queries."""

    words: np.ndarray
    queries: list[Query]


def least_cosine(weighted: np.ndarray, window: int, dimensions: int) -> np.ndarray:
    """The cosine from which a window is a candidate. With ``n`` weighted words of an item, of which a paraphrase keeps PARAPHRASE_SHARE,
    among ``m`` words of a window, a cosine of ``share * sqrt(n / m)`` is expected in directions that count
    alike; the chance agreement of the other words spreads it by one over the root of the dimensions at most."""
    expected = PARAPHRASE_SHARE * np.sqrt(np.minimum(weighted / window, 1.0))
    return expected - MARGIN * np.sqrt((1 - expected**2) / max(dimensions, 1))


def queries(items: list[Item], space: Space) -> Wanted:
    by_class: dict[tuple[int, int, bool], list[Item]] = {}
    for item in items:
        if len(item.words):
            by_class.setdefault((*window_class(len(item.words)), len(item.words) > LONG_ITEM), []).append(item)
    known = np.unique(np.concatenate([i.words for i in items if len(i.words)] or [np.zeros(0, np.uint64)]))
    lengths = np.linalg.norm(space.vectors, axis=1)
    dimensions = int(np.count_nonzero(np.abs(space.vectors).max(0, initial=0)))
    out = []
    for (width, stride, long), group in sorted(by_class.items(), key=lambda x: x[0]):
        terms = [(i.words & np.uint64(TERMS - 1)).astype(np.int64) for i in group]
        vectors = np.stack([space.vectors[t].sum(0) for t in terms])
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        weighted = np.array([np.count_nonzero(lengths[t]) for t in terms])
        counted = weighted < WEIGHTED_WORDS
        least = np.where(counted, np.inf, least_cosine(weighted, width * GRAIN, dimensions))
        # a window that holds fewer of an item's words, in whatever order, cannot be confirmed
        needed = [n if n < SHORT_ITEM else math.ceil(PARAPHRASE_SHARE * n - 1e-9) for n in (len(i.words) for i in group)]
        limbs = 0 if long else -(-max(len(i.words) for i in group) // _LIMB)
        item = np.repeat(np.arange(len(group)), [len(i.words) for i in group])
        place = np.concatenate([np.arange(len(i.words)) for i in group])
        number = np.searchsorted(known, np.concatenate([i.words for i in group]))
        keys, at = np.unique(item * (len(known) + 1) + number, return_inverse=True)
        size = max(10, (16 * len(keys)).bit_length(), min(22, (64 * len(keys)).bit_length()))  # few other words share a place
        hashed = np.zeros(1 << size, dtype=np.uint8)
        hashed[slots(item, number, len(hashed))] = 1
        places = np.zeros((limbs, len(keys) + 1), dtype=np.uint64)  # the last one: no place
        if limbs:
            np.bitwise_or.at(places, (place // _LIMB, at), np.uint64(1) << (place % _LIMB).astype(np.uint64))
        masks = []
        for one in group:
            mask: dict[int, int] = {}
            for k, word in enumerate(one.words.tolist()):
                mask[word] = mask.get(word, 0) | (1 << k)
            masks.append(mask)
        unit = (vectors / np.maximum(norms, 1e-12)).T.astype(np.float32)
        out.append(Query(width, stride, group, unit, least.astype(np.float32), counted, np.array(needed), keys, hashed, places, masks))
    return Wanted(known, out)


def slots(item: np.ndarray, number: np.ndarray, size: int) -> np.ndarray:
    """A place for a word of an item in a table of ``size`` (a power of two) bytes; others may share it."""
    return (item * 0x9E3779B1 + number * 0x85EBCA77 >> 7) & (size - 1)


def words_held(q: Query, number: np.ndarray, nobody: int, begin: np.ndarray, end: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, items) for the items without a reliable direction: windows that hold enough of their words. ``number`` is
    that of each word of the block in the vocabulary (``nobody``: in none); windows go from grain ``begin`` to ``end``."""
    edges = np.append(starts, len(number))
    for item in np.flatnonzero(q.counted):
        own = q.keys[np.searchsorted(q.keys, item * (nobody + 1)) : np.searchsorted(q.keys, (item + 1) * (nobody + 1))] - item * (nobody + 1)
        held = np.zeros(nobody + 1, dtype=bool)
        held[own] = True
        running = np.concatenate([[0], np.cumsum(held[number])])
        window = np.flatnonzero(running[edges[end]] - running[edges[begin]] >= q.needed[item])
        yield window, np.full(len(window), item)


def directions(running: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unit vectors of the windows from grain ``begin`` to ``end``."""
    z = (running[end] - running[begin]).astype(np.float32, copy=False)
    z /= np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-12)[:, None]
    return z


def near(q: Query, z: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, items) whose cosine reaches the item's least; ``z``: unit vectors of windows."""
    for first in range(0, len(q.items), ITEMS_AT_ONCE):
        cosine = z @ q.vectors[:, first : first + ITEMS_AT_ONCE]
        window, item = np.divmod(np.flatnonzero(cosine >= q.least[first : first + ITEMS_AT_ONCE]), cosine.shape[1])
        yield window, item + first


def candidates(q: Query, running: np.ndarray, number: np.ndarray, nobody: int, begin: np.ndarray, end: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, items) by cosine, and by word counts for the items without a reliable direction. Windows that hold fewer words of
    all the query's items than the item needs cannot be confirmed: they are left out."""
    asked = np.zeros(nobody + 1, dtype=bool)
    asked[q.keys % (nobody + 1)] = True
    count, edges = np.concatenate([[0], np.cumsum(asked[number])]), np.append(starts, len(number))
    held = count[edges[end]] - count[edges[begin]]
    able = np.flatnonzero(held >= q.needed.min())
    for part in range(0, len(able), WINDOWS_AT_ONCE):
        some = able[part : part + WINDOWS_AT_ONCE]
        for window, item in near(q, directions(running, begin[some], end[some])):
            enough = held[some[window]] >= q.needed[item]
            yield some[window[enough]], item[enough]
    yield from words_held(q, number, nobody, begin, end, starts)


def kept_in_order(q: Query, number: np.ndarray, multiplied: np.ndarray, nobody: int, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which candidates, the words from ``low`` to ``high`` with an item each, may keep as many of the item's words in order as a
    match must (all that do, and where there are MANY to be measured only those); ``multiplied``: numbers as ``slots`` takes them. Words are counted first; the rest is the recurrence of ``common_words`` for many candidates at once, with carries
    from limb to limb. Bits beyond an item stay set."""
    longest = int((high - low).max(initial=0))
    # at least as many as there are: a place may be shared, and words around the window count too where it is shorter
    place = np.lib.stride_tricks.sliding_window_view(multiplied, longest)[np.minimum(low, len(number) - longest)]
    place += (item * 0x9E3779B1)[:, None]
    place >>= 7
    place &= len(q.hashed) - 1
    likely = q.hashed.take(place, mode="clip").sum(1, dtype=np.int32) >= q.needed[item]
    if not likely.any():
        return likely
    low, high, item = low[likely], high[likely], item[likely]
    at = low[:, None] + np.arange(longest)
    own = np.where(at < high[:, None], number[np.minimum(at, len(number) - 1)], nobody)
    key = item[:, None] * (nobody + 1) + own
    found = np.full(own.shape, len(q.keys))
    some = own < nobody
    where = np.minimum(np.searchsorted(q.keys, key[some]), len(q.keys) - 1)
    found[some] = np.where(q.keys[where] == key[some], where, len(q.keys))
    enough = np.count_nonzero(found < len(q.keys), axis=1) >= q.needed[item]
    if not len(q.places) or np.count_nonzero(enough) < MANY:  # ``confirmed`` finds the few out sooner
        likely[likely] = enough
        return likely
    found, full = found[enough], np.uint64((1 << _LIMB) - 1)
    rows = np.full((len(q.places), len(found)), full)
    for k in range(found.shape[1]):
        carry = np.uint64(0)
        for row, places in zip(rows, q.places, strict=True):
            kept = row & places[found[:, k]]
            total = row + kept + carry
            carry = total >> np.uint64(_LIMB)
            row[:] = (total & full) | (row - kept)
    enough[enough] = np.bitwise_count(~rows & full).sum(0, dtype=np.int64) >= q.needed[item[enough]]
    likely[likely] = enough
    return likely


def confirmed(item: Item, masks: dict[int, int], words: list[int]) -> tuple[str, float, float] | None:
    """Kind, share of the item's words and share of its answer's words that stand in ``words`` in order."""
    n = len(item.words)
    kept = common_words(masks, n, words)
    share = kept.bit_count() / n
    if n < SHORT_ITEM:
        own = item.words.tolist()
        whole = any(words[i : i + n] == own for i in range(len(words) - n + 1))
        return ("copy", 1.0, 1.0) if whole else None
    if share < PARAPHRASE_SHARE:
        return None
    tail = {w: m >> (n - item.answer) for w, m in masks.items()}
    answer = common_words(tail, item.answer, words).bit_count() / item.answer
    if share >= COPY_SHARE:
        return "copy", share, answer
    return ("paraphrase", share, answer) if answer >= ANSWER_SHARE else None


def search(block: Block, wanted: Wanted, space: Space) -> Iterator[tuple]:
    """(row, item, kind, share, answer share, cosine, first word, words) of the block's matches, one for each
    row and item: the one that shares most."""
    words, bounds = block_words(block)
    terms, starts, per_row = runs(words, bounds, GRAIN)
    if not len(starts) or not len(wanted.words):
        return
    edge = np.concatenate([[0], np.cumsum(per_row)])
    running = running_sums(space.vectors, terms, np.float32 if len(starts) <= SHORT_BLOCK else np.float64)
    row = np.repeat(np.arange(len(per_row)), per_row)
    nth = np.arange(len(starts)) - edge[row]
    nobody = len(wanted.words)
    distinct, which = np.unique(words, return_inverse=True)
    at = np.minimum(np.searchsorted(wanted.words, distinct), nobody - 1)
    number = np.where(wanted.words[at] == distinct, at, nobody)[which]
    multiplied = number * 0x85EBCA77
    best: dict[tuple[int, int], tuple] = {}
    for q in wanted.queries:
        # windows begin at every stride-th grain, as long as the one before did not reach the end of the row
        begin = np.flatnonzero((nth % q.stride == 0) & ((nth == 0) | (nth + q.width - q.stride < per_row[row])))
        end = np.minimum(begin + q.width, edge[row[begin] + 1])
        first = starts[begin]
        last = np.where(end < edge[row[begin] + 1], starts[np.minimum(end, len(starts) - 1)], bounds[row[begin] + 1])
        at_once = max(1, CANDIDATE_WORDS // (q.width * GRAIN))
        for window, item in candidates(q, running, number, nobody, begin, end, starts):
            for some in range(0, len(window), at_once):
                i, k = window[some : some + at_once], item[some : some + at_once]
                enough = kept_in_order(q, number, multiplied, nobody, first[i], last[i], k)
                i, k = i[enough], k[enough]
                for i, k, z in zip(i.tolist(), k.tolist(), directions(running, begin[i], end[i]), strict=True):
                    r, own, low, high = int(row[begin[i]]), q.items[k], int(first[i]), int(last[i])
                    found = confirmed(own, q.masks[k], words[low:high].tolist())
                    if found and ((r, own.item_id) not in best or best[r, own.item_id][1] < found[1]):
                        best[r, own.item_id] = (*found, float(z @ q.vectors[:, k]), low - int(bounds[r]), high - low)
    for (r, item_id), found in sorted(best.items()):
        yield (r, item_id, *found)


def read_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list[Item]:
    """The items on the driver, in a bounded number. The answer is the last quarter of an item's words, three at least."""
    table = benchmark.select(F.col(item).cast("long").alias("i"), F.lower(text).alias("t")).where("i is not null").toArrow()
    out = []
    for block in blocks(table["t"]):
        words, bounds = block_words(block)
        for r in range(len(bounds) - 1):
            own = words[bounds[r] : bounds[r + 1]]
            out.append(Item(table["i"][block.first + r].as_py(), own, min(len(own), max(3, len(own) // 4))))
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each document and benchmark item that it holds: the key, ``item_id``, ``kind`` (copy or
    paraphrase), ``lcs_share``, ``answer_share``, ``cosine``, and the window: ``first_word`` and ``n_words``.

    Every window of every document is compared by cosine with every item of its length class; a window that keeps enough
    of an item's words in order is found if its cosine reaches the item's least (``least_cosine``). Null and empty texts hold
    nothing; items without words are never found; items under eight words must occur word for word. Rows
    repeated under a key give a row each. An empty table on either side gives no rows. Null keys are kept.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("item_id", T.LongType()),
            T.StructField("kind", T.StringType()),
            T.StructField("lcs_share", T.DoubleType()),
            T.StructField("answer_share", T.DoubleType()),
            T.StructField("cosine", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("n_words", T.LongType()),
        ]
    )
    passes = -(-benchmark.count() // ITEMS_PER_PASS)
    space = semantic_space(docs, text) if passes else None
    found = spark.createDataFrame([], schema)
    for p in range(passes):
        some = benchmark.where(F.pmod(F.xxhash64(item, item_text), F.lit(passes)) == p)
        wanted = queries(read_items(some, item, item_text), space)

        def scan(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [(b.first + h[0], *h[1:]) for b in blocks(batch.column(1)) for h in search(b, wanted, space)]
                columns = list(zip(*hits, strict=True)) or [[]] * len(schema)
                keys = batch.column(0).take(pa.array(columns[0], pa.int64()))
                rest = [pa.array(c, t) for c, t in zip(columns[1:], _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([keys, *rest], [f.name for f in schema])
                give_back("decontamination")

        found = found.unionByName(docs.select(key, F.lower(text).alias("_text")).mapInArrow(scan, schema))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not found to hold a benchmark item. Removal goes by row: where texts under one key differ, each is
    judged by itself; repeated rows go or stay together. Rows without a key stay, and so do null and empty texts. An empty
    table on either side changes nothing. Columns of any name pass through."""
    mark = lambda c: F.struct(F.xxhash64(c, F.lit(1)).alias("a"), F.xxhash64(c, F.lit(2)).alias("b"))
    named = docs.select(F.struct(F.col(key).alias("key"), mark(F.col(text)).alias("mark")).alias("row"), F.col(text).alias("text"))
    found = find_leaks(named.where("row.key is not null"), benchmark, "row", "text")
    gone = written(found.select("row.key", "row.mark").distinct(), "leaks")
    same = (F.col(f"row.`{key}`") == F.col("gone.key")) & (mark(F.col(f"row.`{text}`")) == F.col("gone.mark"))
    return docs.alias("row").join(few(gone).alias("gone"), same, "left_anti")


_TYPES = [pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
