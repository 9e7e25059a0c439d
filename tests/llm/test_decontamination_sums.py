"""The sums of the decomposition and the count of words, held against plain ways."""

import random
import resource

import numpy as np

from leadloom.llm import decontamination as d
from leadloom.llm.worker import LARGE_BYTES, give_back

from .data import prose


def test_sums_are_those_of_the_presence_matrix():
    draw = np.random.default_rng(3)
    rare = draw.integers(0, 1 << 62, 70_000, dtype=np.uint64)
    words = np.where(np.arange(70_000) % 29 == 0, np.uint64(7), rare)  # one term stands in nearly all passages
    words[1::40] = draw.integers(0, 30, len(words[1::40]), dtype=np.uint64)
    bounds = np.array([0, 0, 5, 40_000, 40_032, 70_000])
    sums, seen = np.zeros((d.TERMS, d.RANK)), np.zeros(d.TERMS, dtype=np.int64)
    for _ in range(2):  # a second block adds to the first
        n = d.add_passages(words, bounds, d.random_matrix(), sums, seen)
    present = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        present += [np.unique(words[i : min(i + d.PASSAGE, high)] % d.TERMS) for i in range(low, high, d.PASSAGE)]
    assert n == len(present) and max(seen) > 2 * (d.VECTORS_AT_ONCE + d.LAYERS)
    w, want, counted = d.random_matrix().astype(np.float64), np.zeros_like(sums), np.zeros_like(seen)
    for own in present:
        want[own] += 2 * w[own].sum(0)
        counted[own] += 2
    assert (seen == counted).all() and np.abs(sums - want).max() < 1e-6 * np.abs(want).max()


def test_running_sums_and_sums_of_lines():
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((50, 6)).astype(np.float32)
    vectors[-1] = 0
    for n in (0, 1, d.VECTORS_AT_ONCE, 2 * d.VECTORS_AT_ONCE + 3):
        terms = draw.integers(0, 50, (n, 4))
        lines = vectors[terms[:, 0]] + vectors[terms[:, 1]] + vectors[terms[:, 2]] + vectors[terms[:, 3]]
        assert np.array_equal(d.summed(vectors, terms), lines)
        for kind in (np.float32, np.float64):
            want = np.concatenate([np.zeros((1, 6), kind), np.cumsum(lines.astype(kind), axis=0)])
            got = d.running_sums(vectors, terms, kind)
            assert got.dtype == kind and np.array_equal(got, want)


def test_words_are_counted_up_to_the_end_of_a_block():
    draw = random.Random(5)
    items = [d.Item(i, np.array(draw.sample(range(200), n), dtype=np.uint64), n // 4) for i, n in enumerate([10, 17, 24, 24, 40, 60])]
    wanted = d.queries(items, d.Space(np.ones((d.TERMS + 1, d.RANK), dtype=np.float32)))
    words = np.array([draw.randrange(300) for _ in range(400)], dtype=np.uint64)
    for i, item in enumerate(items):  # each stands somewhere, the last one at the end
        at = 400 - len(item.words) if i == 5 else 60 * i
        words[at : at + len(item.words)] = item.words
    nobody = len(wanted.words)
    at = np.minimum(np.searchsorted(wanted.words, words), nobody - 1)
    number = np.where(wanted.words[at] == words, at, nobody)
    for q in wanted.queries:
        low = np.repeat(np.arange(400), len(q.items))
        item = np.tile(np.arange(len(q.items)), 400)
        high = np.minimum(low + q.width * d.GRAIN, 400)
        few, number_of = d.kept_in_order(q, number, number * 0x85EBCA77, nobody, low, high, item), d.MANY
        low, high, item = (np.tile(x, number_of) for x in (low, high, item))
        kept = d.kept_in_order(q, number, number * 0x85EBCA77, nobody, low, high, item)
        want = [d.common_words(q.masks[k], len(q.items[k].words), words[a:b].tolist()).bit_count() >= q.needed[k] for a, b, k in zip(low, high, item, strict=True)]
        assert kept.tolist() == want and any(want) and few[np.array(want[: len(few)])].all()


def test_blocks_are_worked_on_in_arrays_that_workers_keep():
    words = np.random.default_rng(6).integers(0, 1 << 62, 160_000, dtype=np.uint64) % np.uint64(9001)
    bounds = np.array([0, 70_000, 160_000])
    sums, seen, w = np.zeros((d.TERMS, d.RANK)), np.zeros(d.TERMS, dtype=np.int64), d.random_matrix()
    give_back("test")
    d.add_passages(words, bounds, w, sums, seen)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    d.add_passages(words, bounds, w, sums, seen)
    pages = resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before
    assert pages * resource.getpagesize() < 160 * LARGE_BYTES  # three to four times as much with arrays as long as the block


def test_prose_gives_the_same_space_in_any_blocks():
    text = [prose(i, 300) for i in range(40)]
    made = []
    for size in (40, 7):
        sums, seen, n = np.zeros((d.TERMS, d.RANK)), np.zeros(d.TERMS, dtype=np.int64), 0
        for i in range(0, 40, size):
            words = [np.array([hash(x) & ((1 << 62) - 1) for x in t.split()], dtype=np.uint64) for t in text[i : i + size]]
            n += d.add_passages(np.concatenate(words), np.cumsum([0, *map(len, words)]), d.random_matrix(), sums, seen)
        made.append((sums, seen, n))
    assert made[0][2] == made[1][2] and (made[0][1] == made[1][1]).all() and np.allclose(made[0][0], made[1][0], atol=1e-9)
