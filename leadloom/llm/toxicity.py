"""Toxicity by a factorization machine over hashed terms.

Terms are words (runs of letters, A-Z lower-cased) and the words' beginnings, so that inflected and
compound forms share evidence. The machine adds a weight for each term and, through a short factor
vector for each term, a weight for each pair of terms of a text: an insult beside the mention of a
group can count for more than both alone, which no linear model can say.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.sampling import ROWS_PER_CLASS, labelled_sample, remainder, sampled_texts
from leadloom.llm.worker import give_back
from leadloom.llm.words import NO_LETTER, Block, blocks, hashes, lowered, mixed, split

PREFIX_BYTES = (4, 5, 6, 7, 8)
FACTORS = 4
LEAST_DOCS = 5
SMOOTHING = 10.0
EPOCHS = 10
BATCH = 256
RATE = 0.1
L1 = 2e-2
THRESHOLD = 0.7
_SIEVE_BITS = 20


class Machine(NamedTuple):
    """Terms in the order of their hashes, with weights and factors; the size is bounded by the sample."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray


def block_terms(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, row) of every term of the block, repeats included, one pair of arrays for each kind."""
    low = lowered(block)
    words = split(low, NO_LETTER)
    row = np.searchsorted(words.bounds, np.arange(len(words.start)), "right") - 1
    kinds = [(hashes(low.data, words.start, words.end), row)]
    for n in PREFIX_BYTES:
        long = np.flatnonzero(words.end - words.start > n)
        value = hashes(low.data, words.start[long], words.start[long] + n)
        kinds.append((mixed(value + np.uint64(n)), row[long]))
    return kinds


@F.arrow_udf(T.ArrayType(T.LongType()))
def _terms(text: pa.Array) -> pa.Array:
    values, offsets = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for block in blocks(text):
        kinds = block_terms(block)
        term = np.concatenate([t for t, _ in kinds])
        row = np.concatenate([r for _, r in kinds])
        order = np.lexsort((term, row))
        term, row = term[order], row[order]
        new = np.ones(len(term), dtype=bool)
        new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
        values.append(term[new].view(np.int64))
        offsets.append(np.searchsorted(row[new], np.arange(1, len(block.bounds))) + offsets[-1][-1])
    give_back("toxicity")
    return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(np.concatenate(values)))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Machine:
    """A machine learnt from at most ``rows_per_class`` labelled rows of each class (the bound). Terms are
    extracted by tasks; what reaches the driver is the bounded sample's terms. Without rows of both
    classes, or with an empty table, the machine is neutral and gives every text a score of 0.5. A null text is the empty
    one; null keys, and labels that are null or neither 0 nor 1, are left out; of texts repeated under a key one counts."""
    sample, _ = labelled_sample(labels, label, key, rows_per_class)
    table = sampled_texts(docs, sample, key, text).select("_key", "_label", _terms("_text").alias("terms")).toArrow()
    y = table["_label"].to_numpy().astype(np.float64)
    lists = table["terms"].combine_chunks()
    counts = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return learn(values, counts, y, np.argsort(table["_key"].to_numpy(), kind="stable"))


def learn(values: np.ndarray, counts: np.ndarray, y: np.ndarray, by_key: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad, with shrinkage that sets uninformative terms to exactly zero.
    ``values``: the distinct terms of row after row; ``counts``: how many each row has; ``by_key``: the rows in
    the order of their keys, so that the fit does not depend on the order in which tasks answered."""
    none = Machine(0.0, np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, FACTORS)))
    if not len(y) or y.min() == y.max():
        return none
    terms, index, docs = np.unique(values, return_inverse=True, return_counts=True)
    often = docs >= min(LEAST_DOCS, max(1, len(y) // 4))
    kept = often[index]
    row = np.repeat(np.arange(len(y)), counts)[kept]
    index = (np.cumsum(often) - 1)[index[kept]]
    terms, size = terms[often], int(often.sum())
    if not size:
        return none
    starts = np.searchsorted(row, np.arange(len(y) + 1))
    # a term enters with the size of its smoothed log odds, so that evenly spread terms hardly enter at all
    with_1 = (np.bincount(index, y[row], size) + SMOOTHING) / (y.sum() + 2 * SMOOTHING)
    with_0 = (np.bincount(index, 1 - y[row], size) + SMOOTHING) / ((1 - y).sum() + 2 * SMOOTHING)
    extent = np.abs(np.log(with_1 / with_0))
    draw = np.random.default_rng(seed)
    w, v, bias = np.zeros(size), draw.normal(0, 0.01, (size, FACTORS)), 0.0
    seen_w, seen_v, seen_b = np.full(size, 1e-8), np.full((size, FACTORS), 1e-8), 1e-8
    importance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(EPOCHS):
        order = by_key[draw.permutation(len(y))]
        for at in range(0, len(y), BATCH):
            some = order[at : at + BATCH]
            n = starts[some + 1] - starts[some]
            local = np.repeat(np.arange(len(some)), n)
            pos = np.repeat(starts[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            f = index[pos]
            x = extent[f]
            fv = v[f] * x[:, None]
            sums = np.stack([np.bincount(local, fv[:, k], len(some)) for k in range(FACTORS)], 1)
            z = bias + np.bincount(local, w[f] * x - 0.5 * (fv**2).sum(1), len(some)) + 0.5 * (sums**2).sum(1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) * importance[some] / len(some)
            step = np.bincount(f, g[local] * x, size)
            seen_w += step**2
            rate = RATE / np.sqrt(seen_w)
            w -= rate * step
            w = np.sign(w) * np.maximum(np.abs(w) - rate * L1 / 10, 0)
            for k in range(FACTORS):
                step = np.bincount(f, g[local] * x * (sums[local, k] - fv[:, k]), size)
                seen_v[:, k] += step**2
                v[:, k] -= RATE / 2 / np.sqrt(seen_v[:, k]) * step * (seen_v[:, k] > 1e-7)
            norm = np.sqrt((v**2).sum(1))
            v *= np.maximum(1 - RATE * L1 / np.maximum(norm, 1e-12), 0)[:, None]
            seen_b += g.sum() ** 2
            bias -= RATE / np.sqrt(seen_b) * g.sum()
    w, v = w * extent, v * extent[:, None]
    used = (w != 0) | ((v**2).sum(1) > 1e-12)
    return Machine(float(bias), terms[used], w[used], v[used])


def margins(block: Block, machine: Machine, sieve: np.ndarray) -> np.ndarray:
    """The machine's value of each row: bias, weights of its distinct terms, and their pairs' weights."""
    rows, size = len(block.bounds) - 1, len(machine.terms)
    found = [np.zeros(0, dtype=np.int64)]
    for term, row in block_terms(block) if size else []:
        near = np.flatnonzero(sieve[term & np.uint64((1 << _SIEVE_BITS) - 1)])
        at = np.minimum(np.searchsorted(machine.terms, term[near]), size - 1)
        same = machine.terms[at] == term[near]
        found.append(row[near][same] * size + at[same])
    row, at = np.divmod(np.unique(np.concatenate(found)), max(size, 1))
    factors = machine.factors[at]
    z = machine.bias + np.bincount(row, machine.weights[at] - 0.5 * (factors**2).sum(1), rows)
    for k in range(FACTORS):
        z += 0.5 * np.bincount(row, factors[:, k], rows) ** 2
    return z


def toxicity(machine: Machine, text: Column) -> Column:
    """The probability (0 to 1) that a whole text is toxic, equal for equal texts; a null text is scored as the empty one."""
    sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
    sieve[machine.terms & np.uint64((1 << _SIEVE_BITS) - 1)] = True

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        out = [margins(b, machine, sieve) for b in blocks(column)]
        give_back("toxicity")
        z = np.concatenate(out) if out else np.zeros(0)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score(text)


def remove_toxic(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns of any name, that score below ``threshold``. Each row is judged by its own whole text: equal texts go or stay
    together, a null text is scored as the empty one, null keys play no part; an empty table stays empty."""
    return docs.where(toxicity(machine, F.col(text)) < threshold)


def op6_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32 of the decimal doc_id is not 1 modulo 3; scores every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 3) != 1)
    machine = fit(docs, labels)
    return docs.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        toxicity(machine, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
