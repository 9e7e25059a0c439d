"""Text quality by Bradley-Terry pairwise ranking over measures of the text's form.

Every document has a strength; in a pair of a good and a poor one, the good one wins with the logistic of
the difference of strengths. Strengths are linear in the measures, so the fit is a logistic loss on
differences of measures. Decisions go by a quantile of the strengths. Fit, quantiles and cut come from all labelled rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.sampling import labels_by_key, remainder
from leadloom.llm.worker import give_back
from leadloom.llm.words import Block, blocks, hashes, lowered, split
from leadloom.session import few, written

THRESHOLD = 0.3
PAIRS_PER_ROW = 8
RIDGE = 1e-3
#: Labelled rows among which a task draws pairs, and how many such groups there are at most: the groups grow beyond that.
ROWS_PER_GROUP, MOST_GROUPS = 4096, 2048
#: Rows of each class that a group has on average at least, where it must borrow them.
PARTNERS = 64
#: Cells from strength 0 to infinity on which strengths are counted.
CELLS = 1 << 15
_KNOTS = 513


def _kind(chars: str) -> np.ndarray:
    table = np.zeros(256)
    table[list(chars.encode())] = 1
    return table


_UPPER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _kind("abcdefghijklmnopqrstuvwxyz") + _UPPER
_LETTER[128:] = 1
_DIGIT = _kind("0123456789")
_SYMBOL = _kind("#$%&*+/<=>@[\\]^_`{|}~")
_LOUD = _kind("!?")
_STOP = _kind(".,;:")


class Ranking(NamedTuple):
    """Weights over the scaled measures, and the map from strength to score: knots of the weighted
    quantiles of the labelled rows, and the quantile at which good documents begin."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    strengths: np.ndarray
    quantiles: np.ndarray
    cut: float


def _repeats(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct values each row has, and how often its most frequent one occurs."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(rows)
    np.maximum.at(most, r[at], np.diff(np.append(at, len(v))))
    return np.bincount(r[at], minlength=rows).astype(float), most


def byte_counts(block: Block) -> np.ndarray:
    """How often each byte value occurs in each row."""
    out = np.zeros((len(block.bounds) - 1, 256))
    for i, (low, high) in enumerate(zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), strict=True)):
        for at in range(low, high, 1 << 20):
            out[i] += np.bincount(block.data[at : min(high, at + (1 << 20))], minlength=256)
    return out


def measures(block: Block) -> np.ndarray:
    """One row of measures for each text. The empty text has zeros, but for the flag of having no words."""
    rows = len(block.bounds) - 1
    n_bytes = np.diff(block.bounds).astype(float)
    histogram = byte_counts(block)
    count = lambda table: histogram @ table
    low = lowered(block)
    words = split(low)
    n_words = np.diff(words.bounds).astype(float)
    row = np.repeat(np.arange(rows), np.diff(words.bounds))
    value = hashes(low.data, words.start, words.end)
    kinds, most = _repeats(value, row, rows)
    again = np.zeros(len(value), dtype=bool)
    again[1:] = (value[1:] == value[:-1]) & (row[1:] == row[:-1])
    tri = np.zeros(len(value), dtype=bool)
    tri[2:] = row[2:] == row[:-2]
    at = np.flatnonzero(tri)
    runs = value[at - 2] * np.uint64(3) + value[at - 1] * np.uint64(5) + value[at] * np.uint64(7)
    kinds3, most3 = _repeats(runs, row[at], rows)
    length = (words.end - words.start).astype(float)
    symbol_end = _SYMBOL[block.data[words.end - 1]] if len(value) else np.zeros(0)
    loud_end = _LOUD[block.data[words.end - 1]] if len(value) else np.zeros(0)
    letters, w, b = np.maximum(count(_LETTER), 1), np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    share3 = np.maximum(n_words - 2, 1)
    lines = histogram[:, 10] + 1
    basic = [
        np.log1p(n_words),
        count(_UPPER) / letters,
        count(_SYMBOL) / b,
        count(_LOUD) / b,
        count(_DIGIT) / b,
        count(_STOP) / w,
        np.bincount(row, symbol_end, rows) / w,
        np.bincount(row, loud_end, rows) / w,
        np.bincount(row, length == 1, rows) / w,
        kinds / w,
        most / w,
        np.bincount(row, again, rows) / w,
        np.where(n_words > 2, kinds3 / share3, 1),
        most3 / share3,
        np.bincount(row, length, rows) / w,
        np.log1p(w / lines),
        (n_words == 0).astype(float),
        (n_words < 5).astype(float),
        np.log1p(n_words) * kinds / w,
    ]
    x = np.stack(basic, 1)
    bent = np.sqrt(np.abs(x[:, [1, 2, 3, 4, 6, 7, 8, 10, 11, 13]]))
    return np.concatenate([x, bent, x[:, [9, 12, 14]] ** 2], 1)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _measures(text: pa.Array) -> pa.Array:
    parts = [measures(b) for b in blocks(text)]
    x = np.concatenate(parts) if parts else np.zeros((0, 1))
    give_back("quality")
    offsets = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
    rows_per_group: int = ROWS_PER_GROUP,
) -> Ranking | None:
    """A ranking learnt from all labelled rows; None where the labels do not hold both classes or a table is empty. Rows are dealt over groups of about
    ``rows_per_group`` by a hash of the key; tasks draw the pairs of a group, and the driver gets sums only. A null text is the empty one; null keys, and
    labels that are null or neither 0 nor 1, are left out; a key with several labels takes the largest; of texts repeated under a
    key one counts, that with the smallest hash. Other columns are not read."""
    marks = written(labels_by_key(labels, label, key), "labels")
    picked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    measured = [F.xxhash64("_text").alias("_hash"), _measures("_text").alias("x")]
    if few(marks):
        rows = picked.join(F.broadcast(marks), "_key").select("_key", "_label", *measured)
    else:  # the texts stay where they are, their measures meet the labels
        rows = picked.where("_key is not null").select("_key", *measured).join(marks, "_key")
    rows = rows.groupBy("_key").agg(F.max("_label").alias("_label"), F.min_by("x", "_hash").alias("x"))
    rows = written(rows, "measures")
    counts = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return None
    return learn(written(grouped(rows, counts, rows_per_group), "groups"))


def grouped(rows: DataFrame, counts: dict[int, int], rows_per_group: int) -> DataFrame:
    """One row a group, with the measures of its good and poor documents, and count, mean and squared deviations of those that are its own. Every row
    has one group of its own; where a class has too few rows for all groups, its rows visit further ones as partners."""
    groups = max(1, min(MOST_GROUPS, sum(counts.values()) // rows_per_group))
    visits = {c: min(groups, -(-PARTNERS * groups // n)) for c, n in counts.items()}
    home = F.pmod(F.xxhash64("_key"), F.lit(groups)).cast("int")
    many = F.when(F.col("_label") == 1, visits[1]).otherwise(visits[0])
    placed = rows.select("_label", "x", home.alias("_home"), F.explode(F.sequence(F.lit(0), many - 1)).alias("_visit"))
    placed = placed.select("_label", "x", ((F.col("_home") + F.col("_visit")) % groups).alias("_group"), (F.col("_visit") == 0).alias("_own"))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        y, own = table["_label"].to_numpy(), table["_own"].to_numpy()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        order = np.lexsort((*x.T, ~own))  # what follows does not depend on the order in which rows came
        x, y, own = x[order], y[order], own[order]
        n, mean = int(own.sum()), x[own].mean(0) if own.any() else np.zeros(x.shape[1])
        off = ((x[own] - mean) ** 2).sum(0)
        give_back("quality")
        return pa.table({
            "group": [key[0].as_py()], "n": [n], "mean": [mean], "off": [off],
            **{f"{name}{part}": [x[(y == c) & (own if part == "" else ~own)].ravel()] for c, name in ((1, "good"), (0, "poor")) for part in ("", "_guest")},
        }, schema=pa.schema(_PACKED))

    schema = "group int, n long, mean array<double>, off array<double>, good array<double>, good_guest array<double>, poor array<double>, poor_guest array<double>"
    return placed.groupBy("_group").applyInArrow(pack, schema)


_LIST = pa.list_(pa.float64())
_PACKED = [("group", pa.int32()), ("n", pa.int64()), ("mean", _LIST), ("off", _LIST), *[(f"{c}{part}", _LIST) for c in ("good", "poor") for part in ("", "_guest")]]


def _pairs(draw: np.random.Generator, rows: int, pairs: int) -> np.ndarray:
    """``pairs`` row numbers; all rows come before any comes again."""
    return np.concatenate([draw.permutation(rows) for _ in range(-(-pairs // rows))])[:pairs]


def learn(groups: DataFrame, seed: int = 7) -> Ranking:
    """Newton steps on the logistic loss over random (good, poor) pairs of all groups; a step is one pass over the measures. Then the
    strengths of all rows are counted on a fine grid, which gives quantiles and the cut."""
    stats = sorted(groups.where("n > 0").select("group", "n", "mean", "off").collect())
    n = np.array([r["n"] for r in stats], dtype=float)
    means, off = np.array([r["mean"] for r in stats]), np.array([r["off"] for r in stats])
    mean = n @ means / n.sum()
    scale = np.maximum(np.sqrt((off.sum(0) + n @ (means - mean) ** 2) / n.sum()), 1e-9)
    width = len(mean)

    def matrix(row: dict, *names: str) -> np.ndarray:
        return (np.concatenate([np.asarray(row[name]) for name in names]).reshape(-1, width) - mean) / scale

    def step_of(w: np.ndarray):
        def sums(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    good, poor = matrix(row, "good", "good_guest"), matrix(row, "poor", "poor_guest")
                    draw = np.random.default_rng((seed, row["group"]))
                    pairs = PAIRS_PER_ROW * row["n"] if len(good) and len(poor) else 0
                    gradient, curve = np.zeros(width), np.zeros((width, width))
                    if pairs:
                        g, b = _pairs(draw, len(good), pairs), _pairs(draw, len(poor), pairs)
                        for at in range(0, pairs, 1 << 14):
                            d = good[g[at : at + (1 << 14)]] - poor[b[at : at + (1 << 14)]]
                            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # the chance that the poor one wins
                            gradient -= d.T @ p
                            curve += (d * (p * (1 - p))[:, None]).T @ d
                    yield pa.record_batch([
                        pa.array([row["group"]], pa.int32()), pa.array([pairs], pa.int64()), pa.array([gradient], _LIST), pa.array([curve.ravel()], _LIST),
                    ], ["group", "pairs", "gradient", "curve"])
            give_back("quality")

        return sums

    w = np.zeros(width)
    for _ in range(30):
        told = sorted(groups.mapInArrow(step_of(w), "group int, pairs long, gradient array<double>, curve array<double>").collect())
        pairs = sum(r["pairs"] for r in told)
        gradient = RIDGE * w + np.sum([r["gradient"] for r in told], 0) / pairs
        curve = np.sum([r["curve"] for r in told], 0).reshape(width, width) / pairs + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break

    def strengths(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cells = [_cell(matrix(row, name) @ w) for name in ("good", "poor")]
                cell, at = np.unique(np.concatenate(cells), return_inverse=True)
                good = np.bincount(at[: len(cells[0])], minlength=len(cell))
                yield pa.record_batch([pa.array(c.astype(np.int64)) for c in (cell, good, np.bincount(at, minlength=len(cell)) - good)], ["cell", "good", "poor"])
        give_back("quality")

    counted = groups.mapInArrow(strengths, "cell long, good long, poor long").groupBy("cell").agg(F.sum("good").alias("good"), F.sum("poor").alias("poor"))
    table = counted.orderBy("cell").toArrow()
    return _with_cut(mean, scale, w, *(table[c].to_numpy() for c in ("cell", "good", "poor")))


def _cell(strength: np.ndarray) -> np.ndarray:
    """Cells of the grid on which strengths are counted: even on the strength bent into (-1, 1), so that the grid has no end."""
    return np.floor(strength / (1 + np.abs(strength)) * CELLS).astype(np.int64)


def _border(cell: np.ndarray) -> np.ndarray:
    """The strength at which a cell begins."""
    bent = np.clip(cell / CELLS, -1 + 1e-9, 1 - 1e-9)
    return bent / (1 - np.abs(bent))


def _with_cut(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, cell: np.ndarray, good: np.ndarray, poor: np.ndarray) -> Ranking:
    """Quantiles and cut from the counts of all rows by cell."""
    below_good, below_poor = np.cumsum(good), np.cumsum(poor)
    # the cut between two neighbouring cells that errs least on both classes alike
    errors = below_good / below_good[-1] + 1 - below_poor / below_poor[-1]
    at = int(np.argmin(errors))
    middle = _border(cell + 0.5)
    border = (middle[at] + middle[min(at + 1, len(cell) - 1)]) / 2
    upto = below_good + below_poor
    below = upto - (good + poor) / 2
    picks = np.unique(np.clip(np.searchsorted(upto, np.linspace(0, upto[-1], _KNOTS)), 0, len(cell) - 1))
    strengths, quantiles = middle[picks], below[picks] / upto[-1]
    return Ranking(mean, scale, w, strengths, quantiles, float(np.interp(border, strengths, quantiles)))


def scores(block: Block, model: Ranking | None) -> np.ndarray:
    """Score of each text: its strength's quantile, stretched so that the cut lies at the threshold; beyond
    their extremes the score goes on towards 0 and 1."""
    x = measures(block)
    if model is None:
        return np.full(len(x), 0.5)
    s = ((x - model.mean) / model.scale) @ model.weights
    q = np.interp(s, model.strengths, model.quantiles)
    cut = min(max(model.cut, 1e-6), 1 - 1e-6)
    score = np.where(q < cut, THRESHOLD * q / cut, THRESHOLD + (1 - THRESHOLD) * (q - cut) / (1 - cut))
    low, high = model.strengths[0], model.strengths[-1]
    return np.where(s < low, score[...] / (1 + low - s), np.where(s > high, 1 - (1 - score) / (1 + s - high), score))


def quality(model: Ranking | None, text: Column) -> Column:
    """Score from 0 to 1 of each whole text, equal for equal texts; a null text is scored as the empty one; 0.5 without a model."""

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        out = [scores(b, model) for b in blocks(column)]
        give_back("quality")
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(text)


def keep_good(docs: DataFrame, model: Ranking | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns of any name, that score ``threshold`` or more. Each row is judged by its own whole text: equal texts go or
    stay together, a null text is scored as the empty one, null keys play no part. Without a model all stay; an empty table stays empty."""
    return docs.where(quality(model, F.col(text)) >= threshold)


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32 of the decimal doc_id is not 0 modulo 5; scores every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 5) != 0)
    model = fit(docs, labels)
    return docs.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        quality(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
