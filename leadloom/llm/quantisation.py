"""Near-duplicate embeddings by product quantisation.

Unit vectors go to the nearest of some coarse centres (an inverted list for each label, length and centre); what is left of
them is coded by subspace, one byte each. Two vectors within distance t of each other lie in one list, or the line between them
crosses the plane midway between their centres, and then one of them lies within t / 2 of that plane. So a vector
visits the lists beyond all planes within t / 2 of it: these probes suffice, no pair is lost. In a list, a visitor's
distance to each member is looked up in its tables by the member's codes; the true distance is smaller by the error of the
member's code at most, so what lies within t plus that error is a candidate, and its cosine is computed from the full
vectors.

Lists are cut into blocks, and a task compares one block of visitors with one block of members. It gives a count for
each vector and a spanning forest of the links that it has found, never the pairs, so its output is linear in its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.graph import components
from leadloom.session import written

COSINE = 0.93
#: Vectors that centres and codes are learnt from: those with the smallest hashes, up to so many rows and so many entries in all (but
#: SAMPLE_ROWS[0] rows at least). All vectors are indexed.
SAMPLE_ROWS, SAMPLE_ENTRIES = (1_024, 16_384), 1 << 22
#: Rows of the most frequent label for each centre, and how many centres there may be.
ROWS_PER_CENTRE, FEWEST, MOST = 2_048, 8, 1_024
SUBSPACES, CODES = 8, 256
ROUNDS = 8
#: Rows of a list that meet in one task.
BLOCK_ROWS = 4_096
#: Visitors whose distances to a block of members are looked up at once, and pairs whose cosines are computed at once.
LOOKED_UP, RERANKED = 128, 1 << 15
#: What single-precision tables and rounding may add to a distance.
ROUNDING = 1e-4


class Index(NamedTuple):
    """Coarse ``centres``; ``books[m]``: the codes' vectors in the dimensions ``cuts[m] : cuts[m + 1]``."""

    centres: np.ndarray
    books: list[np.ndarray]
    cuts: np.ndarray


def finite(vector: Column) -> Column:
    """Whether a vector is there, holds no null or non-finite entry, and is not zero."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.coalesce(F.exists(wide, lambda c: c != 0), F.lit(False))


def padded(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of doubles, shorter ones with zeros behind. Each is scaled by a power of two so that squares neither
    overflow nor vanish, which leaves cosines as they are to the last bit."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return np.ldexp(out, -np.frexp(np.abs(out).max(1, initial=0))[1][:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centre, less the row's own square."""
    return np.einsum("ij,ij->i", centres, centres) - 2.0 * (x @ centres.T)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def clustered(x: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of at most ``count`` clusters by Lloyd's rounds, begun at rows spread evenly over ``x``; all different."""
    first = np.unique(np.linspace(0, len(x) - 1, min(count, len(x))).astype(int))
    centres = np.unique(x[first], axis=0)
    for _ in range(rounds):
        own = nearest(x, centres)
        size = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.unique(sums[size > 0] / size[size > 0, None], axis=0)
    return centres


def fit(sample: np.ndarray, centres: int) -> Index:
    """Centres and codes from unit vectors, a row each."""
    coarse = clustered(sample, centres)
    rest = sample - coarse[nearest(sample, coarse)]
    cuts = np.unique(np.linspace(0, sample.shape[1], SUBSPACES + 1).astype(int))
    return Index(coarse, [clustered(rest[:, a:b], CODES) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], cuts)


def coded(x: np.ndarray, index: Index, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """List, codes, error of the code, and the other lists to visit, of each unit vector."""
    square = _squares(x, index.centres)
    own = square.argmin(1)
    rest = x - index.centres[own]
    codes = np.stack([nearest(rest[:, a:b], book) for book, a, b in zip(index.books, index.cuts, index.cuts[1:])], 1).astype(np.uint8)
    guess = np.concatenate([book[codes[:, m]] for m, book in enumerate(index.books)], 1)
    error = np.linalg.norm(rest - guess, axis=1)
    between = np.sqrt(np.maximum(_squares(index.centres, index.centres) + np.einsum("ij,ij->i", index.centres, index.centres)[:, None], 0))
    np.fill_diagonal(between, 1.0)
    to_plane = (square - square[np.arange(len(x)), own][:, None]) / (2 * between[own])
    near = to_plane <= reach / 2 + ROUNDING
    near[np.arange(len(x)), own] = False
    return own, codes, error, [np.flatnonzero(n) for n in near]


_LISTED = [("cell", "int"), ("codes", "binary"), ("error", "float"), ("probes", "array<int>")]


def indexed(nodes: DataFrame, index: Index, width: int, reach: float) -> DataFrame:
    """``nodes`` (their column ``vector``) with what the index has of them."""
    names = nodes.columns
    kind = T.StructType([*nodes.schema.fields, *[T.StructField(c, T._parse_datatype_string(t)) for c, t in _LISTED]])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kind)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, codes, error, probes = coded(unit(padded(batch.column(names.index("vector")), width)), index, reach)
            more = [own.astype(np.int32), [c.tobytes() for c in codes], error.astype(np.float32), [p.astype(np.int32) for p in probes]]
            columns = [*batch.columns, *[pa.array(v, schema.field(c).type) for v, (c, _) in zip(more, _LISTED, strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return nodes.mapInArrow(listed, kind)


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, once the links (a, b) are added."""
    a, b = labels[a], labels[b]
    while len(open_ := np.flatnonzero(a != b)):
        a, b = a[open_], b[open_]
        parent = np.arange(len(labels))
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(parent, above := parent[parent]):
            parent = above
        labels, a, b = parent[labels], parent[a], parent[b]
    return labels


def compared(tile: pa.Table, index: Index, width: int, cosine: float, cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each linked node of a tile: the node, one that its links lead to (itself for one of each component) and how many
    vectors its links of this tile reach."""
    reach = math.sqrt(2 - 2 * cosine)
    nodes, times = tile["node"].to_numpy(), tile["times"].to_numpy()
    own = tile["cell"].to_numpy()
    vectors = padded(tile["vector"], width)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    visitors, members = np.flatnonzero(tile["visits"].to_numpy()), np.flatnonzero(tile["listed"].to_numpy())
    codes = np.frombuffer(b"".join(tile["codes"].take(pa.array(members)).to_pylist()), np.uint8).reshape(len(members), -1)
    limit = reach + tile["error"].to_numpy()[members].astype(np.float64) + ROUNDING
    limit = (limit * limit).astype(np.float32)
    # members that visit a visitor's own list are met there, if that comes first
    probes = tile["probes"].combine_chunks().take(pa.array(members))
    probes_of = np.repeat(np.arange(len(members)), np.diff(probes.offsets.to_numpy()))
    returned = np.unique(probes_of * (len(index.centres) + 1) + probes.flatten().to_numpy(zero_copy_only=False))
    counts, labels = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
    for i in range(0, len(visitors), LOOKED_UP):
        some = visitors[i : i + LOOKED_UP]
        rest = vectors[some] / norms[some, None] - index.centres[cell]
        distance = np.zeros((len(some), len(members)), dtype=np.float32)
        for m, (book, a, b) in enumerate(zip(index.books, index.cuts, index.cuts[1:])):
            table = _squares(rest[:, a:b], book) + np.einsum("ij,ij->i", rest[:, a:b], rest[:, a:b])[:, None]
            distance += table.astype(np.float32)[:, codes[:, m]]
        at, with_ = np.nonzero(distance <= limit)
        a, b = some[at], members[with_]
        # members meet once; a visitor from elsewhere meets a member unless they meet in its own list
        elsewhere = own[a] != cell
        twice = np.isin(with_ * (len(index.centres) + 1) + own[a], returned)
        keep = np.where(elsewhere, ~twice | (cell < own[a]), nodes[a] < nodes[b])
        a, b = a[keep], b[keep]
        for j in range(0, len(a), RERANKED):
            p, q = a[j : j + RERANKED], b[j : j + RERANKED]
            near = np.einsum("ij,ij->i", vectors[p], vectors[q]) / (norms[p] * norms[q]) >= cosine
            p, q = p[near], q[near]
            counts += np.bincount(p, times[q], len(nodes)).astype(np.int64) + np.bincount(q, times[p], len(nodes)).astype(np.int64)
            labels = merged(labels, p, q)
    linked = np.flatnonzero(counts)
    return nodes[linked], nodes[labels[linked]], counts[linked]


def _tiles(listed: DataFrame, group: list[str]) -> DataFrame:
    """A row for each tile that a vector belongs to: its list's blocks of visitors against its blocks of members. Members visit their
    own list as well."""
    each = F.explode(F.concat(F.array("cell"), "probes"))
    rows = listed.withColumn("list", each).withColumn("member", F.col("list") == F.col("cell"))
    sizes = rows.groupBy(*group, "list").agg(F.count(F.lit(1)).alias("v"), F.count_if("member").alias("m"))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK_ROWS)).cast("int")
    sizes = sizes.where("m > 0 and v > 1").select(*group, "list", blocks("v").alias("_v"), blocks("m").alias("_m"))
    rows = rows.join(sizes, [*group, "list"])
    rows = rows.withColumn("_mine", F.pmod(F.xxhash64("node", F.lit(1)), "_v").cast("int")).withColumn("_block", F.pmod(F.xxhash64("node", F.lit(2)), "_m").cast("int"))
    tile = lambda v, m, visits, is_listed: F.struct(v.alias("tv"), m.alias("tm"), visits.alias("visits"), is_listed.alias("listed"))
    across = F.transform(
        F.sequence(F.lit(0), F.col("_m") - 1),
        lambda m: tile(F.col("_mine"), m, F.lit(True), F.col("member") & (m == F.col("_block"))),
    )
    down = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("_v") - 1), lambda v: F.col("member") & (v != F.col("_mine"))),
        lambda v: tile(v, F.col("_block"), F.lit(False), F.lit(True)),
    )
    return rows.withColumn("t", F.explode(F.concat(across, down))).drop("_mine", "_block", "_v", "_m", "member").select("*", "t.*").drop("t")


def near_duplicate_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """One row per row of ``rows``: the key, ``n_links`` (other vectors of the same label whose cosine with it is ``cosine`` or more),
    ``component_id`` (the smallest key that links lead to, its own included) and ``kept`` (it is that key).

    Vectors that are null, empty or zero or hold null or non-finite entries, those without label, and those of different
    lengths or labels are linked with nothing; alone, a vector's component is its own key. Equal vectors of one label are one
    node, and count as links of each other. Rows repeated under one key are vectors like any other; a null key counts in no
    minimum and is never kept. An empty table gives no rows. Other columns are not read. ``cosine`` is above 0.
    """
    vectors = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    able = F.col("label").isNotNull() & finite(F.col("vector"))
    mark = [F.xxhash64("label", "vector", F.lit(salt)).alias(f"h{salt}") for salt in (1, 2)]
    vectors = vectors.withColumn("vector", F.when(able, F.transform("vector", lambda c: c + 0)))  # -0 is 0
    # equal vectors are one node
    nodes = (
        vectors.where("vector is not null").groupBy("label", "vector")
        .agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("times"))
        .withColumns({"node": F.monotonically_increasing_id(), "length": F.size("vector")})
    )
    nodes = written(nodes, "vectors")
    facts = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("c"), F.max("length").alias("d")).agg(F.max("c").alias("c"), F.max("d").alias("d")).first()
    thin = vectors.select("key", F.when(F.col("vector").isNotNull(), F.struct(*mark)).alias("mark"))
    if facts["c"] is None:
        return _answer(thin.withColumns({"n_links": F.lit(0).cast("long"), "group_least": F.col("key")}), key)
    width, reach = facts["d"], math.sqrt(2 - 2 * cosine)
    size = min(SAMPLE_ROWS[1], max(SAMPLE_ROWS[0], SAMPLE_ENTRIES // width))
    sample = nodes.orderBy(F.xxhash64("label", "vector"), "node").limit(size).select("vector").toArrow()
    index = fit(unit(padded(sample["vector"], width)), min(MOST, max(FEWEST, facts["c"] // ROWS_PER_CENTRE)))
    group = ["label", "length"]
    listed = indexed(nodes.select("node", "label", "length", "times", "vector"), index, width, reach)
    tiles = _tiles(written(listed, "listed"), group)

    def found(name: tuple, tile: pa.Table) -> pa.Table:
        node, root, count = compared(tile, index, width, cosine, name[2].as_py())
        return pa.table({"node": node, "root": root, "links": count})

    by_tile = tiles.groupBy(*group, "list", "tv", "tm").applyInArrow(found, "node long, root long, links long")
    by_tile = written(by_tile, "links")
    counts = by_tile.groupBy("node").agg(F.sum("links").alias("links"))
    maps = components(by_tile.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("label", "top")
    nodes = nodes.join(counts, "node", "left").join(maps, "node", "left")
    nodes = nodes.select("label", "vector", "least", "times", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("top", "node").alias("top"))
    nodes = written(nodes.select(F.struct(*mark).alias("mark"), "least", "top", (F.col("links") + F.col("times") - 1).alias("n_links")), "linked")
    least = nodes.groupBy("top").agg(F.min("least").alias("group_least"))
    linked = nodes.join(least, "top").select("mark", "n_links", "group_least")
    return _answer(thin.join(linked, "mark", "left"), key)


def _answer(found: DataFrame, key: str) -> DataFrame:
    component = F.when(F.col("n_links") > 0, F.col("group_least")).otherwise(F.col("key"))
    done = found.select(F.col("key"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    kept = F.coalesce(F.col("key") == F.col("component_id"), F.lit(False))
    return done.withColumn("kept", kept).withColumnRenamed("key", key)


def op12_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
