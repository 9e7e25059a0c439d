"""Near-duplicate documents by b-bit MinHash, confirmed on the full sets of word shingles.

Documents with equal sets are one node. Each node has 256 minima; runs of five of the first ones are banded into bucket keys,
and the low four bits of every minimum are packed into bit planes, from which a pair's similarity is
estimated by counting equal positions and correcting for chance collisions. What the estimate lets
through is confirmed on the full sets, and confirmed links are joined into components.

Within a bucket not all pairs are made. Every member is first compared with one hub of the bucket (the member that
meets most others in all its buckets, as the middle of a group does). Only where a bucket then still spans several
components, the members outside its largest one meet the whole bucket, a block against a block in one task, with their full
sets. The task joins what it finds linked and gives a spanning forest only, so its output is linear in its rows; every
pair of a bucket is either compared or already known to be connected.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.graph import components
from leadloom.llm.joins import few
from leadloom.llm.worker import give_back, small_batches
from leadloom.llm.words import Block, blocks, distinct, hashes, lowered, mixed, shingles, split
from leadloom.session import written

WIDTH = 5
MINIMA = 256
ROWS = 5
BANDS = 25
BITS = 4
#: Standard deviations of the estimate that a pair may fall below the threshold and still be confirmed.
SLACK = 4.0
#: Rows of a bucket, on either side, that meet in one task.
BLOCK_ROWS = 512
_FACTORS = mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and where each row's begin. A-Z count as lower case."""
    low = lowered(block)
    words = split(low)
    return distinct(*shingles(hashes(low.data, words.start, words.end), words.bounds, width))


def digests(values: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    ends = bounds.tolist()
    return [
        hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
        for a, b in zip(ends[:-1], ends[1:], strict=True)
    ]


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The minima of each non-empty row: one line for each row of ``bounds`` that has values."""
    first = bounds[:-1][np.diff(bounds) > 0]
    out = np.zeros((len(first), MINIMA), dtype=np.uint64)
    for k in range(MINIMA if len(first) else 0):
        out[:, k] = np.minimum.reduceat(values * _FACTORS[k], first)
    return out


def planes(minima: np.ndarray) -> np.ndarray:
    """Low bits of the minima, plane by plane, 64 positions to a word."""
    out = []
    for bit in range(BITS):
        flags = ((minima >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        out.append(np.packbits(flags, axis=1, bitorder="little").view(np.uint64))
    return np.concatenate(out, 1)


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(minima), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(minima), band + 1, dtype=np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, k])
        keys[:, band] = key
    return keys


_PROFILE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("planes", T.ArrayType(T.LongType())),
    ]
)


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """Lines of a matrix as lists; null where ``present`` is false."""
    sizes = np.where(present, rows.shape[1], 0)
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    flat = pa.array(rows.ravel().view(np.int64))
    return pa.ListArray.from_arrays(offsets, flat, mask=pa.array(~present))


def _profile(width: int):
    @F.arrow_udf(_PROFILE)
    def profile(text: pa.Array) -> pa.Array:
        n, digest, bands, bits = [np.zeros(0, np.int64)], [], [np.zeros((0, BANDS), np.uint64)], []
        for block in blocks(text):
            values, bounds = shingle_sets(block, width)
            minima = signatures(values, bounds)
            n.append(np.diff(bounds))
            digest += digests(values, bounds)
            bands.append(band_keys(minima))
            bits.append(planes(minima))
        counts = np.concatenate(n)
        bits = np.concatenate(bits) if bits else np.zeros((0, BITS * MINIMA // 64), np.uint64)
        columns = [
            pa.array(counts),
            pa.array(digest, pa.binary()),
            _lists(np.concatenate(bands), counts > 0),
            _lists(bits, counts > 0),
        ]
        give_back("minhash")
        return pa.StructArray.from_arrays(columns, ["n", "digest", "bands", "planes"])

    return profile


_SET = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("values", T.ArrayType(T.LongType()))])


def _full_set(width: int):
    @F.arrow_udf(_SET)
    def full(text: pa.Array) -> pa.Array:
        digest, sets, ends = [], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for block in blocks(text):
            values, bounds = shingle_sets(block, width)
            digest += digests(values, bounds)
            sets.append(values)
            ends.append(bounds[1:] + ends[-1][-1])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
        give_back("minhash")
        return pa.StructArray.from_arrays([pa.array(digest, pa.binary()), lists], ["digest", "values"])

    return full


def likeness(a: str, b: str) -> Column:
    """The estimated similarity of two packed signatures: the share of positions whose low bits all agree,
    less what unequal minima agree by chance."""
    words = MINIMA // 64
    equal = F.lit(0)
    for w in range(words):
        differ = None
        for bit in range(BITS):
            x = F.col(a)[bit * words + w].bitwiseXOR(F.col(b)[bit * words + w])
            differ = x if differ is None else differ.bitwiseOR(x)
        equal = equal + 64 - F.bit_count(differ)
    chance = 2.0**-BITS
    return (equal / MINIMA - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    """The estimate from which a pair is confirmed on the full sets."""
    chance = 2.0**-BITS
    p = chance + (1 - chance) * percent / 100
    return percent / 100 - SLACK * math.sqrt(p * (1 - p) / MINIMA) / (1 - chance)


def _sizes_fit(percent: int) -> Column:
    """Whether sets of sizes ``_na`` and ``_nb`` can be alike enough at all."""
    return 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")


def _labelled(rows: DataFrame, maps: list[DataFrame], node: str, label: str) -> DataFrame:
    """``rows`` with the label of the node in column ``node``, by one map after the other; what a map does not
    hold stays as it is."""
    rows = rows.withColumn(label, F.col(node))
    for m in maps:
        m = m.select(F.col("node").alias(label), F.col("label").alias("_to"))
        rows = rows.join(m, label, "left").withColumn(label, F.coalesce("_to", label)).drop("_to")
    return rows


def _between(pairs: DataFrame, maps: list[DataFrame]) -> DataFrame:
    """``pairs`` that lead from one component to another, with the labels ``_la`` and ``_lb``."""
    return _labelled(_labelled(pairs, maps, "a", "_la"), maps, "b", "_lb").where("_la <> _lb")


def _joined(links: DataFrame, maps: list[DataFrame]) -> list[DataFrame]:
    """The maps and one more, that of the components which ``links`` join."""
    between = _between(links, maps).select(F.col("_la").alias("a"), F.col("_lb").alias("b"))
    return [*maps, components(between)]


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = WIDTH
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_shingles`` (distinct runs of ``width`` words; fewer words are one
    run), ``component_id`` (the smallest key that links lead to, its own included) and ``kept`` (it is that
    key). Two texts are linked where 100 * common >= ``percent`` * all shingles.

    Null, empty and blank texts have no shingles and are linked with nothing; their component is their own
    key. Rows repeated under one key share everything. A null key counts in no minimum and is never kept
    (``drop_near_duplicates`` leaves such rows alone). An empty table gives no rows. Other columns are not read.
    """
    return _classes(docs, key, text, percent, width).drop("_mark").withColumnRenamed("_key", key)


def _mark(text: Column) -> Column:
    """Tells rows of one key apart by their texts."""
    return F.struct(F.xxhash64(text, F.lit(1)).alias("a"), F.xxhash64(text, F.lit(2)).alias("b"))


def _classes(docs: DataFrame, key: str, text: str, percent: int, width: int) -> DataFrame:
    """``near_duplicates`` with the key as ``_key`` and ``_mark`` for the text."""
    profile = docs.select(F.col(key).alias("_key"), _mark(F.col(text)).alias("_mark"), _profile(width)(F.col(text)).alias("p"))
    thin = written(profile.select("_key", "_mark", "p.*"), "profiles")
    nodes = written(
        thin.where("n > 0")
        .groupBy("digest")
        .agg(F.min("_key").alias("_key"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = written(banded.join(sizes, "bucket"), "buckets")  # members of the buckets that hold several
    # the member that meets most others in all its buckets is the likeliest middle of its group
    crowd = shared.groupBy("node").agg(F.sum("m").alias("crowd"))
    first = F.max_by("node", F.struct("crowd", F.xxhash64("node")))
    hubs = shared.join(crowd, "node").groupBy("bucket").agg(first.alias("hub"))
    signature = nodes.select("node", "n", "planes")
    least = least_estimate(percent)

    def estimated(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that the packed signatures let through, with the estimate."""
        left = signature.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("planes").alias("_a"))
        right = signature.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("planes").alias("_b"))
        both = pairs.join(left, "a").join(right, "b").withColumn("estimate", likeness("_a", "_b"))
        return both.where(_sizes_fit(percent) & (F.col("estimate") >= least)).select("a", "b", "estimate")

    spokes = shared.join(hubs, "bucket").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    spokes = written(estimated(spokes), "spokes")

    wanted = written(
        _nodes_in(spokes).unionByName(shared.select("node")).distinct().join(nodes.select("node", "digest", "n", "_key"), "node"),
        "wanted",
    )
    sets = _sets(docs, wanted, key, text, width)

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("values").alias("_a"))
        right = sets.select(F.col("node").alias("b"), F.col("values").alias("_b"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("_a", "_b"))
        return both.where(100 * common >= percent * (F.size("_a") + F.size("_b") - common)).select("a", "b")

    # first each node's likeliest hub, then what still leads from one component to another
    best = spokes.groupBy("a").agg(F.max_by("b", F.struct("estimate", F.col("b"))).alias("b"))
    maps = [components(written(confirmed(best), "confirmed"))]
    maps = _joined(written(confirmed(_between(spokes, maps)), "confirmed"), maps)
    maps = _joined(written(_across(shared, maps, nodes, sets, percent), "confirmed"), maps)

    own = _labelled(nodes.select("node", "digest", F.col("_key").alias("_least")), maps, "node", "label")
    smallest = own.groupBy("label").agg(F.min("_least").alias("component_id"))
    by_digest = own.join(smallest, "label").select("digest", "component_id")
    found = thin.join(by_digest, "digest", "left")
    return found.select(
        "_key",
        "_mark",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_key")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("_key") == F.col("component_id"), F.lit(False)))


def _nodes_in(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """The full shingle sets of the nodes of ``wanted``, from the texts of their documents."""
    keys = wanted.select("_key")
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    texts = texts.join(few(keys), F.col("_id").eqNullSafe(F.col("_key")), "left_semi")
    full = texts.select(_full_set(width)(F.col("_text")).alias("s")).select("s.*")
    found = full.join(wanted.select("node", "digest"), "digest").groupBy("node").agg(F.first("values").alias("values"))
    return written(found, "sets")


def forest(tile: pa.Table, bucket: int, percent: int) -> list[tuple[int, int]]:
    """Links of a tile (rows of one bucket: ``minor`` ones meet those that are not) that join its components, one for each time
    that two become one. A pair that shares an earlier bucket as well is left to that."""
    node, label, main = (tile[c].to_numpy() for c in ("node", "label", "main"))
    matrix = lambda c, kind: tile[c].combine_chunks().flatten().to_numpy().view(kind).reshape(len(node), -1)
    bands, bits = matrix("bands", np.int64), matrix("planes", np.uint64)
    sets = tile["values"].combine_chunks()
    bounds = np.append(0, np.cumsum(np.diff(sets.offsets.to_numpy())))
    shingle = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
    size, mark = np.diff(bounds), np.zeros(len(shingle), dtype=bool)
    root = np.unique(label, return_inverse=True)[1]  # of each row, the component that it is in so far
    minor = tile["minor"].to_numpy()
    others = np.flatnonzero(~minor)
    words, chance, least, found = MINIMA // 64, 2.0**-BITS, least_estimate(percent), []
    for i in np.flatnonzero(minor).tolist():
        # two members outside the largest component meet twice
        open_ = (root[others] != root[i]) & ((label[others] == main[others]) | (node[others] > node[i]))
        open_ &= 100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])
        some = others[open_]
        if not len(some):
            continue
        differ = (bits[some] ^ bits[i]).reshape(len(some), BITS, words)
        equal = MINIMA - np.bitwise_count(np.bitwise_or.reduce(differ, 1)).sum(1, dtype=np.int64)
        some = some[(equal / MINIMA - chance) / (1 - chance) >= least]
        some = some[bands[i, (bands[some] == bands[i]).argmax(1)] == bucket]
        if not len(some):
            continue
        own = shingle[bounds[i] : bounds[i + 1]]
        mark[own] = True
        edge = np.append(0, np.cumsum(size[some]))
        at = np.arange(edge[-1]) + np.repeat(bounds[some] - edge[:-1], size[some])
        common = np.add.reduceat(mark[shingle[at]].astype(np.int64), edge[:-1])
        mark[own] = False
        for j in some[100 * common >= percent * (size[i] + size[some] - common)].tolist():
            if root[j] != root[i]:
                found.append((int(node[i]), int(node[j])))
                root[root == root[j]] = root[i]
    return found


def _across(shared: DataFrame, maps: list[DataFrame], nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that join the components which a bucket still spans. The members outside a bucket's largest component meet
    all of its members, block by block."""
    members = written(_labelled(shared.select("bucket", "m", "node"), maps, "node", "label"), "members")
    largest = (
        members.groupBy("bucket", "label")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("bucket")
        .agg(F.max_by("label", F.struct("_n", F.col("label"))).alias("main"), F.max("_n").alias("_most"), F.count(F.lit(1)).alias("_labels"))
        .where("_labels > 1")
        .drop("_labels")
    )
    blocks_of = lambda rows: F.ceil(rows / BLOCK_ROWS).cast("int")
    spanned = members.join(largest, "bucket").select(
        "bucket", "node", "label", "main", blocks_of(F.col("m")).alias("_w"), blocks_of(F.col("m") - F.col("_most")).alias("_v")
    )
    hashed = lambda salt, blocks: F.pmod(F.xxhash64("node", F.lit(salt)), blocks).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    whole = spanned.select("bucket", every("_v").alias("v"), hashed(1, F.col("_w")).alias("w"), "node", "label", "main", F.lit(False).alias("minor"))
    outside = spanned.where("label <> main")
    outside = outside.select("bucket", hashed(2, F.col("_v")).alias("v"), every("_w").alias("w"), "node", "label", "main", F.lit(True).alias("minor"))
    rows = whole.unionByName(outside).join(nodes.select("node", "bands", "planes"), "node").join(sets.select("node", "values"), "node")

    def settled(key: tuple, tile: pa.Table) -> pa.Table:
        links = forest(tile, key[0].as_py(), percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return rows.groupBy("bucket", "v", "w").applyInArrow(settled, "a long, b long")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without those that are not their group's smallest key. Removal goes by row: where texts under one key
    differ, each is judged by itself; where one key and text is repeated, one of its rows stays. Rows without a key, and rows
    whose text is null, empty or blank, all stay. An empty table gives no rows. Columns of any name pass through."""
    found = _classes(docs, key, text, percent, WIDTH).where("_key is not null and n_shingles > 0")
    judged = found.groupBy("_key", "_mark").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("times"))
    judged = written(judged.where("not kept or times > 1"), "judged")
    row = docs.alias("row")
    same = (F.col(f"row.`{key}`") == F.col("judged._key")) & (_mark(F.col(f"row.`{text}`")) == F.col("judged._mark"))
    stay = row.join(few(judged.select("_key", "_mark")).alias("judged"), same, "left_anti")
    twice = judged.where("kept").select("_key", "_mark")
    if twice.isEmpty():
        return stay
    again = row.join(few(twice).alias("judged"), same, "left_semi")
    return stay.unionByName(again.dropDuplicates([key, text]))


def op2_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85)
