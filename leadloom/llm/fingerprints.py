"""Document fingerprints by I-Match over randomised lexicons, in DataFrame functions alone.

The lexicon keeps the terms (lower-cased words) whose document frequency lies within a band. A fingerprint has a
part for the whole lexicon and one for each of several random subsets of it, in families of nested, ever
smaller ones: the hash of the sorted distinct terms that the text has of that subset. Two texts agree in a
part only if they have the very same terms of its subset; the large subsets tell near copies from all
else, the small ones let looser relatives agree in some part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.llm.joins import few
from leadloom.session import written

#: Shares of the documents in which a term of the lexicon occurs. A document has some hundreds of distinct
#: terms on average, so at most those hundreds over LEAST_SHARE terms reach it, however large the corpus is.
LEAST_SHARE = 0.0005
MOST_SHARE = 0.2
FAMILIES = 6
LEVELS = 10
PARTS = 1 + FAMILIES * LEVELS
SEED = 77
#: Rows that a range of keys holds on average, and cells that key ranges are first counted in.
ROWS_PER_RANGE = 1_000
CELLS = 1_024
_SPACES = "[ \\t\\n\\x0b\\f\\r]+"


def terms(text: Column) -> Column:
    """Distinct lower-cased words of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _SPACES)), "")


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """``term`` (a 64-bit hash) for each term within the band of document frequency, over all documents. Its
    rows are bounded by a document's mean number of distinct terms over ``least``."""
    rows = docs.agg(F.count(F.lit(1)).alias("_rows"))
    words = docs.select(F.explode(terms(F.coalesce(text, F.lit("")))).alias("_word"))
    counts = words.groupBy(F.xxhash64("_word").alias("term")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.col("_n") / F.col("_rows")
    return counts.join(F.broadcast(rows), (share >= least) & (share <= most)).select("term")


def _has_bit(n: int) -> Callable[[Column], Column]:
    return lambda term: term.bitwiseAND(F.lit(1 << n)) != 0


def with_parts(df: DataFrame, lists: dict[str, str]) -> DataFrame:
    """``df`` with an array of parts for each sorted list of lexicon terms (column -> new column). Each level
    halves the one above by one bit of the terms' hashes; an empty subset gives a null part."""
    columns = df.columns
    part = lambda c: F.when(F.size(c) > 0, F.xxhash64(F.lit(SEED), F.col(c)))
    for source in lists:
        for family in range(FAMILIES):
            df = df.withColumn(f"_{source}_{family}_0", F.col(source))
    for level in range(LEVELS):
        halves = {}
        for source in lists:
            for family in range(FAMILIES):
                halves[f"_{source}_{family}_{level + 1}"] = F.filter(
                    f"_{source}_{family}_{level}", _has_bit(family * LEVELS + level)
                )
        df = df.withColumns(halves)
    made = {
        target: F.array(part(source), *[part(f"_{source}_{f}_{k + 1}") for f in range(FAMILIES) for k in range(LEVELS)])
        for source, target in lists.items()
    }
    return df.select(*columns, *[c.alias(t) for t, c in made.items()])


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are (0 to 1): in each family the smallest subset of which either text has a
    term is compared, and equal ones count. Such a subset holds a term or two, so this follows the share
    of terms that the texts have in common; the whole lexicon stands above every family."""

    def family(f: int) -> Column:
        places = [1 + f * LEVELS + level for level in reversed(range(LEVELS))] + [0]
        either = [F.when(a[i].isNotNull() | b[i].isNotNull(), a[i].eqNullSafe(b[i]).cast("double")) for i in places]
        return F.coalesce(*either, F.lit(1.0))

    return reduce(lambda x, y: x + y, map(family, range(FAMILIES))) / FAMILIES


def spelled(parts: Column) -> Column:
    """A fingerprint as text: its parts in hexadecimal digits, a dash for a missing one."""
    return F.array_join(F.transform(parts, lambda p: F.lower(F.hex(p))), ":", "-")


def key_ranges(docs: DataFrame, key: str, rows_per_range: int = ROWS_PER_RANGE) -> tuple[Column, Column]:
    """(cell, part): two whole numbers that follow the order of a whole-number key, so that rows of a pair are
    about as many as asked for. Keys are counted in cells of equal width; crowded cells are cut into
    more parts. Nulls come before all. The driver gets at most CELLS counts."""
    low, high = docs.agg(F.min(key), F.max(key)).first()
    k = F.col(key).cast("double")
    if low is None:
        return F.lit(-1), F.lit(0)
    width = (float(high) - float(low) + 1) / CELLS
    cell = F.coalesce(F.floor((k - float(low)) / width).cast("int"), F.lit(-1))
    counts = {r["c"]: r["count"] for r in docs.select(cell.alias("c")).groupBy("c").count().collect()}
    cuts = F.create_map(*[F.lit(x) for c, n in sorted(counts.items()) for x in (c, -(-n // rows_per_range))])
    inside = F.coalesce((k - float(low)) / width - cell, F.lit(0.0))
    return cell, F.floor(inside * cuts[cell]).cast("int")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key``, ``_text`` and ``_next`` (the text that follows by descending key; after the last, the first's)
    of all rows, dealt by ``_cell`` and ``_part`` in ranges of keys, with ``_place`` in the range, and ``_copy``:
    each range ends in a copy of the next one's first row, so that no range needs another. Texts are
    dealt out once. Null texts are empty; rows of one key follow each other in the order of text hashes."""
    cell, part = key_ranges(docs, key)
    rows = docs.select(
        F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"), cell.alias("_cell"), part.alias("_part")
    ).withColumn("_hash", F.xxhash64("_text"))
    at = ["_cell", "_part"]
    first = rows.groupBy(*at).agg(F.max(F.struct("_key", "_hash")).alias("_first"))
    # one row for each range: a fixed share of the table
    order = W.orderBy(*[F.desc(c) for c in at])
    everywhere = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    above = F.coalesce(F.lag(F.struct(*at)).over(order), F.last(F.struct(*at)).over(everywhere))
    first = first.select(F.col("_first._key").alias("_k"), F.col("_first._hash").alias("_h"), above.alias("_to"))
    found = rows.join(few(written(first, "firsts")), F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")))
    copies = found.select("_key", "_text", F.col("_to._cell").alias("_cell"), F.col("_to._part").alias("_part"), "_hash")
    both = rows.withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True)))
    within = W.partitionBy(*at).orderBy("_copy", F.desc_nulls_last("_key"), F.desc("_hash"))
    return both.select(
        "*", F.lead("_text").over(within).alias("_next"), F.row_number().over(within).alias("_place")
    ).drop("_hash")


def fingerprints(
    docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_chars``, and ``parts``, ``edited_parts`` and ``next_parts``: the parts
    of its fingerprint, of that of the text whose second half is replaced by the beginning of the next
    document's, and of that of the next document; and ``edited_sha256``.

    Equal texts have equal parts. Null and empty texts, and texts without a lexicon term, have the hash of the
    text in every part. A single document is its own next. An empty table gives no rows. Key: a whole number;
    null keys come last. Only the two named columns are read.
    """
    at = ["_cell", "_part", "_place"]
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("_text", n - half), F.left(F.coalesce("_next", F.lit("")), half))
    rows = with_next(docs, key, text).withColumn("_n", n).withColumn("_edited", edited)
    own, other = terms(F.col("_text")), terms(F.col("_edited"))
    wide = rows.select(
        *at, "_copy", "_key", "_n", F.sha2("_edited", 256).alias("_sha"), F.xxhash64(F.lit(SEED), "_text").alias("_whole"),
        F.xxhash64(F.lit(SEED), "_edited").alias("_edited_whole"), own.alias("_own"), F.when(~F.col("_copy"), other).alias("_other"),
    )
    # an empty word after all others carries each document through the join
    listed = F.concat("_own", F.coalesce("_other", F.array().cast("array<string>")), F.array(F.lit("")))
    carried = ["_copy", "_key", "_n", "_sha", "_whole", "_edited_whole"]
    exploded = wide.select(*at, *carried, F.size("_own").alias("_size"), F.posexplode(listed).alias("_pos", "_word")).withColumn(
        "term", F.when(F.col("_word") == "", F.lit(0)).otherwise(F.xxhash64("_word"))
    )
    # what a document is carried with goes along with that empty word alone
    exploded = exploded.withColumn("_carried", F.when(F.col("_word") == "", F.struct(*carried))).drop(*carried).withColumn(
        "_list", F.when(F.col("_word") == "", F.lit(0)).when(F.col("_pos") < F.col("_size"), F.lit(1)).otherwise(F.lit(2))
    ).drop("_word", "_pos", "_size")
    known = lexicon.unionByName(exploded.sparkSession.range(1).select(F.lit(0).cast("long").alias("term")))
    # the lexicon is bounded by its band (see above), so it may be broadcast
    inside = exploded.join(F.broadcast(known), "term")
    lists = inside.groupBy(*at).agg(
        F.max("_carried").alias("_carried"),
        F.sort_array(F.collect_list(F.when(F.col("_list") == 1, F.col("term")))).alias("_a"),
        F.sort_array(F.collect_list(F.when(F.col("_list") == 2, F.col("term")))).alias("_b"),
    ).select(*at, "_carried.*", "_a", "_b")
    made = with_parts(lists, {"_a": "_pa", "_b": "_pb"})
    filled = made.select(
        *at, *carried,
        F.when(F.size("_a") > 0, F.col("_pa")).otherwise(F.array_repeat("_whole", PARTS)).alias("parts"),
        F.when(F.size("_b") > 0, F.col("_pb")).otherwise(F.array_repeat("_edited_whole", PARTS)).alias("edited_parts"),
    )
    following = F.lead("parts").over(W.partitionBy("_cell", "_part").orderBy("_place"))
    return (
        filled.withColumn("next_parts", following)
        .where("not _copy")
        .select(F.col("_key").alias(key), F.col("_n").cast("long").alias("n_chars"), F.col("_sha").alias("edited_sha256"), "parts", "edited_parts", "next_parts")
    )


def op5_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = fingerprints(docs, lexicon(docs))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spelled(F.col("parts")).alias("fingerprint"),
        spelled(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
    )
