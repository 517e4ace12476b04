"""Benchmark decontamination by SimHash over item-sized windows.

Texts are lower-cased and cut into words (runs of letters and digits); shingles are
five words.  For every benchmark item, a document has a window of the item's size
wherever the two can be aligned on a shared shingle (a window without one has
similarity 0).  Windows and items get a 64-bit SimHash over their weighted shingles
(weight: the number of occurrences).  Fingerprints are cut into ``BLOCKS`` blocks, and
the index holds every block value within ``RADIUS // BLOCKS`` flipped bits of an item's:
by the pigeonhole principle two fingerprints within ``RADIUS`` meet in a block, so the
join on (item size, block, value) loses none of a size.  Only fingerprints take part in it; the shingles of what
is within the radius are fetched afterwards and verified by their exact weighted Jaccard similarity.

Built-in functions only.  Where a text may be aligned with an item is found by places and hashes alone; only texts
with such a place are cut into windows, in a second read.  The index is joined by shuffle; the benchmark's shingles are
broadcast only while their counted rows stay below ``BROADCAST_ROWS``; beyond, the same narrow rows are shuffled.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import ready, written

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS = 4
RADIUS = 15
BROADCAST_ROWS = 2_000_000


def word_array(text: str) -> Column:
    """Lower-case words (letters and digits) of a column; an empty array for null."""
    bare = F.btrim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def shingles(words: str, k: int = SHINGLE) -> Column:
    """64-bit hashes of all runs of ``k`` words, in order; empty if there are fewer words."""
    return F.expr(f"""case when size({words}) < {k} then cast(array() as array<bigint>) else
        transform(sequence(1, size({words}) - {k - 1}), i -> xxhash64(slice({words}, i, {k}))) end""")


def simhash(col: str) -> Column:
    """64-bit SimHash of an array of shingle hashes; a shingle weighs as often as it occurs."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (f, b) -> f | shiftleft(
        if(aggregate({col}, 0, (s, h) -> s + if(getbit(h, b) = 1, 1, -1)) > 0, 1L, 0L), b))""")


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingle hashes (multisets)."""
    return F.expr(f"""(aggregate(array_distinct({a}), 0, (s, x) -> s + least(
        size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))) / cast(size({a}) + size({b}) -
        aggregate(array_distinct({a}), 0, (s, x) -> s + least(
        size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x)))) as double)""")


def block_values(fingerprint: str, blocks: int) -> str:
    """SQL array of (block, value) of a fingerprint."""
    width = 64 // blocks
    return "array(" + ", ".join(
        f"struct({k} as block, shiftright({fingerprint}, {k * width}) & {(1 << width) - 1}L as value)"
        for k in range(blocks)) + ")"


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def flips(width: int, most: int) -> list[int]:
    """All masks of at most ``most`` of ``width`` bits."""
    return [sum(1 << b for b in c) for r in range(most + 1) for c in combinations(range(width), r)]


def within_radius(windows: DataFrame, items: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS) -> DataFrame:
    """``windows`` (``n``, ``fp`` and others) beside each of ``items`` (``item_id``, ``n``, ``item_fp``) of the same size
    whose fingerprint is within ``radius``, once each, with their ``distance``."""
    masks = ", ".join(f"{x}L" for x in flips(64 // blocks, radius // blocks))
    index = items.select("item_id", "n", "item_fp", F.expr(f"inline({block_values('item_fp', blocks)})")).select(
        "item_id", "n", "item_fp", "block", F.explode(F.expr(f"transform(array({masks}), x -> value ^ x)")).alias("value"))
    cut = windows.select("*", F.expr(f"inline({block_values('fp', blocks)})"))
    # Thousands of rows an item: evenly dealt, never broadcast.
    met = cut.join(index.hint("merge"), ["n", "block", "value"]).withColumn(
        "distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).where(F.col("distance") <= radius)
    return met.select(*windows.columns, "item_id", "distance").distinct()


def _leaks(docs: DataFrame, benchmark: DataFrame, threshold: float, blocks: int, radius: int) -> DataFrame:
    """One row for each window that is similar to an item: ``doc_id, t`` (hash of the text), ``item_id, start, len,
    distance, similarity``."""
    spark = docs.sparkSession
    ready(spark)
    items = written(
        benchmark.select("item_id", word_array("text").alias("w")).select("item_id", "w", shingles("w").alias("item_sh"))
        .select(F.monotonically_increasing_id().alias("item"), "item_id", "item_sh", F.size("w").alias("n"),
                simhash("item_sh").alias("item_fp")), "benchmark-items")
    items = items.where(f"n >= {SHINGLE}")
    # Windows depend on a shared shingle's place and the item's size, not on the item.
    anchors = items.select("n", F.posexplode("item_sh").alias("o", "h")).distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    cut = rows.select("doc_id", "t", word_array("text").alias("w")).select("doc_id", "t", F.size("w").alias("nw"),
                                                                          shingles("w").alias("sh"))
    # An outer generator: a plain one makes Catalyst filter on the array's size below this projection,
    # which would build the array twice.
    hits = cut.select("doc_id", "t", "nw", F.posexplode_outer("sh").alias("p", "h")).join(_bounded(anchors), "h")
    places = written(hits.select(
        "doc_id", "t", "n", F.expr("greatest(0, least(p - o, nw - n))").alias("start"),
        F.expr("least(n, nw)").alias("len")).distinct(), "leak-places")
    # The texts with a place, once each, cut into their windows on all cores.
    found = places.groupBy(F.col("doc_id").alias("id_"), F.col("t").alias("t_")).agg(
        F.collect_list(F.struct("start", "len", "n")).alias("places"))  # at most a few for each word of the text
    texts = rows.join(_bounded(found), rows["doc_id"].eqNullSafe(F.col("id_")) & (F.col("t") == F.col("t_")))
    texts = texts.dropDuplicates(["doc_id", "t"]).select("doc_id", "t", "places", word_array("text").alias("w"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    windows = texts.select("doc_id", "t", shingles("w").alias("sh"), F.explode("places").alias("x")).select(
        "doc_id", "t", "x.*", F.expr(f"slice(sh, x.start + 1, x.len - {SHINGLE - 1})").alias("sh"))
    windows = written(windows.repartition(parts, "doc_id", "t", "start", "n").withColumns(
        {"fp": simhash("sh"), "window": F.monotonically_increasing_id()}), "leak-windows")
    near = within_radius(windows.select("window", "n", "fp"), items.select(F.col("item").alias("item_id"), "n", "item_fp"),
                         blocks, radius)
    near = near.select("window", F.col("item_id").alias("item"), "distance")
    both = near.join(windows.drop("fp", "n"), "window").join(items.select("item", "item_id", "item_sh"), "item")
    return both.withColumn("similarity", similarity("sh", "item_sh")).where(F.col("similarity") >= threshold).drop(
        "sh", "item_sh", "item", "window")


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
               blocks: int = BLOCKS, radius: int = RADIUS) -> DataFrame:
    """Leaked items: ``doc_id, item_id, start_word, n_words, distance, similarity``, one row for
    each pair of ids (its most similar, then first window).

    Items and documents of fewer than five words have no shingle and never match; null texts
    count as empty; rows that repeat an id are searched one by one and reported once; a null id
    is reported as null.  Other columns are ignored; an empty table gives no row.
    """
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "len", "distance"))
    return _leaks(docs, benchmark, threshold, blocks, radius).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.col("b.start").alias("start_word"), F.col("b.len").alias("n_words"),
        F.col("b.distance").cast("int").alias("distance"), (-F.col("b.s")).alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS,
                  radius: int = RADIUS) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay.

    Rows are judged by id and text together, so a leak under a null or repeated id takes no row with another text.
    """
    bad = written(_leaks(docs, benchmark, threshold, blocks, radius).select(
        F.col("doc_id").alias("leaked_id_"), F.col("t").alias("leaked_t_")).distinct(), "leaked-rows")
    same = docs["doc_id"].eqNullSafe(bad["leaked_id_"]) & (F.xxhash64(docs["text"]) == bad["leaked_t_"])
    return docs.join(_bounded(bad), same, "left_anti")
