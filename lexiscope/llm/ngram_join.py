"""N-gram Jaccard join by a MinHash LSH forest.

Every text has ``TREES`` keys of ``MAX_DEPTH`` MinHash values (16 bits each) over its shingles of five words.  A tree is a
prefix trie held as the texts sorted by their keys: texts that share a prefix lie side by side.  The matched prefix starts
at the whole key and is shortened by one value at a time until the target recall: two texts of similarity s agree in the
first d values of some tree with probability 1 - (1 - s^d)^TREES, which must reach ``RECALL`` at the threshold (the
threshold is the same for all texts, so the walk ends at one depth; 4 at 0.8).  One pass over the sorted prefixes links each
text with the first of its run of equal prefixes (runs go on across tasks).  Within a run the texts are ordered by their
digest, so near copies have the same few first texts in all trees and their links are few.  A first text may be that of a very
large run: its links are made by many tasks, and its label is broadcast (:func:`components`).  The texts of one component
meet once, in blocks of ``BLOCK``, where all their pairs are verified by exact Jaccard similarity of their shingle sets.

Copies (equal texts) are one node with a weight throughout; no pair is ever written, only
counts of links and roots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import find_by, ready, written
from lexiscope.llm.components import components
from lexiscope.llm.word_hash import U, mix, shingle_hashes, text_chunks

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
MAX_DEPTH = 8
RECALL = 0.999
BLOCK = 256
#: No longer read: runs have one first text each.
LINKED = 256
VALUE_BITS = 16
CHUNK = 1 << 20  # bytes of text whose shingles are held at once
#: Rows up to which a table of ids is broadcast.
BROADCAST_ROWS = 1_000_000


def prefix_depth(threshold: float, trees: int, max_depth: int, recall: float) -> int:
    """The longest prefix that reaches ``recall`` at ``threshold``, shortened from ``max_depth`` on (1 if none does)."""
    for d in range(max_depth, 1, -1):
        if 1 - (1 - threshold ** d) ** trees >= recall:
            return d
    return 1


def signatures(h: np.ndarray, begin: np.ndarray, n: int, used: list[int] | None = None) -> np.ndarray:
    """MinHash values (uint32) of each text's shingles by ``n`` hashes, or by those of them in ``used``; texts without
    a shingle get the largest value."""
    used = list(range(n)) if used is None else used
    out = np.full((len(begin) - 1, len(used)), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(begin) > 0)
    if len(full):
        low = (h >> U(32)).astype(np.uint32)
        seed = mix(np.arange(1, 2 * n + 1, dtype=U))
        for i, j in enumerate(used):
            a, b = np.uint32(int(seed[2 * j]) & 0xFFFFFFFF | 1), np.uint32(int(seed[2 * j + 1]) >> 32)
            out[full, i] = np.minimum.reduceat((low ^ b) * a, begin[full])
    return out


def keys_of(sig: np.ndarray, trees: int, max_depth: int) -> np.ndarray:
    """Two 64-bit numbers for each text and tree: its values in order, 16 bits each, first ones first."""
    value = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(32 - VALUE_BITS)).astype(U).reshape(len(sig), trees, max_depth)
    out = np.zeros((len(sig), trees, 2), U)
    for d in range(max_depth):
        out[:, :, d // 4] |= value[:, :, d] << U(VALUE_BITS * (3 - d % 4))
    return out


def _sign(k: int, trees: int, max_depth: int):
    def run(batches):
        for batch in batches:
            for i, j, words, where in text_chunks(batch.column("text"), CHUNK):
                h, begin = shingle_hashes(words, where, k)
                key = keys_of(signatures(h, begin, trees * max_depth), trees, max_depth)
                some = np.diff(begin) > 0
                flat = key[some].view(np.int64).ravel()
                offsets = np.concatenate([[0], np.cumsum(np.where(some, 2 * trees, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("node").slice(i, j - i),
                     pa.ListArray.from_arrays(offsets, pa.array(flat))], ["doc_id", "node", "keys"])
    return run


def prefixes(tree: np.ndarray, hi: np.ndarray, lo: np.ndarray, depth: int) -> np.ndarray:
    """Rows ``tree, hi, lo`` of which only the first ``depth`` values of the key are left."""
    drop = [VALUE_BITS * max(0, 4 - depth), VALUE_BITS * min(4, 8 - depth)]
    keep = [(~U(0) << U(n)) if n < 64 else U(0) for n in drop]
    return np.stack([tree.astype(U), hi.view(U) & keep[0], lo.view(U) & keep[1]], axis=1)


def _forest(depth: int):
    """Links of sorted prefixes: each text with the first of its run in this task; and the first and last row of the
    task, for runs that go on (the last row with the first of its run)."""
    names = ["a", "b", "place", "ends", "tree", "hi", "lo"]

    def ends(place: int, last: bool, row: tuple) -> tuple:
        p, node = row
        return (node, None, place, last, *(int(x) for x in p.view(np.int64)))

    def run(batches):
        place, before = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            p = prefixes(*(batch.column(c).to_numpy() for c in ("tree", "hi", "lo")), depth)
            node = batch.column("node").to_pylist()
            same = np.concatenate([[before is not None and (p[0] == before[0]).all()], (p[1:] == p[:-1]).all(axis=1)])
            rows = [ends(place, False, (p[0], node[0]))] if before is None else []
            start = np.maximum.accumulate(np.where(same, -1, np.arange(len(p))))  # a run's first row, -1: in an earlier batch
            first = [before[1] if i < 0 else node[i] for i in start.tolist()]
            rows += [(node[i], first[i], place, None, None, None, None) for i in np.flatnonzero(same).tolist()]
            before = p[-1], first[-1]
            yield _rows(rows)
        if before is not None:
            yield _rows([ends(place, True, before)])

    types = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]

    def _rows(rows):
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
    return run


def forest_links(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """``a, b``: links that join all of ``nodes`` (``node, keys``) whose keys agree in ``depth`` values in some tree.

    The texts of a run are ordered by node alone, so the runs of a group of near copies have the same few first
    texts in all trees, and most of the group's links are equal."""
    def kept(half: int) -> str:  # the bits of a half of the key that belong to the prefix
        n = VALUE_BITS * min(4, max(0, depth - 4 * half))
        return "0L" if n == 0 else f"keys[2 * t + {half}]" if n == 64 else f"shiftleft(shiftright(keys[2 * t + {half}], {64 - n}), {64 - n})"

    member = nodes.select("node", F.explode(F.expr(
        f"transform(sequence(0, {trees - 1}), t -> struct(cast(t as bigint) as tree, {kept(0)} as hi, {kept(1)} as lo))"
    )).alias("k")).select("node", "k.*")
    order = ["tree", "hi", "lo", "node"]
    found = written(member.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _forest(depth), "a string, b string, place long, ends boolean, tree long, hi long, lo long"), "forest")
    # Two rows for each task.
    edge = Window.orderBy("place", "ends")
    cut = found.where("ends is not null").select(
        "a", "ends", "tree", "hi", "lo", *[F.lag(c).over(edge).alias(f"{c}_") for c in ("a", "tree", "hi", "lo")])
    over = cut.where("not ends and tree = tree_ and hi = hi_ and lo = lo_").select("a", F.col("a_").alias("b"))
    return found.where("ends is null").select("a", "b").unionByName(over)


def verified(sets: list[np.ndarray], weights: np.ndarray, left: int, threshold: float):
    """Links among sets of shingles: per set the number of partners and their weight, and the least index
    linked to it directly or through others.  ``left``: only pairs across the first ``left`` sets and the
    rest count (0: all pairs)."""
    m = len(sets)
    size = np.array([len(s) for s in sets], float)
    owner = np.repeat(np.arange(m), size.astype(int))
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    both = np.zeros((m, m), np.float32)
    wide = max(256, (4 << 20) // max(m, 1) // 4)
    for c in range(0, int(place[-1]) + 1, wide):
        a, b = np.searchsorted(place, [c, c + wide])
        x = np.zeros((m, wide), np.float32)
        x[owner[a:b], place[a:b] - c] = 1
        both += x @ x.T
    near = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(near, False)
    if left:
        near[:left, :left] = False
        near[left:, left:] = False
    root = np.arange(m)
    while True:  # least label over links, until nothing changes
        low = np.where(near, root[None, :], m).min(axis=1, initial=m)
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    return near.sum(axis=1), near @ weights, root


def _verify(k: int, threshold: float):
    names = ("node", "root", "links", "weight")

    def group(key, rows):
        nodes, sides, weights, sets = [], [], [], []
        for node, block, weight, s in sorted(rows, key=lambda r: (r[1], r[0])):
            nodes.append(node)
            sides.append(block)
            weights.append(weight)
            sets.append(np.frombuffer(s, U))
        left = 0 if key[1] == key[2] else sum(s == key[1] for s in sides)
        if len(nodes) < 2 or key[1] != key[2] and left in (0, len(nodes)):
            return []
        links, weight, root = verified(sets, np.array(weights, float), left, threshold)
        return [(nodes[i], nodes[root[i]], int(links[i]), int(weight[i])) for i in np.flatnonzero(links)]

    def run(batches):
        key, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("comp", "b1", "b2", "node", "block", "copies", "shingles")]
            for comp, b1, b2, node, block, copies, s in zip(*cols):
                if (comp, b1, b2) != key:
                    if rows:
                        out += group(key, rows)
                    key, rows = (comp, b1, b2), []
                rows.append((node, block, copies, s))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if rows:
            out += group(key, rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for i, j, words, where in text_chunks(batch.column("text"), CHUNK):
                h, begin = shingle_hashes(words, where, k)
                sets = [np.unique(h[begin[x]:begin[x + 1]]).tobytes() for x in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(i, j - i), batch.column("comp").slice(i, j - i),
                     batch.column("size").slice(i, j - i), batch.column("copies").slice(i, j - i),
                     pa.array(sets, pa.binary())], ["node", "comp", "size", "copies", "shingles"])
    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES,
                    max_depth: int = MAX_DEPTH, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): ``doc_id, node`` (digest of the text), ``class_id`` (least
    id of its class: copies and texts linked directly or through others), ``n_copies`` (rows with this
    text), ``n_text_links`` (other texts at ``threshold`` or more), ``n_links`` (other rows at ``threshold`` or more).

    A text of one to four words has one shingle, all its words; a null or blank text has none:
    it is in a class of its own with no link.  Rows that repeat an id are rows of their own; a
    null id never becomes a class id unless its class has no other (then ``class_id`` is null).
    Other columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    ready(spark)
    depth = prefix_depth(threshold, trees, max_depth, recall)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("node"), "text")
    signed = written(rows.mapInArrow(_sign(shingle, trees, max_depth),
                                     "doc_id long, node string, keys array<long>"), "signatures")
    nodes = written(signed.where("size(keys) > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")), "nodes")
    near = components(forest_links(nodes, trees, depth))
    sizes = written(near.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "component-sizes")
    near = written(find_by(near, sizes, "root", "size").join(nodes.select("node", "rep", "copies"), "node").select(
        "node", F.col("root").alias("comp"), "size", "rep", "copies"), "candidates")
    # The text of one row of each candidate node, by id and digest: copies of a hot text stay behind.
    some = near.select(F.col("node").alias("node_"), "comp", "size", "rep", "copies")
    if near.count() <= BROADCAST_ROWS:
        some = F.broadcast(some)
    texts = rows.join(some, (F.col("node") == F.col("node_")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    sets = texts.select("node", "text", "comp", "size", "copies").mapInArrow(
        _sets(shingle), "node string, comp string, size long, copies long, shingles binary")
    sets = sets.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn(
        "block", F.expr("pmod(xxhash64(node), blocks)").cast("int"))
    sets = sets.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select(
        "node", "copies", "shingles", "comp", "block", F.least("block", "other").alias("b1"),
        F.greatest("block", "other").alias("b2"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A row that repeats both id and text gives its node twice: one is enough.
    links = written(
        sets.repartition(n, "comp", "b1", "b2").sortWithinPartitions("comp", "b1", "b2", "node")
        .mapInArrow(_once(_verify(shingle, threshold)), "node string, root string, links long, weight long"), "links")
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = links.groupBy("node").agg(F.sum("links").alias("n_text_links"), F.sum("weight").alias("weight"))
    joined = written(nodes.select("node", "rep", "copies").join(roots, "node", "left").join(totals, "node", "left"), "joined")
    linked = joined.where("root is not null")
    classes = written(linked.groupBy("root").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("texts")), "class-ids")
    info = find_by(linked, classes, "root", "texts").unionByName(
        joined.where("root is null"), allowMissingColumns=True).select(
        "node", F.coalesce("class_id", "rep").alias("class_id"), F.col("copies").alias("n_copies"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("n_links")).where("n_copies > 1 or n_links > 0")
    info = written(info, "classes")
    # At most 1,000 texts can have a thousandth of the rows each: their rows join by broadcast.
    total = signed.count()
    hot = info.where(F.col("n_copies") * 1000 >= total)
    cold = info.where(F.col("n_copies") * 1000 < total)
    ids = signed.where("size(keys) > 0").select("doc_id", "node")
    first = ids.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "node", "left")
    columns = ["class_id", "n_copies", "n_text_links", "n_links"]
    out = first.where("hot").select("doc_id", "node", *columns).union(
        first.where("hot is null").select("doc_id", "node").join(cold, "node", "left")
        .select("doc_id", "node", *columns)).union(
        signed.where("size(keys) = 0").select("doc_id", "node", *[F.lit(None).cast("long") for _ in columns]))
    return out.select(
        "doc_id", "node", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _once(verify):
    """Drops a row that repeats the one before it (same group and node)."""
    def run(batches):
        def fresh():
            last = None
            for batch in batches:
                keys = list(zip(*(batch.column(c).to_pylist() for c in ("comp", "b1", "b2", "node"))))
                keep = [k != p for k, p in zip(keys, [last, *keys])]
                if keys:
                    last = keys[-1]
                yield batch if all(keep) else batch.filter(pa.array(keep))
        return verify(fresh())
    return run


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each class (the least id; of equal rows, one); all columns stay.
    Null and blank texts stay."""
    found = written(near_duplicates(docs, **settings), "near-duplicates")
    group = found.where("n_copies > 1 or n_links > 0")
    # The row that stays: of each class the least id, then digest.
    stays = group.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "node")).alias("s"))
    stays = stays.select(F.col("s.doc_id").alias("doc_id"), F.col("s.node").alias("node"), F.lit(True).alias("stays"))
    many = group.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n")).join(
        stays.withColumnsRenamed({"doc_id": "i", "node": "m"}),
        F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("node") == F.col("m")), "left")
    marks = written(many.select(F.col("doc_id").alias("id_"), F.col("node").alias("node_"),
                                F.coalesce("stays", F.lit(False)).alias("stays_"), F.col("n").alias("rows_")),
                    "near-duplicate-marks")

    digest = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))

    def matched(part: DataFrame, how: str) -> DataFrame:
        part = part.select("id_", "node_")
        same = docs["doc_id"].eqNullSafe(part["id_"]) & (part["node_"] == digest)
        return docs.join(F.broadcast(part) if part.count() <= BROADCAST_ROWS else part, same, how)

    gone = matched(marks.where("not stays_ or rows_ > 1"), "left_anti")
    repeated = marks.where("stays_ and rows_ > 1")
    if not repeated.limit(1).count():
        return gone
    return gone.union(matched(repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
