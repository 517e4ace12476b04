"""Hard negatives by Fagin's threshold algorithm.

Vectors become integers, floor(256 x).  All rows are dealt by a hash of their ids into segments of about
``SEGMENT_VALUES`` components, all anchors into groups of about ``GROUP_VALUES``; each (segment, group) pair is one cogroup.  In it
every dimension has the segment's rows in sorted order.  An anchor reads all those lists from the end that its
component's sign prefers, all to the same depth; rows met for the first time are scored in full by random access.  No
row still unmet can score more than the threshold, the sum over dimensions of the anchor's component times the last
value read.  Reading stops once the threshold is strictly below the kth score of the anchor's list (for positives) or
of each of its windows (for negatives), so ties by id are exact; a window that has no k rows stops once the threshold
is below its least score.  Lists of the segments are merged per anchor by a count and a rank, never by all rows.

Two rounds: the best positives of each anchor, then the best rows of the other labels within each positive's window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import ready, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is within LOW and HIGH percent of the positive's, inclusive.
LOW, HIGH = 30, 90
#: Components of a segment's rows and of a group's anchors, about; bounds of a task's memory, not of the result.
SEGMENT_VALUES, GROUP_VALUES = 1 << 19, 1 << 17
FIRST_DEPTH = 64
LEAST_SCORE, MOST_SCORE = -(1 << 63), (1 << 63) - 1


def integer_rows(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, label, q`` (array<int>) of the rows that take part.

    A null id, label or vector, and a null, NaN or infinite component leave a row out.  An empty vector is all zeros; a
    component beyond 64 bits becomes the nearest 64-bit integer.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.transform(F.col(vector), lambda x: x.cast("double")).alias("x"))
    finite = F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    whole = F.expr(f"""transform(x, v -> case when v * {SCALE} >= 9.2e18 then {MOST_SCORE} when v * {SCALE} <= -9.2e18
        then -{MOST_SCORE} else floor(v * {SCALE}) end)""")
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
                      & finite).select("vec_id", "label", whole.alias("q"))


class Lists:
    """A segment's rows with one sorted list for each dimension; of rows with the same id the least is kept."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        if (ids[by_id][1:] == ids[by_id][:-1]).any():
            least = {}
            for i in by_id.tolist():
                row = (labels[i], rows[i].tolist())
                if ids[i] not in least or row < least[ids[i]][0]:
                    least[ids[i]] = row, i
            by_id = np.array([least[i][1] for i in sorted(least)])
        self.ids, self.labels, self.rows = ids[by_id], labels[by_id], rows[by_id]
        self.most = max(abs(int(self.rows.max(initial=0))), abs(int(self.rows.min(initial=0))))
        self.order = np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32)  # dimension x rank
        self.values = np.take_along_axis(self.rows.T, self.order, axis=1)
        self.copies = {}

    def kind(self, anchor: np.ndarray) -> type:
        """The cheapest type in which the anchor's products and their sums are exact."""
        most = len(anchor) * self.most * max(abs(int(anchor.max(initial=0))), abs(int(anchor.min(initial=0))))
        return (np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object)

    def scores(self, anchor: np.ndarray, which: np.ndarray, kind: type) -> np.ndarray:
        """Random access: whole scores of some rows."""
        if kind not in self.copies:
            self.copies[kind] = self.rows.astype(kind)
        found = self.copies[kind][which] @ anchor.astype(kind)
        if kind is object:
            found = np.array([min(MOST_SCORE, max(LEAST_SCORE, int(x))) for x in found], np.int64)
        return found.astype(np.int64)

    def read(self, anchor: np.ndarray, wanted: np.ndarray, stop) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the rows met among ``wanted`` (a mask), until ``stop(scores, threshold)``;
        row numbers ascend with ids."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        unmet = wanted.copy()
        which, score = [], []
        kind = self.kind(anchor)
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            upto = min(n, depth + step)
            met = np.zeros(n, bool)
            if not len(up) and not len(down):  # a zero vector: every list is one tie
                upto, met[:] = n, True
            met[self.order[up, n - upto:n - depth].ravel()] = True
            met[self.order[down, depth:upto].ravel()] = True
            new = np.flatnonzero(met & unmet)
            unmet[new] = False
            if len(new):
                which.append(new)
                score.append(self.scores(anchor, new, kind))
                which, score = [np.concatenate(which)], [np.concatenate(score)]
            wide = object if kind is object else np.int64
            threshold = (int(anchor[up].astype(wide) @ self.values[up, n - upto].astype(wide))
                         + int(anchor[down].astype(wide) @ self.values[down, upto - 1].astype(wide)))
            threshold = min(MOST_SCORE, max(LEAST_SCORE, threshold))
            if upto == n or stop(score[0] if score else np.zeros(0, np.int64), threshold):
                break
            depth, step = upto, 2 * step
        if not which:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return which[0], score[0]


def kth(scores: np.ndarray, k: int) -> int | None:
    """The kth best of ``scores``, None if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None


def best(which: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score, then id."""
    if len(scores) > k:
        keep = np.flatnonzero(scores >= kth(scores, k))
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((which[keep], -scores[keep]))][:k]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` integers; shorter ones end in zeros."""
    flat = column.combine_chunks()
    size = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    out[row, np.arange(len(row)) - begin[row]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    """Components of the longest vector, 1 at least."""
    return max(1, *(pc.max(pc.list_value_length(c)).as_py() or 0 for c in columns))


def _lists(rows: pa.Table, width: int) -> Lists:
    return Lists(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["q"], width))


def best_positives(anchors: pa.Table, rows: pa.Table, k: int) -> Iterator[tuple]:
    """``anchor_id, vec_id, score`` of each anchor's first ``k`` other rows of its label in this segment."""
    width = _width(anchors["q"], rows["q"])
    lists = _lists(rows, width)
    masks = {label: lists.labels == label for label in set(anchors["label"].to_pylist())}
    for a, label, vector in zip(anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), _matrix(anchors["q"], width)):
        def stop(scores: np.ndarray, threshold: int) -> bool:
            last = kth(scores, k)
            return last is not None and threshold < last

        which, scores = lists.read(vector, masks[label] & (lists.ids != a), stop)
        for j in best(which, scores, k):
            yield a, int(lists.ids[which[j]]), int(scores[j])


def best_negatives(anchors: pa.Table, rows: pa.Table, k: int) -> Iterator[tuple]:
    """``anchor_id, positive_id, positive_score, vec_id, score`` of the first ``k`` rows of other labels in this
    segment within each window of each anchor (``positives``: list of ids and scores)."""
    width = _width(anchors["q"], rows["q"])
    lists = _lists(rows, width)
    masks = {label: lists.labels != label for label in set(anchors["label"].to_pylist())}
    for a, label, given, vector in zip(anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(),
                                       anchors["positives"].to_pylist(), _matrix(anchors["q"], width)):
        windows = [(p["id"], p["score"]) for p in given if p["score"] >= 0]  # below 0 no score fits
        if not windows:
            continue
        spans = sorted({score for _, score in windows})
        inside = {p: (-(-LOW * p // 100), HIGH * p // 100) for p in spans}  # least and greatest score that fit

        def stop(scores: np.ndarray, threshold: int) -> bool:
            for low, high in inside.values():
                if threshold >= low:
                    last = kth(scores[(scores >= low) & (scores <= high)], k)
                    if last is None or threshold >= last:
                        return False
            return True

        which, scores = lists.read(vector, masks[label], stop)
        for p, score in windows:
            low, high = inside[score]
            fit = np.flatnonzero((scores >= low) & (scores <= high))
            for j in fit[best(which[fit], scores[fit], k)]:
                yield a, p, score, int(lists.ids[which[j]]), int(scores[j])


def _task(names: list[str], find, k: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = list(find(anchors, rows, k)) if anchors.num_rows and rows.num_rows else []
        columns = zip(*found) if found else [[]] * len(names)
        return pa.table({name: pa.array(list(c), pa.int64()) for name, c in zip(names, columns)})
    return run


def mine(embeddings: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
         segment_values: int = SEGMENT_VALUES, group_values: int = GROUP_VALUES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embeddings`` has ``vec_id, label, q`` (see :func:`integer_rows`), ``anchors`` those of its rows that are to have
    negatives.  An anchor's positives are the first ``positives`` other rows of its label by score (integer inner
    product), ties by the smaller id; for each, the first ``negatives`` rows of other labels with LOW * positive score <=
    100 * score <= HIGH * positive score.  Vectors of different lengths are compared as if the shorter ended in zeros;
    a score beyond 64 bits counts as the nearest 64-bit integer.  Of rows with the same id one whole row is kept (the
    least label, then vector).  No anchors, no rows of another label or a negative positive score give no rows.
    """
    spark = embeddings.sparkSession
    ready(spark)
    rows = written(embeddings.select("vec_id", "label", "q"), "vectors")
    wanted = written(anchors.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select(
        "vec_id", "r.label", "r.q"), "anchors")

    def shares(df: DataFrame, most: int) -> int:
        n = df.agg(F.sum(F.greatest(F.size("q"), F.lit(1)))).first()[0] or 0
        return max(1, -(-n // most))

    segments, groups = shares(rows, segment_values), shares(wanted, group_values)
    part, group = F.expr(f"pmod(xxhash64(vec_id), {segments})"), F.expr(f"pmod(xxhash64(vec_id, 1), {groups})")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = rows.select("*", part.cast("int").alias("part"), every(groups).alias("grp"))

    def search(asked: DataFrame, find, k: int, names: list[str], name: str) -> DataFrame:
        """The lists that each (group of anchors, segment) finds, written."""
        placed = asked.select("*", group.cast("int").alias("grp"), every(segments).alias("part"))
        task = _task(names, find, k)
        return written(placed.groupBy("part", "grp").cogroup(dealt.groupBy("part", "grp")).applyInArrow(
            task, ", ".join(f"{c} long" for c in names)), name)

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        """The first ``k`` of the at most ``k`` a segment that were found for each key."""
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = first(search(wanted, best_positives, positives, ["anchor_id", "vec_id", "score"], "positives"),
                 ["anchor_id"], positives)
    near = near.groupBy("anchor_id").agg(F.collect_list(F.struct(
        F.col("vec_id").alias("id"), "score")).alias("positives"))  # at most ``positives`` of them
    asked = written(wanted.join(near, wanted["vec_id"] == near["anchor_id"]).select(*wanted.columns, "positives"),
                    "anchors")
    found = search(asked, best_negatives, negatives,
                   ["anchor_id", "positive_id", "positive_score", "vec_id", "score"], "negatives")
    return first(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
