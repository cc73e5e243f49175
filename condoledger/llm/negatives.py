"""Hard-negative mining over anchor-clustered shared lists (operator 11).

Anchors are put to the nearest of a few directions, found by spherical
k-means on a bounded sample of anchors. For the members of one cluster, c its
direction and t the widest angle between c and a member, no candidate i can
score more than |a| |i| cos(max(0, angle(c, i) - t)) with any member a. The
candidates of a shard are sorted by |i| cos(...) once per cluster; all members
walk that one list in blocks, and a member stops where |a| times the bound of
what is left lies under all that it still looks for. The bound is widened by
more than the rounding of its doubles, so a stop is certain.

Two walks: the first finds an anchor's positives, its best other rows of the
same label; the second, with their scores known, for each positive the best
rows of other labels with low * positive <= 100 * score <= high * positive.
Shards' findings are merged by ranking windows. The directions only decide how
soon a walk ends, never what it finds. Components x become floor(scale * x).

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a shorter vector counts as filled up with zeros and an
empty or zero vector scores 0 with all; ties go to the smaller vec_id, a null
vec_id (no anchor here, the condition being null) last; repeated rows are rows
of their own; an anchor without another row of its label, or a positive
without a row in its range, gives no rows; an empty table gives an empty
result; scores beyond 64 bits are cut to their range; extra columns are
ignored. Memory of a task: one shard (about SHARD_ROWS candidates) and GROUP
anchors at a time, however many share a cluster.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import stored, work_dir

DIRECTIONS = 16            # anchor clusters
SAMPLE = 2000              # anchors that the directions are fitted on, at most
ROUNDS = 8                 # of k-means
GROUP = 256                # anchors of a cluster that walk together
BLOCK_ROWS = 2048          # candidates of the shared list taken at a time
NONE = -(1 << 62)          # the key of an empty place in a member's list
FOUND = "anchor bigint, target int, vec_id bigint, row bigint, score bigint"


def fit_directions(vectors: list[list[float]]) -> np.ndarray:
    """Directions of the clusters by spherical k-means, from farthest-first starts."""
    n = max(map(len, vectors), default=0)
    x = np.array([list(v) + [0.0] * (n - len(v)) for v in vectors], float).reshape(len(vectors), n)
    x = x[np.abs(x).sum(axis=1) > 0]
    if not x.size:
        return np.zeros((0, n))
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = x[:1]
    while len(c) < min(DIRECTIONS, len(x)):
        c = np.vstack([c, x[np.argmin((x @ c.T).max(axis=1))]])
    for _ in range(ROUNDS):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.array([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), c)
    return c


def clustered(anchors: DataFrame, directions: np.ndarray) -> DataFrame:
    """The anchors with the number of their nearest direction."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [int(np.argmax(directions[:, :len(v)] @ v[:directions.shape[1]])) if len(directions) else 0
                    for v in V._vectors(b.column("vec"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32())], names=[*b.schema.names, "cluster"])
    return anchors.mapInArrow(apply, anchors.withColumn("cluster", F.lit(0)).schema)


def _matched(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices filled up to one width, both of Python integers if one is."""
    n = max(a.shape[1], b.shape[1])
    a, b = (x if x.shape[1] == n else np.hstack([x, np.zeros((len(x), n - x.shape[1]), x.dtype)]) for x in (a, b))
    return (a.astype(object), b.astype(object)) if object in (a.dtype, b.dtype) else (a, b)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length one, lengths) in doubles."""
    x = x.astype(float)
    norm = np.linalg.norm(x, axis=1)
    return x / np.where(norm > 0, norm, 1)[:, None], norm


class Shard:
    """Candidates of one shard, in the order of ties."""

    def __init__(self, batches: list[pa.RecordBatch], scale: int):
        values = V.integers(batches, scale)
        ids, null, rows = V.ids_of(batches)
        labels = np.concatenate([b.column("label").to_numpy(zero_copy_only=False) for b in batches])
        order = np.lexsort((rows, ids, null))
        self.values, self.ids, self.null, self.rows, self.labels = (x[order] for x in (values, ids, null, rows, labels))
        self.scale, (self.unit, self.norm) = scale, _unit(self.values)

    def shared_list(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places by descending bound, bounds) for anchors of one cluster: the
        bound times an anchor's length is no less than its score."""
        if members.dtype == object:                           # beyond what doubles bound safely
            return np.arange(len(self.rows)), np.full(len(self.rows), np.inf)
        unit, norm = _unit(members)
        middle = unit.sum(axis=0, keepdims=True)
        middle, n = _unit(middle)
        if n[0] == 0:
            angle, widest = np.zeros(len(self.unit)), 0.0
        else:
            w = max(middle.shape[1], self.unit.shape[1])
            middle, own = (np.hstack([x, np.zeros((len(x), w - x.shape[1]))]) for x in (middle, self.unit))
            # a vector without a direction may lie at any angle
            cosines = unit[norm > 0] @ middle[0, :unit.shape[1]]
            widest = float(np.arccos(np.clip(cosines, -1, 1)).max(initial=0)) + 1e-6
            angle = np.arccos(np.clip(own @ middle[0], -1, 1))
        bound = self.norm * np.cos(np.maximum(angle - widest, 0))
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def walk(self, batch: pa.RecordBatch, k: int, ranges: Callable) -> Iterator[pa.RecordBatch]:
        """For each anchor and each of its targets, the k best candidates that the
        target allows. ``ranges(batch)`` gives (anchor of each target, lowest and
        highest score, whether the label has to be the same)."""
        for start in range(0, batch.num_rows, GROUP):
            yield self._walk(batch.slice(start, GROUP), k, *ranges(batch.slice(start, GROUP)))

    def _walk(self, batch, k, asker, target, low, high, same) -> pa.RecordBatch:
        members, values = _matched(V.integers([batch], self.scale), self.values)
        _, _, member_rows = V.ids_of([batch])
        member_labels = batch.column("label").to_numpy(zero_copy_only=False)
        order, bound = self.shared_list(members)
        length = _unit(members)[1]
        big = members.dtype == object
        shift = 1 << V.KEY_BITS
        top = np.full((len(asker), k), NONE, object if big else np.int64)
        if big:
            top[:] = -(1 << 200)
        empty = top[0, 0] if len(asker) else NONE
        open_ = np.arange(len(asker))
        for begin in range(0, len(order), BLOCK_ROWS):
            # what is left scores this much at most with each asking anchor
            most = np.inf if big else length[asker[open_]] * bound[begin]
            most = most + np.abs(most) * 1e-9 + 1
            worst = top[open_].min(axis=1)
            wanted = np.maximum(low[open_], np.where(worst == empty, low[open_], worst // shift)) if not big else \
                np.array([max(a, a if w == empty else w // shift) for a, w in zip(low[open_], worst)], object)
            open_ = open_[np.greater_equal(most, wanted).astype(bool)]
            if not len(open_):
                break
            at = order[begin:begin + BLOCK_ROWS]
            asking, place = np.unique(asker[open_], return_inverse=True)
            scores = V.cut(members[asking] @ values[at].T)[place]
            fits = (scores >= low[open_, None]) & (scores <= high[open_, None])
            fits &= (member_labels[asker[open_], None] == self.labels[at][None]) == same
            fits &= member_rows[asker[open_], None] != self.rows[at][None]
            keys = np.where(fits, scores * shift + (shift - 1 - at)[None], empty)
            both = np.hstack([top[open_], keys])
            both = np.sort(both, axis=1) if big else np.partition(both, both.shape[1] - k, axis=1)
            top[open_] = both[:, -k:]
        which, slot = np.nonzero(top != empty)
        key = top[which, slot]
        at = (shift - 1 - key % shift).astype(np.int64)
        return pa.record_batch([
            pa.array(member_rows[asker[which]]), pa.array(target[which].astype(np.int32)),
            pa.array(self.ids[at], mask=self.null[at]), pa.array(self.rows[at]), V.long(key // shift)],
            names=["anchor", "target", "vec_id", "row", "score"])


def _any_score(batch: pa.RecordBatch):
    n = batch.num_rows
    wide = np.full(n, 1 << 61)
    return np.arange(n), np.zeros(n, np.int64), -wide, wide, True


def _below_positives(low: int, high: int) -> Callable:
    """Ranges of the second walk: from the scores of each anchor's positives."""
    def ranges(batch: pa.RecordBatch):
        lists = [v or [] for v in batch.column("positive_scores").to_pylist()]
        asker = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        target = np.array([i for v in lists for i in range(len(v))], np.int64)
        least = np.array([-(-low * s // 100) for v in lists for s in v], np.int64)
        most = np.array([high * s // 100 for v in lists for s in v], np.int64)
        return asker, target, least, most, False
    return ranges


def mine(table: DataFrame, is_anchor: Column | str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark, folder = table.sparkSession, work_dir(table.sparkSession, "negatives")
    rows = (table.where(V.whole(F.col(vector_col)) & F.col(label_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"),
                    F.col(label_col).cast("long").alias("label"), V.condition(is_anchor).alias("is_anchor")))
    rows = V.numbered(rows, f"{folder}/rows")
    shards, groups = V.grid(spark, rows.count())
    asked = rows.where("is_anchor").drop("is_anchor")
    sample = asked.select("vec").orderBy(F.xxhash64("row")).limit(SAMPLE).collect()
    anchors = stored(clustered(asked, fit_directions([r["vec"] for r in sample])), f"{folder}/anchors")
    rows = rows.drop("is_anchor")

    def walk(anchors: DataFrame, k: int, ranges: Callable) -> DataFrame:
        cells = V.deal(rows, anchors, shards, groups, ["cluster"])
        found = cells.mapInArrow(V.search(lambda parts: Shard(parts, scale), lambda shard, batch: shard.walk(batch, k, ranges),
                                          ["cluster"]), FOUND)
        return V.best(found, ["anchor", "target"], k)

    near = stored(walk(anchors, positives, _any_score), f"{folder}/positives")
    scores = near.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("positive_scores"))
    anchors = anchors.join(scores.withColumnRenamed("anchor", "row"), "row")
    far = walk(anchors, negatives, _below_positives(low, high))
    near = near.select("anchor", (F.col("rank") - 1).alias("target"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(near, ["anchor", "target"]).join(names, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
               AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
