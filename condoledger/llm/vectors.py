"""Shared pieces of the two searches over vectors (operators 11 and 13).

Rows are stored once under a row number, then dealt out as a grid of cells:
candidates over shards, queries over groups, and a cell is one shard with one
group. Inside a task the candidates of a cell come first and are indexed, the
cell's queries then stream past, so a task holds one shard and one batch of
queries. Both copies grow with the grid only; rows never meet outside a cell,
and no cell depends on what the rows hold, so no key can be hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARD_ROWS = 1 << 18       # candidates that a task indexes at a time, about
KEY_BITS = 20              # of a sort key: the place inside a shard
EXACT = 1 << 41            # scores below this keep their sort keys within 64 bits


def whole(vector: Column) -> Column:
    """True for a vector without null or non-finite components that is not null itself."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad, F.lit(False))


def condition(c: Column | str) -> Column:
    """A condition on the caller's columns, null as false."""
    return F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False))


def numbered(rows: DataFrame, path: str) -> DataFrame:
    """The rows under a number ``row``, stored: the number belongs to the files,
    so it is the same in every later read."""
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), path)


def grid(spark, n_rows: int) -> tuple[int, int]:
    """(shards of candidates, groups of queries): cells for all cores twice over, more
    shards where a shard would not fit. Queries are few, so shards come cheaper."""
    cells = 2 * max(1, spark.sparkContext.defaultParallelism)
    shards = max(math.ceil(n_rows / SHARD_ROWS), round(2 * math.sqrt(cells)), 1)
    return shards, math.ceil(cells / shards)


def deal(candidates: DataFrame, queries: DataFrame, shards: int, groups: int, order: list[str]) -> DataFrame:
    """One row per candidate and group (kind 0) and per query and shard (kind 1),
    dealt by cell, candidates first, queries by ``order``. The rows carry the
    columns of both sides; those that one side lacks are null."""
    place = F.pmod(F.xxhash64("row"), F.lit(shards)) * groups
    c = candidates.select("*", F.lit(0).alias("kind"), F.explode(F.array(*[place + g for g in range(groups)])).alias("cell"))
    group = F.pmod(F.xxhash64("row", F.lit(groups)), F.lit(groups))
    q = queries.select("*", F.lit(1).alias("kind"),
                       F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s * groups + group)).alias("cell"))
    both = c.unionByName(q, allowMissingColumns=True)
    return both.repartition(shards * groups, "cell").sortWithinPartitions("cell", "kind", *order)


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches cut wherever one of these integer columns changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(n).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for n in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def search(index: Callable, ask: Callable, split: list[str]) -> Callable:
    """A mapInArrow function over the rows of ``deal``: ``index(batches)`` builds a
    shard from its candidates, ``ask(shard, batch)`` yields results of a run of
    queries that agree in ``split``."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, shard = None, [], None
        for run in runs(batches, ["cell", "kind", *split]):
            here, kind = run.column("cell")[0].as_py(), run.column("kind")[0].as_py()
            if here != cell:
                cell, parts, shard = here, [], None
            if kind == 0:
                parts.append(run)
            elif parts:
                if shard is None:
                    shard = index(parts)
                yield from ask(shard, run)
    return apply


def integers(batches: list[pa.RecordBatch], scale: int) -> np.ndarray:
    """floor(scale * x) of each component, x as double; one row per vector, shorter
    vectors filled up with zeros. Whole numbers as doubles where every inner
    product of them is exact in a double, else as Python integers."""
    lists = [v for b in batches for v in _vectors(b.column("vec"))]
    out = np.zeros((len(lists), max(map(len, lists), default=0)))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    if out.size and np.abs(out).max() >= math.sqrt(EXACT / out.shape[1]) / scale:
        big = [[int(x) * scale if abs(x) >= 2.0 ** 52 else math.floor(x * scale) for x in row] for row in out.tolist()]
        return np.array(big, dtype=object).reshape(out.shape)
    return np.floor(out * scale)


def _vectors(column: pa.ListArray) -> Iterator[np.ndarray]:
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    for start, end in zip(ends[:-1], ends[1:]):
        yield flat[start:end]


def cut(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers or, as Python integers, cut to their range."""
    if scores.dtype == object:
        return np.minimum(np.maximum(scores, -(1 << 63)), (1 << 63) - 1)
    return scores.astype(np.int64)


def long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64))


def ids_of(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vec_id with 0 for null, whether it is null, row) of each vector."""
    ids = pa.chunked_array([b.column("vec_id") for b in batches], pa.int64())
    rows = np.concatenate([b.column("row").to_numpy(zero_copy_only=False) for b in batches])
    null = ids.is_null().to_numpy().astype(bool)
    return ids.fill_null(0).to_numpy(), null, rows


def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k rows of highest score of each key, ties to the smaller vec_id (null
    last), numbered from 1. Each key has at most k rows a shard to begin with."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
