"""Exact top-k search by term-at-a-time accumulation (operator 13).

A vector's nonzero components are its terms. A shard of candidates becomes an
index of postings: for each term the candidates that have it and their
weights there. A query, a sparse row, goes through its terms one at a time
and scatters the postings' weights times its own into a dense array of scores
with a place per candidate. Nothing is skipped; the k best of the array are
found by partition selection, and the shards' selections are merged by a
ranking window.

Components x become floor(scale * x), so scores are integers and exact; ties
go to the smaller vec_id.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; an empty vector has the score 0 with all; a shorter vector
counts as filled up with zeros; a null vec_id is no query here (the caller's
condition is null) and as a candidate comes last among ties; repeated rows
are rows of their own, each a candidate of the other; a query has as many
results as there are candidates where they are under k; an empty table gives
an empty result; scores beyond 64 bits are cut to their range; extra columns
are ignored. Memory of a task: one shard (about SHARD_ROWS candidates) and one
Arrow batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .common import work_dir

BLOCK_ROWS = 1 << 13       # candidates whose dense scores are accumulated at a time
FOUND = "query bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


class Postings:
    """Postings lists of one shard, block by block, candidates in the order of ties."""

    def __init__(self, batches: list[pa.RecordBatch], scale: int):
        values = V.integers(batches, scale)
        ids, null, rows = V.ids_of(batches)
        order = np.lexsort((rows, ids, null))
        self.ids, self.null, self.rows, self.scale = ids[order], null[order], rows[order], scale
        self.object = values.dtype == object
        values = values[order] if self.object else values[order].astype(np.int64)
        self.blocks = []
        for start in range(0, len(values), BLOCK_ROWS):
            block = values[start:start + BLOCK_ROWS]
            lists = []
            for term in range(block.shape[1]):
                at = np.flatnonzero(block[:, term])
                lists.append((at, block[at, term]))
            self.blocks.append((start, len(block), lists))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Dense scores of all candidates for one query."""
        wide = self.object or query.dtype == object
        out = np.zeros(len(self.ids), object if wide else np.int64)
        terms = [(t, int(query[t])) for t in np.flatnonzero(query)]
        for start, n, lists in self.blocks:
            part = out[start:start + n]
            for term, weight in terms:
                if term < len(lists):
                    at, values = lists[term]
                    part[at] += (values.astype(object) if wide else values) * weight
        return V.cut(out)

    def top(self, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the k highest scores, lowest place first among equals."""
        if k < len(scores):
            if scores.dtype == object:
                return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k])
            bound = np.partition(scores, len(scores) - k)[len(scores) - k]
            above = np.flatnonzero(scores > bound)
            at = np.concatenate([above, np.flatnonzero(scores == bound)[:k - len(above)]])
        else:
            at = np.arange(len(scores))
        return at[np.lexsort((at, -scores[at]))] if scores.dtype != object else np.array(sorted(at, key=lambda i: (-scores[i], i)), np.int64)

    def answer(self, batch: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        queries = V.integers([batch], self.scale)
        if queries.dtype != object:
            queries = queries.astype(np.int64)
        ids, _, rows = V.ids_of([batch])
        places, values = [], []
        for q in range(len(rows)):
            scores = self.scores(queries[q])
            at = self.top(scores, k + 1)                      # one more: the query's own row may be here
            places.append(at[self.rows[at] != rows[q]][:k])
            values.append(scores[places[-1]])
        asker, at = np.repeat(np.arange(len(rows)), [len(p) for p in places]), np.concatenate(places)
        yield pa.record_batch([
            pa.array(rows[asker]), pa.array(ids[asker]), pa.array(self.ids[at], mask=self.null[at]),
            pa.array(self.rows[at]), V.long(np.concatenate(values))], names=["query", "query_id", "vec_id", "row", "score"])


def search(table: DataFrame, is_query: Column | str, k: int = 20, scale: int = 64, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The k highest scores of each query row among all other rows: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    rows = (table.where(V.whole(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"),
                    V.condition(is_query).alias("is_query")))
    rows = V.numbered(rows, f"{work_dir(spark, 'topk')}/rows")
    shards, groups = V.grid(spark, rows.count())
    rows, asked = rows.drop("is_query"), rows.where("is_query").drop("is_query")
    cells = V.deal(rows, asked, shards, groups, [])
    apply = V.search(lambda parts: Postings(parts, scale), lambda shard, batch: shard.answer(batch, k), [])
    found = cells.mapInArrow(apply, FOUND)
    return V.best(found, ["query"], k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
