"""Lexical retrieval packing (operator 10).

Documents become token ids plus an end id. They are dealt by range of their
strongest terms (tf-idf over the document frequencies of the whole table), so
that lexically close documents lie side by side whatever files they came from. A slice of a partition (a few MB of ids)
forms one shard with a BM25 inverted index over the documents' token ids,
without the end id; a seed asks with all its terms. Whole windows of a long document are sequences by
themselves; what is left of each document is a pool. A seed from the pool
opens a sequence; the index returns its best unused neighbours, which fill
the window in the order of their scores. The piece that no longer fits is
cut: its head fills the window and its rest stays in the pool. When no
neighbour shares a term with the seed, the next unused document follows.
What is left at the end of a shard is cut into sequences whose lengths are
powers of two, so that there is no padding at all.

The ids are stored, then shuffled once; a term that very many documents share
is split further by their next terms and a hash of the id. Memory is bounded
by a slice or the longest text. Sequence ids carry the partition in the upper bits.

Defined cases: a null or empty text is just its end id; repeated rows are
packed once each; an empty table gives an empty result; extra input columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, stored, work_dir
from .tokenizing import chunk_tokenizer, default_tokenizer

WINDOW = 2048
END_ID = 1
# BM25's constants, and how many of a document's terms place it.
K1, B = 1.2, 0.75
PLACE_TERMS = 3
# What ``wide`` says in a stored row that holds a slice's document frequencies.
FREQUENCIES = "df"


class Bm25Shard:
    """Inverted index over items (arrays of token ids)."""

    def __init__(self, items: list[np.ndarray]):
        self.n = len(items)
        sizes = np.fromiter(map(len, items), np.int64, self.n)
        tokens = np.concatenate([np.zeros(0, np.uint32), *items]).astype(np.int64)
        owner = np.repeat(np.arange(self.n), sizes)
        # one row a (term, item), sorted by term, with its term frequency
        keys, tf = np.unique(tokens * self.n + owner, return_counts=True)
        term, self.item = keys // max(1, self.n), keys % max(1, self.n)
        self.terms, self.first, df = np.unique(term, return_index=True, return_counts=True)
        self.last = self.first + df
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / max(1.0, sizes.mean() if self.n else 1.0))
        weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.item])
        self.weight = weight
        # the terms of each item that another one has too: rows in the order of item
        row_term = np.repeat(np.arange(len(self.terms)), df)
        shared = np.flatnonzero(np.repeat(df, df) > 1)
        order = shared[np.argsort(self.item[shared], kind="stable")]
        self.by_item = row_term[order]
        self.item_first = np.searchsorted(self.item[order], np.arange(self.n + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused items that share a term with the seed, best first."""
        lo, hi = self.item_first[seed], self.item_first[seed + 1]
        spans = [slice(self.first[t], self.last[t]) for t in self.by_item[lo:hi]]
        if not spans:
            return np.zeros(0, np.int64)
        score = np.bincount(np.concatenate([self.item[s] for s in spans]),
                            np.concatenate([self.weight[s] for s in spans]), self.n)
        found = np.flatnonzero((score > 0) & unused)
        return found[np.argsort(-score[found], kind="stable")]


def pack_shard(docs: list[np.ndarray], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) over a shard's ids, each
    document's last one its end id."""
    rest: list[int] = []                               # first token not yet in a sequence
    for d, ids in enumerate(docs):
        whole = len(ids) // window * window
        for start in range(0, whole, window):
            yield [(d, start, window)]
        rest.append(whole)
    index = Bm25Shard([ids[:-1] for ids in docs])      # whole documents: a tail stands for its document
    unused = np.array([len(ids) > start for ids, start in zip(docs, rest)], bool)
    after = 0                                          # items before it are all used

    def take(d: int, space: int) -> tuple[int, int, int]:
        n = min(len(docs[d]) - rest[d], space)
        piece = (d, rest[d], n)
        rest[d] += n
        unused[d] = rest[d] < len(docs[d])
        return piece

    while True:
        while after < len(docs) and not unused[after]:
            after += 1
        if after == len(docs):
            return
        seed = after
        sequence = [take(seed, window)]
        space = window - sequence[0][2]
        near = iter(index.neighbours(seed, unused) if space else ())
        while space:
            d = next((x for x in near if unused[x]), None)
            if d is None:
                while after < len(docs) and not unused[after]:
                    after += 1
                if after == len(docs):
                    break
                d = after
            sequence.append(take(int(d), space))
            space -= sequence[-1][2]
        if not space:
            yield sequence
        else:                                          # the shard's tail: lengths that are powers of two
            yield from _powers_of_two(sequence)


def _powers_of_two(sequence: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    left = sum(n for _, _, n in sequence)
    todo = sequence[::-1]
    while left:
        space = 1 << (left.bit_length() - 1)
        left -= space
        out = []
        while space:
            d, start, n = todo.pop()
            if n > space:
                todo.append((d, start + space, n - space))
                n = space
            out.append((d, start, n))
            space -= n
        yield out


def document_terms(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, how often) of every different term of every document, sorted."""
    base = int(ids.max(initial=0)) + 1
    kind = np.uint32 if base * len(offsets) < 1 << 32 else np.int64          # short keys sort faster
    keys = np.sort(np.repeat(np.arange(len(offsets) - 1, dtype=kind) * kind(base), np.diff(offsets)) + ids.astype(kind))
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    doc, term = np.divmod(keys[first], kind(base))
    return doc.astype(np.int64), term.astype(np.int64), np.diff(first, append=len(keys))


def strongest(ids: np.ndarray, offsets: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    """The PLACE_TERMS terms of each document with the highest tf-idf, -1 where
    it has fewer; terms that no other document has come last."""
    out = np.full((len(offsets) - 1, PLACE_TERMS), -1, np.int32)
    doc, term, tf = document_terms(ids, offsets)
    idf = np.log1p(np.maximum(n - df + 0.5, 0) / (df + 0.5)) * np.where(df < 2, 1e-3, 1)
    weight = tf * (K1 + 1) / (tf + K1) * idf[term]
    for k in range(PLACE_TERMS if len(doc) else 0):        # the best, the smallest of equal ones, then the next best
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        best = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, first), np.diff(first, append=len(doc))))
        best = best[np.unique(doc[best], return_index=True)[1]]
        best = best[weight[best] >= 0]
        out[doc[best], k] = term[best]
        weight[best] = -1
    return out


def coded(docs: DataFrame, end_id: int, tokenizer: str | None) -> DataFrame:
    """doc_id, ids (with the end id) and wide (their type), stored; for each slice
    one more row, with FREQUENCIES as wide and, as ids, its documents' number and
    its pairs of a term and the number of documents that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_tokenizer(tokenizer or default_tokenizer())
        for batch in slices(batches, "text"):
            ids, offsets = encoder.encode(batch.column("text"))
            wide = "<u4" if max(end_id, ids.max(initial=0)) > 0xFFFF else "<u2"
            whole = [np.append(ids[a:b], np.uint32(end_id)).astype(wide).tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            term, count = np.unique(document_terms(ids, offsets)[1], return_counts=True)
            known = np.concatenate([[-1, len(whole)], np.stack([term, count], 1).ravel()]).astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([batch.column("doc_id"), pa.nulls(1, batch.column("doc_id").type)]), pa.array([*whole, known], pa.binary()),
                                              pa.array([wide] * len(whole) + [FREQUENCIES])], names=["doc_id", "ids", "wide"])

    df = docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary, wide string")
    return stored(df, f"{work_dir(docs.sparkSession, 'packing')}/ids")


def frequencies(stored_ids: DataFrame) -> tuple[np.ndarray, int]:
    """Document frequencies by term id and the number of documents, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<i4").reshape(-1, 2).astype(np.int64)
            term, at = np.unique(pairs[:, 0], return_inverse=True)
            count = np.bincount(at, pairs[:, 1], len(term)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(count, pa.int64())], names=["term", "n"])

    found = (stored_ids.where(F.col("wide") == FREQUENCIES).select("ids").mapInArrow(run, "term long, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).collect())
    df = np.zeros(max([0, *(r.term for r in found)]) + 1, np.int64)
    for r in found:
        if r.term >= 0:
            df[r.term] = r.n
    return df, max([0, *(r.n for r in found if r.term < 0)])


def placed(docs: DataFrame, end_id: int, tokenizer: str | None) -> DataFrame:
    """doc_id, ids (with the end id) and wide (their type), dealt and sorted by the strongest terms."""
    rows = coded(docs, end_id, tokenizer)
    df, n = frequencies(rows)
    places = [f"t{k}" for k in range(PLACE_TERMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            whole = [np.frombuffer(x, w)[:-1].astype(np.uint32) for x, w in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())]
            terms = strongest(np.concatenate([np.zeros(0, np.uint32), *whole]), np.concatenate([[0], np.cumsum([len(x) for x in whole])]), df, n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "ids", "wide")), *(pa.array(t, pa.int32()) for t in terms.T)],
                                             names=["doc_id", "ids", "wide", *places])

    near = rows.where(F.col("wide") != FREQUENCIES).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary, wide string, " + ", ".join(f"{t} int" for t in places))
    near = near.withColumn("salt", F.xxhash64("doc_id"))
    return near.repartitionByRange(*places, "salt").sortWithinPartitions(*places, "salt").select("doc_id", "ids", "wide")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row a piece: doc_id, start (the document's ids before it), length,
    doc_tokens (with the end id), sequence_id, offset (inside the sequence)
    and ids (little-endian unsigned 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence_id = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "ids"):
            shard = [np.frombuffer(x, w).astype("<u4") for x, w in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist())]
            rows: list[tuple] = []
            for sequence in pack_shard(shard, window):
                offset = 0
                for d, start, n in sequence:
                    rows.append((d, start, n, len(shard[d]), sequence_id, offset, shard[d][start:start + n].tobytes()))
                    offset += n
                sequence_id += 1
            d, *cols = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(d, pa.int64())), *(pa.array(c, pa.int64()) for c in cols[:-1]),
                 pa.array(cols[-1], pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    df = placed(id_and_text(docs, id_col, text_col), end_id, tokenizer)
    return df.mapInArrow(run, f"doc_id {dict(df.dtypes)['doc_id']}, start long, length long, doc_tokens long, "
                              "sequence_id long, offset long, ids binary")
