"""Token files with canonical length-limited Huffman codes (operator 8).

A token file set is a folder with three Parquet tables:

* ``codebook`` (id, bits): the code length of each id that occurs. Codes are
  canonical: they follow from the lengths, in the order of (bits, id).
* ``parts`` (part, first_token, n_tokens): the parts in ascending order of
  document id; ids of part p precede those of part p + 1.
* ``blocks`` (part, first_doc, doc_ids, doc_tokens, part_start, checkpoints,
  payload): the documents of an independent block in order, their token
  counts, the part's tokens before the block, the bit offset of every
  CHECKPOINT-th token, and the code bits (most significant bit first).

Writing: documents are range-partitioned and sorted by id, tokenized once
and stored; the ids' global counts give length-limited code lengths
(package-merge over at most a vocabulary of symbols, on the driver); blocks
are encoded with numpy. Reading decodes each block by a lookup table of
2^MAX_BITS entries, all checkpoints of a block in lock step.

Defined cases: a null or empty text is just its end id; rows that repeat an
id follow each other in the order of their texts, nulls first; an empty
table gives an empty file set; extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_and_text, slices, stored
from .tokenizing import chunk_tokenizer, default_tokenizer

MAX_BITS = 18            # longest code; the decoding table has 2^18 entries (it stays in cache) and serves 2^18 symbols
CHECKPOINT = 128         # tokens between two checkpoints
BLOCK_TOKENS = 1 << 19   # a block is closed once it holds so many tokens
END_ID = 2


# ---------------------------------------------------------------- code book
def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for symbols with these
    counts (all positive), by package-merge."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit into codes of {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)                       # is this entry a leaf?
        merged = both[rank]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        k = int(leaf[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes of sorted distinct ids with given lengths."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.ids, self.bits = ids.astype(np.int64), bits.astype(np.int64)
        self.order = np.lexsort((self.ids, self.bits))
        space = np.left_shift(1, MAX_BITS - self.bits[self.order])    # table entries of each code
        first = np.cumsum(space) - space
        self.codes = np.empty(len(ids), np.int64)
        self.codes[self.order] = first >> (MAX_BITS - self.bits[self.order])

    def encode(self, tokens: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(code bits, bit offset of every CHECKPOINT-th token)."""
        size = int(self.ids[-1]) + 1 if len(self.ids) else 0
        code, bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        code[self.ids], bits[self.ids] = self.codes.astype(np.uint64), self.bits
        n = bits[tokens]
        ends = np.cumsum(n)
        at = ends - n
        placed = code[tokens] << (64 - (at & 31) - n).astype(np.uint64)
        word = at >> 5
        words = np.zeros(int(ends[-1] >> 5) + 3 if len(ends) else 2, np.uint64)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        if len(starts):
            w = word[starts]
            words[w] += np.add.reduceat(placed >> np.uint64(32), starts)
            words[w + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), starts)
        return words.astype(">u4").tobytes(), at[::CHECKPOINT]

    def table(self) -> np.ndarray:
        """Symbol << 5 | code length for every MAX_BITS-bit prefix."""
        space = np.left_shift(1, MAX_BITS - self.bits[self.order])
        out = np.zeros(1 << MAX_BITS, np.uint32)
        out[:space.sum()] = np.repeat(self.ids[self.order] << 5 | self.bits[self.order], space)
        return out


def decode(payload: bytes, checkpoints: np.ndarray, n_tokens: int, table: np.ndarray) -> np.ndarray:
    """The ids of a block: one lane for each checkpoint, all in lock step."""
    b = np.frombuffer(payload, np.uint8).astype(np.uint32)
    window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    at = checkpoints.astype(np.int64)
    out = np.empty((CHECKPOINT, len(at)), np.uint32)
    last = len(window) - 1
    shift = np.uint32(32 - MAX_BITS)
    for step in range(min(CHECKPOINT, n_tokens)):
        entry = table[(window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> shift]
        out[step] = entry >> np.uint32(5)
        at += entry & np.uint32(31)
    return out.T.reshape(-1)[:n_tokens]


# ---------------------------------------------------------------- writing
def _tokenized(docs: DataFrame, end_id: int, tokenizer: str | None, folder: str) -> DataFrame:
    """part, position and part_start (rows and tokens of the part before it),
    doc_id, n_tokens, ids - stored, in ascending order of id."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_tokenizer(tokenizer or default_tokenizer())
        part, position, before = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches, "text"):
            ids, offsets = encoder.encode(batch.column("text"))
            rows = [np.append(ids[a:b], np.uint32(end_id)) for a, b in zip(offsets[:-1], offsets[1:])]
            n = np.fromiter(map(len, rows), np.int64, len(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part)), pa.array(position + np.arange(len(n))),
                 pa.array(before + np.cumsum(n) - n), batch.column("doc_id"), pa.array(n),
                 pa.array([x.tobytes() for x in rows], pa.binary())],
                names=["part", "position", "part_start", "doc_id", "n_tokens", "ids"])
            position, before = position + len(n), before + int(n.sum())

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(parts, F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    out = ordered.mapInArrow(run, f"part long, position long, part_start long, doc_id {kind}, n_tokens long, ids binary")
    out.write.option("compression", "zstd").parquet(f"{folder}/tokenized")
    return docs.sparkSession.read.parquet(f"{folder}/tokenized")


def _counts(tokenized: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Global count of each id; one row an id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in slices(batches, "ids"):
            own = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.uint32), minlength=len(total))
            own[:len(total)] += total
            total = own
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n": pa.array(total[ids], pa.int64())})

    rows = tokenized.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    rows = rows.sort_values("id")
    return rows["id"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def write_token_files(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, tokenizer: str | None = None) -> str:
    """Write the token file set of ``docs`` at ``path``; ``folder`` takes the
    stored step. Both must be folders that all executors share."""
    spark = docs.sparkSession
    df = id_and_text(docs, id_col, text_col)
    kind = dict(df.dtypes)["doc_id"]
    tokenized = _tokenized(df, end_id, tokenizer, folder)
    ids, counts = _counts(tokenized)
    bits = code_lengths(counts)
    spark.createDataFrame(list(zip(ids.tolist(), bits.tolist())), "id long, bits long").coalesce(1).write.parquet(f"{path}/codebook")

    totals = tokenized.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)    # one row a part
    totals.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"),
                  "n_tokens").write.parquet(f"{path}/parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(ids, bits)

        def block(rows: list[dict]) -> dict:
            payload, checkpoints = book.encode(np.frombuffer(b"".join(r["ids"] for r in rows), np.uint32))
            return {"part": rows[0]["part"], "first_doc": rows[0]["position"], "part_start": rows[0]["part_start"],
                    "doc_ids": [r["doc_id"] for r in rows], "doc_tokens": [r["n_tokens"] for r in rows],
                    "checkpoints": checkpoints.tolist(), "payload": payload}

        rows: list[dict] = []
        held = 0
        for batch in slices(batches, "ids"):
            for r in batch.to_pylist():
                follows = rows and (r["part"], r["position"]) == (rows[-1]["part"], rows[-1]["position"] + 1)
                if rows and (not follows or held >= BLOCK_TOKENS):
                    yield pa.RecordBatch.from_pylist([block(rows)], schema)
                    rows, held = [], 0
                rows.append(r)
                held += r["n_tokens"]
        if rows:
            yield pa.RecordBatch.from_pylist([block(rows)], schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    out = f"part long, first_doc long, part_start long, doc_ids array<{kind}>, doc_tokens array<long>, checkpoints array<long>, payload binary"
    schema = to_arrow_schema(spark.createDataFrame([], out).schema)
    tokenized.mapInArrow(run, out).write.parquet(f"{path}/blocks")
    return path


# ---------------------------------------------------------------- reading
def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, decoded from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    book = spark.read.parquet(f"{path}/codebook").orderBy("id").toPandas()       # one row a symbol
    ids, bits = book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Codebook(ids, bits).table()
        for batch in slices(batches, "payload"):
            doc_ids = batch.column("doc_ids")
            for k in range(batch.num_rows):
                n = np.array(batch.column("doc_tokens")[k].as_py(), np.int64)
                tokens = decode(batch.column("payload")[k].as_py(), np.array(batch.column("checkpoints")[k].as_py()), int(n.sum()), table)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), batch.column("part")[k].as_py())), doc_ids[k].values,
                     pa.array(batch.column("part_start")[k].as_py() + ends - n), pa.array(n),
                     pa.array([tokens[e - m:e].tobytes() for e, m in zip(ends, n)], pa.binary())],
                    names=["part", "doc_id", "part_start", "n_tokens", "ids"])

    rows = blocks.mapInArrow(run, f"part long, doc_id {kind}, part_start long, n_tokens long, ids binary")
    parts = spark.read.parquet(f"{path}/parts").select("part", "first_token")
    return rows.join(F.broadcast(parts), "part").select(                        # one row a part
        "doc_id", (F.col("first_token") + F.col("part_start")).alias("start"), "n_tokens", "ids")
