"""Benchmark decontamination with an FM-index per training shard (operator 4).

Words are maximal runs of a-z, 0-9 and non-ASCII characters after lower-casing
A-Z. A benchmark item is cut into windows of ``size`` consecutive words; an
item of fewer words, but not none, is one window.

A task takes its documents slice by slice. Words become symbols of the
benchmark's vocabulary; only stretches whose neighbouring words also follow
each other in some benchmark window can hold an occurrence, so only those
stretches enter the shard (an exact prefilter, it loses no occurrence). Over
the shard's symbols it builds an FM-index: suffix order by prefix doubling,
the Burrows-Wheeler transform in a wavelet matrix, and sampled suffix
positions. All windows are searched backward at once, one symbol a step;
occurrences are located by stepping to the next sampled position, and their
words are merged to removal spans.

Nothing is shuffled: the documents' hits are found where the documents are
read, however many documents share a passage. The benchmark is a stated
query set; it reaches the tasks in blocks of at most BLOCK_WORDS words, each
broadcast on its own, and a task holds one block at a time.

Defined cases: null or empty texts have no words; a null item text has no
window; item ids are compared as text, null as the empty one, and an id that
several rows share counts once; repeated documents get equal rows; empty
tables work; ``scan`` ignores extra columns and ``remove`` keeps them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, raw_texts, slices

WINDOW = 10
BLOCK_WORDS = 500_000      # words of benchmark items in one broadcast block
SHARD_SYMBOLS = 1 << 20    # symbols after which a shard is closed (a single longer text makes its own)
SAMPLE = 16                # every SAMPLE-th text position is kept for locating

# Lower-cases A-Z and turns every ASCII character that is no word character into a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


# ---------------------------------------------------------------- FM-index
def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffix array of symbols >= 1 (the end counts as 0), by prefix doubling."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64) + 1
    k = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[:n - k] = rank[k:]
        key = rank * (n + 2) + follow
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]] - 1) > 0)
        if new[order[-1]] == n:
            return order
        rank, k = new, 2 * k


class WaveletMatrix:
    """Rank of any symbol in a sequence, for many queries at once."""

    def __init__(self, s: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (s >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(s) - int(bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each end."""
        lo, hi = np.zeros_like(end), end
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbol >> (self.levels - 1 - k)) & 1 == 1
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return hi - lo


class FmIndex:
    """Backward search and locating over symbols in 1 .. sigma - 1."""

    def __init__(self, s: np.ndarray, sigma: int):
        sa = np.concatenate([[len(s)], suffix_order(s)])           # the empty suffix comes first
        self.n = len(sa)
        self.bwt = np.append(s, 0)[sa - 1]                         # position -1 is the end mark, symbol 0
        counts = np.bincount(self.bwt, minlength=sigma)
        self.before = np.cumsum(counts) - counts
        self.ranks = WaveletMatrix(self.bwt, sigma)
        sampled = sa % SAMPLE == 0
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - sampled
        self.samples = sa[sampled]

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.ranks.rank(symbol, at)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval [lo, hi) of each row of ``patterns``."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        alive = np.arange(len(patterns))
        for column in patterns.T[::-1]:
            lo[alive], hi[alive] = self.step(column[alive], lo[alive]), self.step(column[alive], hi[alive])
            alive = alive[hi[alive] > lo[alive]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.sampled[at])
        while len(todo):
            at[todo] = self.step(self.bwt[at[todo]], at[todo])
            steps[todo] += 1
            todo = todo[~self.sampled[at[todo]]]
        return self.samples[self.sample_rank[at]] + steps


# ---------------------------------------------------------------- benchmark blocks
class Block:
    """Windows of some benchmark items over their own vocabulary.

    Symbols: 1 separates stretches, words start at 2; 0 is the FM-index's end.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = defaultdict(set)
        pairs: set[tuple[int, int]] = set()
        for item, words in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words)
            pairs.update(zip(ids, ids[1:]))
            for k in range(max(1, len(ids) - size + 1)):
                found[ids[k:k + size]].add(item)
        self.sigma = len(self.vocabulary) + 2
        self.pairs = np.array(sorted(a * self.sigma + b for a, b in pairs) or [0], np.int64)
        self.shortest = min(map(len, found), default=1)
        # per window length: the windows' symbols, and the items of each window
        self.windows = {n: [w for w in found if len(w) == n] for n in {len(w) for w in found}}
        self.items = {n: [found[w] for w in rows] for n, rows in self.windows.items()}

    def stretches(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word positions) of the stretches that can hold a window."""
        ids = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        if not ids.any():
            return ids[:0], ids[:0]
        key = ids[:-1] * self.sigma + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        linked = (self.pairs[at] == key) & (ids[:-1] > 0) & (ids[1:] > 0)
        edges = np.flatnonzero(~linked) + 1
        first, last = np.concatenate([[0], edges]), np.concatenate([edges, [len(ids)]])
        keep = (last - first >= self.shortest) & (ids[first] > 0)
        first, n = first[keep], (last - first)[keep]
        if not len(n):
            return ids[:0], ids[:0]
        ends = np.cumsum(n)
        at = np.repeat(first - (ends - n), n) + np.arange(ends[-1])
        # a separator behind each stretch
        return np.insert(ids[at], ends, 1), np.insert(at, ends, -1)

    def occurrences(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, int, set[str]]]:
        """(text positions, window length, items) of each window found."""
        index = FmIndex(symbols, self.sigma)
        for n, rows in self.windows.items():
            lo, hi = index.search(np.array(rows, np.int64).reshape(len(rows), n))
            found = np.flatnonzero(hi > lo)
            size = hi[found] - lo[found]
            ends = np.cumsum(size)
            at = index.locate(np.repeat(lo[found] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0))
            for k, start, end in zip(found, ends - size, ends):
                yield at[start:end], n, self.items[n][k]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> list[Broadcast]:
    """The benchmark's windows as broadcast blocks of bounded size."""
    sc, out, held, words = benchmark.sparkSession.sparkContext, [], [], 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col))
    for item, text in rows.toLocalIterator():
        own = words_of((text or "").encode())
        if own:
            held.append((item, own))
            words += len(own)
        if words >= BLOCK_WORDS:
            out.append(sc.broadcast(Block(held, size)))
            held, words = [], 0
    return [*out, sc.broadcast(Block(held, size))] if held else out


# ---------------------------------------------------------------- documents
class Found:
    """What was found in one document."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.n_words = 0
        self.hit: np.ndarray | None = None
        self.items: set[str] = set()

    @property
    def n_hit(self) -> int:
        return 0 if self.hit is None else int(self.hit.sum())

    def byte_spans(self) -> list[tuple[int, int]]:
        """Merged removal spans: stretches of neighbouring hit words."""
        if self.hit is None:
            return []
        at = [m.span() for m in _WORD.finditer(self.raw.translate(_FOLD))]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], self.hit.view(np.int8), [0]])))
        return [(at[a][0], at[b - 1][1]) for a, b in zip(edges[::2], edges[1::2])]

    def spans(self) -> list[tuple[int, int]]:
        """The same in code points."""
        return [(len(self.raw[:a].decode()), len(self.raw[:b].decode())) for a, b in self.byte_spans()]

    def cleaned(self) -> str:
        """The text with each span replaced by a line feed."""
        out, end = [], 0
        for a, b in self.byte_spans():
            out.append(self.raw[end:a])
            end = b
        return b"\n".join([*out, self.raw[end:]]).decode()


def search(raws: list[bytes], blocks: list[Block]) -> list[Found]:
    """Search all windows of the blocks in these documents, shard by shard."""
    out = [Found(x) for x in raws]
    split = [words_of(x) for x in raws]
    for found, words in zip(out, split):
        found.n_words = len(words)
    for block in blocks:
        shard: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0
        for d, words in enumerate(split):
            symbols, at = block.stretches(words)
            if len(symbols):
                shard.append((d, symbols, at))
                held += len(symbols)
            if held >= SHARD_SYMBOLS:
                _search_shard(out, shard, block)
                shard, held = [], 0
        if shard:
            _search_shard(out, shard, block)
    return out


def _search_shard(out: list[Found], shard: list[tuple[int, np.ndarray, np.ndarray]], block: Block) -> None:
    symbols = np.concatenate([s for _, s, _ in shard])
    word = np.concatenate([at for _, _, at in shard])
    doc = np.repeat([d for d, _, _ in shard], [len(s) for _, s, _ in shard])
    for at, n, items in block.occurrences(symbols):
        for d in np.unique(doc[at]).tolist():
            found = out[d]
            found.items |= items
            if found.hit is None:
                found.hit = np.zeros(found.n_words, bool)
        for d, w in zip(doc[at].tolist(), word[at].tolist()):
            out[d].hit[w:w + n] = True


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, items (ids of the items with
    an occurring window, as sorted strings) and spans (code points, end
    exclusive) of what a removal takes out."""
    blocks = blocks_of(benchmark, item_col, item_text_col, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = search(raw_texts(batch, "text"), [b.value for b in blocks])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f.n_words for f in found], pa.int64()), pa.array([f.n_hit for f in found], pa.int64()),
                 pa.array([sorted(f.items) for f in found], pa.list_(pa.string())),
                 pa.array([[{"start": a, "end": b} for a, b in f.spans()] for f in found], spans_type)],
                names=["doc_id", "n_words", "n_hit", "items", "spans"])

    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    df = id_and_text(docs, id_col, text_col)
    return df.mapInArrow(run, f"doc_id {dict(df.dtypes)['doc_id']}, n_words long, n_hit long, items array<string>, "
                              "spans array<struct<start: long, end: long>>")


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) with the removal spans taken out of the texts.
    A cleaned text is searched again, as its neighbouring parts may form a
    window anew, until it holds none; texts without a hit stay as they are."""
    blocks = blocks_of(benchmark, item_col, item_text_col, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            todo = list(range(len(texts)))
            while todo:
                found = search([(texts[k] or "").encode() for k in todo], [b.value for b in blocks])
                hits = [(k, f) for k, f in zip(todo, found) if f.n_hit]
                for k, f in hits:
                    texts[k] = f.cleaned()
                todo = [k for k, _ in hits]
            place = batch.schema.get_field_index(text_col)
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
