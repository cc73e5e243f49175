"""Removal of repeated byte strings by suffix structures in shards (operator 3).

Every byte that is covered by a string of LENGTH bytes which also starts
anywhere else, in the same document or another one, is removed. Strings are
judged on the input. 64-bit hashes only bring strings together, whose bytes
are then compared; the last step of a huge group compares 128-bit digests.

1. Windows of LENGTH bytes are grouped by their minimum: the smallest hash of
   the shorter strings (grams) inside. Equal windows have equal minima, so
   they meet in one group; neighbouring windows mostly share their minimum,
   so a document gives one segment (a range of windows) for some hundred
   bytes. Minima that only one segment has are dropped before any text moves.
2. The segments of the other minima are dealt out by minimum; equal segments
   are merged before the shuffle and again behind it. All windows of a segment
   that occurs twice are repeated. The different segments of whole groups
   fill shards of bounded size.
3. A shard's Burrows-Wheeler transform is built to the depth of LENGTH, and
   threshold-bounded interval expansion runs on it: breadth-first backward
   extension of the interval of the empty string finds the longest common
   prefixes of neighbouring suffixes in increasing order, and stops at
   LENGTH. The entries that are still open are prefixes of at least LENGTH,
   so each stretch of them is one repeated window with all its places.
4. A group whose different segments exceed GROUP_BYTES (a passage in very many
   documents with other text around it) is split: its segments are cut anew
   by the minima of longer grams, which only equal stretches share; what is
   still too large then is settled window by window with 128-bit digests.

Defined cases: a null text is the empty one; rows that repeat a text or an id
are documents of their own; texts shorter than LENGTH keep all bytes; an
empty table gives an empty result; extra columns are ignored; the memory of a
task grows with the longest single text. The rows are stored once under a
number, so the input may give them in another order or split when read again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, slices, stored, work_dir
from .shingles import _powers, mix

LENGTH = 400               # bytes of a string whose repetition is removed
GRAMS = (160, 300)         # bytes of the grams of the first and the second grouping
SHARD_BYTES = 1 << 20      # a shard is closed once its segments hold so many bytes
GROUP_BYTES = 4 << 20      # different segments of one group that a shard takes, at most


# ---------------------------------------------------------------- grouping by minima
def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at each position where one fits."""
    if len(b) < gram:
        return np.zeros(0, np.uint64)
    up, down = _powers(max(22, int(len(b)).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], dtype=np.uint64)])
    return mix((total[gram:] - total[:-gram]) * down[:len(b) - gram + 1])


def sliding_minimum(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of v[i : i + width] for each i where that fits."""
    n = len(v) - width + 1
    if n <= 0:
        return v[:0]
    rows = np.full(-(-len(v) // width) * width, np.iinfo(v.dtype).max, v.dtype)
    rows[:len(v)] = v
    rows = rows.reshape(-1, width)
    prefix = np.minimum.accumulate(rows, axis=1).ravel()
    suffix = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1:width - 1 + n])


def segments(raws: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(minimum, text number, first window, last window, own) of each segment;
    own: the minimum stands at different places, so that windows of the segment
    may repeat each other."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    first = np.cumsum(sizes) - sizes
    h = gram_hashes(np.frombuffer(b"".join(raws), np.uint8), gram)
    bits = np.uint64(max(1, len(h)).bit_length())
    # the upper bits of a hash with its place below them: the minimum tells where it stands
    placed = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    place = (sliding_minimum(placed, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(raws)), sizes)[:len(place)]
    at = np.flatnonzero(np.arange(len(place)) + length <= (first + sizes)[text])
    low, place, text = h[place[at]].view(np.int64), place[at], text[at]
    if not len(low):
        return low, text, at, at, np.zeros(0, bool)
    cut = np.flatnonzero((low[1:] != low[:-1]) | (text[1:] != text[:-1])) + 1
    start, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(low)]]) - 1
    return (low[start], text[start], at[start] - first[text[start]], at[last] - first[text[start]], place[start] != place[last])


# ---------------------------------------------------------------- one shard
class Shard:
    """Burrows-Wheeler transform of some strings, sorted to a given depth."""

    def __init__(self, parts: list[bytes], depth: int):
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.first = np.cumsum(sizes + 1) - sizes - 1
        s = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.int16) + 1
        self.part = np.repeat(np.arange(len(parts)), sizes + 1)
        self.ends = self.first + sizes
        s[self.ends] = 0                                            # the mark behind each part
        self.n = len(s)
        self.order = self._sorted(s, depth)
        self.bwt = s[self.order - 1]
        by = np.argsort(self.bwt, kind="stable")
        self.places = by                                            # positions by character, ascending
        self.step = np.empty(self.n, np.int64)                      # row of the suffix one longer
        self.step[by] = np.arange(self.n)
        counts = np.bincount(self.bwt, minlength=257)
        self.before = np.cumsum(counts) - counts
        self.letters = np.flatnonzero(counts)

    @staticmethod
    def _sorted(s: np.ndarray, depth: int) -> np.ndarray:
        """Order of the rotations by their first ``depth`` characters at least:
        seven at once, then doubling."""
        n = len(s)
        key = np.zeros(n, np.int64)
        for k in range(7):
            key = (key << 9) | np.roll(s, -k)
        known = 7
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1] - 1) != 0)
            if known >= depth or rank[order[-1]] == n:
                return order
            key = rank * (n + 1) + np.roll(rank, -known)
            known *= 2

    def open_prefixes(self, threshold: int) -> np.ndarray:
        """Whether each row's common prefix with the row before reaches the threshold."""
        known = np.zeros(self.n + 1, bool)
        known[0] = known[self.n] = True
        lo, hi = np.zeros(1, np.int64), np.full(1, self.n)
        for _ in range(threshold):
            lo, hi = self._extend(lo, hi)
            new = ~known[hi]
            lo, hi = lo[new], hi[new]
            known[hi] = True                                        # the common prefix there has this round's length
            if not len(lo):
                break
        return ~known[:self.n]

    def _extend(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of all strings one character longer to the left."""
        width = hi - lo
        one, wide = width == 1, width > 16
        some = ~one & ~wide
        out_lo, out_hi = [self.step[lo[one]]], [self.step[lo[one]] + 1]
        if some.any():                                              # look at each row
            a, w = lo[some], width[some]
            ends = np.cumsum(w)
            rows = np.repeat(a - (ends - w), w) + np.arange(ends[-1])
            of = np.repeat(np.arange(len(a)), w)
            to, letter = self.step[rows], self.bwt[rows]
            at = np.lexsort((to, of))
            to, letter, of = to[at], letter[at], of[at]
            new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (letter[1:] != letter[:-1])]))
            out_lo.append(to[new])
            out_hi.append(to[np.append(new[1:], len(to)) - 1] + 1)
        if wide.any():                                              # count each character
            a, b = lo[wide], hi[wide]
            for c in self.letters:
                at = self.places[self.before[c]:self.before[c] + self._count(c)]
                x, y = np.searchsorted(at, a), np.searchsorted(at, b)
                found = y > x
                out_lo.append(self.before[c] + x[found])
                out_hi.append(self.before[c] + y[found])
        return np.concatenate(out_lo), np.concatenate(out_hi)

    def _count(self, c: int) -> int:
        return int((self.before[c + 1] if c < 256 else self.n) - self.before[c])


def repeated_windows(parts: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For each part, which of its windows occur at least twice in the shard
    (a part counts as often as its weight says)."""
    shard = Shard(parts, length)
    group = np.cumsum(~shard.open_prefixes(length))
    part = shard.part[shard.order]
    total = np.bincount(group, weights[part])
    hit = np.zeros(shard.n, bool)
    hit[shard.order[total[group] >= 2]] = True
    return [hit[a:b - length + 1] for a, b in zip(shard.first, shard.ends)]


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


# ---------------------------------------------------------------- Spark steps
_PLACES = pa.list_(pa.struct([("k", pa.int64()), ("a", pa.int64())]))
_SEGMENT = pa.schema([("low", pa.int64()), ("own", pa.bool_()), ("bytes", pa.binary()), ("places", _PLACES)])
_SEGMENT_DDL = "low long, own boolean, bytes binary, places array<struct<k: long, a: long>>"
_SPAN = pa.schema([("k", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), *_SEGMENT])


def _merged(found: Iterator[tuple[int, bool, bytes, list[tuple[int, int]]]]) -> pa.RecordBatch:
    """Equal segments of a slice as one row with all their places."""
    rows: dict[tuple[int, bool, bytes], list[dict]] = defaultdict(list)
    for low, own, content, places in found:
        rows[low, own, content] += [{"k": k, "a": a} for k, a in places]
    low, own, content = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(own, pa.bool_()), pa.array(content, pa.binary()),
                                       pa.array(list(rows.values()), _PLACES)], schema=_SEGMENT)


def common_minima(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """k, found: the segments (low, own, a, b) of each document whose minimum
    more than one segment has, or which may repeat themselves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            low, text, a, b, own = segments(raw_texts(batch, "text"), length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(own), batch.column("k").take(pa.array(text)), pa.array(a), pa.array(b)],
                                             names=["low", "own", "k", "a", "b"])

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of sorted batches that are their own or whose minimum the row
        before or behind has too; the last row of a batch waits for the next."""
        held, tied = None, False                       # the waiting row, and whether it stays whatever follows
        for batch in batches:
            if not batch.num_rows:
                continue
            low = batch.column("low").to_numpy()
            if held is not None:
                same = held.column("low")[0].as_py() == low[0]
                if same or tied:
                    yield held
            equal = low[1:] == low[:-1]
            keep = np.concatenate([[same if held is not None else False], equal]) | batch.column("own").to_numpy(zero_copy_only=False)
            keep[:-1] |= equal
            yield batch.slice(0, len(low) - 1).filter(pa.array(keep[:-1]))
            held, tied = batch.slice(len(low) - 1), bool(keep[-1])
        if held is not None and tied:
            yield held

    kind = "low long, own boolean, k long, a long, b long"
    rows = docs.mapInArrow(cut, kind).repartition("low").sortWithinPartitions("low").mapInArrow(common, kind)
    return rows.groupBy("k").agg(F.collect_list(F.struct("low", "own", "a", "b")).alias("found"))


def settle(rows: DataFrame, length: int, shard_bytes: int, group_bytes: int) -> DataFrame:
    """Spans (k, lo, hi) of repeated bytes, and the segments of groups that are
    too large for a shard (k is null there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        shard: list[list] = []                          # [bytes, weight, place or None, own]
        held = 0

        def whole(content: bytes, places: list[dict]) -> None:
            out.extend({"k": p["k"], "lo": p["a"], "hi": p["a"] + len(content)} for p in places)

        def flush() -> None:
            nonlocal shard, held
            if shard:
                hits = repeated_windows([s[0] for s in shard], np.array([s[1] for s in shard]), length)
                for (_, _, place, _), flags in zip(shard, hits):
                    if place is not None:
                        out.extend({"k": place["k"], "lo": place["a"] + x, "hi": place["a"] + y - 1 + length} for x, y in ranges(flags))
            shard, held = [], 0

        def close(group: list[list]) -> None:
            nonlocal held
            if len(group) > 1 or group and group[0][2] is not None and group[0][3]:    # else its only segment is settled
                shard.extend(group)
                held += sum(len(s[0]) for s in group)
            if held >= shard_bytes:
                flush()

        group, low, size, large = [], None, 0, False
        for batch in slices(batches, "bytes"):
            for row in batch.to_pylist():
                if row["low"] != low:
                    close(group)
                    group, low, size, large = [], row["low"], 0, False
                content, places = row["bytes"], row["places"]
                if large:
                    out.append(row)
                    continue
                same = group and group[-1][0] == content
                if same or len(places) > 1:             # it occurs at least twice: all its windows are repeated
                    if same and group[-1][2] is not None:
                        places = [*places, group[-1][2]]
                    whole(content, places)
                if same:
                    group[-1][1:3] = [2, None]
                else:
                    group.append([content, min(2, len(places)), places[0] if len(places) == 1 else None, row["own"]])
                    size += len(content)
                if size > group_bytes:
                    # places of segments that are settled already went out; one of them stands for the segment
                    out.extend({"low": low, "own": own, "bytes": c, "places": [p] if p else [{"k": -1, "a": 0}] * 2} for c, _, p, own in group)
                    group, large = [], True
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, _SPAN)
                out.clear()
        close(group)
        flush()
        if out:
            yield pa.RecordBatch.from_pylist(out, _SPAN)

    ordered = rows.withColumn("c", F.xxhash64("bytes")).repartition("low").sortWithinPartitions("low", "c").select("low", "own", "bytes", "places")
    return ordered.mapInArrow(run, f"k long, lo long, hi long, {_SEGMENT_DDL}")


def finer(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The segments of large groups cut anew by the minima of longer grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            raws, places = raw_texts(batch, "bytes"), batch.column("places").to_pylist()
            yield _merged((low, own, raws[t][a:b + length], [(p["k"], p["a"] + a) for p in places[t]])
                          for low, t, a, b, own in zip(*(x.tolist() for x in segments(raws, length, gram))))

    return rows.mapInArrow(run, _SEGMENT_DDL)


def by_window(rows: DataFrame, length: int) -> DataFrame:
    """Spans of what is still too large: windows counted by 128-bit digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            for raw, places in zip(raw_texts(batch, "bytes"), batch.column("places").to_pylist()):
                digests = b"".join(blake2b(raw[i:i + length], digest_size=16).digest() for i in range(len(raw) - length + 1))
                xy = np.frombuffer(digests, np.int64).reshape(-1, 2)
                n = len(xy)
                for p in places:
                    yield pa.RecordBatch.from_arrays([pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy()), pa.array(np.full(n, p["k"])),
                                                      pa.array(p["a"] + np.arange(n))], names=["x", "y", "k", "a"])

    windows = rows.mapInArrow(run, "x long, y long, k long, a long")
    twice = windows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "y")
    return windows.join(twice, ["x", "y"], "left_semi").select("k", F.col("a").alias("lo"), (F.col("a") + length).alias("hi"))


def repeated_spans(docs: DataFrame, folder: str, length: int = LENGTH, grams: tuple[int, ...] = GRAMS,
                   shard_bytes: int = SHARD_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """k, lo, hi: byte spans (they may overlap) to remove from documents (k, text)."""
    found = common_minima(docs, length, grams[0])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raws, ks = raw_texts(batch, "text"), batch.column("k").to_pylist()
            yield _merged((s["low"], s["own"], raw[s["a"]:s["b"] + length], [(k, s["a"])])
                          for raw, k, some in zip(raws, ks, batch.column("found").to_pylist()) for s in some)

    rows = docs.join(found, "k").mapInArrow(cut, _SEGMENT_DDL)
    spans = None
    for level, gram in enumerate([*grams[1:], None]):
        out = stored(settle(rows, length, shard_bytes, group_bytes), f"{folder}/spans{level}")
        done = out.where("k >= 0").select("k", "lo", "hi")
        spans = done if spans is None else spans.unionAll(done)
        large = out.where("k IS NULL").select("low", "own", "bytes", "places")
        if large.isEmpty():
            return spans
        rows = finer(large, length, gram) if gram else large
    return spans.unionAll(stored(by_window(rows, length), f"{folder}/windows").where("k >= 0"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """One row a document: doc_id, n_bytes, spans (maximal removed runs, bytes,
    end exclusive), n_removed and kept (the remaining bytes)."""
    folder = work_dir(docs.sparkSession, "suffix")
    # the key belongs to the stored row: a later read that is split differently has the same one
    keyed = stored(docs.select(F.monotonically_increasing_id().alias("k"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                   f"{folder}/keyed")
    spans = repeated_spans(keyed.select("k", "text"), folder, **parameters)
    gone = spans.groupBy("k").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for raw, found in zip(raw_texts(batch, "text"), batch.column("found").to_pylist()):
                kept, spans, end = [], [], 0
                for s in sorted(found or (), key=lambda s: s["lo"]):
                    if spans and s["lo"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], s["hi"])
                    else:
                        spans.append({"start": s["lo"], "end": s["hi"]})
                for s in spans:
                    kept.append(raw[end:s["start"]])
                    end = s["end"]
                kept.append(raw[end:])
                rows.append((len(raw), spans, sum(s["end"] - s["start"] for s in spans), b"".join(kept)))
            n, spans, removed, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(spans, spans_type),
                                              pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "spans", "n_removed", "kept"])

    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kind = dict(keyed.dtypes)["doc_id"]
    return keyed.join(gone, "k", "left").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, n_removed long, kept binary")
