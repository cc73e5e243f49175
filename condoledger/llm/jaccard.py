"""N-gram Jaccard join by prefix trees (operator 7).

Documents link when the Jaccard similarity of their word-shingle sets reaches
a threshold; the result is each document's component over those links. The
join is exact: no link between different texts is lost, and no cap drops one.

1. One pass makes each document's distinct shingles in a global order (see
   ``shingles.Order``) and keeps its size, a 128-bit fingerprint, the prefix
   that two linked sets must share a shingle of, and a parity sketch (a
   shingle flips one bit, so the sketches of two sets differ in at most as
   many bits as the sets differ in shingles). Equal sets are one class.
2. A token that only one class has in its prefix cannot link it. The others
   form groups of classes; groups with the same members are processed once.
3. In a group, pairs whose sizes or sketches rule a link out are skipped, and
   of the rest only a forest is a candidate: edges that join parts not yet
   connected. A group of many classes is dealt out as pairs of blocks.
4. Candidates are verified on whole sets: the neighbours of a class go into a
   path-compressed prefix tree, which the class's set traverses; partial
   overlaps are shared along common beginnings, and a subtree is left as soon
   as the remaining lengths cannot reach the needed overlap.
5. Links join components (minimum labels with pointer jumping). A second
   forest round and a last round with every pair that is still open between
   different components make sure that nothing is missed.

Hot tokens: shingles that are frequent in all documents (counted in buckets,
so never too low) come last in the order, so a line or passage that a third of all documents share is in no
prefix of a longer document. All steps are keyed by token or class, none by
component; everything stored lies in the shared checkpoint folder.

Defined cases: null, empty and blank texts have no shingle, link with nothing
and are their own component; rows with equal texts are copies, and rows with equal
ids one document that has the links of all its texts; a row without an id is
no component's name and links with nothing; an empty table gives an empty
result; extra columns are ignored; a very long text is one task's slice. Ids
are integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, raw_texts, slices, stored, work_dir
from .shingles import BUCKETS, SHIFTS, Order, buckets, mix, shingles

SIZE = 4                   # words of a shingle
THRESHOLD = 85             # per cent
FREQUENT = 4               # times that a shingle must occur to be frequent, at least,
FREQUENT_SHARE = 1000      # and once in so many documents
COUNT_PARTS = 32           # parts in which the tables of counts are summed up
BLOCK = 4096               # classes of a group that one task compares with as many others


def needed(n: int, threshold: int) -> int:
    """Shingles that a set of n shares with any set it links with, at least."""
    return -(-threshold * n // 100)


# ---------------------------------------------------------------- signatures
def sketch(h: np.ndarray) -> bytes:
    """Parity sketch: a power of two bits, at least 256 and 1.5 times the set's size."""
    bits = max(256, 1 << int(3 * len(h) // 2).bit_length())
    flips = np.bincount((mix(h ^ np.uint64(0x5BF03635)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def folded(rows: list[bytes], size: int) -> np.ndarray:
    """Sketches folded to ``size`` bytes each, as rows of 64-bit words."""
    out = np.empty((len(rows), size), np.uint8)
    for k, row in enumerate(rows):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(row, np.uint8).reshape(-1, size), axis=0)
    return out.view(np.uint64)


def frequent_shingles(docs: DataFrame, size: int) -> Order:
    """The order that knows the frequent shingles of all documents, counted in buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((len(SHIFTS), BUCKETS), np.int64), 0
        for batch in slices(batches, "text"):
            n += batch.num_rows
            for table, at in zip(counts, buckets(shingles(raw_texts(batch, "text"), size)[0])):
                table += np.bincount(at, minlength=BUCKETS)
        if n:
            rows = [np.array([n]), *counts.reshape(COUNT_PARTS, -1)]        # the number of documents, then the counts
            yield pa.RecordBatch.from_pydict({"part": np.arange(len(rows)), "counts": pa.array([r.tobytes() for r in rows], pa.binary())})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int64()), "counts": pa.array([c.tobytes() for c in sums.values()], pa.binary())})

    kind = "part long, counts binary"
    rows = docs.select("text").mapInArrow(count, kind).repartition(COUNT_PARTS, "part").mapInArrow(total, kind).collect()   # a fixed size
    if not rows:
        return Order()
    n, *parts = (np.frombuffer(r.counts, np.int64) for r in sorted(rows, key=lambda r: r.part))
    return Order(np.concatenate(parts).reshape(len(SHIFTS), -1), max(FREQUENT, int(n[0]) // FREQUENT_SHARE))


def signatures(docs: DataFrame, order: Order, size: int, threshold: int) -> DataFrame:
    """doc_id, n, a, b (fingerprint), sketch and prefix of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, offsets = order.sets(raw_texts(batch, "text"), size)
            n = np.diff(offsets)
            prints = prints_of(h, offsets)
            keep = [k - needed(k, threshold) + 1 if k else 0 for k in n.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                 pa.array([sketch(h[a:b]) for a, b in zip(offsets, offsets[1:])], pa.binary()),
                 pa.array([h[a:a + k].view(np.int64) for a, k in zip(offsets, keep)], pa.list_(pa.int64()))],
                names=["doc_id", "n", "a", "b", "sketch", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, a long, b long, sketch binary, prefix array<long>")


# ---------------------------------------------------------------- groups
def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups: stretches of equal ``key`` in sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1].column(key)[0].as_py() != k[0].item():
            yield pa.Table.from_batches(held)
            held = []
        if len(cuts):
            yield pa.Table.from_batches([*held, batch.slice(0, int(cuts[-1]))])
            held = []
            batch = batch.slice(int(cuts[-1]))
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """token, c, m, members: the rows of tokens that at least two classes have,
    with the number of classes and a fingerprint of which they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "token"):
            token, c = t.column("token").to_numpy(), t.column("c").to_numpy()
            first = np.flatnonzero(np.diff(token, prepend=token[0] - 1))
            m = np.diff(np.append(first, len(token)))
            prints = np.add.reduceat(mix(c.view(np.uint64)), first).view(np.int64)
            keep = np.repeat(m > 1, m)
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(c[keep]), pa.array(np.repeat(m, m)[keep]),
                                              pa.array(np.repeat(prints, m)[keep])], names=["token", "c", "m", "members"])

    return (tokens.repartition("token").sortWithinPartitions("token", "c")
            .mapInArrow(run, "token long, c long, m long, members long"))


def _open_pairs(c: np.ndarray, n: np.ndarray, comp: np.ndarray, rows: list[bytes], side: np.ndarray, threshold: int,
                failed: set[tuple[int, int]], forest: bool) -> Iterator[tuple[int, int]]:
    """Pairs of a group that may link and lie in different components; as a
    forest: only those that join parts not connected so far. ``side`` is 0 for
    both sides of the comparison, or 1 and 2 for two blocks."""
    root = {int(x): int(x) for x in np.unique(comp)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    at = np.lexsort((c, n))
    c, n, side = c[at], n[at], side[at]
    comp = comp[at].copy()
    rows = [rows[k] for k in at]
    for i in range(len(c)):
        # larger sets that this one can link with
        end = int(np.searchsorted(n, n[i] * 100 // threshold, side="right"))
        js = np.arange(i + 1, end)
        js = js[(comp[js] != comp[i]) & ((side[js] != side[i]) | (side[i] == 0))]
        while len(js):
            some, js = js[:512], js[512:]
            width = len(rows[i])
            differ = np.bitwise_count(folded([rows[j] for j in some], width) ^ folded([rows[i]], width)).sum(1)
            # |x - y| + |y - x| of linked sets is at most (1 - t) / (1 + t) of the sizes' sum
            some = some[(100 + threshold) * differ <= (100 - threshold) * (n[some] + n[i])]
            for j in some.tolist():
                pair = (int(min(c[i], c[j])), int(max(c[i], c[j])))
                if pair in failed or forest and find(int(comp[j])) == find(int(comp[i])):
                    continue
                yield pair
                if forest:
                    root[max(find(int(comp[i])), find(int(comp[j])))] = min(find(int(comp[i])), find(int(comp[j])))
            if forest and len(js):
                own = find(int(comp[i]))
                js = js[[find(int(x)) != own for x in comp[js]]]


def candidates(groups: DataFrame, failed: DataFrame, threshold: int, forest: bool) -> DataFrame:
    """Open pairs (x, y) of all groups (token, c, comp, n, sketch), and in rows of
    their own the tokens of the groups that have one (a task tells a pair once)."""
    size = groups.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    size = size.where("lo <> hi").select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    bad = failed.groupBy("x").agg(F.collect_list("y").alias("bad")).select(F.col("x").alias("c"), "bad")
    rows = groups.join(size, "token").join(bad, "c", "left").withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = rows.select("token", "c", "comp", "n", "sketch", "bad", "block", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    dealt = dealt.select(F.xxhash64("token", low, high).alias("key"), "token", low.alias("low"), high.alias("high"), "block", "c", "comp", "n", "sketch", "bad")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "key"):
            cols = {k: t.column(k).to_numpy() for k in ("key", "token", "low", "high", "block", "c", "comp", "n")}
            sketches, bad = t.column("sketch").to_pylist(), t.column("bad").to_pylist()
            first = np.flatnonzero(np.diff(cols["key"], prepend=cols["key"][0] - 1))
            found: set[tuple[int, int]] = set()
            still_open: set[int] = set()
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(sketches)]):
                own = {k: v[a:b] for k, v in cols.items()}
                # one hash may hold several (token, low, high); rows of another are told apart by the token
                for token in np.unique(own["token"]):
                    at = np.flatnonzero(own["token"] == token)
                    side = np.where(own["low"][at] == own["high"][at], 0, np.where(own["block"][at] == own["low"][at], 1, 2))
                    fails = {(min(x, y), max(x, y)) for k in at for x in [int(own["c"][k])] for y in bad[a + k] or ()}
                    pairs = set(_open_pairs(own["c"][at], own["n"][at], own["comp"][at], [sketches[a + k] for k in at], side,
                                            threshold, fails, forest))
                    found |= pairs
                    if pairs and forest:
                        still_open.add(int(token))
            rows = [*((None, *pair) for pair in sorted(found)), *((token, None, None) for token in sorted(still_open))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows)], names=["token", "x", "y"])

    return (dealt.repartition("key").sortWithinPartitions("key", "token", "c")
            .mapInArrow(run, "token long, x long, y long"))


# ---------------------------------------------------------------- prefix tree
class PrefixTree:
    """Path-compressed tree over sets given as arrays in one global order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        rank = {h: k for k, h in enumerate(dict.fromkeys(np.concatenate(sets).tolist()))} if sets else {}
        paths = [[rank[h] for h in s.tolist()] for s in sets]
        order = sorted(range(len(sets)), key=paths.__getitem__)
        # node: (depth it starts at, depth it ends at, a set on its path, sets that end here, longest set below, children)
        self.nodes: list[list] = []
        self.root = self._build(order, paths) if sets else -1

    def _build(self, order: list[int], paths: list[list[int]]) -> int:
        self.nodes.append([0, 0, order[0], [], 0, []])
        todo = [(0, order)]
        while todo:
            at, members = todo.pop()
            node = self.nodes[at]
            start = node[0]
            low, high = paths[members[0]], paths[members[-1]]         # sorted: what these share, all share
            end = start
            stop = min(len(low), len(high))
            while end < stop and low[end] == high[end]:
                end += 1
            node[1], node[2], node[4] = end, members[0], max(len(paths[k]) for k in members)
            node[3] = [k for k in members if len(paths[k]) == end]
            rest = [k for k in members if len(paths[k]) > end]
            a = 0
            while a < len(rest):
                b = a
                while b < len(rest) and paths[rest[b]][end] == paths[rest[a]][end]:
                    b += 1
                self.nodes.append([end, end, rest[a], [], 0, []])
                node[5].append(len(self.nodes) - 1)
                todo.append((len(self.nodes) - 1, rest[a:b]))
                a = b
        return 0

    def linked(self, probe: np.ndarray, threshold: int) -> Iterator[int]:
        """Numbers of the sets whose Jaccard similarity with the probe reaches the threshold."""
        if self.root < 0:
            return
        have, nx = np.sort(probe), len(probe)
        todo = [(self.root, 0)]
        while todo:
            at, overlap = todo.pop()
            start, end, of, here, longest, children = self.nodes[at]
            part = self.sets[of][start:end]
            k = np.minimum(np.searchsorted(have, part), nx - 1)
            overlap += int((have[k] == part).sum())
            # the best any set below can still reach; more length helps, so the longest one bounds all
            if (100 + threshold) * (overlap + longest - end) < threshold * (nx + longest):
                continue
            for s in here:
                if (100 + threshold) * overlap >= threshold * (nx + end):
                    yield s
            todo += [(c, overlap) for c in children]


def verify(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """x, y, linked of each candidate pair, on whole sets (c, items)."""
    degree = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / 512).cast("int").alias("salts"))
    dealt = pairs.join(degree, "x").select("x", "y", F.pmod(F.xxhash64("y"), F.col("salts")).cast("int").alias("salt"))
    members = dealt.select("x", "salt", F.col("y").alias("c")).unionAll(dealt.select("x", "salt", F.col("x").alias("c")).distinct())
    rows = members.join(sets, "c").select(F.xxhash64("x", "salt").alias("key"), "x", "c", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(slices(batches, "items"), "key"):
            key, x, c = (t.column(k).to_numpy() for k in ("key", "x", "c"))
            items = [np.frombuffer(v, np.uint64) for v in t.column("items").to_pylist()]
            first = np.flatnonzero(np.diff(key, prepend=key[0] - 1)).tolist()
            out: list[tuple[int, int, bool]] = []
            for a, b in zip(first, [*first[1:], len(key)]):
                for center in np.unique(x[a:b]).tolist():
                    near = [k for k in range(a, b) if x[k] == center and c[k] != center]
                    probe = next(k for k in range(a, b) if x[k] == center and c[k] == center)
                    found = set(PrefixTree([items[k] for k in near]).linked(items[probe], threshold))
                    out += [(center, int(c[k]), i in found) for i, k in enumerate(near)]
            xs, ys, ok = zip(*out)
            yield pa.RecordBatch.from_pydict({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64()), "linked": pa.array(ok, pa.bool_())})

    return rows.repartition("key").sortWithinPartitions("key", "x", "c").mapInArrow(run, "x long, y long, linked boolean")


# ---------------------------------------------------------------- components
def components(links: DataFrame, path: str) -> DataFrame:
    """c, comp: the smallest member of each linked class's component, by
    minimum labels and pointer jumping; each round is a written table."""
    both = stored(links.select("x", "y").unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y"))), f"{path}/both")
    labels = stored(both.groupBy(F.col("x").alias("c")).agg(F.least(F.min("x"), F.min("y")).alias("comp")), f"{path}/0")
    for k in range(1, 200):
        near = (both.join(labels.select(F.col("c").alias("y"), "comp"), "y").groupBy(F.col("x").alias("c"))
                .agg(F.min("comp").alias("near")))
        own = labels.join(near, "c").select("c", F.col("comp").alias("before"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("c").alias("comp"), F.col("comp").alias("further"))
        out = own.join(jump, "comp", "left").select("c", "before", F.least("comp", F.coalesce("further", "comp")).alias("comp"))
        out = stored(out, f"{path}/{k}")
        labels = out.select("c", "comp")
        if out.where("before <> comp").isEmpty():
            return labels
    raise RuntimeError("components did not settle in 200 rounds")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                       threshold: int = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    folder = work_dir(spark, "jaccard")
    df = id_and_text(docs, id_col, text_col)
    df = df.withColumn("doc_id", F.col("doc_id").cast("long"))
    order = spark.sparkContext.broadcast(frequent_shingles(df, size))                       # tables of a fixed size

    with_order: Callable[[], Order] = lambda: order.value
    sig = stored(signatures(df, _Late(with_order), size, threshold), f"{folder}/signatures")
    known = sig.where("doc_id IS NOT NULL AND n > 0")
    # A class is named by its smallest id. Where different texts share that id, the
    # first of their classes has it as its number, the others a hash of their own.
    classes = stored(known.groupBy("a", "b", "n").agg(F.min("doc_id").alias("name")), f"{folder}/named")
    own = classes.groupBy("name").agg(F.min(F.struct("a", "b", "n")).alias("first"))
    number = F.when(F.col("first") == F.struct("a", "b", "n"), F.col("name")).otherwise(F.xxhash64(F.lit("class"), "a", "b", "n"))
    classes = stored(classes.join(own, "name").select("a", "b", "n", "name", number.alias("c")), f"{folder}/classes")
    first = classes.select("a", "b", "n", F.col("name").alias("doc_id"), "c")
    reps = known.join(first, ["doc_id", "a", "b", "n"]).dropDuplicates(["doc_id", "a", "b", "n"]).select("c", "n", "sketch", "prefix")

    shared = stored(shared_tokens(reps.select(F.explode("prefix").alias("token"), "c")), f"{folder}/shared")
    once = shared.groupBy("members", "m").agg(F.min("token").alias("token")).select("token")
    groups = shared.select("token", "c").join(once, "token", "left_semi").join(reps.select("c", "n", "sketch"), "c")
    groups = stored(groups, f"{folder}/groups")

    # different texts under one id are one document
    several = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    of_id = known.join(several, "doc_id", "left_semi").join(classes.select("a", "b", "n", "c"), ["a", "b", "n"])
    same = of_id.join(of_id.groupBy("doc_id").agg(F.min("c").alias("x")), "doc_id").where("c > x").select("x", F.col("c").alias("y")).distinct()
    same = stored(same, f"{folder}/same")
    tested, comp, sets, left = None, None, None, groups
    one_text_an_id = same.isEmpty()
    if not one_text_an_id:
        comp = components(same, f"{folder}/ids")
    for k, forest in enumerate((True, True, False)):
        now = left.withColumn("comp", F.col("c")) if comp is None else (
            left.join(comp, "c", "left").withColumn("comp", F.coalesce("comp", "c")))
        failed = spark.createDataFrame([], "x long, y long") if tested is None else tested.where("NOT linked")
        found = stored(candidates(now, failed, threshold, forest), f"{folder}/open{k}")
        if found.where("x IS NOT NULL").isEmpty():
            break
        # a group in which nothing is open now stays closed
        left = groups.join(found.select("token").where("token IS NOT NULL"), "token", "left_semi")
        pairs = stored(found.select("x", "y").where("x IS NOT NULL").distinct(), f"{folder}/pairs{k}")
        if sets is None:
            wanted = first.join(pairs.select(F.explode(F.array("x", "y")).alias("c")).distinct(), "c", "left_semi")
            texts = whole_sets(df.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi"), _Late(with_order), size)
            if one_text_an_id:                                 # then the id is the class's number
                texts = texts.withColumnRenamed("doc_id", "c")
            else:
                texts = texts.join(wanted, ["doc_id", "a", "b", "n"])
            sets = stored(texts.select("c", "items"), f"{folder}/sets").dropDuplicates(["c"])
        new = stored(verify(pairs, sets, threshold), f"{folder}/tested{k}")
        tested = new if tested is None else tested.unionAll(new)
        links = tested.where("linked").select("x", "y").unionAll(same)
        comp = components(links, f"{folder}/comp{k}")

    named = classes.select("a", "b", "n", F.col("name").alias("c"))
    if comp is not None:
        of = classes.join(comp, "c")
        names = of.groupBy("comp").agg(F.min("name").alias("first")).join(comp, "comp").select("c", "first")
        named = classes.join(names, "c", "left").select("a", "b", "n", F.coalesce("first", "name").alias("c"))
    out = sig.select("doc_id", "n", "a", "b").join(named, ["a", "b", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("c", "doc_id")).alias("component_id"))


class _Late:
    """An order that a task takes from the broadcast when it first needs it."""

    def __init__(self, get: Callable[[], Order]):
        self.get = get

    def sets(self, raws: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        return self.get().sets(raws, size)


def prints_of(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128-bit fingerprint of each set as two 64-bit columns."""
    total = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(np.stack([mix(h), mix(h ^ np.uint64(0xA5A5A5A5))], 1), axis=0, dtype=np.uint64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)


def whole_sets(docs: DataFrame, order: Order | _Late, size: int) -> DataFrame:
    """doc_id, a, b, n and items (the shingles in the global order) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, offsets = order.sets(raw_texts(batch, "text"), size)
            prints = prints_of(h, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(np.diff(offsets).astype(np.int64)),
                                              pa.array([h[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary())],
                                             names=["doc_id", "a", "b", "n", "items"])

    return docs.mapInArrow(run, "doc_id long, a long, b long, n long, items binary")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` (all columns) without the documents that are not the first of
    their component; rows without an id stay."""
    found = jaccard_components(docs, id_col, text_col, size, threshold)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti")
