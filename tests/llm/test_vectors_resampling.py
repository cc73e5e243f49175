"""Operators 11, 12 and 13 against brute force, with the edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from condoledger.llm import negatives, queries, resampling, topk, vectors

from .conftest import EDGE, SF

NAN, INF = float("nan"), float("inf")


def taking_part(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def score(a, b, scale):
    return sum(math.floor(scale * x) * math.floor(scale * y) for x, y in zip(a, b))


def place(vec_id):
    return vec_id is None, vec_id or 0


def brute_top(rows, k):
    rows = taking_part(rows)
    out = []
    for i, q in enumerate(rows):
        if q[0] is not None and q[0] % 20 == 0:
            found = sorted(((-score(q[1], c[1], 64), place(c[0]), c[0]) for j, c in enumerate(rows) if j != i))[:k]
            out += [(q[0], n, vec_id, -s) for n, (s, _, vec_id) in enumerate(found, 1)]
    return sorted(out, key=str)


def brute_negatives(rows):
    rows = [r for r in taking_part(rows) if r[2] is not None]
    out = []
    for i, a in enumerate(rows):
        if a[0] is None or a[0] % 100:
            continue
        others = sorted((-score(a[1], c[1], 256), place(c[0]), c[0], c[2]) for j, c in enumerate(rows) if j != i)
        same = [o for o in others if o[3] == a[2]][:5]
        for s, _, positive, _ in same:
            fits = [o for o in others if o[3] != a[2] and -80 * s <= -100 * o[0] <= -100 * s][:5]
            out += [(a[0], positive, n, o[2], -s, -o[0]) for n, o in enumerate(fits, 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edge_vectors(seed=0, n=60):
    """Nulls, non-finite components, ties, repeated rows, several lengths, a null id."""
    rng = np.random.default_rng(seed)
    rows = [(i * 10, [float(x) for x in rng.integers(-2, 3, 5) / 4], int(i % 3)) for i in range(n)]
    rows += rows[:4] + [(0, [0.5, 0.5, 0.5, 0.5, 0.5], 0), (20, None, 1), (40, [NAN, 1.0], 1), (60, [1.0, INF], 2), (80, [None, 1.0], 0),
                        (100, [], 1), (200, [0.25], None), (None, [1.0, 1.0], 1), (None, None, None), (300, [0.75] * 9, 2), (400, [0.0] * 5, 0)]
    return rows


def frame(spark, rows):
    """With extra columns named like outputs and inner columns of the operators."""
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                 "vec_id long, embedding array<double>, label int, score int, row string, rank int")


IS_QUERY, IS_ANCHOR = "vec_id % 20 = 0", "vec_id % 100 = 0"


@pytest.fixture
def small_steps(monkeypatch):
    """Shards, groups and blocks so small that the edge rows cross them."""
    monkeypatch.setattr(vectors, "grid", lambda spark, n: (3, 2))


def test_top_k_edges(spark, small_steps):
    rows = edge_vectors()
    assert got(topk.search(frame(spark, rows), IS_QUERY, 20)) == brute_top(rows, 20)
    assert got(topk.search(frame(spark, rows), IS_QUERY, 500)) == brute_top(rows, 500)
    assert topk.search(frame(spark, rows).where("vec_id = -1"), IS_QUERY).count() == 0
    assert topk.search(frame(spark, [(20, [1.0], 1)]), IS_QUERY).count() == 0


def test_negatives_edges(spark, small_steps):
    for seed in range(2):
        rows = edge_vectors(seed)
        assert got(negatives.mine(frame(spark, rows), IS_ANCHOR)) == brute_negatives(rows)
    assert negatives.mine(frame(spark, rows).where("vec_id = -1"), IS_ANCHOR).count() == 0
    assert negatives.mine(frame(spark, [(100, [1.0], 1), (3, [1.0], 2)]), IS_ANCHOR).count() == 0


def test_scores_near_and_beyond_64_bits(spark, small_steps):
    """Exact up to 64 bits, cut beyond (so 20 and 40 tie); floats of any size."""
    rows = [(0, [3e6, 1e6], 1), (20, [2e6, -1e6], 1), (40, [1e-3, 1e8], 2), (60, [1e7, 1e7], 2)]
    assert got(topk.search(frame(spark, rows), IS_QUERY, 3)) == brute_top(rows, 3)
    rows = [(0, [1.0, 1.0], 1), (20, [1e300, 0.5], 1), (40, [1.7e308, -1e300], 2)]
    assert [r for r in got(topk.search(frame(spark, rows), IS_QUERY, 1)) if r[0] == 0] == [(0, 1, 20, 2 ** 63 - 1)]
    rows = [(100, [3e6, 1e6], 1), (1, [3e6, 1e6], 1), (2, [2.9e6, 1e6], 2), (3, [2.6e6, 1e6], 2), (4, [1.0, 1e6], 2)]
    assert got(negatives.mine(frame(spark, rows), IS_ANCHOR)) == brute_negatives(rows)


def test_one_vector_in_a_third_of_the_rows(spark, small_steps):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.5, 0.25] if i % 3 == 0 else [float(x) for x in rng.normal(size=3)], i % 4) for i in range(600)]
    assert got(topk.search(frame(spark, rows), IS_QUERY, 7)) == brute_top(rows, 7)
    assert got(negatives.mine(frame(spark, rows), IS_ANCHOR)) == brute_negatives(rows)


def test_walk_stops_early_and_finds_the_same(monkeypatch):
    """Tight clusters: a walk over a list of one row a block ends before its end."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 1)
    import pyarrow as pa
    rng = np.random.default_rng(1)
    vecs = np.concatenate([rng.normal(c, 0.02, (40, 4)) for c in np.eye(4)]).tolist()
    batch = pa.record_batch([pa.array(range(160)), pa.array(vecs, pa.list_(pa.float64())), pa.array([i % 2 for i in range(160)]), pa.array(range(160))],
                            names=["vec_id", "vec", "label", "row"])

    class Counted(np.ndarray):
        taken = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and len(key) == 1:
                Counted.taken += 1
            return super().__getitem__(key).view(np.ndarray)

    shard = negatives.Shard([batch], 256)
    shard.values = shard.values.view(Counted)
    asked = batch.slice(0, 5)
    out = list(shard.walk(asked, 5, negatives._any_score))[0].to_pylist()
    assert Counted.taken < 80
    for a in range(5):
        want = sorted((-score(vecs[a], vecs[c], 256), c) for c in range(160) if c != a and c % 2 == a % 2)[:5]
        assert sorted((-r["score"], r["vec_id"]) for r in out if r["anchor"] == a) == want


def test_queries_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(queries.op13_term_at_a_time_top_k(spark, SF)) == brute_top(rows, 20)
    moved = [(i, v, (x + 1) % 10 if i % 7 == 0 else x) for i, v, x in rows]
    assert got(queries.op11_shared_list_negatives(spark, SF)) == brute_negatives(moved)


# ------------------------------------------------------------------ operator 12
def brute_resample(docs, target, longest=1, buckets=10000, per_cent=10, min_words=20):
    def feats(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        grams = [" ".join(ws[i:i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]
        return len(ws), Counter(zlib.crc32(g.encode()) % buckets for g in grams)

    per_doc = [(d[0], *feats(d[1])) for d in docs]
    s, t = sum((f for _, _, f in per_doc), Counter()), sum((feats(x)[1] for x in target), Counter())
    all_s, all_t = s.total(), t.total()
    out = []
    for doc_id, n, f in per_doc:
        w = sum(c * math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b, c in f.items())
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, f.total(), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], place(r[0])))
    for i, r in enumerate(able[:per_cent * len(able) // 100], 1):
        r[4] = i
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_resampling_on_the_table(spark, documents):
    target = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert got(queries.op12_importance_resampling(spark, SF)) == brute_resample(documents, target)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_edges(spark, edge_docs, empty_docs, longest):
    docs = [*((d[0], d[1]) for d in EDGE), *((100 + i, f"word number {i} " * 9) for i in range(30))]
    more = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, weight string, rank int")
    target = ["Word NUMBER one", None, "", "word " * 40]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    assert got(resampling.resample(more, bench, longest=longest, per_cent=50)) == brute_resample(docs, target, longest, per_cent=50)
    assert got(resampling.resample(more, bench.where("n = 2"), longest=longest)) == brute_resample(docs, [], longest)
    assert resampling.resample(empty_docs, bench).count() == 0
    assert got(resampling.resample(edge_docs, bench)) == brute_resample(EDGE, target)
