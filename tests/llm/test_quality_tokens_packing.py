"""Operators 6, 8 and 10 against brute force, with the edge rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from condoledger.llm import huffman, packing, quality, queries
from condoledger.llm.tokenizing import ChunkTokenizer

from .conftest import EDGE, SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text, end):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(c - 1 for c in Counter(lines).values()),
            len(hit), n < 10 or 100 * len(hit) > 20 * n)


def check_stats(rows, docs):
    got = sorted((r[:7] for r in rows), key=str)
    assert got == sorted(((d[0], *stats(d[1])) for d in docs), key=str)


def test_op6_statistics(spark, documents):
    rows = [tuple(r) for r in queries.op6_quality_rules(spark, SF).collect()]
    check_stats(rows, documents)
    assert all(not r[7] for r in rows if r[6]) and any(not r[7] and not r[6] for r in rows)


def test_quality_edge_rows(edge_docs, empty_docs):
    check_stats([tuple(r) for r in quality.document_stats(edge_docs).collect()], EDGE)
    assert quality.document_stats(empty_docs).count() == 0
    kept = quality.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == 0
    assert quality.keep_good(empty_docs).count() == 0


def test_order_does_not_change_the_verdict(spark, documents):
    docs = spark.createDataFrame([(d[0], d[1]) for d in documents], "doc_id long, text string")
    kept = {r[0] for r in quality.keep_good(docs).select("doc_id").collect()}
    assert kept == {d[0] for d in documents if not any(f(quality.Text(d[1].encode())) for f in quality.RULES.values())}


def test_cheap_selective_rules_come_first(spark):
    docs = spark.createDataFrame([(i, "a " * 500) for i in range(200)], "doc_id long, text string")
    rules = {"slow": lambda t: sum(hash(w) % 3 for w in t.words * 20) < 0, "quick": lambda t: t.raw.startswith(b"a")}
    assert quality.rule_order(docs, "text", rules) == ["quick", "slow"]


def check_token_rows(rows, docs):
    start, want = 0, []
    for doc_id, text, *_ in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = ids_of(text, 2)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == want


def test_op8_round_trip(spark, documents):
    check_token_rows([tuple(r) for r in queries.op8_huffman_token_files(spark, SF).collect()], documents)


def test_token_files_edge_rows(spark, edge_docs, empty_docs, tmp_path):
    path = huffman.write_token_files(edge_docs, f"{tmp_path}/files", f"{tmp_path}/steps")
    rows = huffman.read_token_files(spark, path).collect()
    check_token_rows([(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in rows], EDGE)
    path = huffman.write_token_files(empty_docs, f"{tmp_path}/empty", f"{tmp_path}/steps2")
    assert huffman.read_token_files(spark, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**9), min_size=2, max_size=60), st.integers(6, 12), st.randoms())
def test_huffman_lengths_and_codes(counts, limit, rnd):
    bits = huffman.code_lengths(np.array(counts), limit)
    assert bits.max() <= limit and sum(2.0 ** -b for b in bits) <= 1
    if limit == 12 and max(bits) < 12:                              # unlimited Huffman cost
        import heapq
        heap, cost = list(counts), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert cost == sum(c * b for c, b in zip(counts, bits))
    ids = np.arange(len(counts)) * 7 + 3
    book = huffman.Codebook(ids, bits)
    tokens = np.array([rnd.choice(ids.tolist()) for _ in range(rnd.randint(1, 1500))], np.uint32)
    payload, checkpoints = book.encode(tokens)
    assert (huffman.decode(payload, checkpoints, len(tokens), book.table()) == tokens).all()


def check_pieces(rows, docs):
    pieces, windows = defaultdict(list), defaultdict(list)
    for doc_id, start, length, c, n, seq, offset in rows:
        pieces[doc_id].append((start, length, c, n))
        windows[seq].append((offset, length))
    for at in windows.values():                                     # gapless, no padding but at powers of two
        end = 0
        for offset, length in sorted(at):
            assert offset == end and length > 0
            end += length
        assert end == 2048 or end & (end - 1) == 0 and end < 2048
    want = defaultdict(list)
    for doc_id, text, *_ in docs:
        want[doc_id].append(ids_of(text, 1))
    assert set(want) == set(pieces)
    for doc_id, copies in want.items():
        got = sorted(pieces[doc_id])
        ids = copies[0]
        assert sum(p[1] for p in got) == sum(map(len, copies))
        assert all(p[2] == crc(ids[p[0]:p[0] + p[1]]) and p[3] == len(ids) for p in got)
        starts = Counter()
        for p in got:
            starts[p[0]] += 1
            starts[p[0] + p[1]] -= 1
        assert {k: v for k, v in starts.items() if v} == {0: len(copies), len(ids): -len(copies)}


def test_op10_pieces(spark, documents):
    check_pieces([tuple(r) for r in queries.op10_bm25_packing(spark, SF).collect()], documents)


def test_packing_edge_rows(edge_docs, empty_docs):
    rows = packing.pack(edge_docs).collect()
    check_pieces([(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in rows], EDGE)
    assert packing.pack(empty_docs).count() == 0


def test_neighbours_share_rare_terms():
    rng = np.random.default_rng(1)
    items = [np.concatenate([rng.integers(0, 8, 40), np.full(3, 100 + k // 2)]) for k in range(20)]
    index = packing.Bm25Shard(items)
    for k in range(20):
        unused = np.arange(20) != k
        assert index.neighbours(k, unused)[0] == k ^ 1


def test_related_documents_meet(spark):
    """Documents of a topic lie far apart in the table, yet share their windows."""
    topics = ["violin orchestra concerto", "glacier summit alpine", "enzyme protein molecule", "harbour sailor anchor",
              "orchard harvest tractor", "telescope galaxy planet"]
    rng = np.random.default_rng(5)
    common = "people often say that this time some things are much better than they were before and others are not".split()
    rows = [(k, " ".join([*rng.choice(common, 120), *topics[k % 6].split() * 12])) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    by = defaultdict(list)
    for r in packing.pack(docs).collect():
        by[r.sequence_id].append(r.doc_id % 6)
    same = sum(Counter(x).most_common(1)[0][1] for x in by.values())
    assert same > 0.85 * sum(map(len, by.values()))


def test_end_id_is_no_term_and_all_terms_ask():
    """Tails after whole windows meet by their documents, not by the end id."""
    item = lambda k, n: np.append(np.arange(n, dtype=np.uint32) + 10_000 * k, np.uint32(1))
    docs = [item(1, 2048), item(2, 500), item(3, 600), np.append(item(1, 40)[:-1], np.uint32(1))]
    first = next(s for s in packing.pack_shard(docs, 2048) if s[0][1] == 2048)
    assert [d for d, _, _ in first][:2] == [0, 3]
    index = packing.Bm25Shard([np.append(np.arange(100), 900), np.append(np.arange(200, 230), 900), np.arange(99, 130)])
    assert set(index.neighbours(0, np.array([False, True, True])).tolist()) == {1, 2}


@pytest.mark.parametrize("lengths", [[1], [5], [2048], [2047, 3], [100] * 50, [5000, 1, 1, 700]])
def test_every_token_in_one_sequence(lengths):
    docs = [np.arange(n, dtype=np.uint32) for n in lengths]
    seen = [np.zeros(n, int) for n in lengths]
    for sequence in packing.pack_shard(docs, 2048):
        total = sum(n for _, _, n in sequence)
        assert total == 2048 or total & (total - 1) == 0
        for d, start, n in sequence:
            seen[d][start:start + n] += 1
    assert all((s == 1).all() for s in seen)


def test_slice_tokenizer_equals_the_library():
    """Cuts, cache and joined words give the ids that the library gives for whole texts."""
    encoder = ChunkTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", None, " ", "  a\n\nb ", "<|endoftext|>", "x<|startoftext|>y,", "\u0130stanbul J\u030c, \u01f0,a", "e\u0301, a\u0338=b",
             "don't, I'LL. x,'s 's", "\u00c0\u00c9\u00df\u00d7\u00f7\u00ff, \u03a9a,b", "a" * 5000 + ".", "\u65e5\u672c a,b 12,3 a\tb,c d.e f", "a,\u0301b q're,ve"]
    rng = random.Random(5)
    letters = "aAbZ\u00e9\u00c9\u00df\u00ff'sStTlLdDmMvVeE.,;$#<|> \n\t\u0338\u0301\u0307\u0130J\u03a3\u03c2\u65e51\u0663_`\u00a0\u200d\u00d7"
    for more in ([], ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(2000)], []):
        ids, offsets = encoder.encode(pa.array(texts + more, pa.string()))
        for k, text in enumerate(texts + more):
            assert ids[offsets[k]:offsets[k + 1]].tolist() == TOKENIZER.encode(text or "", add_special_tokens=False).ids, text


def test_each_chunk_of_a_slice_is_looked_up_once():
    class Counted(dict):
        lookups = 0

        def get(self, *args):
            Counted.lookups += 1
            return super().get(*args)

        def __getitem__(self, key):
            Counted.lookups += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Counted.lookups += 1
            return super().__contains__(key)

    encoder = ChunkTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array(["one two, three 44 one", "don't Two 44", None, "four"])
    want = [x.tolist() for x in encoder.encode(texts)]
    encoder.row = Counted(encoder.row)
    assert [x.tolist() for x in encoder.encode(texts)] == want
    assert Counted.lookups == len(encoder.row)


@pytest.mark.parametrize("largest, kind", [(9, np.uint32), (60_000, np.uint32), (4_000_000_000, np.int64)])
def test_document_terms_sort_short_keys(largest, kind, monkeypatch):
    rng = np.random.default_rng(2)
    ids, offsets = rng.integers(0, largest, 500).astype(np.uint32), np.array([0, 0, 120, 121, 300, 500])
    ids[:20] = ids[20:40]
    seen, sort = [], np.sort
    monkeypatch.setattr(packing.np, "sort", lambda x: seen.append(x.dtype) or sort(x))
    got = list(zip(*(x.tolist() for x in packing.document_terms(ids, offsets))))
    want = sorted((d, t, n) for d in range(5) for t, n in Counter(ids[offsets[d]:offsets[d + 1]].tolist()).items())
    assert got == want and seen == [kind]


def test_terms_are_counted_in_every_document(spark):
    """also in those beyond any bounded number of first rows."""
    rows = [(k, "plain" if k < 2400 else "plain violin plain") for k in range(2500)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    df, n = packing.frequencies(packing.coded(docs, 1, None))
    term = {w: ids_of(w, 1)[:-1] for w in ("plain", "violin")}
    assert n == 2501 and [df[t] for t in term["plain"]] == [2500] * len(term["plain"]) and [df[t] for t in term["violin"]] == [100] * len(term["violin"])


def test_strongest_terms_against_one_document_at_a_time():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 2, 3, 50, 400, 0]
    ids, offsets = rng.integers(0, 60, sum(sizes)).astype(np.uint32), np.concatenate([[0], np.cumsum(sizes)])
    df = rng.integers(1, 7, 60)
    got = packing.strongest(ids, offsets, df, 7)
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        term, tf = np.unique(ids[a:b], return_counts=True)
        idf = np.log1p(np.maximum(7 - df + 0.5, 0) / (df + 0.5)) * np.where(df < 2, 1e-3, 1)
        top = term[np.argsort(-(tf * (packing.K1 + 1) / (tf + packing.K1) * idf[term]), kind="stable")[:3]]
        assert got[k].tolist() == [*top, *[-1] * (3 - len(top))]
