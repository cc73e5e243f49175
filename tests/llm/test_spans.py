"""Operators 3, 4, 5 and 9 against brute force, with the edge rows."""

import hashlib
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from condoledger.llm import contamination, langid, pii, queries, suffix

from .conftest import EDGE, SF


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# ---------------------------------------------------------------- operator 3
def brute_repeats(raws, length):
    seen = Counter(r[i:i + length] if length < 50 else hash(r[i:i + length]) for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length] if length < 50 else hash(r[i:i + length])] > 1:
                gone[i:i + length] = True
        spans = int((gone[1:] < gone[:-1]).sum())
        out.append((len(r), int(gone.sum()), spans, sha(bytes(b for b, g in zip(r, gone) if not g))))
    return out


def test_op3_whole_table(spark, documents):
    want = [(d[0], *x) for d, x in zip(documents, brute_repeats([(d[1] or "").encode() for d in documents], 400))]
    got = sorted(tuple(r) for r in queries.op3_suffix_dedup(spark, SF).collect())
    assert got == want and sum(r[2] for r in got) > 0


def span_rows(df, raws_by_id=None):
    return sorted(((r.n_bytes, r.n_removed, len(r.spans), sha(r.kept)) for r in df.collect()))


def test_op3_edge_rows(edge_docs, empty_docs):
    raws = [(d[1] or "").encode() for d in EDGE]
    assert span_rows(suffix.remove_repeats(edge_docs)) == sorted(brute_repeats(raws, 400))
    assert suffix.remove_repeats(empty_docs).count() == 0


def test_op3_does_not_depend_on_how_the_table_is_split_again(spark, documents):
    """Spans found, then the result planned for another number of cores."""
    want = sorted(tuple(r) for r in queries.op3_suffix_dedup(spark, SF).collect())
    conf = "spark.sql.leafNodeDefaultParallelism"
    try:
        spark.conf.set(conf, "7")
        result = queries.op3_suffix_dedup(spark, SF)
        spark.conf.set(conf, "2")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
        assert sorted(tuple(r) for r in result.collect()) == want
    finally:
        spark.conf.unset(conf)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stored_steps_leave_no_shuffle_files(spark, tmp_path):
    """The shuffles of a written step are gone with it; the frame itself can be read and written again."""
    from condoledger.llm.common import CLEANUP, stored

    blocks = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = lambda: {x for x in (str(b) for b in blocks().mkString(",").split(",")) if x.startswith("shuffle_")}
    before, setting = names(), spark.conf.get(CLEANUP)
    docs = spark.range(5000).selectExpr("id % 97 AS k", "id AS v").repartition(7, "k")
    rows = stored(docs, f"{tmp_path}/a")
    for _ in range(30):
        if not names() - before:
            break
        time.sleep(0.1)
    assert not names() - before and spark.conf.get(CLEANUP) == setting
    assert stored(docs, f"{tmp_path}/b").count() == rows.count() == docs.count() == 5000


def test_op3_strings_of_equal_hashes(spark):
    """Thue-Morse strings and their complements have equal polynomial hashes modulo 2^64."""
    word = b"a"
    while len(word) < 2048:
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    flip = word.translate(bytes.maketrans(b"ab", b"ba"))
    h = [suffix.gram_hashes(np.frombuffer(w, np.uint8), 2048)[0] for w in (word, flip)]
    assert h[0] == h[1]
    raws = [b"1" * 60 + word, b"2" * 60 + flip, b"3" * 60 + word]
    docs = spark.createDataFrame([(k, r.decode()) for k, r in enumerate(raws)], "doc_id long, text string").coalesce(1)
    for group_bytes in (4 << 20, 1):
        out = suffix.remove_repeats(docs, length=2048, grams=(2048, 2048), group_bytes=group_bytes)
        assert {r.doc_id: r.n_removed for r in out.collect()} == {0: 2048, 1: 0, 2: 2048}


@pytest.mark.parametrize("sizes", [(1 << 20, 4 << 20), (300, 400), (100, 60), (50, 1)])
def test_op3_large_groups(spark, sizes):
    """Shards and groups of any size give the same spans (splits by longer grams and by window)."""
    rng = np.random.default_rng(5)
    base = bytes(rng.integers(97, 100, 60).tolist())
    raws = []
    for k in range(120):
        raw = bytes(rng.integers(97, 101, int(rng.integers(0, 60))).tolist()) + base[int(rng.integers(0, 30)):] + bytes(rng.integers(97, 101, 30).tolist())
        raws.append(raw if k % 7 else base)
    raws += [b"ab" * 40, b"a" * 90, b"a" * 21, b"", "é".encode() * 30]
    docs = spark.createDataFrame([(k, r.decode()) for k, r in enumerate(raws)], "doc_id long, text string").repartition(3)
    docs = docs.sort("doc_id")
    got = span_rows(suffix.remove_repeats(docs, length=20, grams=(8, 14), shard_bytes=sizes[0], group_bytes=sizes[1]))
    assert got == sorted(brute_repeats(raws, 20))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=4, max_size=40), min_size=1, max_size=8), st.integers(2, 4), st.integers(0, 99))
def test_interval_expansion_gives_the_common_prefixes(parts, length, seed):
    raws = [p.encode() for p in parts]
    weights = np.random.default_rng(seed).integers(1, 3, len(raws))
    seen = Counter()
    for r, w in zip(raws, weights):
        for i in range(len(r) - length + 1):
            seen[r[i:i + length]] += int(w)
    got = suffix.repeated_windows(raws, weights, length)
    assert [g.tolist() for g in got] == [[seen[r[i:i + length]] > 1 for i in range(len(r) - length + 1)] for r in raws]


# ---------------------------------------------------------------- operator 4
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_hits(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc in docs:
        w = words(doc[1])
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out.append((doc[0], len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def test_op4_whole_table(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = sorted(tuple(r) for r in queries.op4_fm_index_decontamination(spark, SF).collect())
    assert got == brute_hits(documents, items) and any(r[5] for r in got)


ITEMS = [(1, "Twin ROW of"), (2, None), (3, ""), (4, "no words here or there but more than ten words in one item"), (4, "twin"), (None, "row of text"),
         (5, "word " * 14), (6, "Ünïcödé ẞ")]
MORE = [(20, "x no words, here or there. but more than ten words in one item; twin row", "en"), (21, "twin row twin row of text text", "en"),
        (22, "no words here or there but MORE than ten words; words here or there but more than ten words in", "de")]


def rows_of(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), sha(",".join(r["items"])), r.n_hit > 0) for r in found.collect()), key=str)


@pytest.mark.parametrize("block", [500_000, 1])
def test_op4_edge_rows_and_blocks(spark, edge_docs, empty_docs, block, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([*EDGE, *MORE], "doc_id long, text string, items string")
    assert rows_of(contamination.scan(docs, items)) == sorted(brute_hits([*EDGE, *MORE], ITEMS), key=str)
    assert contamination.scan(empty_docs, items).count() == 0
    assert {r.n_hit for r in contamination.scan(docs, items.where("false")).collect()} == {0}


def test_op4_removal(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "x y")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Say: alpha, BETA; gamma delta!"), (2, "alpha beta x y gamma delta end"), (3, "clean x z"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in contamination.remove(docs, items).collect()}
    assert got[1] == "Say: \n!" and got[3] == "clean x z" and got[4] is None and words(got[2]) == ["end"]
    span = contamination.scan(docs, items).where("doc_id = 1").first().spans[0]
    assert (span.start, span.end) == (5, 29)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120), st.lists(st.lists(st.integers(1, 4), min_size=3, max_size=3), min_size=1, max_size=10))
def test_fm_index(symbols, patterns):
    s = np.array(symbols)
    index = contamination.FmIndex(s, 5)
    lo, hi = index.search(np.array(patterns))
    for p, a, b in zip(patterns, lo, hi):
        assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(s) - 2) if s[i:i + 3].tolist() == p]


# ---------------------------------------------------------------- operator 5
def luhn(d):
    return sum(sum(divmod(int(x) * (1 + k % 2), 10)) for k, x in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    text = text or ""
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    card, phone = [], []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            card.append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            phone.append(m.span())
    kinds = dict(email=email, ip=ip, card=card, phone=phone)
    return [f"{k}:{a}:{b}" for k, v in kinds.items() for a, b in v], [len(v) for v in kinds.values()]


def test_op5_whole_table(spark, documents):
    got = {r.doc_id: r for r in queries.op5_pii_deobfuscation(spark, SF).collect()}
    assert len(got) == len(documents)
    for doc_id, text, *_ in documents:
        base, counts = brute_pii(text)
        r = got[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == sha(",".join(base))
        assert set(base) <= set(r.spans.split(",") if r.spans else [])
    assert sum(r.n_email + r.n_ip for r in got.values()) > 0


@settings(max_examples=400, deadline=None)
@given(st.text("aZ0159.@+- ()_%é\n", max_size=60))
def test_pii_base_spans(text):
    base, spans = pii.all_spans(text)
    assert [f"{k}:{a}:{b}" for k, a, b in base] == brute_pii(text)[0]
    assert set(base) <= set(spans)


@pytest.mark.parametrize("text, kind, found", [
    ("write to john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("write to john dot doe at mail dot example dot com.", "email", "john dot doe at mail dot example dot com"),
    ("mail jo(at)ex.org", "email", "jo(at)ex.org"),
    ("mаry@exаmple.com!", "email", "mаry@exаmple.com"),
    ("user＠host．com", "email", "user＠host．com"),
    ("us​er@ho​st.com", "email", "us​er@ho​st.com"),
    ("call plus four nine one five one two three four five six seven ok", "phone", "plus four nine one five one two three four five six seven"),
    ("ip １９２.168 dot 0 dot 1 up", "ip", "１９２.168 dot 0 dot 1"),
    ("card four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
])
def test_deobfuscation_maps_back(text, kind, found):
    _, spans = pii.all_spans(text)
    assert (kind, text.index(found), text.index(found) + len(found)) in spans


@pytest.mark.parametrize("text", ["we met at noon. dot the i", "look at this dot", "one two three go", "at example.com we are", "a (dot) b", ""])
def test_clean_texts_have_no_spans(text):
    assert pii.all_spans(text) == ([], [])


def test_pii_linear_on_long_runs():
    for run in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "+" * 100_000, "+1" * 50_000, " " * 200_000, "one " * 30_000,
                "dot " * 30_000, "a dot " * 20_000, "( at " * 20_000, "one" + " " * 100_000 + "two"):
        pii.all_spans(run + " dot")


def test_pii_edge_rows(edge_docs, empty_docs):
    assert pii.find(edge_docs).count() == len(EDGE) and pii.find(empty_docs).count() == 0


# ---------------------------------------------------------------- operator 9
def test_op9_held_out(spark, documents):
    by = {d[0]: d for d in documents}
    rows = queries.op9_nearest_centroid_language(spark, SF).collect()
    assert len(rows) == len(documents)
    right = total = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        if r.held_out:
            total += 1
            right += r.lang_pred == by[r.doc_id][2]
    assert right / total > 0.97


def test_langid_edge_rows(spark, edge_docs, empty_docs):
    model = langid.fit(edge_docs)
    got = langid.identify(edge_docs.withColumn("lang", edge_docs.lang), model).collect()
    for r, d in zip(got, EDGE):
        assert (r.lang == "und") == (not any(c.isalpha() for c in d[1] or ""))
    assert langid.identify(empty_docs, model).count() == 0
    none = langid.fit(empty_docs)
    assert {r.lang for r in langid.identify(edge_docs, none).collect()} == {"und"}


def test_langid_learns_from_different_texts(spark, monkeypatch):
    """Copies count once: a language of few copied texts keeps all of them, one of many texts 200."""
    rows = [(f"copied text number {'abcdefghijklmnopqrst'[k % 20] * 3}", "aa") for k in range(4000)]
    rows += [(f"an other text {'abcdefghij'[k % 10]} {'klmnopqrst'[k // 10 % 10]} {'uvwxyz'[k // 100]}", "bb") for k in range(300)]
    rows += [("bulk of one text", "bb")] * 3000 + [("12 34", "cc"), (None, "dd"), ("sole", "ee")]
    sizes, cluster = [], langid._cluster
    monkeypatch.setattr(langid, "_cluster", lambda x, k: (sizes.append(len(x)), cluster(x, k))[1])
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    assert sizes == [20, langid.SAMPLE_PER_LANG, 1] and sorted(set(model.languages)) == ["aa", "bb", "ee"]


def test_langid_rejects_what_lies_far(spark, documents):
    docs = spark.createDataFrame([(d[0], d[1], d[2]) for d in documents], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, "xqzw kkvj zzxq wvvk qqqz xjxj")], "doc_id long, text string")
    assert langid.identify(odd, model).first().rejected
    assert langid.identify(docs, model).where("rejected").count() < 20
