"""Operators 1, 2 and 7 against brute force, with the edge rows."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from condoledger.llm import chat, jaccard, queries, shingles, templates

from .conftest import EDGE, SF

TABLES = ("documents", "conversations", "benchmark")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def oracle(sql, **tables):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, (ddl, rows) in tables.items():
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT NULL LIMIT 0" if False else f"DROP VIEW {name}")
        con.execute(f"CREATE TABLE {name} ({ddl})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({','.join('?' * len(rows[0]))})", rows)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, sorted(cur.fetchall(), key=str)


def same(df, result):
    names, rows = result
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == rows


# ---------------------------------------------------------------- operator 1
def test_op1_oracle(spark):
    out = queries.op1_line_template_dedup(spark, SF)
    same(out, oracle(templates.SQL))
    assert out.agg(F.sum("n_dropped")).first()[0] > 0


def template_docs():
    docs = [(k, f"Unique opening {k} of this very text {k}\nPosted by user {k} on Monday morning\nshort line\n"
                + (f"Visit our shop in {w} for more great offers" if k % 2 else "Every right reserved by the one owner")
                + "\n" + " ".join(f"w{k}x{i}y".replace("0", "a").translate(str.maketrans("123456789", "bcdefghij")) for i in range(8)))
            for k, w in enumerate(["red", "blue", "green", "old"] * 8)]
    return [*docs, (50, None), (51, ""), (52, "Posted by user 1 on Monday morning"), (53, docs[0][1]), (54, docs[0][1]), (54, docs[0][1])]


def test_op1_generalises_fields(spark):
    rows = template_docs()
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, gone int")
    got = templates.drop_recurring(docs).select("doc_id", "text").orderBy("doc_id").collect()
    texts = dict((r[0], r[1]) for r in got)
    assert len(got) == len(rows) and texts[50] is None and texts[51] == "" and texts[52] == ""
    assert "Posted" in texts[0] and "reserved" in texts[0] and "Visit" in texts[1]          # the first ones stay
    assert all("short line" in texts[k] and texts[k].count("\n") == 1 for k in range(2, 32))  # the fields are generalised
    assert all(texts[k].split("\n")[-1] == rows[k][1].split("\n")[-1] for k in range(32))
    result = oracle(templates.SQL, documents=("doc_id BIGINT, text VARCHAR", rows))
    same(templates.digest(docs), result)


def test_op1_edge_rows(edge_docs, empty_docs):
    assert templates.digest(edge_docs).count() == len(EDGE)
    assert templates.drop_recurring(empty_docs).count() == 0
    assert templates.drop_recurring(edge_docs).columns == edge_docs.columns


def words(k, n):
    return " ".join(f"{a}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k % 10]}{'abcdefghij'[i]}" for i in range(n) for a in "xy")


def test_op1_bound_follows_the_length(spark):
    """A long line from two texts on, a short one where it is very frequent, one of
    middle length from ten texts on; copies of a text count once."""
    long, middle, short = words(77, 10), "This middle line has seven tokens", "All rights reserved"
    rows = [(k, f"{words(k, 10)}\n" + "\n".join([long] * (k in (3, 8)) + [middle] * (k < 9) + [short] * (k >= 4) + ["}", "few times"] * (k < 9)))
            for k in range(20)]
    rows += [(30, f"{words(88, 10)}\n{words(89, 10)}")] * 2 + [(31, f"{words(88, 10)}\n{words(89, 10)}"), (32, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in templates.drop_recurring(docs, every=True).collect()}
    assert [k for k in got if long in (got[k] or "")] == [3]
    assert [k for k in sorted(got) if short in (got[k] or "")] == [4]
    assert all(middle in got[k] and "}" in got[k] and "few times" in got[k] for k in range(9))
    assert all(words(k, 10) in got[k] for k in range(20)) and got[30] == got[31] == rows[-2][1] and got[32] is None


@pytest.mark.parametrize("noise, names", [(60, 40), (400, 40), (400, 5)])
def test_op1_several_templates_a_leaf(spark, noise, names):
    """Three templates with fields of letters in one leaf beside other lines with its
    opening; more noise or fields that come again do not hide them."""
    letters = "abcdefghijklmnopqrst"

    def word(k, at):
        return f"w{letters[at]}{letters[k // 20 % 20]}{letters[k % 20]}"

    def line(kind, k):
        a, b = word(k % names, 18), word(k * 7 % names, 19)
        return "see also the " + [f"page of {a} in our list of members near {b}", f"notes that {a} wrote for every last guest from {b}",
                                  f"house {a} where the old town ends at {b} today"][kind]

    rows = [(k, f"{words(k, 10)}\n{line(k % 3, k)}") for k in range(120)]
    rows += [(1000 + k, f"{words(k + 200, 10)}\nsee also the " + " ".join(word(k, i) for i in range(len(line(0, 0).split()) - 3))) for k in range(noise)]
    assert len({len(line(kind, 0).split()) for kind in range(3)}) == 1
    got = {r.doc_id: r.text for r in templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string"), every=True).collect()}
    left = [k for k in range(120) if "see also" in got[k]]
    assert left[:3] == [0, 1, 2] and len(left) == 3
    assert all("see also" in got[1000 + k] for k in range(noise))


def test_op1_every_recurring_line(spark, documents):
    """Whole table: no exact long line is left in two different texts."""
    rows = spark.createDataFrame([d[:2] for d in documents], "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in templates.drop_recurring(rows, every=True).collect()]
    assert len(got) == len(documents)

    def long_lines(rows):
        out = defaultdict(set)
        for _, text in rows:
            for line in (text or "").split("\n"):
                t = ["<*>" if any(c in "0123456789" for c in x) else x for x in line.replace("\t", " ").replace("\r", " ").split(" ") if x]
                if len(t) >= templates.LONG_TOKENS:
                    out[" ".join(t)].add(text)
        return out

    before = long_lines(d[:2] for d in documents)
    of = dict(d[:2] for d in documents)
    source = defaultdict(set)
    for doc_id, text in got:
        for x in long_lines([(doc_id, text)]):
            source[x].add(of[doc_id])
    assert any(len(x) > 1 for x in before.values())
    assert not [x for x in source if len(source[x]) > 1]


# ---------------------------------------------------------------- operator 2
CHATS = [(1, 0, "user", "a"), (1, 1, "user", "b<part/>&lt;"), (1, 2, "assistant", None), (1, 3, "assistant", "</turn>\n<turn role=\"user\">"),
         (1, 4, "system", ""), (2, 0, None, "x"), (2, 0, "", "y"), (2, None, "assistant", "é🙂&"), (None, 5, "us\"er>", "&amp;"), (None, 5, "us\"er>", "&amp;"),
         (3, 7, "assistant", "z" * 50_000)]


def brute_chats(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = sorted(turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def test_op2_oracle_and_brute_force(spark):
    got = queries.op2_chat_formatting(spark, SF)
    same(got, oracle(chat.SQL))
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    rows += [(-7, 0, "user", chat.EXTRA_TEXT), (-7, 1, "assistant", chat.EXTRA_TEXT)]
    assert {r[0]: tuple(r)[1:5] for r in got.collect()} == brute_chats(rows)


def test_op2_edge_rows(spark):
    turns = spark.createDataFrame([(*r, "clash") for r in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    chats = chat.format_chats(turns)
    assert {r[0]: tuple(r)[1:5] for r in chat.read_back(chats).collect()} == brute_chats(CHATS)
    one = chats.where("conv_id = 1").first().formatted
    assert one.startswith('<turn role="user">a<part/>b&lt;part/>&amp;lt;</turn>\n<turn role="assistant"><part/>&lt;/turn>')
    assert chat.format_chats(turns.where("false")).count() == 0
    same(chat.read_back(chats).where("conv_id IS NOT NULL"), oracle(
        f"SELECT * FROM ({chat.SQL}) WHERE conv_id <> -7", conversations=("conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", CHATS)))


# ---------------------------------------------------------------- operator 7
def sets_of(rows, size):
    out = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split() if (text or "").isascii() else bytes(
            c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
        out.append((doc_id, {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()))
    return out


def brute_components(rows, size, threshold):
    sets = sets_of(rows, size)
    have = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            have[x].append(k)
    shared = Counter()
    for ks in have.values():
        for i in ks:
            for j in ks:
                if i < j:
                    shared[i, j] += 1
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, j), n in shared.items():
        if sets[i][0] is not None and sets[j][0] is not None and 100 * n >= threshold * (len(sets[i][1]) + len(sets[j][1]) - n):
            root[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 62)
    for k, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(k)] = min(least[find(k)], doc_id)
    return sorted(((d, len(s), None if d is None else least[find(k)]) for k, (d, s) in enumerate(sets)), key=str)


def got_components(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_op7_whole_table(spark, documents):
    got = got_components(queries.op7_prefix_tree_jaccard(spark, SF))
    assert got == brute_components(documents, 4, 85)
    assert len({r[2] for r in got}) < len(got)


def test_op7_edge_rows(edge_docs, empty_docs):
    assert got_components(jaccard.jaccard_components(edge_docs)) == brute_components(EDGE, 4, 85)
    assert jaccard.jaccard_components(empty_docs).count() == 0


def test_shingles_are_counted_in_every_document(spark):
    """More documents than any sample would read; the frequent phrase is in the last ones alone."""
    rows = [(k, f"a{k} b{k} c{k} d{k} e{k}") for k in range(6000)] + [(6000 + k, f"some words found often x{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = jaccard.frequent_shingles(docs, 4)
    frequent, _, _ = shingles.shingles([b"some words found often"], 4)
    rare, _, _ = shingles.shingles([t.encode() for _, t in rows[:6000]], 4)
    assert (order.key(frequent, np.zeros(1, np.int64)) >> np.uint64(16)).tolist() == [40]
    assert (order.key(rare, np.zeros(len(rare), np.int64)) >> np.uint64(16)).max() == 0


def test_no_order_changes_the_components(spark, documents, monkeypatch):
    """Also not a random one."""
    rows = [(d[0], d[1]) for d in documents[:300]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = got_components(jaccard.jaccard_components(docs))
    counts = np.random.default_rng(3).integers(0, 50, (2, shingles.BUCKETS))
    monkeypatch.setattr(jaccard, "frequent_shingles", lambda docs, size: shingles.Order(counts))
    assert got_components(jaccard.jaccard_components(docs)) == want


def test_op7_different_texts_under_one_id(spark):
    """Each keeps its links, and they are one document."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (9, c), (9, a + " y"), (7, c + " z"), (4, c + " z"), (5, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = got_components(jaccard.jaccard_components(docs))
    assert {(r[0], r[2]) for r in got} == {(d, 5 if d == 5 else 1) for d, _ in rows} and len(got) == len(rows)
    alone = [(1, a), (1, b), (8, c)]
    got = got_components(jaccard.jaccard_components(spark.createDataFrame(alone, "doc_id long, text string")))
    assert [(r[0], r[2]) for r in got] == [(1, 1), (1, 1), (8, 8)]


@pytest.mark.parametrize("block, threshold", [(4096, 85), (8, 85), (16, 60)])
def test_op7_chains_and_clusters(spark, block, threshold, monkeypatch):
    """Chains of borderline links, clusters with random changes, a line that all share."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows, line = [], " ".join(f"common{k}" for k in range(12))
    for cluster in range(6):
        base = [f"c{cluster}w{k}" for k in range(int(rng.integers(30, 120)))]
        for _ in range(int(rng.integers(2, 40))):
            w = list(base)
            for at in rng.integers(0, len(w), int(rng.integers(0, 4))):
                w[at] = f"r{rng.integers(0, 50)}"
            rows.append((len(rows), " ".join(w) + (" " + line if cluster % 2 else "")))
    chain = [f"k{k}" for k in range(80)]
    for step in range(25):
        rows.append((len(rows), " ".join(chain[step * 2:] + [f"t{k}" for k in range(step * 2)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_components(jaccard.jaccard_components(docs, size=4, threshold=threshold)) == brute_components(rows, 4, threshold)
    kept = [r.doc_id for r in jaccard.keep_one(docs, size=4, threshold=threshold).collect()]
    assert sorted(kept) == sorted({r[2] for r in brute_components(rows, 4, threshold)})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=12), st.sets(st.integers(0, 30), min_size=1), st.integers(30, 100))
def test_prefix_tree(sets, probe, threshold):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = sorted(jaccard.PrefixTree(arrays).linked(np.array(sorted(probe), np.uint64), threshold))
    assert got == [k for k, s in enumerate(sets) if 100 * len(s & probe) >= threshold * len(s | probe)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aB \n\té", max_size=40), min_size=1, max_size=6), st.integers(1, 5))
def test_shingle_sets(texts, size):
    h, offsets = shingles.Order().sets([t.encode() for t in texts], size)
    want = [len(s) for _, s in sets_of([(0, t) for t in texts], size)]
    assert np.diff(offsets).tolist() == want
    alone = [shingles.Order().sets([t.encode()], size)[0].tolist() for t in texts]
    assert [h[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == alone


def test_pipeline_stages(spark, documents):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        if name != "packing":
            assert docs.columns == before.columns
        if name == "n-gram Jaccard join":
            rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
            assert sorted(r.doc_id for r in docs.collect()) == sorted({r[2] for r in brute_components(rows, 5, 80)})
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]


def test_op1_normal_lines_and_fields(spark):
    """Tabs, returns, runs of blanks and tokens with digits, against a split by hand; a very long token stays linear."""
    lines = ["", "  ", "a b", "\ta  b\r", "x1 \t y  2z w", "1", "a-1b\u00e9 c\u00a0d  \u0663", "k" * 300_000 + " 7"]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string")
    found = {r.line_no: r for r in templates.tree_lines(docs, "doc_id", "text", 2, 0)
             .withColumn("line", templates._general(F.col("line"))).collect()}
    assert len(found) == len(lines)
    for k, line in enumerate(lines):
        tokens = ["<*>" if re.search("[0-9]", x) else x for x in re.split("[ \t\r]+", line) if x]
        assert (found[k].size, found[k].line) == (len(tokens), " ".join(tokens))
        assert found[k].leaf == " ".join([str(len(tokens)), *tokens[:2]]) + ("" if tokens else " ")
