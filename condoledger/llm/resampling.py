"""Target-distribution importance resampling (operator 12).

A 256-byte table lower-cases A-Z and blanks the ASCII separators of a text's
UTF-8 bytes, so that ``bytes.split`` yields its words. A run of words is one
feature; its crc32 comes from the run one word shorter by going on from that
checksum as seed, and modulo ``buckets`` it is the feature's bucket. Counters
add up the buckets of a document, of a task, and (as rows, by Spark) of the
corpus and of the target texts. A bucket's gain is the logarithm of its
smoothed share in the target over that in the corpus, a document's weight the
sum of the gains of its features. With Gumbel noise from a hash of the
document's id on top, the highest scores are a draw without replacement by
importance.

Two passes over the texts, no shuffle of texts: one for the counts (at most
``buckets`` rows a task are shuffled), one for the weights. The gains, one
number a bucket, are all that reaches the driver and the tasks. Ranks come
from a range partitioning by score, not from one task.

Defined cases: a null or empty text has no words, no features and the weight
0; an empty table gives an empty result; empty target texts give gains by the
smoothing alone; a null id is hashed as an empty one and comes last among
ties; repeated rows are documents of their own (equal rows are drawn in either
order); equal scores are ordered by id; extra columns are ignored. Memory of a
task grows with the longest single text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import global_row_number
from .common import id_and_text, raw_texts, slices

BUCKETS = 10_000
SEED = 2024
PER_CENT = 10
MIN_WORDS = 20

# Bytes of words map to themselves, lower-cased; all other ASCII to a blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(TABLE).split()


def features(ws: list[bytes], longest: int) -> Counter:
    """crc32 of each run of 1 to ``longest`` words joined by a space, with its number."""
    sums = [crc32(w) for w in ws]
    out = Counter(sums)
    for n in range(2, longest + 1):
        sums = [crc32(w, crc32(b" ", s)) for s, w in zip(sums, ws[n - 1:])]
        out.update(sums)
    return out


def bucket_counts(docs: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all texts."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for part in slices([batch], "text"):
                for raw in raw_texts(part, "text"):
                    for feature, n in features(words(raw), longest).items():
                        total[feature % buckets] += n
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["bucket", "n"])
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(apply, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket: at most ``buckets`` rows of either side reach the driver."""
    s, t = ({r["bucket"]: r["n"] for r in side.collect()} for side in (corpus, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    return [math.floor(1000 * math.log((t.get(b, 0) + 1) * (all_s + buckets) / ((s.get(b, 0) + 1) * (all_t + buckets))))
            for b in range(buckets)]


def weights(docs: DataFrame, gain: list[int], longest: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of each document."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "text"):
                rows = []
                for raw in raw_texts(part, "text"):
                    ws = words(raw)
                    found = features(ws, longest)
                    rows.append((len(ws), found.total(), sum(n * gain[f % len(gain)] for f, n in found.items())))
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.record_batch([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                                      names=["doc_id", "n_words", "n_features", "weight"])
    d = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(apply, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel variate, floored, from the hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, min_words: int = MIN_WORDS, longest: int = 1,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank; the rank is null where a document is not drawn."""
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets), buckets)
    scored = weights(docs, gain, longest, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # all rows are numbered, those with too few words behind the others
    ordered = (scored.withColumn("short", F.col("n_words") < min_words).withColumn("down", -F.col("score"))
               .withColumn("no_id", F.col("doc_id").isNull()))
    ranked = global_row_number(ordered, ["short", "down", "no_id", "doc_id"], "place")
    n = ranked.where(~F.col("short")).count()
    drawn = ~F.col("short") & (F.col("place") <= per_cent * n // 100)
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))


# crc32 byte by byte over the distinct words, its table made by its rule (the reversed polynomial 0xEDB88320)
SQL = r"""
WITH bit AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc),
w AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
f AS (SELECT word, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM w GROUP BY word),
x AS (SELECT word, s, t, hex(encode(word)) AS h FROM f),
b AS (
  SELECT word, s, t, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i::INT, 2))::BIGINT),
           lambda c, v: xor(c >> 8, crc[(xor(c, v) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM x, bit),
g AS (
  SELECT bucket, floor(1000 * ln(((sum(t) + 1) * (sum(sum(s)) OVER () + 10000))::DOUBLE / ((sum(s) + 1) * (sum(sum(t)) OVER () + 10000))::DOUBLE))::BIGINT AS gain
  FROM b GROUP BY bucket),
d AS (
  SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) WHERE side = 'd' GROUP BY id),
e AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
         + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN d ON id = doc_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM r
"""
