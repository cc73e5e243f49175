"""Language identification by nearest centroid (operator 9).

A text becomes a TF-IDF vector over hashed letter n-grams of its lower-cased
text (one to three letters; anything else counts as a space), normalised to
length one. Each language has several centroids, found by spherical k-means
on a bounded sample of its labelled texts. A text gets the language of the
centroid with the highest cosine. It is marked as rejected when it lies
farther from that centroid than ``slack`` times the farthest training text
of that centroid.

Fitting learns from the first SAMPLE_PER_LANG different texts of each
language in the order of a hash of the text, all of them where there are
fewer; copies of a text count once. Prediction is one pass over
the whole texts without a shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without any training text every text is ``und``; repeated rows get equal
rows; rows with a null text or label are not learned from; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fingerprint, id_and_text, slices

DIM = 4096                 # hashed n-gram features
SAMPLE_PER_LANG = 200      # training texts a language, at most
CENTROIDS = 4              # a language
ROUNDS = 12                # of k-means
SLACK = 1.5
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts_of(text: str | None) -> np.ndarray | None:
    """Hashed counts of letter n-grams; None without any letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return None
    s = np.concatenate([[32], np.where(letter, code, 32), [32]]).astype(np.uint32)
    s = s[np.concatenate([[True], (s[1:] != 32) | (s[:-1] != 32)])]       # one space between words
    out = np.zeros(DIM, np.int64)
    h = np.zeros(len(s), np.uint32)
    for n in range(3):
        h = (h[:len(s) - n] * np.uint32(0x01000193) ^ s[n:]) * np.uint32(0x85EBCA6B)
        out += np.bincount((h ^ (h >> np.uint32(15))) % np.uint32(DIM), minlength=DIM)
    return out


@dataclass
class Model:
    languages: list[str]       # of each centroid
    centroids: np.ndarray      # rows of length one
    radius: np.ndarray         # distance of the farthest training text
    idf: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = np.sqrt(counts) * self.idf
        return v / max(np.linalg.norm(v), 1e-12)

    def predict(self, text: str | None, slack: float) -> tuple[str, float, bool]:
        counts = counts_of(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        cosine = self.centroids @ self.vector(counts)
        k = int(cosine.argmax())
        return self.languages[k], float(min(1.0, max(0.0, cosine[k]))), bool(1 - cosine[k] > slack * self.radius[k])


def _cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first starts: (centroids, radii)."""
    starts = [x.sum(0)]
    while len(starts) < min(k, len(x)):
        near = np.max([x @ (c / np.linalg.norm(c)) for c in starts], axis=0)
        starts.append(x[near.argmin()])
    c = np.array(starts)
    for _ in range(ROUNDS):
        c = c / np.linalg.norm(c, axis=1, keepdims=True)
        own = (x @ c.T).argmax(1)
        c = np.array([x[own == j].sum(0) for j in range(len(c)) if (own == j).any()])
    c = c / np.linalg.norm(c, axis=1, keepdims=True)
    cosine = x @ c.T
    own = cosine.argmax(1)
    return c, np.array([1 - cosine[own == j, j].min() if (own == j).any() else 0.0 for j in range(len(c))])


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model from rows with a text and a label."""
    rows = training.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.where(F.col("text").rlike("\\p{L}")).withColumn("key", fingerprint("text"))
    # copies of a text are one text; of a language's keys only a share that holds its
    # first SAMPLE_PER_LANG four times over is sorted, so none of them piles up in a task
    keys = rows.select("lang", "key").distinct().withColumn("h", F.pmod("key.a", F.lit(1 << 30)))
    sizes = F.broadcast(keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))       # one row a language
    low = keys.join(sizes, "lang").where(F.col("h") * F.col("n").cast("double") < F.lit(4.0 * SAMPLE_PER_LANG * (1 << 30)))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "key.a", "key.b"))
    picked = low.withColumn("k", order).where(F.col("k") <= SAMPLE_PER_LANG).select("lang", "key")
    texts = rows.join(F.broadcast(picked), ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [counts_of(x) for x in batch.column("text").to_pylist()]
            keep = [k for k, v in enumerate(found) if v is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(keep, pa.int64())), pa.array([found[k].astype("<f4").tobytes() for k in keep], pa.binary())],
                names=["lang", "counts"])

    sample = texts.select("text", "lang").mapInArrow(run, "lang string, counts binary")
    by: dict[str, list[np.ndarray]] = {}
    for lang, counts in sorted(map(tuple, sample.collect())):             # at most SAMPLE_PER_LANG a language
        by.setdefault(lang, []).append(np.frombuffer(counts, "<f4"))
    if not by:
        return Model([], np.zeros((0, DIM)), np.zeros(0), np.zeros(DIM))
    every = np.array([v for x in by.values() for v in x])
    idf = np.log((1 + len(every)) / (1 + (every > 0).sum(0))) + 1
    model = Model([], np.zeros((0, DIM)), np.zeros(0), idf)
    for lang, x in by.items():
        c, radius = _cluster(np.array([model.vector(v) for v in x]), CENTROIDS)
        model.languages += [lang] * len(c)
        model.centroids = np.concatenate([model.centroids, c])
        model.radius = np.concatenate([model.radius, radius])
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """One row a document: doc_id, lang (of the nearest centroid, ``und`` without
    a letter), score (cosine, 0 to 1) and rejected (too far from it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [model.predict(x, slack) for x in batch.column("text").to_pylist()]
            lang, score, rejected = zip(*found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(rejected, pa.bool_())], names=["doc_id", "lang", "score", "rejected"])

    df = id_and_text(docs, id_col, text_col)
    return df.mapInArrow(run, f"doc_id {dict(df.dtypes)['doc_id']}, lang string, score double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """Is this document held out? crc32 of its id as text, modulo 3, is 1
    (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1
