"""Quality rules as a short-circuit cascade (operator 6).

A rule rejects a text or lets it pass; a text is kept when no rule rejects
it. The verdict does not depend on the order of the rules, only the work
does: each rule's cost (seconds a text) and selectivity (share rejected) are
measured on a small sample, and the rules run in the order of rejections per
second, stopping at the first rejection. Statistics that several rules read
are computed once per text and only when a rule asks for them.

Defined cases: a null or empty text has no words and is rejected by
``few_words``; repeated rows get the same verdict each; an empty table gives
an empty result; extra input columns are ignored by ``document_stats`` and
kept by ``keep_good``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, raw_texts, slices

# Rows of the sample on which cost and selectivity are measured (an upper bound).
SAMPLE_ROWS = 400

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)


class Text:
    """One text and its lazily computed statistics."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()          # exactly the six ASCII white-space characters

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        chars = len(self.raw.decode("utf-8"))
        return chars - sum(self.raw.count(c) for c in SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.raw.count(c) for c in SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a 5-word window that occurs at least twice in the text."""
        n = len(self.words)
        if n <= REPEAT_WINDOW:
            return 0
        ids = np.fromiter(map(hash, self.words), np.int64, n).view(np.uint64)
        m = n - REPEAT_WINDOW + 1
        windows = np.zeros(m, np.uint64)
        for k in range(REPEAT_WINDOW):
            windows = (windows ^ ids[k:k + m]) * _MIX[k]
            windows ^= windows >> np.uint64(29)
        ordered = np.sort(windows)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        hit = np.isin(windows, twice)
        covered = np.zeros(n, bool)
        for k in range(REPEAT_WINDOW):
            covered[k:k + m] |= hit
        return int(covered.sum())

    @cached_property
    def n_upper(self) -> int:
        return sum(self.raw.count(c) for c in range(65, 91))

    @cached_property
    def n_ascii_letters(self) -> int:
        return self.n_upper + sum(self.raw.count(c) for c in range(97, 123))


# name -> does the rule reject this text?
Rule = Callable[[Text], bool]
BASE_RULES: dict[str, Rule] = {
    "few_words": lambda t: t.n_words < 10,
    "repeated_words": lambda t: 100 * t.n_repeat_words > 20 * t.n_words,
}
MORE_RULES: dict[str, Rule] = {
    # symbols: more than a quarter as many as words
    "symbol_heavy": lambda t: 4 * t.n_symbols > t.n_words,
    # shouting: over half of the ASCII letters are capitals
    "upper_case": lambda t: 2 * t.n_upper > t.n_ascii_letters > 0,
    # over half of the lines repeat an earlier one
    "repeated_lines": lambda t: 2 * t.n_dup_lines > len(t.lines),
    # words of over 40 characters on average: no prose
    "long_words": lambda t: t.word_chars > 40 * t.n_words,
}
RULES = BASE_RULES | MORE_RULES


def measure(docs: DataFrame, text_col: str, rules: dict[str, Rule]) -> list[tuple[str, float, float]]:
    """(rule, rejected share, seconds a text) of each rule, each measured alone on
    a sample of at most SAMPLE_ROWS rows that spreads over the whole table."""
    total = docs.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    sample = (docs.select(F.col(text_col).alias("text"))
              .where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)
              .limit(SAMPLE_ROWS))
    names = list(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, out, spent = 0, [0] * len(names), [0.0] * len(names)
        for batch in slices(batches, "text"):
            raws = raw_texts(batch, "text")
            seen += len(raws)
            for k, name in enumerate(names):
                began = time.perf_counter()
                out[k] += sum(rules[name](Text(x)) for x in raws)
                spent[k] += time.perf_counter() - began
        if seen:
            yield pa.RecordBatch.from_pydict({"rule": names, "rejected": out, "spent": spent, "seen": [seen] * len(names)})

    got = (sample.mapInArrow(run, "rule string, rejected long, spent double, seen long")
           .groupBy("rule").agg(F.sum("rejected").alias("r"), F.sum("spent").alias("s"), F.sum("seen").alias("n")).collect())
    return [(x["rule"], x["r"] / x["n"], x["s"] / x["n"]) for x in got]    # one row a rule


def rule_order(docs: DataFrame, text_col: str = "text", rules: dict[str, Rule] | None = None) -> list[str]:
    """Rule names by rejections per second on the sample, best first; a rule
    that rejected nothing there counts as one in twice the sample."""
    rules = RULES if rules is None else rules
    found = {name: (max(share, 0.5 / SAMPLE_ROWS) / max(cost, 1e-9)) for name, share, cost in measure(docs, text_col, rules)}
    return sorted(rules, key=lambda name: (-found.get(name, 0.0), name))


def _first_rejection(t: Text, order: list[str], rules: dict[str, Rule]) -> str | None:
    return next((name for name in order if rules[name](t)), None)


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: the base statistics of the whole text, whether a
    base rule fails, and the cascade's verdict (``kept``, ``rejected_by``).
    The cascade over the other rules runs only where no base rule failed."""
    order = rule_order(docs, text_col, MORE_RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            cols: dict[str, list] = {k: [] for k in STAT_COLUMNS}
            for raw in raw_texts(batch, "text"):
                t = Text(raw)
                for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
                    cols[k].append(getattr(t, k))
                base = next((name for name, rule in BASE_RULES.items() if rule(t)), None)
                by = base or _first_rejection(t, order, MORE_RULES)
                cols["base_failed"].append(base is not None)
                cols["kept"].append(by is None)
                cols["rejected_by"].append(by)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, STAT_COLUMNS[k]) for k, v in cols.items())],
                names=["doc_id", *cols])

    df = id_and_text(docs, id_col, text_col)
    kind = dict(df.dtypes)["doc_id"]
    return df.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                              "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


STAT_COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
                "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "rejected_by": pa.string()}


def keep_good(docs: DataFrame, text_col: str = "text", rules: dict[str, Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) that no rule rejects, by the cascade
    with all rules in measured order."""
    rules = RULES if rules is None else rules
    order = rule_order(docs, text_col, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array([_first_rejection(Text(x), order, rules) is None
                                         for x in raw_texts(batch, text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
