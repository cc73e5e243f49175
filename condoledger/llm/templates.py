"""Line dedup by a log-template tree, with DataFrame functions only (operator 1).

The tree has a fixed depth: a line goes down by its token count, then by its
LEADING first tokens, where a token with a digit counts as the variable field
``<*>``; the rest of the line is the leaf's business. Lines of fewer than
MIN_TOKENS tokens stay out of the tree (and in the text): they recur by chance.

* Leaves with fewer than MIN_DOCS lines hold no recurring template and go
  first, by one small aggregation; only the lines of the other leaves are
  stored and looked at again.
* A leaf's template generalises by position: the token that most of its lines
  share there, else ``<*>``. A line belongs to the leaf's template when at
  least 70 % of its positions agree with it; any other line of the leaf is a
  template of its own (its tokens with the variable fields replaced).
* A template recurs if its lines lie in at least MIN_DOCS documents with
  different texts: copies of one document are one document here, so that a
  copied document keeps its lines and stays recognisable as a copy.
* Every line of a recurring template is dropped but the first one (smallest
  document id, then line), so that no text vanishes from the corpus.

Aggregations combine before they shuffle; a leaf or template with a third of
all lines is joined as a skewed join that Spark splits.

Defined cases: null texts stay null and have no lines; an empty text has one
empty line; rows with the same id and text are treated alike; nulls order
first; an empty table gives an empty result; ``drop_recurring`` keeps all
columns of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fingerprint, stored, work_dir

LEADING = 3
MIN_TOKENS = 5
MIN_DOCS = 10
FIELD = "<*>"
# Bounds of every_dropped_line: an exact line of LONG_TOKENS or more recurs from
# LONG_DOCS different texts on, one of fewer than MIN_TOKENS from one text in
# SHORT_SHARE (and MIN_DOCS) on.
LONG_TOKENS = 20
LONG_DOCS = 2
SHORT_SHARE = 100
LEVELS = [MIN_DOCS << 2 * k for k in range(25)]


def _general(line: Column) -> Column:
    """A normal line with its tokens that hold a digit as fields."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(line)


def tree_lines(docs: DataFrame, id_col: str, text_col: str, leading: int, min_tokens: int) -> DataFrame:
    """doc_id, doc (fingerprint of the text), line_no, size, leaf and line (its tokens,
    joined by spaces: smaller to shuffle than an array, their fields not yet
    told) of every line in the tree."""
    lines = docs.select(F.col(id_col).alias("doc_id"), fingerprint(text_col).alias("doc"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    line = F.col("line")
    keys = ["doc_id", "doc", "line_no"]
    lines = lines.select(*keys, F.when(line.contains("\t") | line.contains("\r"), F.translate(line, "\t\r", "  ")).otherwise(line).alias("line"))
    lines = lines.select(*keys, F.trim(F.when(line.contains("  "), F.regexp_replace(line, " {2,}", " ")).otherwise(line)).alias("line"))
    size = F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)
    lines = lines.select(*keys, size.alias("size"), "line").where(F.col("size") >= min_tokens)
    leaf = F.concat_ws(" ", F.col("size").cast("string"), _general(F.substring_index(line, " ", leading)))
    return lines.select(*keys, "size", leaf.alias("leaf"), "line")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leading: int = LEADING,
                  min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, doc and line_no of the lines that go."""
    folder = work_dir(docs.sparkSession, "templates")
    lines = tree_lines(docs, id_col, text_col, leading, min_tokens).drop("size")
    busy = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    lines = stored(lines.join(busy, "leaf").withColumn("line", _general(F.col("line"))), f"{folder}/lines")

    # the leaf's template: at each position the token of most of its lines
    at = lines.select("leaf", "n", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    common = (at.groupBy("leaf", "n", "pos", "token").agg(F.count(F.lit(1)).alias("c"))
              .where(2 * F.col("c") > F.col("n")))
    leaves = common.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("pos", "token"))).alias("template"))

    agree = F.aggregate(F.transform(F.split("line", " "), lambda x, k: F.when(x == F.col("template")[k], 1).otherwise(0)),
                        F.lit(0), lambda a, x: a + x)
    named = lines.join(leaves, "leaf").select(
        "doc_id", "doc", "line_no",
        F.when(10 * agree >= 7 * F.size(F.split("line", " ")), F.concat(F.lit("leaf "), F.col("leaf")))
        .otherwise(F.concat(F.lit("line "), F.col("line"))).alias("name"))
    named = stored(named, f"{folder}/named")
    docs_of = named.groupBy("name", "doc").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    recurring = (docs_of.groupBy("name").agg(F.count(F.lit(1)).alias("n_docs"), F.min("first").alias("first"))
                 .where(F.col("n_docs") >= min_docs).select("name", "first"))
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    return named.join(recurring, "name").where(~first).select("doc_id", "doc", "line_no")


def every_dropped_line(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, doc and line_no of the lines that go when the bound follows the
    line. Equal lines of LONG_TOKENS or more recur from LONG_DOCS different
    texts on, templates of MIN_TOKENS or more from MIN_DOCS on, equal shorter
    lines with a letter from one text in SHORT_SHARE on."""
    folder = work_dir(docs.sparkSession, "templates")
    lines = tree_lines(docs, id_col, text_col, LEADING, 1)
    enough = F.when(F.substring_index("leaf", " ", 1).cast("int") >= LONG_TOKENS, LONG_DOCS).otherwise(MIN_DOCS)
    busy = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough)
    lines = stored(lines.join(busy, "leaf").withColumn("line", _general(F.col("line"))), f"{folder}/lines").where((F.col("size") >= MIN_TOKENS) | F.col("line").rlike("\\p{L}"))
    n_texts = docs.select(fingerprint(text_col).alias("doc")).distinct().count()
    short_docs = max(MIN_DOCS, -(-n_texts // SHORT_SHARE))

    # a line's own name, with the bound of its length, and the name of its template;
    # equal lines share their template, so its first line is the first of its equals
    # too, and no text loses all its lines
    own = F.struct(fingerprint(F.lit("line"), "line").alias("name"),
                   F.when(F.col("size") >= LONG_TOKENS, LONG_DOCS).when(F.col("size") >= MIN_TOKENS, MIN_DOCS)
                   .otherwise(short_docs).alias("bound"))
    template = F.struct(fingerprint(F.lit("template"), "template").alias("name"), F.lit(MIN_DOCS).alias("bound"))
    names = F.when(F.col("template").isNull(), F.array(own)).when(F.col("size") >= LONG_TOKENS, F.array(own, template)).otherwise(F.array(template))
    named = with_template(lines, folder).select("doc_id", "doc", "line_no", F.inline(names))
    named = stored(named, f"{folder}/named")
    docs_of = named.groupBy("name", "bound", "doc").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    recurring = (docs_of.groupBy("name", "bound").agg(F.count(F.lit(1)).alias("n_docs"), F.min("first").alias("first"))
                 .where(F.col("n_docs") >= F.col("bound")).select("name", "first"))
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    return named.join(recurring, "name").where(~first).select("doc_id", "doc", "line_no")


def with_template(lines: DataFrame, folder: str) -> DataFrame:
    """``lines`` with the name of their template, null without one: the leaf's
    majority where 70 % of the positions agree with it, else the line's own
    pattern, so that a leaf holds any number of templates.

    The pattern keeps the tokens that are frequent at their position of the
    leaf and has ``<*>`` elsewhere. What counts as frequent follows the line:
    the highest of LEVELS that 70 % of its positions reach, however many other
    lines share the leaf, and however often a field's value comes again."""
    tree = lines.where((F.col("size") >= MIN_TOKENS) & (F.col("n") >= MIN_DOCS))
    at = tree.select("leaf", "n", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    counts = stored(at.groupBy("leaf", "n", "pos", "token").agg(F.count(F.lit(1)).alias("c"))
                    .where((F.col("c") >= MIN_DOCS) | (2 * F.col("c") > F.col("n"))), f"{folder}/counts")
    leaves = (counts.where(2 * F.col("c") > F.col("n")).groupBy("leaf")
              .agg(F.map_from_entries(F.collect_list(F.struct("pos", "token"))).alias("majority")))
    agree = F.aggregate(F.transform(F.split("line", " "), lambda x, k: F.when(x == F.col("majority")[k], 1).otherwise(0)),
                        F.lit(0), lambda a, x: a + x)
    lines = lines.join(leaves, "leaf", "left").withColumn("agrees", F.coalesce(10 * agree >= 7 * F.col("size"), F.lit(False)))
    lines = stored(lines.drop("majority").withColumn("key", fingerprint("line")), f"{folder}/agrees")

    odd = lines.where(~F.col("agrees") & (F.col("size") >= MIN_TOKENS) & (F.col("n") >= MIN_DOCS)).select("key", "leaf", "line").distinct()
    tokens = odd.select("key", "leaf", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    tokens = tokens.join(counts.select("leaf", "pos", "token", "c"), ["leaf", "pos", "token"], "left")
    whole = tokens.groupBy("key", "leaf").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("c", F.lit(0)).alias("c"), "token"))).alias("t"))
    reached = F.sort_array(F.transform("t", lambda x: x["c"]), asc=False)[F.floor((7 * F.size("t") + 9) / 10).cast("int") - 1]
    level = F.array_max(F.filter(F.array(*map(F.lit, LEVELS)), lambda x: x <= F.col("reached")))
    whole = whole.withColumn("reached", reached).withColumn("level", level).where("level IS NOT NULL")
    pattern = F.array_join(F.transform("t", lambda x: F.when(x["c"] >= F.col("level"), x["token"]).otherwise(FIELD)), " ")
    patterns = whole.select("key", F.concat_ws(" ", F.lit("pattern"), "leaf", pattern).alias("pattern"))
    return (lines.join(patterns, "key", "left")
            .withColumn("template", F.when(F.col("agrees"), F.concat(F.lit("leaf "), F.col("leaf"))).otherwise(F.col("pattern"))))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines_col: str | None = None,
                   every: bool = False, **parameters) -> DataFrame:
    """``docs`` (all columns) without the lines of recurring templates;
    ``lines_col`` names a column to add with the numbers of the dropped lines;
    ``every`` takes those of every_dropped_line."""
    lines = every_dropped_line(docs, id_col, text_col) if every else dropped_lines(docs, id_col, text_col, **parameters)
    gone = (lines.groupBy("doc_id", "doc")
            .agg(F.sort_array(F.collect_set("line_no")).alias("gone")))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("doc.a").alias("__a"), F.col("doc.b").alias("__b"), F.col("gone").alias("__gone"))
    key = fingerprint(docs[text_col])
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (key["a"] == gone["__a"]) & (key["b"] == gone["__b"]), "left")
    kept = F.filter(F.split(docs[text_col], "\n"), lambda x, k: ~F.array_contains(gone["__gone"], k))
    text = F.when(gone["__gone"].isNull(), docs[text_col]).otherwise(F.array_join(kept, "\n"))
    cols = [text.alias(c) if c == text_col else docs[c] for c in docs.columns]
    more = [F.coalesce(gone["__gone"], F.array().cast("array<int>")).alias(lines_col)] if lines_col else []
    return joined.select(*cols, *more)


def digest(docs: DataFrame, every: bool = False) -> DataFrame:
    """doc_id, number of dropped lines, length and hash of the kept text."""
    out = drop_recurring(docs.select("doc_id", "text"), lines_col="gone", every=every)
    return out.select("doc_id", F.size("gone").cast("long").alias("n_dropped"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
  SELECT doc_id, text, CAST(unnest(range(len(string_split(text, chr(10))))) AS INT) AS line_no, unnest(string_split(text, chr(10))) AS line
  FROM documents),
split AS (
  SELECT doc_id, text, line_no, list_transform(list_filter(string_split(translate(line, chr(9) || chr(13), '  '), ' '), lambda x: x <> ''),
         lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS tokens FROM lines),
tree AS (
  SELECT *, concat_ws(' ', len(tokens), array_to_string(tokens[1:{LEADING}], ' ')) AS leaf FROM split WHERE len(tokens) >= {MIN_TOKENS}),
busy AS (SELECT *, count(*) OVER (PARTITION BY leaf) AS n FROM tree QUALIFY n >= {MIN_DOCS}),
pos AS (SELECT leaf, n, unnest(range(1, len(tokens) + 1)) AS p, unnest(tokens) AS token FROM busy),
common AS (SELECT leaf, p, token FROM pos GROUP BY leaf, n, p, token HAVING 2 * count(*) > n),
template AS (SELECT leaf, map(list(p), list(token)) AS t FROM common GROUP BY leaf),
named AS (
  SELECT doc_id, text, line_no,
    CASE WHEN 10 * len(list_filter(range(1, len(tokens) + 1), lambda k: tokens[k] = t[k])) >= 7 * len(tokens)
         THEN 'leaf ' || leaf ELSE 'line ' || array_to_string(tokens, ' ') END AS name
  FROM busy JOIN template USING (leaf)),
recurring AS (
  SELECT name, min({{'d': doc_id, 'l': line_no}}) AS first FROM named GROUP BY name HAVING count(DISTINCT text) >= {MIN_DOCS}),
gone AS (
  SELECT doc_id, text, list(DISTINCT line_no) AS g FROM named JOIN recurring USING (name)
  WHERE NOT (doc_id = first.d AND line_no = first.l) GROUP BY doc_id, text),
kept AS (
  SELECT doc_id, coalesce(len(g), 0) AS n_dropped, CASE WHEN g IS NULL THEN coalesce(d.text, '') ELSE array_to_string(list_transform(
    list_filter(range(len(string_split(d.text, chr(10)))), lambda k: NOT list_contains(g, CAST(k AS INT))),
    lambda k: string_split(d.text, chr(10))[k + 1]), chr(10)) END AS text
  FROM documents d LEFT JOIN gone USING (doc_id, text))
SELECT doc_id, CAST(n_dropped AS BIGINT) AS n_dropped, length(text) AS kept_chars, sha256(text) AS kept_sha256 FROM kept"""
