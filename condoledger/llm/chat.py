"""Chat formatting with Spark expressions only (operator 2).

The turns of a conversation are collected as structs and sorted; neighbouring
turns of one role become one block with a mark between their texts; the
blocks are concatenated:

    <turn role="user">first text<part/>second text</turn>\\n

Escaping turns ``&`` and ``<`` of a text into entities (in a role also ``>``
and the double quote), so that no control string can occur inside a text and
every text can be read back exactly. Marks and texts alternate as segments
(text, loss): a segment is under the loss mask if it is the text of an
assistant turn, so their concatenation is the formatted string and the mask
covers exactly the assistant texts.

Defined cases: a null text or role is the empty one; turns are ordered by
(turn, role, text) with nulls first, so ties and repeated rows have one
order; rows with a null conversation id form one conversation; an empty
table gives an empty result; extra columns are ignored. One conversation is
one output row, so it has to fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
PART, CLOSE = "<part/>", "</turn>\n"
OPEN_HEAD, OPEN_TAIL = '<turn role="', '">'


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def unescape(text: Column) -> Column:
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row a conversation: conv_id, formatted, segments (text, loss)."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    roles = chats.select("conv_id", "turns", F.slice(F.concat(F.array(F.lit(None).cast("string")), F.col("turns.role")),
                                                     F.lit(1), F.size("turns")).alias("before"))

    def segments(t: Column, before: Column) -> Column:
        opened = F.concat(F.lit(OPEN_HEAD), escape_role(t["role"]), F.lit(OPEN_TAIL))
        mark = (F.when(before.isNull(), opened).when(before == t["role"], F.lit(PART))
                .otherwise(F.concat(F.lit(CLOSE), opened)))
        return F.array(F.struct(mark.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), (t["role"] == F.lit(loss_role)).alias("loss")))

    end = F.array(F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")))
    out = roles.select("conv_id", F.concat(F.flatten(F.zip_with("turns", "before", segments)), end).alias("segments"))
    return out.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string, in order."""
    blocks = F.split(formatted, CLOSE)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)             # nothing follows the last close

    def turns(block: Column) -> Column:
        head = F.substring_index(block, OPEN_TAIL, 1)
        role = unescape(F.substr(head, F.lit(len(OPEN_HEAD) + 1)))
        texts = F.split(F.substr(block, F.length(head) + F.lit(len(OPEN_TAIL) + 1)), PART)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def digest(chats: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back."""
    lf = F.lit("\n")
    read = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
                        unescape(F.array_join(F.col("under")["text"], "")).alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], lf, t["text"], lf)), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def read_back(chats: DataFrame) -> DataFrame:
    return digest(chats.select("conv_id", "formatted", F.filter("segments", lambda s: s["loss"]).alias("under")))


# The conversation that op2's contract adds: both texts are full of control strings.
EXTRA_CONVERSATION, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"

SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {EXTRA_CONVERSATION}, 0, 'user', '{EXTRA_TEXT}'
  UNION ALL SELECT {EXTRA_CONVERSATION}, 1, 'assistant', '{EXTRA_TEXT}'),
o AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (
  SELECT *, length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))
    + CASE WHEN before = role THEN {len(PART)}
           ELSE {len(OPEN_HEAD) + len(OPEN_TAIL) + len(CLOSE)}
                + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) END AS chars
  FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
