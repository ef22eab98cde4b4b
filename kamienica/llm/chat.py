"""Chat formatting from event logs; DataFrame functions only.

A log has one row an event: conversation, sequence number, kind, turn, role, text. Kinds:

* `message` opens a turn (or replaces it) with a role and a first piece of text,
* `delta` appends a streamed piece to its turn,
* `edit` replaces the text of its turn,
* `regenerate` empties its turn and withdraws all that was said from there on.

The log is partitioned by conversation and read in sequence. An event counts if no later event withdraws it; the pieces
that are left are joined by turn. Each turn is rendered between control strings, which are made harmless inside texts
in a way that `parse` undoes, and the loss mask holds the byte and character span of every assistant text.

Defined cases: null texts and roles are empty; a null conversation is one conversation; events of equal sequence number
are ordered by turn, kind and text; an event of another kind withdraws nothing and adds nothing; a turn without a
message has an empty role; an empty log gives an empty result; further columns of the log are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
BREAKABLE = r"\\|<(?=/?s>)|\[(?=/?INST\])"  # a backslash, or what begins one of <s> </s> [INST] [/INST]


def escape(text: Column) -> Column:
    r"""Doubles backslashes and puts one behind the first character of every control string."""
    return F.regexp_replace(text, f"({BREAKABLE})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after all events; one exchange by conversation."""
    events = log.select("conv_id", "seq", "kind", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col(c).desc() for c in ("seq", "turn", "kind", "text")]
    later = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same_turn = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    again_from = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later)
    events = (events.withColumn("again_from", again_from)
              .withColumn("withdrawn", F.coalesce(F.col("again_from") <= F.col("turn"), F.lit(False))))
    resets = F.col("kind").isin("message", "edit") & ~F.col("withdrawn")
    events = events.withColumn("replaced", F.coalesce(F.max(resets).over(same_turn), F.lit(False)))
    named = (F.col("kind") == "message") & F.coalesce(F.col("again_from") >= F.col("turn"), F.lit(True))
    role_at = F.max(F.when(named, F.struct("seq", "role")))  # a turn told anew keeps its role
    says = F.when(~F.col("withdrawn") & ~F.col("replaced") & F.col("kind").isin("message", "delta", "edit"),
                  F.struct("seq", "kind", "text"))
    stays = F.max(~F.col("withdrawn") & F.col("kind").isin("message", "delta", "edit", "regenerate"))
    return (events.groupBy("conv_id", "turn")
            .agg(role_at.alias("said_by"), F.sort_array(F.collect_list(says)).alias("pieces"), stays.alias("stays"))
            .where("stays").select("conv_id", "turn", F.coalesce("said_by.role", F.lit("")).alias("role"),
                                   F.array_join(F.col("pieces.text"), "").alias("text")))


def render(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, mask); mask: spans (first, n, first_byte, n_bytes) of what is to be learned, from 0."""
    body = F.col("body")
    rows = (turns.select("conv_id", "turn", F.col("role"), F.concat(F.lit(OPEN), escape(F.col("role")),
                                                                    F.lit(ROLE_END)).alias("head"),
                         escape(F.col("text")).alias("body"))
            .withColumn("segment", F.concat("head", body, F.lit(CLOSE))))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = [F.coalesce(F.sum(size("segment")).over(before), F.lit(0)) + size("head") for size in (F.length, F.octet_length)]
    span = F.struct(start[0].alias("first"), F.length(body).alias("n"), start[1].alias("first_byte"),
                    F.octet_length(body).alias("n_bytes"))
    rows = rows.select("conv_id", "turn", "segment", F.when(F.col("role") == learn, span).alias("span"))
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "segment", "span"))).alias("all"))
            .select("conv_id", F.array_join(F.col("all.segment"), "").alias("formatted"),
                    F.filter(F.col("all.span"), lambda s: s.isNotNull()).alias("mask")))


def parse(formatted: Column) -> Column:
    """The turns (role, text) read back from the rendered text."""
    parts = F.split(formatted, r"<s>\[INST\]")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.struct(
        unescape(F.substring_index(p, ROLE_END, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, ROLE_END, -1), CLOSE, 1)).alias("text")))


def learned(formatted: Column, mask: Column) -> Column:
    """All text under the mask, cut out by bytes so that long conversations take linear time."""
    raw = formatted.cast("binary")
    cut = F.transform(mask, lambda s: F.substring(raw, s.first_byte.cast("int") + 1, s.n_bytes.cast("int")).cast("string"))
    return unescape(F.array_join(cut, ""))


def log_of(messages: DataFrame) -> DataFrame:
    """The event log that streams each message in two pieces. Rows of one turn number become turns of their own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    half = (F.length(text) / 2).cast("int")
    rows = messages.select("conv_id", F.row_number().over(order).alias("turn"), "role", text.alias("text"), half.alias("half"))
    pieces = F.array(F.struct(F.lit(0).alias("part"), F.lit("message").alias("kind"), F.lit("").alias("text")),
                     F.struct(F.lit(1).alias("part"), F.lit("delta").alias("kind"), F.expr("left(text, half)").alias("text")),
                     F.struct(F.lit(2).alias("part"), F.lit("delta").alias("kind"),
                              F.expr("substring(text, half + 1)").alias("text")))
    return (rows.select("conv_id", "turn", "role", F.explode(pieces).alias("e"))
            .select("conv_id", (F.col("turn") * 3 + F.col("e.part")).alias("seq"), "e.kind", "turn", "role", "e.text"))


def digest(rendered: DataFrame) -> DataFrame:
    """What is read back from the rendered text: turns and learned text as digests, and lengths."""
    turns = rendered.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
                            learned(F.col("formatted"), F.col("mask")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))


QUERY_SQL = r"""
WITH rows_ AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS given FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant'),
sized AS (SELECT *, length(role) + length(text) + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]'))
  + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]')) + length('<s>[INST][/INST]</s>') AS n FROM rows_)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, given NULLS FIRST, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, given NULLS FIRST, text), ''))
    AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
