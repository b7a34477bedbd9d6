"""Chat formatting by prefix-target expansion (DataFrame functions only).

A conversation's turns are rendered once, in order (``formatted``). Then every
assistant turn is expanded into an example of its own (``examples``): a row with
all preceding turns, rendered, as its context, and its reply as the target, the
only part that is trained (``loss_start``, ``loss_end``). So a turn is written
again in every later example of its conversation, as the method asks; a context
is a list of rendered turns, which Parquet's dictionaries store once per file
for as long as they fit. ``example_texts`` joins each example into one string.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles one
backslash is put into every ``<|``, ``<\\|``, ``<\\\\|`` ..., so control strings
never occur there, and taking one away restores the text.

Defined results: null texts and roles count as empty; turns are ordered by
(turn, role, text), nulls first; a null conversation id is a conversation of its
own; repeated rows are turns of their own; without assistant turns a
conversation has no example and an empty mask; turns after the last reply are
in no example; an empty table gives an empty result; texts of any length are
rendered whole; other columns are not read, so their names can't clash. The
last example holds its conversation, so a conversation must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.shared import materialise

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
# characters of a reply's turn before and after the reply
HEAD, TAIL = len(f"{START}{TRAINED_ROLE}\n"), len(f"{END}\n")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    """Roles stand on a line of their own, so line breaks are spelt out too."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    pieces = F.split(unescape(c), r"\\\\")  # at doubled backslashes
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, turns (array of segment, the rendered turn, and trained, in order)."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    spoken = df.select(F.col(conv_col).alias("conv_id"), turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("spoken"))

    def rendered(t: Column) -> Column:
        segment = F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n"))
        return F.struct(segment.alias("segment"), (t["role"] == TRAINED_ROLE).alias("trained"))

    return spoken.select("conv_id", F.transform("spoken", rendered).alias("turns"))


def format_turns(df: DataFrame, **columns) -> DataFrame:
    """The rendered turns, one per row: conv_id, turn_no (from 0), segment, trained."""
    return conversations(df, **columns).select("conv_id", F.posexplode("turns").alias("turn_no", "t")).select("conv_id", "turn_no", "t.segment", "t.trained")


def examples(formatted: DataFrame) -> DataFrame:
    """The expansion, one row per assistant turn.

    conv_id, example (number within the conversation), context (all preceding
    turns, rendered), target (the assistant's turn, rendered), context_turns,
    context_chars, loss_start, loss_end (places in context and target joined),
    reply (what the mask covers, as rendered).
    """
    # places of the assistant turns, from 1
    replies = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["trained"])
    expanded = formatted.select("conv_id", F.col("turns.segment").alias("segments"), F.posexplode(replies).alias("example", "at"))
    context = F.slice("segments", F.lit(1), F.col("at") - 1)
    cut = expanded.select("conv_id", F.col("example").cast("long").alias("example"), context.alias("context"), F.element_at("segments", F.col("at")).alias("target"))
    chars = F.aggregate("context", F.lit(0).cast("long"), lambda n, s: n + F.char_length(s))
    spans = cut.select(
        "*", F.size("context").cast("long").alias("context_turns"), chars.alias("context_chars"), (F.char_length("target") - HEAD - TAIL).alias("chars")
    )
    return spans.select(
        "conv_id",
        "example",
        "context",
        "target",
        "context_turns",
        "context_chars",
        (F.col("context_chars") + HEAD).alias("loss_start"),
        (F.col("context_chars") + HEAD + F.col("chars")).alias("loss_end"),
        F.substr("target", F.lit(HEAD + 1), F.col("chars")).alias("reply"),
    )


def example_texts(formatted: DataFrame) -> DataFrame:
    """Examples as one string each: conv_id, example, text, loss_start, loss_end."""
    text = F.concat(F.array_join("context", ""), "target")
    return examples(formatted).select("conv_id", "example", text.alias("text"), "loss_start", "loss_end")


def parse_turn(segment: Column) -> tuple[Column, Column]:
    """Role and text of a rendered turn."""
    inner = F.substr(segment, F.lit(len(START) + 1), F.char_length(segment) - F.lit(len(START) + TAIL))
    head = F.substring_index(inner, "\n", 1)
    return unescape_role(head), unescape(F.substr(inner, F.char_length(head) + 2))


def parse_turns(formatted: DataFrame) -> DataFrame:
    """Turns read back from the output: conv_id, turn_no, role, text, chars."""
    turns = formatted.select("conv_id", F.posexplode("turns.segment").alias("turn_no", "segment"))
    role, text = parse_turn(F.col("segment"))
    return turns.select("conv_id", "turn_no", role.alias("role"), text.alias("text"), F.char_length("segment").cast("long").alias("chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation as read back from the output: its turns, and what its written examples train.

    A sha256 needs a conversation's text in one piece, so this holds one whole
    conversation at a time.
    """
    # contexts repeat each other, over more than the default codec looks back
    expanded = materialise(examples(formatted).drop("reply"), "chat-examples", compression="zstd")

    def line(segment: Column) -> Column:
        role, text = parse_turn(segment)
        return F.concat(role, F.lit("\n"), text, F.lit("\n"))

    spoken = formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns.segment", line), ""), 256).alias("turns_sha256"),
        F.aggregate("turns.segment", F.lit(0).cast("long"), lambda n, s: n + F.char_length(s)).alias("formatted_chars"),
    )
    # each example trains what its mask covers
    at = (F.col("loss_start") - F.col("context_chars")).cast("int")
    masked = F.substr("target", at + 1, (F.col("loss_end") - F.col("loss_start")).cast("int"))
    trained = expanded.select("conv_id", F.struct("example", unescape(masked).alias("text")).alias("reply"))
    every = spoken.unionByName(trained, allowMissingColumns=True).groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.max("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("reply")).alias("replies"),
    )
    loss = F.array_join("replies.text", "")
    return every.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def formatted(df: DataFrame, **columns) -> DataFrame:
    """Write the rendered conversations and read them back."""
    return materialise(conversations(df, **columns), "chat")


PROBE = f"{END}{START}{TRAINED_ROLE} ok"

ORACLE = rf"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}'
  UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(START) + len(END) + 2} + length(role) + length(text)
           + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM turns
GROUP BY conv_id
"""
