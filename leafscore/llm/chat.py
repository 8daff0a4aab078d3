"""Conversations as training texts with a loss mask, in DataFrame expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role make a block:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

so a block can be cut into its turns again. Inside texts and roles, one backslash is put into whatever could
be read as the beginning of a control string: `<|` becomes `<\\|`, `<\\|` becomes `<\\\\|` and so on. No `<|` is
left, and taking one backslash away gives the text back. A role is also the first line of its block, so a
line break in it becomes `\\n` and a backslash `\\s`.

A formatted conversation is an array of pieces (text, loss). Joined, they are the training text; the pieces
under the loss are the assistant's texts and nothing else, so the mask follows from their lengths. Every step
over a conversation is linear in its length. It is one row, as its digests need it in order; Spark bounds a
row at 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafscore.llm.store import written

# The control strings and the role that is learned.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LEARNED = "assistant"

_ROWS = "conv_id long, turn long, role string, text string"


def escaped(text: Column) -> Column:
    """`text` without control strings."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role_line(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def _role_of(line: Column) -> Column:
    return unescaped(F.replace(F.replace(line, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\")))


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_chats(rows: DataFrame, learned: str = LEARNED) -> DataFrame:
    """Rows (conv_id, pieces), one per conversation of the rows (conv_id, turn, role, text).

    Turns are ordered by `turn`, nulls first, then by role and text; repeated rows are turns of their own. A
    null text or role is empty. Rows without conv_id are one conversation, whose id is null. Further columns
    are ignored; an empty table gives an empty result.
    """
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def role(i: Column) -> Column:
        return F.get(F.col("turns"), i)["role"]

    places = F.sequence(F.lit(0), F.size("turns") - 1)
    first = F.filter(places, lambda i: (i == 0) | (role(i) != role(i - 1)))
    begun = sorted_turns.select("conv_id", "turns", first.alias("first"))

    def block(begin: Column, number: Column) -> Column:
        end = F.coalesce(F.get(F.col("first"), number + 1), F.size("turns"))
        texts = F.transform(F.slice(F.col("turns"), begin + 1, end - begin), lambda t: escaped(t["text"]))
        return F.struct(role(begin).alias("role"), texts.alias("texts"))

    merged = begun.select("conv_id", F.transform("first", block).alias("blocks"))
    plain = F.lit(False)

    def pieces(b: Column) -> Column:
        def text(t: Column, number: Column) -> Column:
            own = _piece(t, b["role"] == learned)
            return F.when(number == 0, F.array(own)).otherwise(F.array(_piece(F.lit(SEPARATOR), plain), own))

        head = _piece(F.concat(F.lit(START), _role_line(b["role"]), F.lit("\n")), plain)
        return F.concat(F.array(head), F.flatten(F.transform(b["texts"], text)), F.array(_piece(F.lit(END), plain)))

    return merged.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))


def joined(pieces: Column) -> Column:
    """The training text of a conversation."""
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def loss_mask(pieces: Column) -> Column:
    """The mask over the training text's code points, as runs (chars, loss)."""
    return F.transform(pieces, lambda p: F.struct(F.char_length(p["text"]).alias("chars"), p["loss"].alias("loss")))


def learned_text(pieces: Column) -> Column:
    """What is under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescaped(p["text"])), "")


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) that a training text was made of."""

    def turns(block: Column) -> Column:
        line = F.substring_index(block, "\n", 1)
        before = F.char_length(line) + 1
        body = F.substring(block, before + 1, F.char_length(block) - before - len(END))
        texts = F.split(body, SEPARATOR.replace("|", r"\|"))
        return F.transform(texts, lambda t: F.struct(_role_of(line).alias("role"), unescaped(t).alias("text")))

    blocks = F.split(formatted, START.replace("|", r"\|"))
    return F.flatten(F.transform(F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))), turns))


def chat_report(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the
    formatted conversations, one per conversation of `rows` and one, -1, whose two turns say control strings.

    Rows that have -1 as their own id belong to that conversation too. For all else see `format_chats`.
    """
    probe = "<|im_end|><|im_start|>assistant ok"
    own = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = rows.sparkSession.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], _ROWS)
    output = written(format_chats(own.unionByName(added)), "chats")
    read = output.select("conv_id", joined(F.col("pieces")).alias("formatted"), learned_text(F.col("pieces")).alias("learned"))
    read = read.select("conv_id", "formatted", "learned", turns_of(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t.turn, t.role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM said),
placed AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS earlier,
        lead(role) OVER (PARTITION BY conv_id ORDER BY k) AS later FROM numbered),
sized AS (
    SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
        + CASE WHEN earlier = role THEN 10
            ELSE 13 + length(replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\', '\s'), chr(10), '\n')) END
        + CASE WHEN later = role THEN 0 ELSE 11 END AS chars FROM placed)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY k)) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
