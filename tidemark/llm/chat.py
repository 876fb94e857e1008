r"""Chat formatting with a grammar round trip.

A conversation is rendered as turns ``### Role: text</turn>\n`` and read by a deterministic parser: it cuts the text in
front of every ``### ``, takes a turn up to ``</turn>\n``, its role up to the first ``: ``, and drops the backslash of
every escaped character.  A text may hold what the parser acts on.  So each turn is rendered with the least of ``ESCAPES``
with which the parser returns exactly its role and text: as it is, with its text escaped, with its role escaped too.
Escaping doubles backslashes and breaks each control string by one, so that none is left in the output outside the
template.  The last step always round trips; a turn for which none did would be an error, never a changed text.

Turns are rendered row by row.  A formatted conversation is an array of segments; their texts in order are the formatted
text and ``loss`` marks those a model is trained on, the texts of assistants.  ``parse`` goes by the joined text alone,
and ``read`` compares what it returns with check values of the source turns.

Only built-in functions are used.  A formatted conversation is one row, so Spark's bound of 2 GB for a row holds for
it, as it does for a digest over all of a conversation's turns; conversations are never cut.

Defined cases: null texts and roles are empty; rows go by turn (null first), then role and text, and repeated rows stay;
a null id is a conversation of its own; an empty table gives no conversation; texts of any length and content, other columns
and their names do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, stored

OPEN, AFTER_ROLE, CLOSE, END = "### ", ": ", "</turn>", "\n"
#: Each control string and what stands for it in an escaped text.  Dropping the backslash restores it.
CONTROLS = ((OPEN, "##\\# "), (CLOSE, "<\\/turn>"))
ROLE_CONTROLS = (*CONTROLS, (AFTER_ROLE, ":\\ "))
#: What to escape in role and text; None leaves it as it is.
ESCAPES = ((None, None), (None, CONTROLS), (ROLE_CONTROLS, CONTROLS))
TRAINED = "assistant"

TURN = "struct<role:string,text:string>"


def escape(value: Column, controls: tuple | None) -> Column:
    if controls is None:
        return value
    doubled = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda v, c: F.replace(v, F.lit(c[0]), F.lit(c[1])), controls, doubled)


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def parse(formatted: Column) -> Column:
    """Turns of a formatted text as structs of role and text; a stretch that breaks the grammar is a null turn."""

    def turn(piece: Column) -> Column:
        body = F.substring_index(piece, CLOSE, 1)
        role = F.substring_index(body, AFTER_ROLE, 1)
        text = F.substr(body, F.char_length(role) + len(AFTER_ROLE) + 1)
        whole = F.concat(role, F.lit(AFTER_ROLE), text, F.lit(CLOSE + END)) == piece
        return F.when(whole, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))

    pieces = F.split(formatted, OPEN)
    stray = F.when(pieces[0] != "", F.array(F.lit(None).cast(TURN))).otherwise(F.array().cast(f"array<{TURN}>"))
    return F.concat(stray, F.transform(F.slice(pieces, 2, F.size(pieces)), turn))


def render(role: Column, text: Column) -> Column:
    """Head and body of a turn with the least escaping that the parser undoes, and its number as ``level``."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))

    def tried(level: int) -> Column:
        if level == len(ESCAPES):
            return F.raise_error(F.lit("a turn does not come back as it was"))
        for_role, for_text = ESCAPES[level]
        head = F.concat(F.lit(OPEN), escape(role, for_role), F.lit(AFTER_ROLE))
        made = F.struct(head.alias("head"), escape(text, for_text).alias("body"), F.lit(level).alias("level"))

        def settle(m: Column) -> Column:
            recovered = parse(F.concat(m["head"], m["body"], F.lit(CLOSE + END)))
            return F.when(recovered.eqNullSafe(source), m).otherwise(tried(level + 1))

        return let(made, settle)

    return tried(0)


def format_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, ``segments`` of text and loss, and ``checks`` of the source turns."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    turns = rows.select("conv_id", "turn", role, text).select(
        "conv_id",
        "turn",
        "role",
        render(F.col("role"), F.col("text")).alias("made"),
        F.xxhash64("role", "text").alias("check"),
    )
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "made.body", "made.head", "check"))).alias("turns")
    )

    def segments(turn: Column) -> Column:
        parts = ((turn["head"], F.lit(False)), (turn["body"], turn["role"] == TRAINED), (F.lit(CLOSE + END), F.lit(False)))
        return F.array(*[F.struct(t.alias("text"), loss.alias("loss")) for t, loss in parts])

    return gathered.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        F.transform("turns", lambda t: t["check"]).alias("checks"),
    )


def write(rows: DataFrame) -> DataFrame:
    """Format, write to the shared folder and read the files back."""
    return stored(format_turns(rows), "chat")


def read(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted text, its parsed turns, and the texts under the loss mask; an error if a turn is not the source's."""
    joined = F.concat_ws("", F.transform("segments", lambda s: s["text"]))
    trained = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))

    def checked(text: Column) -> Column:
        def compared(turns: Column) -> Column:
            same = F.transform(turns, lambda t: F.xxhash64(t["role"], t["text"])) == F.col("checks")
            differs = F.raise_error(F.lit("a conversation does not come back as it was"))
            return F.when(same, F.struct(text.alias("formatted"), turns.alias("turns"))).otherwise(differs)

        return let(parse(text), compared)

    found = formatted.select("conv_id", let(joined, checked).alias("found"), trained.alias("trained"))
    return found.select("conv_id", "found.*", "trained")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from what was read back: turns, loss and lengths in code points."""
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.concat_ws("", "trained")
    return read(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", spoken).cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
