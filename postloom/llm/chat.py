"""Chat formatting with DataFrame expressions only.

A conversation becomes one text. Neighbouring turns of one role form a block:

    ### role: text</part>text</turn>\\n

Inside a role or a text the four characters that the marks need are escaped: backslash, number sign, less-than and
colon become a backslash and a letter. The loss mask lists the spans of the trained role's texts in code points.

Defined results: a null text or role is empty, a null turn number comes first; turns with the same number go by role,
then text; repeated rows are turns of their own; rows without a conversation id form one conversation with a null id;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, GAP, PART, END = "### ", ": ", "</part>", "</turn>\n"
#: Pieces whose spans are listed together.
STRETCH = 256
ESCAPES = {"\\": "\\b", "#": "\\h", "<": "\\l", ":": "\\c"}


def escaped(text: Column) -> Column:
    for plain, mark in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    """The backslash is taken back last, so that no backslash of the text is read as a mark."""
    for plain, mark in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, `formatted` text, `loss_mask` (spans of start and length, from 0)."""
    rows = turns.select(
        F.col(conversation).alias(conversation),
        F.struct(
            F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("one"),
    )
    collected = rows.groupBy(conversation).agg(F.sort_array(F.collect_list("one")).alias("turns"))
    all_turns = F.col("turns")

    def piece(t: Column, i: Column) -> Column:
        before, after = F.get(all_turns, i - 1)["role"], F.get(all_turns, i + 1)["role"]
        opens, closes = ~t["role"].eqNullSafe(before), ~t["role"].eqNullSafe(after)
        return F.struct(
            F.when(opens, F.concat(F.lit(HEAD), escaped(t["role"]), F.lit(GAP))).otherwise(F.lit(PART)).alias("head"),
            escaped(t["text"]).alias("body"),
            F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            (t["role"] == F.lit(trained)).alias("loss"),
        )

    pieces = collected.select(conversation, F.transform("turns", piece).alias("pieces"))
    span = "struct<start:bigint,length:bigint>"

    def step(done: Column, p: Column) -> Column:
        size = lambda part: F.char_length(p[part]).cast("long")
        here = F.array(F.struct((done["at"] + size("head")).alias("start"), size("body").alias("length")))
        return F.struct(
            (done["at"] + size("head") + size("body") + size("tail")).alias("at"),
            F.when(p["loss"], F.concat(done["spans"], here)).otherwise(done["spans"]).alias("spans"),
        )

    def nothing(at: Column, kind: str) -> Column:
        return F.struct(at.alias("at"), F.array().cast(kind).alias("spans"))

    def stretch(done: Column, i: Column) -> Column:
        """The spans of some neighbouring pieces, listed apart, so that no list grows with the conversation while it is copied."""
        here = F.slice("pieces", i * STRETCH + 1, F.lit(STRETCH))
        return F.aggregate(here, nothing(done["at"], f"array<{span}>"), step, lambda own: F.struct(
            own["at"].alias("at"), F.concat(done["spans"], F.array(own["spans"])).alias("spans")))

    stretches = F.sequence(F.lit(0), F.floor((F.size("pieces") - 1) / STRETCH).cast("int"))
    spans = F.aggregate(stretches, nothing(F.lit(0).cast("long"), f"array<array<{span}>>"), stretch, lambda done: F.flatten(done["spans"]))
    return pieces.select(
        conversation,
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        spans.alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of role and text."""
    blocks = F.split(formatted, END)  # the last is what follows the last mark: nothing

    def turns_of(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(HEAD) + 1)), GAP, 1)
        texts = F.split(F.substr(block, F.instr(block, GAP) + len(GAP)), PART)
        return F.transform(texts, lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns_of))


def read_loss(formatted: Column, mask: Column) -> Column:
    """The text under the loss mask."""
    return F.array_join(F.transform(mask, lambda s: unescaped(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations."""
    done = format_conversations(turns)
    back = done.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
