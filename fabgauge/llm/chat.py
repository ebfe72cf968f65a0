"""Chat formatting with Spark expressions only.

A conversation becomes one text of blocks ``<|im_start|>role\\n...<|im_end|>\\n``. Adjacent turns of one
role share a block, separated by ``<|im_sep|>``. Inside texts and roles a control string gets a backslash
after its first character, one more than it may already have, so that the text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# Control strings that no text may hold as such: those above, and those of other usual templates.
CONTROL = r"(\|im_|/?s>|/?INST\]|</?SYS>>)"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def _role(text: Column) -> Column:
    """A role on one line: a line break is written as ``\\n``, a backslash as two."""
    doubled = F.replace(escape(text), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("\n"), F.lit("\\n"))


def _read_role(text: Column) -> Column:
    # A NUL keeps doubled backslashes apart from the mark of a line break.
    single = F.replace(text, F.lit("\\\\"), F.lit("\0"))
    return unescape(F.replace(F.replace(single, F.lit("\\n"), F.lit("\n")), F.lit("\0"), F.lit("\\")))


def format_conversations(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, and segments with the loss mask.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Turns are sorted by turn,
    then role, then text, nulls first; repeated rows are repeated turns. Null texts and roles are
    empty (NUL characters in roles are dropped); a null conv_id is a conversation of its own; an empty
    table gives no rows. ``segments`` is an array of (text, loss) whose texts joined are
    ``formatted``; the loss covers the escaped texts of ``trained_role`` and nothing else. A
    conversation is one value, so it must fit in one row.
    """
    role = F.replace(F.coalesce("role", F.lit("")), F.lit("\0"), F.lit(""))
    row = F.struct(
        "turn",
        role.alias("role"),
        F.coalesce("text", F.lit("")).alias("raw"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    # Places where the role changes; each block runs from one to the next.
    begins = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    blocks = F.transform(
        "begins",
        lambda at, k: F.slice(
            "turns", at + 1, F.coalesce(F.get("begins", k + 1), F.size("turns")) - at
        ),
    )

    def segments(block: Column) -> Column:
        speaker = block[0]["role"]
        head = F.struct(
            F.concat(F.lit(START), _role(speaker), F.lit("\n")).alias("text"), F.lit(False).alias("loss")
        )
        body = F.flatten(
            F.transform(
                block,
                lambda t, k: F.array(
                    F.struct(F.when(k > 0, F.lit(SEPARATOR)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")),
                    F.struct(t["text"].alias("text"), (t["role"] == trained_role).alias("loss")),
                ),
            )
        )
        foot = F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))
        return F.filter(F.concat(F.array(head), body, F.array(foot)), lambda s: s["text"] != "")

    return (
        sorted_turns.withColumn("begins", begins)
        .withColumn("blocks", blocks)
        .withColumn("segments", F.flatten(F.transform("blocks", segments)))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join("segments.text", "").alias("formatted"),
            "segments",
        )
    )


def read_conversations(formatted: DataFrame) -> DataFrame:
    """The turns in the formatted text: adds ``turns``, an array of (role, text)."""
    pattern = START.replace("|", r"\|")
    blocks = F.filter(F.split("formatted", pattern, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        length = F.length(block) - F.length(head) - 1 - len(END)
        texts = F.split(F.substr(block, F.length(head) + 2, length), SEPARATOR.replace("|", r"\|"), -1)
        return F.transform(
            texts, lambda t: F.struct(_read_role(head).alias("role"), unescape(t).alias("text"))
        )

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns)))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text and its loss mask say."""
    said = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    trained = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
    return (
        read_conversations(formatted)
        .withColumn("trained", trained)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
            F.length("trained").cast("long").alias("loss_chars"),
            F.sha2("trained", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
