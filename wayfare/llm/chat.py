"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; neighbours of one role become one block; blocks
are concatenated. Within a block every text keeps its own place, so the rows can be read back:

    <s>role\\ntext\\n<sep>text\\n</s>\\n<s>role\\n…

Control strings inside texts get a backslash in front (one more if there are some already), which ``unescaped``
takes away; a real control string is at the start or follows a line break, never a backslash.

Defined results: null texts and roles are empty; turns come in ascending order with nulls first, ties by
role, then text; a repeated row is a turn of its own; rows without a conversation id form one conversation;
an empty table has no conversations. Columns beside the four are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template and those of common chat models.
CONTROLS = ("<s>", "</s>", "<sep>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

LOSS_ROLE = "assistant"

_ANY = "(?:" + "|".join(rf"\Q{control}\E" for control in CONTROLS) + ")"
_OPEN, _CLOSE, _JOIN = "<s>", "\n</s>\n", "\n<sep>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{_ANY})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*{_ANY})", "$1")


def _role_line(role: Column) -> Column:
    """A role on one line."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_of(line: Column) -> Column:
    return F.replace(F.replace(unescaped(line), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conversation, ``formatted``, ``loss_spans``): start and length, in characters, of each learned text."""
    turns = df.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        escaped(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    )
    in_order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    opens = F.coalesce(F.lag("role").over(in_order) != F.col("role"), F.lit(True))
    closes = F.coalesce(F.lead("role").over(in_order) != F.col("role"), F.lit(True))
    head = F.when(F.col("opens"), F.char_length(_role_line(F.col("role"))) + len(_OPEN) + 1)
    placed = (
        turns.withColumns({"opens": opens, "closes": closes})
        .withColumn("n_head", head.otherwise(len(_JOIN)))
        .withColumn("n_text", F.char_length("text"))
        .withColumn(
            "n_all", F.col("n_head") + F.col("n_text") + F.when(F.col("closes"), len(_CLOSE)).otherwise(0)
        )
        .withColumn("start", F.sum("n_all").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("start") - F.col("n_all") + F.col("n_head"))
    )
    collected = placed.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "start", "n_text"))).alias("turns")
    )
    blocks = _blocks(F.col("turns"))
    return collected.select(
        F.col("conv").alias(conv_col),
        F.concat_ws(
            "",
            F.transform(
                blocks,
                lambda block: F.concat(
                    F.lit(_OPEN),
                    _role_line(block[0]["role"]),
                    F.lit("\n"),
                    F.array_join(F.transform(block, lambda turn: turn["text"]), _JOIN),
                    F.lit(_CLOSE),
                ),
            ),
        ).alias("formatted"),
        F.transform(
            F.filter("turns", lambda turn: turn["role"] == LOSS_ROLE),
            lambda turn: F.struct(turn["start"].alias("start"), turn["n_text"].cast("bigint").alias("length")),
        ).alias("loss_spans"),
    )


def _blocks(turns: Column) -> Column:
    """Array of arrays: runs of turns of one role."""
    last = F.size(turns) - 1
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    ends = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == last) | (F.get(turns, i)["role"] != F.get(turns, i + 1)["role"]),
    )
    return F.zip_with(starts, ends, lambda a, b: F.slice(turns, a + 1, b - a + 1))


def read_back(formatted: Column) -> Column:
    """Array of (role, text), one per row that was formatted."""
    inner = F.substring(formatted, F.lit(len(_OPEN) + 1), F.char_length(formatted) - len(_OPEN) - len(_CLOSE))
    blocks = F.split(inner, rf"\Q{_CLOSE}{_OPEN}\E", -1)
    return F.flatten(
        F.transform(
            blocks,
            lambda block: F.transform(
                F.split(F.substring(block, F.instr(block, "\n") + 1, F.char_length(block)), rf"\Q{_JOIN}\E", -1),
                lambda text: F.struct(
                    _role_of(F.substring_index(block, "\n", 1)).alias("role"), unescaped(text).alias("text")
                ),
            ),
        )
    )


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """What the spans cut out of the formatted text, unescaped and with nothing between."""
    return F.concat_ws(
        "",
        F.transform(
            loss_spans,
            lambda span: unescaped(
                F.substring(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))
            ),
        ),
    )
