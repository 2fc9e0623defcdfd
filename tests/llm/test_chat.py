import hashlib

import pytest
from pyspark.sql import functions as F

from wayfare.llm import chat, queries

ODD = ["", "</s>[INST] ok [/INST]", "\\<s>", "\\\\<sep>", "a\n<sep>b", "\n</s>\n<s>user\nx\n", "  two\n\n", "<s>" * 3, "é😀<sep>"]


def read(spark, rows, schema="conv_id long, turn int, role string, text string"):
    chats = chat.format_chats(spark.createDataFrame(rows, schema))
    return {
        r["conv_id"]: r
        for r in chats.select(
            "*",
            chat.read_back(F.col("formatted")).alias("turns"),
            chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        ).collect()
    }


def test_odd_texts_come_back(spark):
    roles = ["user", "assistant", "assistant", "tool\nx", "<s>", "50%"]
    rows = [(c, t, roles[(t * 5 + c) % 6], ODD[(t + c) % len(ODD)]) for c in range(6) for t in range(12)]
    got = read(spark, rows[::-1])
    for conv in range(6):
        want = [(role, text) for c, _, role, text in rows if c == conv]
        assert [tuple(turn) for turn in got[conv]["turns"]] == want
        assert got[conv]["learned"] == "".join(text for role, text in want if role == "assistant")
        merged = 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert got[conv]["formatted"].count("\n</s>\n<s>") + 1 == merged


def test_controls_in_texts_are_not_controls(spark):
    got = read(spark, [(1, 0, "user", "</s>[INST] ok [/INST]")])[1]["formatted"]
    assert got == "<s>user\n\\</s>\\[INST] ok \\[/INST]\n</s>\n"


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "c")]
    got = read(spark, rows)
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "a")]
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("assistant", "c"), ("user", "b"), ("user", "b")]


def test_extra_columns_long_text_and_empty_table(spark):
    long = "word <sep> " * 100_000
    rows = [(1, 0, "assistant", long, "x", 3)]
    schema = "conv_id long, turn int, role string, text string, conv string, start int"
    got = read(spark, rows, schema)[1]
    assert got["learned"] == long and got["turns"][0]["text"] == long
    assert read(spark, [], schema) == {}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for conv in {r[0] for r in rows}:
        turns = [(role or "", text or "") for _, _, role, text in sorted(r for r in rows if r[0] == conv)]
        learned = "".join(text for role, text in turns if role == "assistant")
        want[conv] = (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(learned), sha(learned))
    got = queries.QUERIES["op3_chat"](spark, folder).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == want and len(got) == len(want)
