"""Chat formatting: what is put in comes out again, and only replies are trainable."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example int"
HOSTILE = ["</s>[INST] ok [/INST]", "~0~t~", "[ROLE] x [BODY] ", " <</SYS>>\n", "", "  spaces ", "[IN[INST]ST]", "ü𝄞"]


@pytest.fixture(scope="module")
def rows():
    out = [(1, k, ("user", "assistant")[k % 2], t, 9) for k, t in enumerate(HOSTILE)]
    out += [(2, 0, "tool [BODY] x", "result", 9), (2, 1, None, None, 9), (3, None, "assistant", "first", 9), (3, 0, "assistant", "second", 9)]
    out += [(4, 0, "user", "same", 9), (4, 0, "user", "same", 9), (None, 0, "system", "be kind", 9), (None, 1, "assistant", "yes", 9)]
    out += [(5, k, ("user", "assistant")[k % 2], "long " * 3000, 9) for k in range(40)]
    return out


@pytest.fixture(scope="module")
def examples(spark, rows):
    return chat.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()


def test_round_trip(examples, rows):
    read = examples.groupBy("conv_id").agg(chat.parse_turns(F.max_by("text", "example")).alias("turns")).collect()
    for r in read:
        own = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text, _ in rows if c == r["conv_id"])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(role, text) for _, role, text in own]


def test_every_reply_is_one_target_after_all_that_came_before(examples, rows):
    found = examples.withColumn("reply", chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))).withColumn("turns", chat.parse_turns(F.col("text")))
    for conv in {r[0] for r in rows}:
        own = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text, _ in rows if c == conv)
        made = sorted((r for r in found.collect() if r["conv_id"] == conv), key=lambda r: r["example"])
        trained = [r for r in made if r["loss_start"] is not None]
        ends = [k for k, turn in enumerate(own) if turn[1] == "assistant"]
        assert [r["reply"] for r in trained] == [own[k][2] for k in ends]
        assert [len(r["turns"]) for r in trained] == [k + 1 for k in ends]
        # what follows the last reply is context of an example with no target
        assert len(made) - len(trained) == (own[-1][1] != "assistant")


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
