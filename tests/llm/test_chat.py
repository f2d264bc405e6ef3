"""Operator 10: chat formatting."""

import pytest

from marketsignals.llm import chat_format
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import SF, same

OP10 = ("conv_id", "part", "speaker", "n_turns", "n_own", "rendered", "masks")
TURNS = ([(1, 0, "system", "be kind"), (1, 1, "ann", "hé"), (1, 2, "bob", None), (1, 2, "ann", "tie"), (1, 2, "ann", "tie"),
          (1, None, "bob", "last"), (1, 3, None, "who"), (2, 0, "system", "only"), (None, 1, "ann", "x"), (None, 0, "bob", ""),
          (4, 5, "solo", "<|end|>\n"), (5, -1, "b", "日本"), (5, -2, "a", "😀")]
         + [(3, i, "ann" if i % 3 else "bob", f"turn {i}") for i in range(150)])


def test_edges(spark):
    rows = spark.createDataFrame([(*r, 1, "x") for r in TURNS], "conv_id long, turn long, role string, text string, at int, part string")
    out = chat_format.rotate_perspectives(rows)
    out = out.withColumn("masks", chat_format.mask_list(out.masks))
    same(out, brute.chat(TURNS), *OP10)


def test_long_dialogues_stay_whole_and_repeated_turns_stay(spark):
    rows = [(1, None, "ann", "yes"), (1, None, "ann", "yes")] + [(2, i, "ann" if i % 2 else "bob", f"turn {i}") for i in range(130)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.speaker): r for r in chat_format.rotate_perspectives(df).collect()}
    assert len(got) == 3 and got[1, "ann"].n_own == 2 and got[2, "bob"].n_turns == 130


@pytest.mark.parametrize("part", [1, 40, 700])
def test_parts_repeat_the_opening(spark, part):
    more = TURNS + [(c, i, "system", f"rule {i}") for c in (3, None) for i in range(-3, 0)]
    rows = spark.createDataFrame(more, "conv_id long, turn long, role string, text string")
    out = chat_format.rotate_perspectives(rows, part=part)
    same(out.withColumn("masks", chat_format.mask_list(out.masks)), brute.chat(more, part), *OP10)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op10_chat_format"](spark, SF), brute.chat(rows), *OP10)


def test_empty(spark, empty_dir):
    assert QUERIES["op10_chat_format"](spark, empty_dir).count() == 0
