"""Turns that share a number, and turns without a conversation."""

from plantlens.llm import preference

TURNS = "conv_id long, turn long, role string, text string"


def test_no_turn_is_lost(spark):
    rows = [
        (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "c"), (1, 1, "user", "d"),
        (None, 0, "user", "x"), (None, 0, "user", "y"), (None, 0, "user", "y"), (None, 1, "user", "z"),
    ]
    found = preference.conversations(spark.createDataFrame(rows, TURNS)).collect()
    turns = sorted((r.conv_id or 0, [tuple(t) for t in r.turns]) for r in found)
    alone = [(0, [("user", text)]) for text in "xyyz"]
    assert turns == [*alone, (1, [("assistant", "c"), ("user", "a"), ("user", "b"), ("user", "d")])]
