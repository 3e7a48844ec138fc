"""Operator 8: round trips, merging, masks."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from marketlake.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, id string, t string, n string"


def _formatted(spark, rows):
    df = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA)
    out = C.format_chats(df).withColumns({"turns": C.read_back(F.col("formatted")), "loss": C.trained_texts(F.col("pieces"), F.col("mask"))})
    return {r.conv_id: r for r in out.collect()}


def test_round_trip_and_mask(spark):
    rng = random.Random(4)
    parts = ["<|turn|>", "<|next|>", "<|end|>", "<|", "<", "|", "\\", "</s>", "[INST]", "[/INST]", "[", "<<SYS>>", "<</SYS>>", "<s>", "ok", "\n", " ", "é", "$1"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(0, 8)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", word()]), rng.choice([word(), word(), None])) for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(99, 0, "assistant", "twice"), (99, 0, "assistant", "twice"), (99, None, "user", "first"), (None, 0, None, None)]
    got = _formatted(spark, rows)
    for conv, r in got.items():
        want = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        found = [(x.role, x.text) for x in r.turns]
        assert sorted(found) == sorted((w[2], w[3]) for w in want)
        assert "".join(r.pieces) == r.formatted
        assert r.loss == [t for role, t in found if role == "assistant"]
    assert [(x.role, x.text) for x in got[99].turns] == [("user", "first"), ("assistant", "twice"), ("assistant", "twice")]
    assert [(x.role, x.text) for x in got[None].turns] == [("", "")]
    turns = [[(x.role, x.text) for x in r.turns] for c, r in got.items() if c is not None and c < 60]
    wanted = [[(role or "", text or "") for c, _, role, text in rows if c == k] for k in got if k is not None and k < 60]
    assert turns == wanted


def test_adjacent_turns_of_a_role_share_a_block(spark):
    r = _formatted(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "<|end|>"), (1, 4, "user", "d")])[1]
    assert r.formatted == ("<|turn|>user<|text|>a<|next|>b<|end|><|turn|>assistant<|text|>c<|next|><\\|end|><|end|><|turn|>user<|text|>d<|end|>")
    assert r.loss == ["c", "<|end|>"] and len(r.turns) == 5


def test_empty_table(spark):
    assert C.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
