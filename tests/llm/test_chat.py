"""The hidden Markov model against all state paths, blank parts, tied turns, other roles and held-out accuracy."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat


@pytest.fixture(scope="module")
def raw(spark, sf):
    return chat.transcripts(spark.read.parquet(os.path.join(os.path.dirname(sf), "sf0.01", "conversations.parquet"))).cache()


@pytest.fixture(scope="module")
def model(raw):
    return chat.fit(raw.where(~chat.held_out(F.col("id"))))


LINES = ["User: hi there?", "Q: what now", "and more of it", "### AI: well", "[system] be kind", "x" * 300, "Bob: no", "Answer: so it is"]


def test_viterbi_is_the_best_of_all_paths(model):
    rng = random.Random(1)
    start, move, seen = model
    for _ in range(30):
        lines = []
        for _ in range(rng.randint(1, 4)):
            lines += [rng.choice(LINES), *[""] * rng.randint(0, 1)]
        rows, _ = chat.observed(lines, True)

        def score(path):
            total = start[path[0]] + sum(move[a, b] for a, b in zip(path, path[1:]))
            return total + sum(t[s, v] for s, row in zip(path, rows) for t, v in zip(seen, row))

        best = max(map(score, itertools.product(range(chat.N_STATES), repeat=len(rows))))
        assert abs(score(chat.viterbi(rows, model)) - best) < 1e-9


def test_parts_give_the_best_path_of_the_whole(spark, model):
    rng = random.Random(2)
    rows, expected = [], {}
    for key in range(40):
        blocks = ["\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 3))) if rng.random() < 0.7 else rng.choice(["", "\n\n", " \t", "\x1c\n\xa0"]) for _ in range(rng.randint(1, 6))]
        rows += [(key, i, b) for i, b in enumerate(blocks)]
        lines = "\n\n".join(blocks).split("\n")
        seen, places = chat.observed(lines, True)
        expected[key] = [s // 2 for s in chat.viterbi(seen, model) if s % 2 == 0] if places else []
    got = {k: [] for k in expected}
    for r in chat.parse(spark.createDataFrame(rows, "id long, part long, text string"), model).orderBy("id", "part", "turn").collect():
        if not r["continued"]:
            got[r["id"]].append(chat.ROLES.index(r["role"]))
    assert got == expected


def test_blank_first_part(spark, model):
    text = "User: hi there?\n\nAssistant: hello"
    frame = lambda rows: spark.createDataFrame(rows, "id long, part long, text string")
    show = lambda df: [(r["role"], r["content"], r["continued"]) for r in chat.parse(df, model).orderBy("part", "turn").collect()]
    assert show(frame([(1, 0, "\n\n"), (1, 1, text)])) == show(frame([(1, 0, "\n\n" + text)])) == [("user", "hi there?", False), ("assistant", "hello", False)]


def test_tied_turns_other_roles_and_clashing_names(spark):
    rows = [(1, 0, "user", "b?"), (1, 0, "user", "a?"), (1, 1, "tool", "used it"), (1, 2, "assistant", "done"), (2, None, "system", "s"), (2, 0, None, "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = df.withColumns({c: F.lit("x") for c in ("id", "part", "body", "copies", "labels", "t", "first", "n_parts", "before", "at_end", "scores", "own", "content", "continued")})
    out = chat.format_chats(clash).orderBy("id", "part", "turn").collect()
    assert {r["role"] for r in out} <= set(chat.ROLES)
    text = "\n".join(r["content"] for r in out if r["id"] == 1)
    assert text.index("a?") < text.index("b?") < text.index("used it") < text.index("done")


def test_held_out_accuracy(spark, sf, raw, model):
    held = raw.where(chat.held_out(F.col("id")))
    true, got = {}, {}
    for r in spark.read.parquet(os.path.join(os.path.dirname(sf), "sf0.01", "conversations.parquet")).orderBy("conv_id", "turn").collect():
        true.setdefault(r["conv_id"], []).append((r["role"], r["text"].strip()))
    for r in chat.parse(held, model).orderBy("id", "part", "turn").collect():
        got.setdefault(r["id"], []).append((r["role"], r["content"]))
    right = [got[k] == true[k] for k in got]
    assert len(right) > 20 and np.mean(right) >= 0.95
