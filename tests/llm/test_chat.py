"""Chat windows: round trips, budgets and masks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from doselens.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "[\\\\/INST]", "<", "[", "\\", "s>", "INST]", "</", "<\\", "\n"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        roles = (["system"] if rng.random() < 0.5 else []) + ["user", "assistant"] * rng.randint(0, 9) + ["user"] * rng.randint(0, 1)
        for turn, role in enumerate(roles):
            pieces = rng.choices([*CONTROLS, "word", "two words ", "漢字🙂"], k=rng.randint(0, 30))
            rows.append((conv, turn, role, " ".join(pieces)))
    return rows


def expected(rows):
    found = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv, _, role, text in sorted(rows, key=order):
        turns, loss = found.setdefault(conv, ([], []))
        turns.append(f"{role or ''}\n{text or ''}\n")
        if role == "assistant":
            loss.append(text or "")
    digest = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    return {c: (len(t), digest(t), len("".join(a)), digest(a)) for c, (t, a) in found.items()}


def read(frame, **sizes):
    rows = chat.read_back(chat.format_windows(frame, chat.word_counter, **sizes)).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:5] for r in rows}


@pytest.mark.parametrize("sizes", [{}, {"budget": 40, "history_tokens": 15, "history_turns": 2}, {"budget": 1}, {"history_turns": 0, "budget": 50}])
def test_everything_is_read_back(spark, sizes):
    rows = random_rows(1)
    assert read(conversations(spark, rows), **sizes) == expected(rows)


def test_windows_keep_to_the_budget(spark):
    rows = random_rows(2)
    budget, history, most = 60, 25, 3
    frame = chat.format_windows(conversations(spark, rows), chat.word_counter, budget, history, most)
    tokens = lambda role, text: len(f"<s>[INST]{role}[/INST]{chat.escape(text)}</s>".split())
    by_conv = {}
    for row in sorted(frame.collect(), key=lambda r: (r.conv_id, r.window)):
        by_conv.setdefault(row.conv_id, []).append(row)
    for conv, made in by_conv.items():
        given = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert [w.window for w in made] == list(range(len(made)))
        at = 0
        for window in made:
            turns = chat.turns_of(window.text)
            assert window.n_tokens == sum(tokens(*t) for t in turns)
            new = turns[window.repeated :]
            assert new and new == given[at : at + len(new)]
            repeated = turns[: window.repeated]
            if window.window and given[0][0] == "system" and 2 * tokens(*given[0]) <= budget:
                assert repeated[0] == given[0]
                repeated = repeated[1:]
            assert repeated == given[at - len(repeated) : at] if repeated else True
            assert len(repeated) <= most and sum(tokens(*t) for t in repeated) <= history
            assert window.n_tokens <= budget or len(new) == 1
            at += len(new)
            learned = [chat.unescape(window.text[s.start : s.end]) for s in window.loss]
            assert learned == [text for role, text in new if role == "assistant"]
        assert at == len(given)
    assert max(map(len, by_conv.values())) > 3


def test_escaping_is_reversible_and_leaves_no_control_string():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices(CONTROLS, k=rng.randint(0, 8)))
        held = chat.escape(text)
        assert chat.unescape(held) == text
        assert not any(c in held for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_odd_rows(spark):
    long = "word " * 50_000
    rows = [
        (None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", None), (1, 0, None, "x"),
        (1, 0, "assistant", "y"), (1, 0, "assistant", "y"), (2, 0, "system", long), (2, 1, "user", "q"),
        (2, 2, "assistant", long), (2, 3, "user", ""), (2, 4, "assistant", ""), (3, 5, "system", "only"),
        (4, 0, "user", "u"), (4, 1, "system", "late"), (4, 2, "assistant", "t"), (5, 0, "</s>", "[/INST]"),
    ]
    frame = conversations(spark, rows).withColumn("window", F.lit("clash")).withColumn("K", F.lit(1))
    assert read(frame, budget=20) == expected(rows)
    assert read(frame.limit(0)) == {}


def test_long_conversation_is_a_stream(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(4000)]
    windows = chat.format_windows(conversations(spark, rows), chat.word_counter, 50, 10, 2)
    assert windows.count() > 150 and windows.agg(F.max(F.length("text"))).first()[0] < 1000
    assert read(conversations(spark, rows), budget=50) == expected(rows)
