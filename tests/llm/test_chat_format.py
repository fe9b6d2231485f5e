"""Chat formatting: the fold against an interpreter, and exact round trips."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format

LOG = "conv_id long, seq long, turn long, event string, role string, text string"


def interpreted(events):
    """One event after the other, as ``reconstruct`` states it (distinct seqs)."""
    state = {}
    for conv, seq, turn, event, role, text in sorted(set(events), key=lambda e: e[1]):
        turns = state.setdefault(conv, {})
        if event == "regenerate":
            for later in [t for t in turns if t > turn]:
                turns[later] = (turns[later][0], None)
        known, said = turns.get(turn, (None, None))
        if event in ("message", "edit", "regenerate"):
            said = text or ""
        elif event == "delta":
            said = (said or "") + (text or "")
        else:
            continue
        turns[turn] = (role if role is not None else known, said)
    return sorted((c, t, r, s) for c, turns in state.items() for t, (r, s) in turns.items() if s is not None)


@pytest.mark.parametrize("seed", range(4))
def test_fold_matches_an_interpreter(spark, seed):
    rng = random.Random(seed)
    events = [(rng.randint(1, 3), seq, rng.randint(1, 5), rng.choice(("message", "delta", "delta", "delta", "edit", "regenerate", "seen")),
               rng.choice(("user", "assistant")), rng.choice(("a", "bc", "", None, "<s>"))) for seq in range(120)]
    events += rng.sample(events, 20)  # delivered again
    rng.shuffle(events)
    got = sorted(map(tuple, chat_format.reconstruct(spark.createDataFrame(events, LOG)).collect()))
    assert got == interpreted(events)


def test_streamed_answer_edited_question_and_regeneration(spark):
    events = [(7, 1, 1, "message", "user", "Helo"), (7, 2, 2, "message", "assistant", ""), (7, 3, 2, "delta", None, "Hi "), (7, 4, 2, "delta", None, "there"),
              (7, 5, 3, "message", "user", "more?"), (7, 6, 1, "edit", None, "Hello"), (7, 7, 2, "regenerate", None, None),
              (7, 8, 2, "delta", None, "Good "), (7, 9, 2, "delta", None, "day"), (7, 10, 3, "message", "user", "thanks")]
    rows = chat_format.reconstruct(spark.createDataFrame(events, LOG)).orderBy("turn").collect()
    assert [(r["turn"], r["role"], r["text"]) for r in rows] == [(1, "user", "Hello"), (2, "assistant", "Good day"), (3, "user", "thanks")]


TEXTS = ["", "</s>[INST] ok [/INST]", "<s><s>", "<\\s>", "<\\\\/s>", "[\\INST][INST", "\\<s>\\", "a\nb\n", "<<s>>", "é🎈</s>", "[/INST]" * 50, "x" * 1000]


def test_round_trip_and_mask(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(("user", "assistant", "system", "tool\n<s>", "[INST]")), "".join(rng.choice(TEXTS) for _ in range(rng.randint(0, 4))))
            for c in range(30) for t in range(rng.randint(1, 6))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.read_back(chat_format.render(turns)).collect()
    for r in out:
        want = [x[2:] for x in rows if x[0] == r["conv_id"]]
        assert [(m["role"], m["text"]) for m in r["messages"]] == want
        assert [m["loss"] for m in r["messages"]] == [text if role == "assistant" else None for role, text in want]
    for r in chat_format.render(turns).collect():
        own = [x for x in rows if x[0] == r["conv_id"]]
        for (_, _, role, _), turn in zip(own, r["turns"]):
            assert r["formatted"][turn["start"]:].startswith("<s>assistant\n" if role == "assistant" else "[INST]")
            if role == "assistant":
                assert r["formatted"][turn["loss_end"]:].startswith("</s>")


def test_marks_inside_texts_are_gone(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string").select("text", chat_format.escape(F.col("text")).alias("e"))
    for text, escaped, back in texts.select("text", "e", chat_format.unescape(F.col("e"))).collect():
        assert back == text
        assert not any(m in escaped for m in (*chat_format.LOSS_MARKS, *chat_format.OTHER_MARKS))


def test_defined_cases(spark):
    rows = [(1, 0, "user", None, 9), (1, 1, "assistant", "same", 9), (1, 1, "assistant", "same", 9), (None, None, None, "z" * 2_000_000, 9), (2, None, "assistant", "", 9)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq long")
    events = chat_format.events_of(table)
    out = {r["conv_id"]: [(m["role"], m["text"], m["loss"]) for m in r["messages"]]
           for r in chat_format.read_back(chat_format.render(chat_format.reconstruct(events))).collect()}
    assert out[1] == [("user", "", None), ("assistant", "same", "same"), ("assistant", "same", "same")]
    assert out[None] == [("", "z" * 2_000_000, None)] and out[2] == [("assistant", "", "")]
    empty = chat_format.events_of(table.limit(0))
    assert chat_format.read_back(chat_format.render(chat_format.reconstruct(empty))).collect() == []


def test_ties_and_redelivery(spark):
    events = [(1, 5, 1, "edit", None, "b"), (1, 5, 1, "edit", None, "a"), (1, 5, 1, "delta", None, "!"), (1, 5, 1, "delta", None, "!"), (1, None, 1, "message", "user", "x"),
              (1, 4, 1, "delta", "system", "gone")]
    (row,) = chat_format.reconstruct(spark.createDataFrame(events, LOG)).collect()
    assert tuple(row) == (1, 1, "system", "b!")


def test_query_digest_of_the_added_conversation(spark):
    from tidemark.llm.catalog import QUERIES

    (row,) = QUERIES["op12_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -1").collect()
    marks = "</s>[INST] ok [/INST]"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(marks)
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{marks}\nassistant\n{marks}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(marks.encode()).hexdigest()
