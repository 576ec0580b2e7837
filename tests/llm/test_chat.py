import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexispan.llm.chat import Template, format_chats, learnt_text, turns_of

SCHEMA = "conv_id long, turn long, role string, text string, segments string, state int"
TEMPLATE = Template()


def chats(spark, rows):
    found = format_chats(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    return {
        r.conv_id: r for r in found.select(
            "conv_id", "valid", "formatted", turns_of(F.col("formatted")).alias("turns"),
            learnt_text(F.col("segments")).alias("learnt"),
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("joined"),
        ).collect()
    }


def test_control_strings_in_texts_come_back(spark):
    nasty = [
        "<|turn|>", "a<|end|>b", "\\<|text|>\\\\", "[INST]", "[\\INST]", "</s>[INST] ok [/INST]", "", "\n \\",
        "<|turn|><|text|><|end|>", "<\\|end|>", "<<s>>",
    ]
    rows = [(1, i, ("user", "assistant")[i % 2], text) for i, text in enumerate(nasty)]
    found = chats(spark, rows)[1]
    assert [(t.role, t.text) for t in found.turns] == [(r[2], r[3]) for r in rows]
    assert found.learnt == "".join(r[3] for r in rows if r[2] == "assistant")
    assert found.joined == found.formatted and found.valid
    assert found.formatted.count("<|turn|>") == len(rows) == found.formatted.count("<|end|>")


def test_order_of_turns_decides_validity(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 1, "assistant", "b"), (2, 0, "user", "a"),
            (3, 0, "assistant", "a"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a"),
            (4, 3, "tool", "t"), (4, 4, "assistant", "a")]
    assert {k: r.valid for k, r in chats(spark, rows).items()} == {1: False, 2: True, 3: False, 4: True}


def test_nulls_ties_and_empty_table(spark):
    rows = [(None, None, None, None), (None, 1, "user", "u"), (5, 1, "user", "b"), (5, 1, "user", "a")]
    found = chats(spark, rows)
    assert [(t.role, t.text) for t in found[None].turns] == [("", ""), ("user", "u")]
    assert [t.text for t in found[5].turns] == ["a", "b"]
    assert chats(spark, []) == {}


def test_long_conversation_and_text(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "word " * 20) for i in range(3000)]
    rows.append((1, 3000, "user", "x" * 300_000))
    found = chats(spark, rows)[1]
    assert len(found.turns) == 3001 and found.valid and found.turns[-1].text == "x" * 300_000


@given(st.sampled_from(TEMPLATE.controls), st.sampled_from(TEMPLATE.controls))
def test_no_control_string_holds_another(a, b):
    assert a == b or a not in b


def test_bad_templates_are_refused():
    for bad in (Template, ):
        with pytest.raises(ValueError):
            bad(turn="<|end|>x")
        with pytest.raises(ValueError):
            bad(turn="aba")
