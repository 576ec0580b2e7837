import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from lexispan.functions import arrays, text
from lexispan.functions.answers import answer_tokens, f1_score, gold_forms, normalize_answer
from lexispan.functions.stopwords import ENGLISH_STOP_WORDS


def one(spark, expression, **columns):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return row.select(expression.alias("r")).first()["r"]


def words_one_by_one(line):
    """The token contract, piece by piece."""
    found = []
    for piece in re.split(r"""[\s;@#$%&?!"()\[\]{}<>,:]+""", line.lower()):
        piece = re.sub(r"[.'`]+$", "", piece)
        piece = re.sub(r"(n't|'s|'m|'d|'ll|'re|'ve)$", "", piece)
        if piece and piece.isalpha():
            found.append(piece)
    return found


def test_stop_words_are_sparks(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_contractions(spark):
    line = "don't can't well-known covid19 It's DOGS' n't 's o'clock they're... `quoted' a.b"
    assert one(spark, text.words(F.col("t")), t=line) == words_one_by_one(line)
    assert one(spark, text.words(F.col("t")), t=line)[:2] == ["do", "ca"]


PIECES = ["can't", "n't", "don", "'s", "it''s", "x", "é", "9", ".", "'", "`", " ", ",", "ss", "\n",
          "'ve", "an't.", "'t", "n", "t's"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=40, max_size=40))
def test_words_follow_the_contract(spark, lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, t string")
    found = {r["i"]: r["w"] for r in df.select("i", text.words(F.col("t")).alias("w")).collect()}
    assert found == {i: words_one_by_one(line) for i, line in enumerate(lines)}


@pytest.mark.parametrize("tokens, n, expected", [
    (["a"], 2, []), ([], 2, []), (["a", "b", "c"], 2, ["a_b", "b_c"]),
    (["a", "b", "c"], 3, ["a_b_c"]), (["a", "b"], 3, []), (["a", "b"], 1, ["a", "b"]),
])
def test_ngrams(spark, tokens, n, expected):
    df = spark.createDataFrame([(tokens,)], "t array<string>")
    assert df.select(text.ngrams(F.col("t"), n)).first()[0] == expected


def test_ngram_range(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    assert df.select(text.ngram_range(F.col("t"), 1, 2)).first()[0] == ["a", "b", "c", "a_b", "b_c"]


def test_template(spark):
    template = "Use {{braces}} for {a} and {b}, then {a}."
    assert one(spark, text.render_template(template), a="x$1", b=None) == (
        "Use {braces} for x$1 and , then x$1."
    )
    assert text.template_variables(template) == ["a", "b", "a"]
    with pytest.raises(ValueError):
        text.render_template("{a:>3}")


@pytest.mark.parametrize("reply, expected", [
    ('ok\n```json\n{"destination": "math", "next_inputs": "2+2"}\n```', ("math", "2+2")),
    ("no object here", (None, None)),
    ('{"destination": "math"}', ("math", None)),
])
def test_parse_route(spark, reply, expected):
    parsed = one(spark, F.coalesce(text.parse_route(F.col("r")),
                                   F.from_json(F.lit("{}"), "destination string, next_inputs string")),
                 r=reply)
    assert tuple(parsed) == expected


def test_parse_list(spark):
    assert one(spark, text.parse_list(F.col("t")), t='["a", "b"]') == ["a", "b"]
    assert one(spark, text.parse_list(F.col("t")), t="['a', 'b c']") == ["a", "b c"]


def test_slices(spark):
    assert one(spark, text.cut_prefix(F.col("t"), 3), t="héllo") == "hél"
    assert one(spark, text.char_slice(F.col("t"), F.lit(1), F.lit(3)), t="héllo") == "él"
    assert one(spark, text.char_slice(F.col("t"), F.lit(3), F.lit(1)), t="héllo") == ""


@pytest.mark.parametrize("raw, expected", [
    ("The  Quick, Bréa a-the fox!", "quick bréa athe fox"), ("an", ""), ("", ""),
    ("the a  an\tTHE cat", "cat"), ("éa a b", "éa b"),
])
def test_normalize_answer(spark, raw, expected):
    assert one(spark, normalize_answer(F.col("t")), t=raw) == expected


def test_answer_tokens(spark):
    assert one(spark, answer_tokens(F.col("t")), t="The end.") == ["end"]
    assert one(spark, answer_tokens(F.col("t")), t="the") == []


@pytest.mark.parametrize("golds, prediction, expected", [
    ([""], "", 1.0), ([""], "x", 0.0), (["x x y"], "x x x", 2 / 3), (["the"], "", 1.0),
    (["p q", "x y"], "x y z", 0.8), (["p"], "q", 0.0), ([], "", 1.0),
])
def test_f1(spark, golds, prediction, expected):
    df = spark.createDataFrame([(golds, prediction)], "g array<string>, p string")
    found = df.select(gold_forms(F.col("g")).alias("g"), normalize_answer(F.col("p")).alias("p"))
    assert found.select(f1_score(F.col("g"), F.col("p"))).first()[0] == pytest.approx(expected)


def test_array_helpers(spark):
    df = spark.createDataFrame(
        [(["b", "a", "b"], ["b", "b", "b", "a"], [1.0, 5.0, 5.0])],
        "l array<string>, r array<string>, x array<double>",
    )
    row = df.select(
        arrays.value_counts(F.col("l")).alias("c"),
        arrays.bag_overlap(F.col("l"), F.col("r")).alias("o"),
        arrays.argmax(F.col("x")).alias("m"),
        arrays.pad_or_cut(F.col("l"), 5, F.lit("-")).alias("p"),
        arrays.pad_or_cut(F.col("l"), 2, F.lit("-")).alias("q"),
        arrays.attention_mask(F.col("l"), 5).alias("k"),
    ).first()
    assert [tuple(c) for c in row["c"]] == [("a", 1), ("b", 2)]
    assert (row["o"], row["m"]) == (3, 1)
    assert row["p"] == ["b", "a", "b", "-", "-"] and row["q"] == ["b", "a"]
    assert row["k"] == [1, 1, 1, 0, 0]
