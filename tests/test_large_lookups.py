"""Dictionaries beyond the size bound: frequent tokens in the row, the others by a join."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispan.operators.frequent import frequent_values
from lexispan.operators.list_slices import in_slices, lists_of
from lexispan.operators.lookup import look_up_tokens, tokens_by


def rows():
    rng = random.Random(3)
    out = [(k, [rng.choice("aaaabbbccd") + rng.choice(["", "", "x", "y"]) for _ in range(rng.randrange(0, 9))])
           for k in range(80)]
    return [*out, (7, ["a", None, "zz"]), (7, ["a", None, "zz"]), (None, ["a", "dx"]), (90, []), (91, None)]


@pytest.mark.parametrize("unmatched", [True, False])
@pytest.mark.parametrize("hot", [0, 2, 1000])
def test_hot_and_cold_tokens_have_the_values_of_the_dictionary(spark, hot, unmatched):
    df = spark.createDataFrame(rows(), "k int, tokens array<string>").repartition(5)
    table = spark.createDataFrame(
        [("a", "1"), ("a", "0"), ("bx", "2"), ("dx", "3"), ("zz", "4"), (None, "5"), ("c", None)], "w string, v string")
    small = look_up_tokens(df, "k", "tokens", table, "out", unmatched)
    large = look_up_tokens(df, "k", "tokens", table, "out", unmatched, max_dictionary_rows=0, max_hot_tokens=hot)
    assert sorted(map(repr, large.collect())) == sorted(map(repr, small.collect()))


def test_only_tokens_that_are_not_hot_are_joined(spark):
    df = spark.createDataFrame([(k, ["a"] * 50 + [f"w{k}"]) for k in range(40)], "k int, tokens array<string>")
    table = spark.createDataFrame([("a", "1"), ("w1", "2")], "w string, v string")
    found = look_up_tokens(df, "k", "tokens", table, "out", max_dictionary_rows=0, max_hot_tokens=3)
    assert found.filter("k = 1").first()["out"] == ["1"] * 50 + ["2"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan


def test_the_most_frequent_values(spark):
    df = spark.createDataFrame([(["a"] * 9 + ["b"] * 5 + ["c", "d", None],), (None,)], "v array<string>")
    assert {r.value for r in frequent_values(df, "v", 2).collect()} == {"a", "b"}
    assert {r.value for r in frequent_values(df, "v", 3).collect()} == {"a", "b"}
    assert len(frequent_values(df, "v", 4).collect()) == 4 and not frequent_values(df, "v", 0).collect()


def test_work_in_slices():
    lists = pa.array([["a"] * 5, None, [], ["b", None], ["c"] * 9, ["d"]], pa.list_(pa.string()))
    sizes = []

    def work(part):
        sizes.append(len(part.flatten()))
        return lists_of(part, part.flatten())

    assert in_slices(work, lists, elements=4).to_pylist() == lists.to_pylist() and max(sizes) == 9
    assert in_slices(work, lists.slice(0, 0)).to_pylist() == []


def test_few_tokens_of_a_given_function_are_alive_at_a_time(spark):
    def make():
        class Token(str):
            alive = 0

            def __new__(cls, text):
                cls.alive += 1
                assert cls.alive <= 6500
                return super().__new__(cls, text)

            def __del__(self):
                type(self).alive -= 1

        return lambda text: [Token(t) for t in text.split()]

    df = spark.range(0, 500, 1, 1).select("id", F.array_join(F.array_repeat(F.lit("ab"), 50), " ").alias("text"))
    assert tokens_by(df, "text", make, "tokens").agg(F.sum(F.size("tokens"))).first()[0] == 25_000
