"""Vocabularies and pooled vectors without shuffling what is rare or not asked for."""

import random

import pytest
from pyspark.sql import functions as F

from lexispan.operators import features
from lexispan.operators.pooling import pool_words


def corpus(spark, even=False):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    weights = None if even else [1 / (k + 1) for k in range(3000)]
    lists = [(rng.choices(words, weights, k=40),) for _ in range(300)]
    return spark.createDataFrame([*lists, ([],), (None,)], "t array<string>").repartition(4)


@pytest.mark.parametrize("even", [False, True])
@pytest.mark.parametrize(("top", "buckets"), [(5, 700), (40, 300), (40, 41), (1, 2), (2900, 11_000)])
def test_candidates_hold_the_most_frequent_terms(spark, top, buckets, even):
    df = corpus(spark, even)
    counts = features.candidate_counts(df, "t", top, buckets=buckets)
    full = features.term_counts(df, "t")
    if counts is not None:
        assert features.top_terms(counts, top).collect() == features.top_terms(full, top).collect()
        assert counts.count() <= full.count()
    if (top, buckets, even) == (5, 700, False):
        assert counts.count() < full.count() / 10


def test_fitted_vocabulary_counts_occurrences_and_documents(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["a", "c"],), ([],), (None,)], "t array<string>")
    rows = features.fitted_vocabulary(df, "t", 2).select("idx", "term", "cnt", "df").orderBy("idx").collect()
    assert [tuple(r) for r in rows] == [(0, "a", 3, 2), (1, "b", 1, 1)]


@pytest.mark.parametrize("how", ["mean", "max"])
@pytest.mark.parametrize("hot", [0, 32, 10**6])
def test_hot_and_joined_words_pool_like_the_matrix(spark, how, hot):
    rng = random.Random(6)
    rows = [(k, rng.choices("aaabbcdefgh", k=rng.randrange(0, 12))) for k in range(60)]
    rows += [(3, ["a", "g", None]), (3, ["a", "g", None]), (None, ["h", "x"]), (70, None), (71, ["x"])]
    table = spark.createDataFrame([(w, [ord(w) / 7, -ord(w) / 3]) for w in "abcdgh"] + [("a", [0.5, 1.0])],
                                  "word string, vec array<float>")
    df = spark.createDataFrame(rows, "k int, t array<string>").repartition(3)

    def result(**bounds):
        pooled = pool_words(df, "k", "t", table, how, 2, **bounds).select(
            "k", F.transform("features", lambda x: F.round(x, 6) + 0.0).alias("f"))
        return sorted(map(repr, pooled.collect()))

    assert result(max_matrix_bytes=0, max_hot_bytes=hot) == result()


def test_entries_do_not_carry_the_lists_they_come_from(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, [])], "id int, t array<string>")
    model = features.TfidfModel.fit(df, "t", 3, max_listed=0)
    found = model.entries(df, "id", "t")
    assert sorted((r.id, r.term, r.cnt) for r in found.collect()) == [(1, "a", 2), (1, "b", 1), (2, "b", 1), (2, "c", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    after = plan[:plan.index("Generate explode")]
    assert "xxhash64" not in after and "size(t" not in after
