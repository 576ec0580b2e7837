"""Tags in context against all paths."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexispan.operators.context_tags import fit_tag_lists, fit_tags, tag_in_context


def corpus():
    rng = random.Random(2)
    rows = []
    for s in range(60):
        tag = ""
        for i in range(rng.randrange(1, 9)):
            tag = rng.choice(["NN", "NN", "VB"] if tag in ("", "JJ") else ["JJ", "VB", "NN"])
            rows.append((s, i, rng.choice("abcde") + ("n" if tag == "NN" and rng.random() < 0.4 else ""), tag))
    return rows


def best_path(sentence, rows):
    tags = sorted({t for *_, t in rows})
    pairs, words, totals, leaving, last = Counter(), Counter(), Counter(), Counter(), {}
    for s, i, w, t in sorted(rows):
        before = last.get(s, "")
        pairs[before, t] += 1
        leaving[before] += 1
        words[w, t] += 1
        totals[t] += 1
        last[s] = t
    kinds = len({w for w, _ in words})

    def cost(n, total, many):
        return round(1000 * math.log((total + many) / (n + 1)))

    def total(path):
        out, before = 0, ""
        for w, t in zip(sentence, path):
            out += cost(pairs[before, t], leaving[before], len(tags)) + cost(words[w, t], totals[t], kinds)
            before = t
        return out
    return min((total(p), p[::-1], p) for p in itertools.product(tags, repeat=len(sentence)))


@pytest.mark.parametrize("most", [500_000, 0])
def test_tags_are_the_best_path(spark, most):
    rows = corpus()
    model = fit_tags(spark.createDataFrame(rows, "s int, i int, token string, tag string").repartition(3), ["s"], "i")
    rng = random.Random(5)
    sentences = [[rng.choice(["a", "b", "c", "an", "dn", "new"]) for _ in range(rng.randrange(1, 6))] for _ in range(25)]
    table = spark.createDataFrame([(k, s) for k, s in enumerate([*sentences, [], None])], "key int, tokens array<string>")
    got = {r.key: r.tags for r in tag_in_context(table, "key", "tokens", model, "tags", most).collect()}
    for k, s in enumerate(sentences):
        assert got[k] == list(best_path(s, rows)[2]), s
    assert got[len(sentences)] == [] and got[len(sentences) + 1] is None


def test_nothing_to_learn_from(spark):
    table = spark.createDataFrame([(1, 1, None, "NN"), (1, 2, "a", None)], "s int, i int, token string, tag string")
    with pytest.raises(ValueError):
        fit_tags(table, ["s"], "i")


def test_a_long_sentence(spark):
    model = fit_tags(spark.createDataFrame(corpus(), "s int, i int, token string, tag string"), ["s"], "i")
    table = spark.range(1).select(F.lit(1).alias("key"), F.array_repeat(F.lit("a"), 5000).alias("tokens"))
    row = tag_in_context(table, "key", "tokens", model, "tags").select(F.size("tags").alias("n")).first()
    assert row.n == 5000


@pytest.mark.parametrize("copies", [1, 2])
def test_lists_teach_the_same_as_rows(spark, copies):
    rows = [*corpus(), (60, 0, "a", None), (60, 1, None, "NN"), (60, 2, "b", "VB"), (60, 3, "b", "JJ")]
    table = spark.createDataFrame(rows, "s int, i int, token string, tag string")
    lists = table.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("i", "token", "tag"))).alias("e")).select(
        "s", F.col("e.token").alias("tokens"), F.col("e.tag").alias("tags"))
    for _ in range(1, copies):
        lists, table = lists.union(lists.filter("s % 7 = 0 OR s = 60")), table.union(table.filter("s % 7 = 0 OR s = 60"))
    one, other = fit_tags(table, ["s"], "i"), fit_tag_lists(lists, "s", "tokens", "tags")
    assert (one.tags, one.transitions, one.unknown) == (other.tags, other.transitions, other.unknown)
    assert sorted(one.emissions.collect()) == sorted(other.emissions.collect())
