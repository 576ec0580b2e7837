"""Global order, with one value or group holding a third of the rows or more."""

import random

import pytest
from pyspark.sql import functions as F

from lexispan.operators import ranking, sampling


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    made = []
    for i in range(3000):
        value = 0.5 if rng.random() < 0.4 else round(rng.random() * 3, 2)
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        made.append((f"q{rng.randrange(10**9)}-{i}", group, value, rng.randrange(-3, 9)))
    return made


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id string, g string, x double, v int").repartition(7)


def test_running_totals(table, rows):
    found = ranking.running_totals(table, ["x", "id"], {"s": F.col("v")}).collect()
    expected, total = {}, 0
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        total += row[3]
        expected[row[0]] = total
    assert {r["id"]: r["s"] for r in found} == expected


def test_ranked_per_group(table, rows):
    found = ranking.ranked(table, ["id"], "n", ["g"]).collect()
    expected = {}
    for group in {r[1] for r in rows}:
        for n, row in enumerate(sorted(r[0] for r in rows if r[1] == group)):
            expected[row] = n + 1
    assert {r["id"]: r["n"] for r in found} == expected


@pytest.mark.parametrize("k", [0, 1, 1234, 3000, 4000])
def test_first_rows(table, rows, k):
    found = ranking.first_rows(table, ["x", "id"], k).collect()
    expected = sorted((r[2], r[0]) for r in rows)[:k]
    assert sorted((r["x"], r["id"]) for r in found) == expected


@pytest.mark.parametrize("k", [1, 300, 5000])
def test_first_rows_per_group(table, rows, k):
    found = ranking.first_rows_per_group(table, ["x", "id"], k, ["g"]).collect()
    for group in {r[1] for r in rows}:
        expected = sorted((r[2], r[0]) for r in rows if r[1] == group)[:k]
        assert sorted((r["x"], r["id"]) for r in found if r["g"] == group) == expected


def test_top_per_group(table, rows):
    found = ranking.top_per_group(table, ["g"], [F.desc("v"), F.col("id")], 5).collect()
    for group in {r[1] for r in rows}:
        expected = sorted((-r[3], r[0]) for r in rows if r[1] == group)[:5]
        mine = sorted((r["rank"], -r["v"], r["id"]) for r in found if r["g"] == group)
        assert [m[1:] for m in mine] == expected


def test_kth_row_does_not_shuffle_the_table(table):
    plan = ranking.first_rows(table, ["x", "id"], 1000)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Window" not in text and "Sort" not in text


def test_no_window_without_partition_over_rows(table):
    plan = ranking.ranked(table, ["x", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_splits_and_samples(spark):
    ids = spark.range(1003).withColumnRenamed("id", "doc")
    train = sampling.train_rows_80_20(1003)
    assert train == 802 and sampling.train_rows_70_30(1003) == 702
    split = sampling.split_exact(ids, "doc", train, 1)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 802, "test": 201}
    again = sampling.split_exact(ids.repartition(13), "doc", train, 1)
    assert split.exceptAll(again).count() == 0
    assert sampling.sample_rows(ids, "doc", 77, 3).distinct().count() == 77
    assert sampling.sample_fraction(ids, "doc", 0.2, 3).count() == 201
    assert 100 < sampling.sample_by_hash(ids, "doc", 0.2, 3).count() < 300
    everything = sampling.split_exact(ids, "doc", 5000, 1)
    assert everything.filter("split = 'train'").count() == 1003
    shuffled = [r["doc"] for r in sampling.shuffled(ids, "doc", 9).collect()]
    assert sorted(shuffled) == list(range(1003)) and shuffled != list(range(1003))


def test_balance_keeps_the_smallest_class_whole(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("label"))
    kept = sampling.balance_classes(df, "id", "label", 42)
    assert {r["label"]: r["count"] for r in kept.groupBy("label").count().collect()} == {0: 100, 1: 100}
    even = df.withColumn("label", (F.col("id") % 2).cast("int"))
    assert sampling.balance_classes(even, "id", "label", 42).count() == 1000


def test_interleave(spark):
    df = spark.range(10).select("id", F.when(F.col("id") < 5, "x").otherwise("y").alias("s"))
    rows = sampling.interleave(df, "s", "id").orderBy("pair", "s", "id").collect()
    assert [r["id"] for r in rows] == [0, 1, 5, 6, 2, 3, 7, 8, 4, 9]
