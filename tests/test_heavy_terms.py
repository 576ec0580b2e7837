"""Frequent terms by bounded counters against the full count, and slices and table functions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexispan.functions import tables
from lexispan.operators import heavy_terms
from lexispan.operators.features import vocabulary
from lexispan.operators.heavy_terms import summaries, top_vocabulary
from lexispan.operators.qa_eval import summary_by


def corpus(spark, even=False):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        rows.append([f"t{int(rng.random() * 900) if even else int(900 * rng.random() ** 4)}" for _ in range(rng.randrange(30))])
    rows += [None, [], [None, "t1"], ["t2", "t2"]]
    return spark.createDataFrame([(r,) for r in rows], "terms array<string>").repartition(4)


def expected(df, n):
    counts = Counter(t for r in df.collect() for t in r.terms or [] if t is not None)
    return sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:n]


@pytest.mark.parametrize(("top", "counters"), [(5, 60), (20, 200), (5, 6), (900, 10), (2000, None)])
@pytest.mark.parametrize("even", [False, True])
def test_top_vocabulary(spark, top, counters, even):
    df = corpus(spark, even)
    got = [(r.term, r.cnt) for r in top_vocabulary(df, "terms", top, counters).orderBy("idx").collect()]
    assert got == expected(df, top)


def test_bounds_hold_and_tell_when_they_do_not(spark, monkeypatch):
    df = corpus(spark)
    true = dict(expected(df, 10**6))
    rows = summaries(df, "terms", 60).collect()
    taken = sum(r.taken for r in rows)
    low = Counter()
    for r in rows:
        if r.term is not None:
            low[r.term] += r.low
    assert taken > 0 and all(low[t] <= n <= low[t] + taken for t, n in true.items())
    full = []
    monkeypatch.setattr(heavy_terms, "term_counts", lambda *a: full.append(1) or vocabulary(*a, 10**6).drop("idx"))
    top_vocabulary(df, "terms", 5, 200).count()
    assert not full
    top_vocabulary(corpus(spark, even=True), "terms", 50, 60).count()
    assert full


def test_empty_vocabulary(spark):
    assert top_vocabulary(corpus(spark).limit(0), "terms", 5).collect() == []


def test_slices(spark):
    scores = spark.createDataFrame(
        [("a", True, 1.0, 0.5), ("a", False, 0.0, 0.5), ("b", True, 1.0, 1.0), (None, True, 0.0, 0.0)],
        "title string, has_ans boolean, exact double, f1 double")
    rows = {(r.slice, r.has_ans, r.title): (r.total, r.exact, r.f1) for r in summary_by(
        scores, [[], ["has_ans"], ["has_ans", "title"]]).collect()}
    assert rows["", None, None] == (4, 50, 50) and rows["has_ans", True, None] == (3, pytest.approx(200 / 3), 50)
    assert rows["has_ans+title", True, None] == (1, 0, 0) and rows["has_ans+title", False, "a"] == (1, 0, 50)
    assert len(rows) == 7
    assert summary_by(scores.limit(0), [[], ["title"]]).collect() == []


def test_packed_words(spark):
    tables.register(spark)
    rows = [(1, "a", 300), (2, "a", 900), (3, "b", 5), (4, "b", None), (5, None, 1024), (6, "c", 0)]
    table = spark.createDataFrame(rows, "id long, source string, n int")
    call = "SELECT * FROM pack_words(TABLE(SELECT * FROM {t}) PARTITION BY (source) ORDER BY (id), 'source', 'id', 'n', {size})"
    got = sorted(map(tuple, spark.sql(call.replace("{size}", "512"), t=table).collect()), key=repr)
    assert got == sorted([("a", 0, 1, 2, 512), ("a", 1, 2, 2, 512), ("a", 2, 2, 2, 176), ("b", 0, 3, 3, 5),
                          (None, 0, 5, 5, 512), (None, 1, 5, 5, 512)], key=repr)
    for wrong in ("0", "NULL"):
        with pytest.raises(Exception, match="at least one word"):
            spark.sql(call.replace("{size}", wrong), t=table).collect()
    with pytest.raises(Exception, match="no columns"):
        spark.sql(call.replace("'n'", "'m'").replace("{size}", "5"), t=table).collect()


def test_one_call_is_one_aggregate(spark):
    scores = spark.range(4).select(F.lit("a").alias("title"), F.lit(True).alias("has_ans"), F.lit(1.0).alias("exact"),
                                   F.lit(1.0).alias("f1"))
    plan = summary_by(scores, [[], ["title"]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
