import math

import pytest
from pyspark.sql import functions as F

from lexispan.operators import features, lookup, pooling

DOCS = [
    (1, ["cats", "cat", "men", "walves", "buses"]),
    (2, ["cat", "dog", "dog", "zebra"]),
    (3, []),
    (4, ["unknown", "things"]),
    (5, ["the"] * 400 + ["cat"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, tokens array<string>")


def close(a, b):
    return all(x == pytest.approx(y) for x, y in zip(a, b, strict=True))


def test_lemmas(spark):
    words = ["cat", "dog", "man", "wolf", "walf", "bus", "box", "buzz", "church", "dish", "fly", "ox"]
    tokens = ["cats", "cat", "men", "walves", "buses", "boxes", "churches", "dishes", "flies",
              "oxen", "xs", "dogs", "geese"]
    lexicon = spark.createDataFrame([(w,) for w in words], "word string")
    corpus = spark.createDataFrame([(t,) for t in tokens], "token string")
    exceptions = spark.createDataFrame([("oxen", "ox"), ("geese", "goose"), ("dogs", "fly")],
                                       "word string, lemma string")
    plain = {r["token"]: r["lemma"] for r in lookup.changed_lemmas(corpus, lexicon).collect()}
    assert plain == {
        "cats": "cat", "men": "man", "walves": "walf", "buses": "bus", "boxes": "box",
        "churches": "church", "dishes": "dish", "flies": "fly", "dogs": "dog"}
    irregular = {r["token"]: r["lemma"]
                 for r in lookup.changed_lemmas(corpus, lexicon, exceptions).collect()}
    assert irregular == plain | {"oxen": "ox", "dogs": "fly"}


def test_dictionary_and_join_agree(spark, docs):
    lemmas = spark.createDataFrame([("cats", "cat"), ("men", "man"), ("the", "das")],
                                   "token string, lemma string")
    more = docs.unionByName(spark.createDataFrame([(6, None)], docs.schema))
    results = []
    for bound in (10, 0):
        for keep in (True, False):
            found = lookup.look_up_tokens(more, "id", "tokens", lemmas, "out", keep, bound)
            results.append({r["id"]: r["out"] for r in found.collect()})
    assert results[0] == results[2] and results[1] == results[3]
    assert results[0][1] == ["cat", "cat", "man", "walves", "buses"]
    assert results[1][1] == ["cat", None, "man", None, None]
    assert results[0][3] == [] and results[0][6] is None


def test_tagged_bigrams_skip_dropped_words(spark):
    df = spark.createDataFrame([(1, ["big", "ran", "dog", "the", "cat"])], "id int, t array<string>")
    tags = spark.createDataFrame(
        [("big", "JJ"), ("ran", "VB"), ("dog", "NN"), ("the", "NN"), ("cat", "NN")],
        "token string, tag string")
    found = lookup.tagged_ngrams(df, "id", "t", tags, "out", stop_words=("the",)).first()["out"]
    assert found == ["big/JJ_dog/NN", "dog/NN_cat/NN"]


def test_vocabulary_ties_in_text_order(spark):
    df = spark.createDataFrame([(["b", "a", "c", "c"],)], "t array<string>")
    rows = features.vocabulary(df, "t", 2).collect()
    assert [(r["idx"], r["term"], r["cnt"]) for r in rows] == [(0, "c", 2), (1, "a", 1)]


def test_vectors_and_join_agree(docs):
    listed = features.TfidfModel.fit(docs, "tokens", 4)
    joined = features.TfidfModel.fit(docs, "tokens", 4, max_listed=0)
    assert not joined.listed and joined.terms == listed.terms

    def rows(model):
        found = model.entries(docs, "id", "tokens").collect()
        return {(r["id"], r["idx"]): (r["term"], r["cnt"], r["tf"], r["tfidf"], r["tfidf_l2"])
                for r in found}

    a, b = rows(listed), rows(joined)
    assert a.keys() == b.keys()
    for key, left in a.items():
        assert left[:2] == b[key][:2] and close(left[2:], b[key][2:])
    assert a[(2, listed.terms.index("dog"))][2] == 0.5


def test_idf_and_zero_rows(docs):
    model = features.TfidfModel.fit(docs, "tokens", 3)
    row = {r["term"]: r for r in model.table.collect()}["cat"]
    assert row["df"] == 3 and row["idf"] == pytest.approx(math.log(6 / 4) + 1)
    vectors = {r["id"]: r["v"] for r in model.vectors(docs, "tokens", "v").collect()}
    assert vectors[3].numNonzeros() == 0 and vectors[4].numNonzeros() == 0
    assert vectors[5].norm(2) == pytest.approx(1)


@pytest.fixture(scope="module")
def embedding(spark):
    return spark.createDataFrame(
        [("cat", [1.0, -2.0]), ("dog", [3.0, 4.0]), ("the", [-5.0, 0.5]), ("unused", [9.0, 9.0])],
        "word string, vec array<float>")


@pytest.mark.parametrize("how", ["mean", "max"])
def test_pooling_paths_agree(docs, embedding, how):
    expected = {"mean": {2: [7 / 3, 2.0], 5: [(-2000 + 1) / 401, (200 - 2) / 401]},
                "max": {2: [3.0, 4.0], 5: [1.0, 0.5]}}[how]
    for bound in (pooling.MAX_MATRIX_BYTES, 0):
        found = pooling.pool_words(docs, "id", "tokens", embedding, how, max_matrix_bytes=bound)
        rows = {r["id"]: r["features"] for r in found.collect()}
        assert len(rows) == len(DOCS) and rows[3] == rows[4] == [0.0, 0.0]
        assert close(rows[2], expected[2]) and close(rows[5], expected[5])


def test_weighted_pooling(docs, embedding):
    model = features.TfidfModel.fit(docs, "tokens", 3)
    assert model.terms == ["the", "cat", "dog"]
    idf = dict(zip(model.terms, model.idf))
    w = {"cat": idf["cat"], "dog": 2 * idf["dog"]}
    total = w["cat"] + 2 * w["dog"]
    expected = [(w["cat"] * c + 2 * w["dog"] * d) / total for c, d in ((1, 3), (-2, 4))]
    for bound in (pooling.MAX_MATRIX_BYTES, 0):
        found = pooling.pool_weighted(docs, "id", "tokens", embedding, model, 2, bound)
        rows = {r["id"]: r["features"] for r in found.collect()}
        assert rows[3] == rows[4] == [0.0, 0.0] and close(rows[2], expected)


def test_weighted_pooling_without_weight_is_the_mean(docs, embedding):
    model = features.TfidfModel.fit(docs, "tokens", 3)
    flat = features.TfidfModel(model.table.withColumn("idf", F.lit(0.0)), 3)
    rows = {r["id"]: r["features"]
            for r in pooling.pool_weighted(docs, "id", "tokens", embedding, flat, 2).collect()}
    assert close(rows[2], [7 / 3, 2.0])


def test_bag_of_terms(docs):
    vocab = features.vocabulary(docs, "tokens", 3)
    for bound in (3, 10**9):
        rows = features.bag_of_terms(docs, "id", "tokens", vocab, bound).collect()
        assert {(r["id"], r["idx"]): r["cnt"] for r in rows} == {
            (1, 1): 1, (2, 1): 1, (2, 2): 2, (5, 0): 400, (5, 1): 1}


ODD_ROWS = [(1, ["cat", "dog"]), (1, ["cat"]), (2, ["dog", "dog"]), (2, ["dog", "dog"]), (None, ["cat"]), (3, None)]


@pytest.mark.parametrize("how", ["mean", "max", "weighted"])
def test_pooling_sides_agree_on_repeats_and_nulls(spark, how):
    docs = spark.createDataFrame(ODD_ROWS, "id int, tokens array<string>")
    table = spark.createDataFrame(
        [("cat", [1.0, 2.0]), ("cat", [5.0, 6.0]), ("dog", None), ("dog", [3.0, 4.0]), (None, [0.0, 0.0])],
        "word string, vec array<float>")
    found = []
    for bound in (pooling.MAX_MATRIX_BYTES, 0):
        vectors = pooling.WordVectors(table, max_matrix_bytes=bound)
        if how == "weighted":
            model = features.TfidfModel.fit(docs, "tokens", 5, max_listed=bound)
            pooled = pooling.pool_weighted(docs, "id", "tokens", vectors, model, keep=("tokens",))
        else:
            pooled = pooling.pool_words(docs, "id", "tokens", vectors, how, keep=("tokens",))
        found.append(sorted(
            (repr((r.id, r.tokens)), [round(x, 9) for x in r.features]) for r in pooled.collect()))
    assert found[0] == found[1] and len(found[0]) == len(ODD_ROWS)
    assert dict(found[0])[repr((None, ["cat"]))] == [1.0, 2.0]


def test_lookup_sides_agree_on_repeats_and_nulls(spark):
    docs = spark.createDataFrame(ODD_ROWS, "id int, tokens array<string>")
    table = spark.createDataFrame([("cat", "b"), ("cat", "a"), (None, "x")], "token string, tag string")
    found = [
        sorted(repr((r.id, r.tokens, r.out)) for r in
               lookup.look_up_tokens(docs, "id", "tokens", table, "out", True, bound).collect())
        for bound in (100, 0)
    ]
    assert found[0] == found[1] and repr((1, ["cat", "dog"], ["a", "dog"])) in found[0]


def test_entries_agree_on_repeated_rows(spark):
    docs = spark.createDataFrame(ODD_ROWS, "id int, tokens array<string>")
    found = [
        sorted(repr((r.id, r.idx, r.cnt, round(r.tfidf_l2, 9))) for r in
               features.TfidfModel.fit(docs, "tokens", 5, bound).entries(docs, "id", "tokens").collect())
        for bound in (5, 0)
    ]
    assert found[0] == found[1]


def test_empty_vocabulary_and_one_beyond_the_list(spark):
    none = spark.createDataFrame([(1, [])], "id int, tokens array<string>")
    model = features.TfidfModel.fit(none, "tokens", 5)
    assert model.vectors(none, "tokens", "v").first()["v"].numNonzeros() == 0
    some = spark.createDataFrame([(1, ["a", "b"])], "id int, tokens array<string>")
    model = features.TfidfModel.fit(some, "tokens", 5, max_listed=0)
    assert model.vectors(some, "tokens", "v").first()["v"].numNonzeros() == 2


def test_fitting_leaves_no_python_rows(docs, capsys):
    # Rows handed over as Python objects would be read by a Python worker per core.
    for table in (features.fitted_vocabulary(docs, "tokens", 4), features.TfidfModel.fit(docs, "tokens", 4).table):
        table.select("idx", "term").explain()
        plan = capsys.readouterr().out
        assert "LocalTableScan" in plan and "ExistingRDD[idx" not in plan
