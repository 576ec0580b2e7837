"""The evaluator against a row-by-row scan, and windows and spans by hand."""

import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexispan.operators import qa_eval, qa_select, qa_windows


def norm(text):
    text = "".join(c for c in text.lower() if c not in string.punctuation)
    return " ".join(re.sub(r"\b(a|an|the)\b", " ", text).split())


def scan(gold, predictions, na_probs, threshold):
    """What the evaluator must find, question by question."""
    exact, f1 = {}, {}
    for qid, golds in gold.items():
        if qid not in predictions:
            continue
        forms = [norm(g) for g in golds if norm(g)] or [""]
        answer = norm(predictions[qid])
        exact[qid] = float(answer in forms)
        scores = []
        for form in forms:
            g, p = form.split(), answer.split()
            same = sum((Counter(g) & Counter(p)).values())
            if not g or not p:
                scores.append(float(g == p))
            else:
                scores.append(2 * same / (len(g) + len(p)))
        f1[qid] = max(scores)
    record = {}
    slices = {"": exact, "HasAns_": [q for q in exact if gold[q]],
              "NoAns_": [q for q in exact if not gold[q]]}
    for prefix, members in slices.items():
        if members:
            for name, scores in (("exact", exact), ("f1", f1)):
                values = [float(not gold[q]) if na_probs[q] > threshold else scores[q]
                          for q in members]
                record[prefix + name] = 100 * sum(values) / len(values)
            record[prefix + "total"] = len(members)
    order = sorted(exact, key=lambda q: (na_probs[q], q))
    positives = sum(1 for g in gold.values() if g)
    for name, scores in (("exact", exact), ("f1", f1)):
        now = best = sum(1 for g in gold.values() if not g)
        at = 0.0
        for qid in order:
            now += scores[qid] if gold[qid] else -1 if predictions[qid] else 0
            if now > best + 1e-9:
                best, at = now, na_probs[qid]
        record[f"best_{name}"] = 100 * best / len(exact)
        record[f"best_{name}_thresh"] = at
    for name, scores in (("exact", exact), ("f1", f1), ("oracle", None)):
        hits, recall, area = 0.0, 0.0, 0.0
        for i, qid in enumerate(order):
            if gold[qid]:
                hits += 1 if scores is None else scores[qid]
            if i + 1 == len(order) or na_probs[order[i + 1]] != na_probs[qid]:
                area += hits / (i + 1) * (hits / positives - recall)
                recall = hits / positives
        record[f"pr_{name}_ap"] = 100 * area
    return record


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_evaluation(spark, seed):
    rng = random.Random(seed)
    words = ["the", "cat", "sat", "on", "a", "mat", "Mat!", "x", "x"]

    def phrase():
        return " ".join(rng.choices(words, k=rng.randrange(0, 5)))

    gold = {f"q{i}": [phrase() for _ in range(rng.randrange(0, 4))] for i in range(200)}
    predictions = {
        q: rng.choice([phrase(), "", golds[0] if golds else "x"])
        for q, golds in gold.items() if rng.random() < 0.9
    } | {"stranger": "x"}
    na_probs = {q: 0.25 if rng.random() < 0.4 else rng.choice([-3.0, 0.0, 0.9, 1.0, 7.5])
                for q in gold}
    tables = (
        spark.createDataFrame(list(gold.items()), "qid string, golds array<string>"),
        spark.createDataFrame(list(predictions.items()), "qid string, text string"),
        spark.createDataFrame(list(na_probs.items()), "qid string, na_prob double"),
    )
    found = {r["metric"]: r["value"] for r in qa_eval.evaluate(*tables, 0.5).collect()}
    assert found == pytest.approx(scan(gold, predictions, na_probs, 0.5))
    for name in ("exact", "f1"):
        assert found[name] * found["total"] == pytest.approx(
            found[f"HasAns_{name}"] * found["HasAns_total"]
            + found[f"NoAns_{name}"] * found["NoAns_total"])
    missing = {r["qid"] for r in qa_eval.missing_predictions(*tables[:2]).collect()}
    assert missing == set(gold) - set(predictions)


def test_evaluation_without_scores_or_slices(spark):
    gold = spark.createDataFrame([("a", ["x"]), ("b", ["the"])], "qid string, golds array<string>")
    preds = spark.createDataFrame([("a", "y"), ("b", "")], "qid string, text string")
    found = {r["metric"]: r["value"] for r in qa_eval.evaluate(gold, preds).collect()}
    assert found == {"exact": 50, "f1": 50, "total": 2,
                     "HasAns_exact": 50, "HasAns_f1": 50, "HasAns_total": 2}


def test_no_gain_means_threshold_zero(spark):
    gold = spark.createDataFrame([("a", ["x"]), ("b", [])], "qid string, golds array<string>")
    preds = spark.createDataFrame([("a", "y"), ("b", "z")], "qid string, text string")
    probs = spark.createDataFrame([("a", 0.4), ("b", None)], "qid string, na_prob double")
    scores = qa_eval.with_na_prob(qa_eval.raw_scores(gold, preds), probs)
    found = {r["metric"]: r["value"] for r in qa_eval.best_thresholds(scores, 1).collect()}
    assert found == {"best_exact": 50, "best_exact_thresh": 0, "best_f1": 50, "best_f1_thresh": 0}


def test_histogram_edges(spark):
    rows = [("a", True, 0.0), ("b", True, 1.0), ("c", True, 1.5), ("d", True, 0.049), ("e", False, -1.0)]
    df = spark.createDataFrame(rows, "qid string, has_ans boolean, na_prob double")
    found = {(r["has_ans"], r["bin"]): r["share"] for r in qa_eval.na_histogram(df).collect()}
    assert found == {(True, 1): 0.5, (True, 20): 0.25}


@pytest.mark.parametrize("n, expected", [(0, 1), (10, 1), (11, 2), (17, 2), (18, 3)])
def test_window_tail(spark, n, expected):
    # Capacity 15 - 2 - 3 = 10, overlap 3.
    context = " ".join("w" * (i % 3 + 1) for i in range(n))
    df = spark.createDataFrame([("e", "two words", context)], "example_id string, question string, context string")
    windows = qa_windows.context_windows(df, max_length=15, stride=3).orderBy("window_idx").collect()
    assert len(windows) == expected
    assert [w["first_token"] for w in windows] == [7 * k for k in range(expected)]
    assert windows[-1]["first_token"] + len(windows[-1]["offsets"]) == n


def test_offsets(spark):
    text = "ab  c\n\tdé 😀x "
    df = spark.createDataFrame([(text,)], "t string")
    offsets = df.select(qa_windows.token_offsets(F.col("t"))).first()[0]
    assert [text[o["s"]:o["e"]] for o in offsets] == text.split()


def test_no_room_is_an_error(spark):
    df = spark.createDataFrame([("e", "two words", "a b")], "example_id string, question string, context string")
    with pytest.raises(Exception, match="stride leaves no room"):
        qa_windows.context_windows(df, max_length=8, stride=3).collect()


def test_answer_alignment(spark):
    context = " ".join(f"w{i:02d}" for i in range(18))
    rows = [("in", "w03 w04", 12), ("part", "03 w0", 13), ("edge", "w09 w10", 36), ("none", None, None)]
    df = spark.createDataFrame(
        [(i, "two words", context, ([t] if t else [], [s] if t else [])) for i, t, s in rows],
        "example_id string, question string, context string, "
        "answers struct<text:array<string>,answer_start:array<int>>")
    found = {(r["example_id"], r["window_idx"]): (r["start_position"], r["end_position"])
             for r in qa_windows.train_features(df, max_length=15, stride=3).collect()}
    assert found[("in", 0)] == (7, 8) and found[("in", 1)] == (0, 0)
    assert found[("part", 0)] == (7, 8)
    # Cut by the end of the first window, whole in the second (tokens 7 to 16).
    assert found[("edge", 0)] == (0, 0) and found[("edge", 1)] == (6, 7)
    assert {found[("none", k)] for k in range(3)} == {(0, 0)}


def test_masked_offsets(spark):
    df = spark.createDataFrame([("e", "two words", "ab cd")], "example_id string, question string, context string")
    row = qa_windows.eval_features(df, max_length=9, stride=1).first()
    assert [tuple(o) for o in row["offsets"]] == [(0, 0)] * 4 + [(0, 2), (3, 5)] + [(0, 0)] * 3
    assert row["context"] == "ab cd"


OFFSETS = [(0, 0), (0, 0), (0, 2), (3, 5), (6, 8), (9, 11)]
CONTEXT = "aa bb cc dd"


def windows(spark, *scores):
    rows = [("e", i, CONTEXT, OFFSETS, [float(x) for x in a], [float(x) for x in b])
            for i, (a, b) in enumerate(scores)]
    return spark.createDataFrame(
        rows, "example_id string, window_idx int, context string, "
        "offsets array<struct<s:int,e:int>>, start_logits array<double>, end_logits array<double>")


def test_swapped_ends(spark):
    df = windows(spark, ([0, 0, 1, 0, 0, 9.0], [0, 0, 8.0, 0, 0, 2]))
    row = qa_select.spans(df).first()
    assert (row["text"], row["score"], row["na_score"]) == ("aa bb cc dd", 3.0, 0.0)


def test_ties_between_windows(spark):
    first = ([0, 0, 5.0, 0, 0, 0], [0, 0, 5.0, 0, 0, 0])
    second = ([0, 0, 0, 5.0, 0, 0], [0, 0, 0, 5.0, 0, 0])
    # Ends out of order: the score is read at the other two positions.
    third = ([4, 0, 1, 0, 0, 9], [3, 0, 8, 0, 0, 1])
    df = windows(spark, first, second)
    assert qa_select.best_window(df).first()["text"] == "aa"
    assert qa_select.last_window(df).first()["text"] == "bb"
    df = windows(spark, first, third)
    assert tuple(qa_select.last_window(df).first()) == ("e", "", 7.0)
    assert qa_select.last_window(df, 5.0).first()["text"] == "aa bb cc dd"
    answers = [r["answer"] for r in qa_select.no_answer_decisions(df).orderBy("window_idx").collect()]
    assert answers == ["aa", ""]
