import json

import pytest
from pyspark.sql import functions as F

from lexispan.sources import corpora, qa, tables

EXAMPLES = [
    {"id": "1", "title": "T", "question": "q1", "context": "c é 1",
     "answers": {"text": ["c", "é"], "answer_start": [0, 2]}},
    {"id": "2", "title": "T", "question": "q2", "context": "c2",
     "answers": {"text": [], "answer_start": []}},
    {"id": "3", "title": None, "question": "q3", "context": "c3",
     "answers": {"text": ["c3"], "answer_start": [0]}},
]


@pytest.fixture
def examples(spark, tmp_path):
    path = tmp_path / "examples.json"
    path.write_text("\n".join(json.dumps(e) for e in EXAMPLES), encoding="utf-8")
    return qa.read_examples(spark, str(path))


def plain(rows):
    return sorted(
        (r["id"], r["title"], r["question"], r["context"], tuple(r["answers"]["text"]),
         tuple(r["answers"]["answer_start"])) for r in rows)


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "fake.csv").write_text('title,text,subject,date\na,"line 1\nline ""2"", end",s,d\nb,,s,d\n')
    (tmp_path / "true.csv").write_text("title,text,subject,date\nc,plain,s,d\n")
    paths = {str(tmp_path / "fake.csv"): -1, str(tmp_path / "true.csv"): 1}
    rows = corpora.labelled_csv(spark, paths).collect()
    assert sorted((r["label"], r["title"], r["text"]) for r in rows) == [
        (-1, "a", 'line 1\nline "2", end'), (-1, "b", None), (1, "c", "plain")]
    kept = corpora.labelled_csv(spark, paths).na.drop(subset=["text"])
    assert {r["text"] for r in kept.collect()} == {'line 1\nline "2", end', "plain"}


def test_reviews(spark, tmp_path):
    head = "Id,ProductId,UserId,ProfileName,HelpfulnessNumerator,HelpfulnessDenominator,Score,Time,Summary,Text"
    lines = [f"{i},p,u,n,0,0,{score},0,s,{text}" for i, (score, text) in enumerate(
        [(5, "x"), (4, "y"), (3, "z"), (1, "w"), ("", "v"), (2, "")])]
    (tmp_path / "r.csv").write_text("\n".join([head, *lines]) + "\n")
    rows = corpora.labelled_reviews(corpora.reviews_csv(spark, str(tmp_path / "r.csv"))).collect()
    assert {(r["Text"], r["label"]) for r in rows} == {("x", 1), ("y", 1), ("w", 0)}


def test_nested_round_trip(spark, tmp_path, examples):
    qa.write_nested(examples, str(tmp_path / "nested"))
    flat = qa.flatten_articles(qa.read_articles(spark, str(tmp_path / "nested"))).collect()
    expected = [dict(e, title=e["title"] or "default") for e in EXAMPLES]
    assert plain(flat) == plain(expected)
    assert {r["id"]: r["has_ans"] for r in flat} == {"1": True, "2": False, "3": True}


def test_whole_document(spark, tmp_path, examples):
    data = [json.loads(line) for line in qa.nest_examples(examples).drop("part").toJSON().collect()]
    path = tmp_path / "dev.json"
    path.write_text(json.dumps({"version": "v2.0", "data": data}, indent=2), encoding="utf-8")
    assert qa.flatten_articles(qa.read_nested(spark, str(path))).count() == 3
    assert qa.answerable(examples).count() == 2


def test_crowded_title_is_split_and_kept_whole(spark):
    rows = [(str(i), "hot" if i % 3 else f"t{i}", "q", "c", (["c"], [0])) for i in range(300)]
    many = spark.createDataFrame(rows, qa.EXAMPLE_SCHEMA)
    nested = qa.nest_examples(many, max_bytes=40)
    hot = [len(r["paragraphs"]) for r in nested.filter("title = 'hot'").collect()]
    assert sum(hot) == 200 and len(hot) > 5 and max(hot) < 60
    flat = qa.flatten_articles(nested)
    assert flat.count() == 300 and flat.select("id").distinct().count() == 300


def test_prediction_maps(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"1": "é", "2": ""}, ensure_ascii=False, indent=2), "utf-8")
    (tmp_path / "n.json").write_text(json.dumps({"1": -3.5, "2": 1}))
    preds = qa.read_prediction_map(spark, str(tmp_path / "p.json"))
    assert {r["qid"]: r["text"] for r in preds.collect()} == {"1": "é", "2": ""}
    probs = qa.read_na_prob_map(spark, str(tmp_path / "n.json"))
    assert {r["qid"]: r["na_prob"] for r in probs.collect()} == {"1": -3.5, "2": 1.0}
    qa.write_predictions(preds, str(tmp_path / "out"))
    again = qa.read_predictions(spark, str(tmp_path / "out"))
    assert preds.exceptAll(again).count() == again.exceptAll(preds).count() == 0
    text = "".join(f.read_text("utf-8") for f in (tmp_path / "out").glob("*.json"))
    assert "é" in text


def test_metrics_sink(spark, tmp_path):
    metrics = spark.createDataFrame([("exact", 50.0)], "metric string, value double")
    qa.write_metrics(metrics, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["value"] == 50.0


def test_materialised(spark, tmp_path):
    path, built = str(tmp_path / "kept"), []

    def build():
        built.append(1)
        return spark.range(3).select(F.array(F.col("id").cast("string")).alias("t"))

    for _ in range(2):
        assert tables.materialised(spark, path, build).count() == 3
    assert len(built) == 1
    (tmp_path / "kept" / "_SUCCESS").unlink()
    assert tables.materialised(spark, path, build).count() == 3 and len(built) == 2


def test_scan_prunes_columns(spark):
    df = tables.scan(spark, "/root/testdata/sf0.001/documents.parquet", "doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "Exchange" not in plan
