"""Large JSON and CSV files read by byte ranges, against Python's own parsers."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispan.sources import corpora, qa, ranges
from lexispan.sources.ranges import CsvRecords, JsonRecords, records

PARTS = ["a", ",", '"', "\\", "{", "}", "[", "]", "é", "\n", "\r\n", " ", "漢", '","', '"}', '":[{', "\\\\\"", "x" * 40]


@pytest.fixture
def small_ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}

    def set_to(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], str(min(size, 100)))

    yield set_to
    for key, value in before.items():
        spark.conf.set(key, value)


def awkward(rng, n):
    return "".join(rng.choice(PARTS) for _ in range(rng.randrange(n)))


@pytest.mark.parametrize(("size", "indent"), [(197, None), (997, 1)])
def test_json_map(spark, tmp_path, small_ranges, size, indent):
    rng = random.Random(size)
    members = {f"{i}{awkward(rng, 4)}": awkward(rng, 30 if size > 500 else 5) for i in range(100)}
    members["long"] = awkward(rng, 1000)
    path = tmp_path / "map.json"
    path.write_text(json.dumps(members, indent=indent, ensure_ascii=False), encoding="utf-8", newline="")
    small_ranges(size)
    read = qa.read_prediction_map(spark, str(path))
    assert {r.qid: r.text for r in read.collect()} == members
    assert read.rdd.getNumPartitions() > 10
    qa.write_prediction_map(read, str(tmp_path / "again.json"))
    assert json.loads((tmp_path / "again.json").read_text("utf-8")) == members
    qa.write_prediction_map(read, str(tmp_path / "parts"), single_file=False)
    joined = "".join(f.read_text("utf-8") for f in sorted((tmp_path / "parts").glob("part-*")))
    assert json.loads(joined) == members
    again = qa.read_prediction_map(spark, str(tmp_path / "parts"), one_document=True)
    assert {r.qid: r.text for r in again.collect()} == members


def test_json_numbers_nulls_and_repeats(spark, tmp_path):
    (tmp_path / "n.json").write_text('\n{ "a" : 1, "b":-2.5e3 ,"c":null, "a": 7, "d": "x"}\n')
    rows = qa.read_na_prob_map(spark, str(tmp_path / "n.json")).collect()
    assert sorted((r.qid, r.na_prob or 0) for r in rows if r.qid != "d") == [("a", 1), ("a", 7), ("b", -2500), ("c", 0)]
    for text in ("{}", " { } ", '{"x":{}}'):
        (tmp_path / "n.json").write_text(text)
        rows = qa.read_na_prob_map(spark, str(tmp_path / "n.json")).collect()
        assert [r for r in rows if r.na_prob is not None] == []


def test_map_of_repeated_null_and_no_keys(spark, tmp_path):
    table = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3"), ("b", None), ("", "e")], "qid string, text string")
    qa.write_prediction_map(table, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"": "e", "a": "2", "b": None}
    qa.write_prediction_map(table.limit(0), str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {}
    assert qa.read_prediction_map(spark, str(tmp_path / "m.json")).collect() == []


def articles(rng, n):
    def paragraph(i):
        return {"context": awkward(rng, 20), "qas": [
            {"id": f"{i}.{k}", "question": awkward(rng, 8), "is_impossible": k == 0,
             "answers": [{"text": awkward(rng, 4), "answer_start": k}] * k} for k in range(rng.randrange(3))]}

    return [{"title": f"t{i}", "paragraphs": [paragraph(i) for _ in range(rng.randrange(4))]} for i in range(n)]


@pytest.mark.parametrize(("size", "indent"), [(151, None), (2011, 2)])
def test_nested_document(spark, tmp_path, small_ranges, size, indent):
    rng = random.Random(size)
    data = articles(rng, 6 if size < 200 else 40)
    other = {"notes": [{"title": "not one", "paragraphs": []}], "meta": {"data": [1, {"a": "]"}]}}
    for k, document in enumerate([
        {"version": "v2.0", "data": data}, {**other, "data": data, "version": "v", "more": other["notes"]},
    ]):
        (tmp_path / f"dev{k}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=False), "utf-8", newline="")
    small_ranges(size)
    read = qa.read_document(spark, *[str(tmp_path / f"dev{k}.json") for k in range(2)])
    got = sorted((json.loads(row) for row in read.toJSON().collect()), key=lambda a: (a["title"], str(a)))
    assert got == sorted(data + data, key=lambda a: (a["title"], str(a)))
    small_ranges(1 << 20)
    assert sorted(read.toJSON().collect()) == sorted(qa.read_nested(spark, str(tmp_path)).toJSON().collect())


def test_a_new_setting_does_not_move_the_ranges(spark, tmp_path, small_ranges):
    members = {str(i): "x, y" for i in range(500)}
    (tmp_path / "m.json").write_text(json.dumps(members))
    small_ranges(300)
    read = qa.read_prediction_map(spark, str(tmp_path / "m.json"))
    small_ranges(777)
    assert {r.qid: r.text for r in read.collect()} == members


def test_written_document(spark, tmp_path):
    rows = [("1", "T", "q", "c \"1\"\n", (["c"], [0])), ("2", None, "q", "c", ([], [])), ("3", "T", None, None, (["x", "y"], [1, 2]))]
    table = spark.createDataFrame(rows, qa.EXAMPLE_SCHEMA)
    qa.write_document(table, str(tmp_path / "d.json"), version="v1")
    document = json.loads((tmp_path / "d.json").read_text())
    assert document["version"] == "v1" and [a["title"] for a in document["data"]] == ["T", "default"]
    flat = qa.flatten_articles(qa.read_document(spark, str(tmp_path / "d.json")))
    assert sorted((r.id, r.title, r.context, r.has_ans) for r in flat.collect()) == [
        ("1", "T", "c \"1\"\n", True), ("2", "default", "c", False), ("3", "T", None, True)]
    qa.write_document(table.limit(0), str(tmp_path / "e.json"))
    assert json.loads((tmp_path / "e.json").read_text())["data"] == []


@pytest.mark.parametrize(("size", "end"), [(97, "\n"), (2009, "\r\n")])
def test_csv(spark, tmp_path, small_ranges, size, end):
    rng = random.Random(size)
    rows = [(str(i), awkward(rng, 12).replace("\r", ""), f"s{i % 3}", "") for i in range(20 if size < 100 else 200)]
    rows.append(("long", '"quoted",\n' * 80, "", "d"))
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["ti\ntle", "text", "subject", "date"])
    writer.writerows(rows)
    (tmp_path / "news.csv").write_bytes(out.getvalue().encode())
    (tmp_path / "other.csv").write_text("title,text,subject,date\nlast,without end,,")
    small_ranges(size)
    read = corpora.labelled_csv(spark, {str(tmp_path / "news.csv"): -1, str(tmp_path / "other.csv"): 1})
    got = sorted((r.title, r.text or "", r.subject or "", r.date or "", r.label) for r in read.collect())
    assert got == sorted([(*r, -1) for r in rows] + [("last", "without end", "", "", 1)])


def test_csv_written_and_read(spark, tmp_path, small_ranges):
    rng = random.Random(3)
    rows = [(f"t{i}", awkward(rng, 9) or "x", None, " s ") for i in range(100)] + [("n", None, None, "x")]
    table = spark.createDataFrame(rows, corpora.NEWS_SCHEMA)
    corpora.write_csv(table.repartition(3), str(tmp_path / "out"))
    small_ranges(400)
    again = corpora.read_csv(spark, str(tmp_path / "out"), corpora.NEWS_SCHEMA)
    assert sorted(map(repr, map(tuple, again.collect()))) == sorted(map(repr, rows))


def test_reading_tasks_follow_the_ranges(spark, tmp_path, small_ranges):
    (tmp_path / "one.csv").write_text("title,text,subject,date\n" + 'a,"b\nc",d,e\n' * 5000)
    small_ranges(2000)
    read = corpora.read_csv(spark, str(tmp_path / "one.csv"), corpora.NEWS_SCHEMA)
    plan = read.select("title")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    found = records(spark, [str(tmp_path / "one.csv")], CsvRecords())
    assert found.select("start").distinct().count() >= 30
    assert read.count() == 5000


def test_empty_files(spark, tmp_path):
    for name, text in (("a.csv", ""), ("b.csv", "title,text,subject,date"), ("c.csv", "title,text,subject,date\n\n\n")):
        (tmp_path / name).write_text(text)
        assert corpora.read_csv(spark, str(tmp_path / name), corpora.NEWS_SCHEMA).collect() == []
    (tmp_path / "a.json").write_text("")
    assert records(spark, [str(tmp_path / "a.json")], JsonRecords(1)).collect() == []


def test_records_keep_their_order(spark, tmp_path, small_ranges):
    (tmp_path / "m.json").write_text(json.dumps({str(i): "y" * (i % 50) for i in range(500)}))
    small_ranges(200)
    found = records(spark, [str(tmp_path / "m.json")], JsonRecords(1)).orderBy("start", "seq")
    keys = found.select(F.regexp_extract("record", r'"(\d+)"', 1).cast("int").alias("k")).collect()
    assert [r.k for r in keys] == list(range(500))


def test_a_batch_is_read_in_parts(monkeypatch):
    monkeypatch.setattr(ranges, "BYTES_AT_ONCE", 10)
    pieces = [b"abc", b"", b"d" * 30, b"ef", b"ghij", b"klmno", b"p"]
    batch = pa.record_batch({"file": pa.array(["f"] * 7), "start": pa.array([0] * 7, pa.int64()), "piece": pa.array(pieces)})
    texts = [text for *_, text in ranges._runs([batch, batch.slice(0, 0)], b"\n")]
    assert b"".join(texts) == b"\n".join(pieces) + b"\n"
    assert all(len(t) <= 20 or t.count(b"\n") == 1 for t in texts) and len(texts) > 2
