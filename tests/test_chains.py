import pytest
from pyspark.sql import functions as F

from lexispan.operators import chains
from lexispan.operators.chains import Stage


def echo(prompts):
    return [f"<{p}>" for p in prompts]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (3, None), (4, "{odd}")], "id int, input string")


def test_stages_see_earlier_variables(rows):
    stages = [Stage("a {input}", echo, "x"), Stage("{x} and {input}", echo, "y")]
    found = {r["id"]: (r["x"], r["y"]) for r in chains.run_chain(rows, stages).collect()}
    assert found[1] == ("<a one>", "<<a one> and one>")
    assert found[3] == ("<a >", "<<a > and >")
    assert found[4] == ("<a {odd}>", "<<a {odd}> and {odd}>")


def test_one_python_step_per_chain(rows):
    stages = [Stage("{input}", echo, n) for n in "abc"]
    plan = chains.run_chain(rows, stages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Exchange" not in plan


def test_wrong_number_of_replies(rows):
    with pytest.raises(Exception, match="prompts, but 0 replies"):
        chains.run_chain(rows, [Stage("{input}", lambda prompts: [], "x")]).collect()


def reply(prompts):
    known = {"one": '{"destination": "math", "next_inputs": "1!"}',
             "two": '{"destination": "cooking", "next_inputs": "2!"}',
             "": "no json", "{odd}": '{"destination": " math "}'}
    return [f"so: {known[p]}" for p in prompts]


def test_routes(rows):
    routed = chains.route(rows, Stage("{input}", reply, "r"), ["math"], "input")
    found = {r["id"]: (r["destination"], r["next_input"]) for r in routed.collect()}
    assert found == {1: ("math", "1!"), 2: ("None", "2!"), 3: ("None", None), 4: ("math", "{odd}")}


def test_routed_chains(rows):
    routed = chains.route(rows, Stage("{input}", reply, "r"), ["math"], "input").coalesce(1)
    done = chains.run_routed(routed, {
        "math": [Stage("m {input}", echo, "name"), Stage("{name}", echo, "text")],
        "None": [Stage("n {input}", echo, "text")],
    })
    found = {r["id"]: (r["name"], r["text"], r["input"]) for r in done.collect()}
    assert found == {
        1: ("<m 1!>", "<<m 1!>>", "one"), 2: (None, "<n 2!>", "two"),
        3: (None, "<n >", None), 4: ("<m {odd}>", "<<m {odd}>>", "{odd}")}


def test_plain_column_template(rows):
    from lexispan.functions.text import render_template

    out = rows.select("id", render_template("q: {input}").alias("p")).filter(F.col("id") == 3)
    assert out.first()["p"] == "q: "


def test_calls_are_cut_and_unknown_destinations_take_the_default(spark):
    def model(prompts):
        assert len(prompts) <= 2
        return [p.upper() for p in prompts]

    rows = [(i, d, f"t{i}") for i, d in enumerate(["a", None, "zzz", "a", "a"])]
    df = spark.createDataFrame(rows, "id int, destination string, next_input string")
    own = {"a": [Stage("A {input}", model, "text")], "None": [Stage("N {input}", model, "text")]}
    found = {r["id"]: r["text"] for r in chains.run_routed(df, own, batch_size=2).collect()}
    assert found == {0: "A T0", 1: "N T1", 2: "N T2", 3: "A T3", 4: "A T4"}
    alone = {r["id"]: r["text"] for r in chains.run_routed(df, {"a": own["a"]}, batch_size=2).collect()}
    assert alone == {0: "A T0", 1: None, 2: None, 3: "A T3", 4: "A T4"}
