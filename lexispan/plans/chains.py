"""Queries that run models over tables.  The models are stubs with SQL twins."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import render_template
from lexispan.operators import prompts
from lexispan.operators.chains import route, run_chain, run_routed
from lexispan.operators.models import score_batches
from lexispan.plans import inputs, sql


def digest(prompt: str) -> str:
    return hashlib.md5(prompt.encode("utf-8")).hexdigest()


def stub_model(tag: str):
    """A model whose reply names itself and the prompt it saw."""

    def reply(batch: list[str]) -> list[str]:
        return [f"{tag}-{digest(prompt)[:12]}" for prompt in batch]

    return reply


def stub_router(choices: list[str]):
    """A router that picks by the prompt's digest and wraps its JSON in prose."""

    def reply(batch: list[str]) -> list[str]:
        out = []
        for prompt in batch:
            code = digest(prompt)
            number = int(code[0], 16) % 5
            choice = choices[number] if number < len(choices) else "elsewhere"
            body = json.dumps({"destination": choice, "next_inputs": f"about {code[:8]}"})
            out.append(f"Here you are:\n```json\n{body}\n```")
        return out

    return reply


def stub_sentiment():
    """Label by the parity of the number of letters e."""

    def predict(texts: np.ndarray) -> np.ndarray:
        return np.array(
            ["POSITIVE" if t.count("e") % 2 == 0 else "NEGATIVE" for t in texts], dtype=object
        )

    return predict


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir, "doc_id", "text").filter("text IS NOT NULL")
    return score_batches(docs, "text", stub_sentiment).select("doc_id", "pred")


def prompt_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.conversations(spark, sf_dir).withColumnRenamed("text", "review")
    spoken = turns.withColumn("language", F.when(F.col("conv_id") % 2 == 0, "French")
                              .otherwise("German"))
    return spoken.select(
        "conv_id", "turn", render_template(prompts.TRANSLATE_REVIEW).alias("prompt")
    )


def chain_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.conversations(spark, sf_dir).withColumnRenamed("text", "review")
    return run_chain(turns, prompts.review_reply_chain(stub_model("m"))).drop("review")


def _routed(spark: SparkSession, sf_dir: str, kind: str, choices: list[str]) -> DataFrame:
    turns = inputs.conversations(spark, sf_dir).withColumnRenamed("text", "input")
    router = prompts.router_stage(stub_router(choices), kind, choices)
    return route(turns, router, choices, "input", prompts.OTHER)


def chain_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = _routed(spark, sf_dir, "subject", prompts.SUBJECTS)
    answered = run_routed(routed, prompts.subject_chains(stub_model("a")))
    return answered.select("conv_id", "turn", "destination", "next_input", "text")


def chain_routed_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = _routed(spark, sf_dir, "category", prompts.PRODUCT_CATEGORIES)
    chains = prompts.product_chains(stub_model("n"), stub_model("w"))
    return run_routed(routed, chains).select(
        "conv_id", "turn", "destination", "name", "text"
    )


QUERIES = {f.__name__: f for f in [
    batch_score, prompt_template, chain_sequential, chain_router, chain_routed_sequential,
]}


def _filled(template: str, **columns: str) -> str:
    """SQL expression of a template; doubled braces do not occur in these."""
    text = sql.quoted(template)
    for name, column in columns.items():
        text = text.replace("{" + name + "}", f"' || {column} || '")
    return f"({text})"


def _reply(tag: str, prompt: str) -> str:
    return f"'{tag}-' || left(md5({prompt}), 12)"


def _routed_sql(kind: str, choices: list[str]) -> str:
    template = prompts.ROUTE.format(kind=kind, choices=", ".join(choices))
    picks = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(choices))
    return f"""
coded AS (
  SELECT conv_id, turn, md5({_filled(template, input='text')}) AS code FROM conversations),
routed AS (
  SELECT conv_id, turn, 'about ' || left(code, 8) AS next_input,
         CASE (instr('0123456789abcdef', left(code, 1)) - 1) % 5 {picks} ELSE 'None' END
           AS destination
  FROM coded)"""


def _by_destination(chains: dict, stage: int, tag: str, **columns: str) -> str:
    cases = " ".join(
        f"WHEN '{d}' THEN {_reply(tag, _filled(stages[stage].template, **columns))}"
        for d, stages in chains.items()
    )
    return f"CASE destination {cases} END"


_SUBJECT_CHAINS = prompts.subject_chains(stub_model("a"))
_PRODUCT_CHAINS = prompts.product_chains(stub_model("n"), stub_model("w"))

ORACLES = {
    "batch_score": """
SELECT doc_id, CASE WHEN (length(t) - length(replace(t, 'e', ''))) % 2 = 0 THEN 1 ELSE 0 END
         AS pred
FROM (SELECT doc_id, left(text, 512) AS t FROM documents WHERE text IS NOT NULL)""",
    "prompt_template": f"""
SELECT conv_id, turn, {_filled(prompts.TRANSLATE_REVIEW, language='language', review='text')}
         AS prompt
FROM (SELECT *, CASE WHEN conv_id % 2 = 0 THEN 'French' ELSE 'German' END AS language
      FROM conversations)""",
    "chain_sequential": f"""WITH
a AS (SELECT *, {_reply('m', _filled(prompts.LANGUAGE, review='text'))} AS language
      FROM conversations),
b AS (SELECT *, {_reply('m', _filled(prompts.TRANSLATE_REVIEW, language='language',
                                     review='text'))} AS english_review FROM a),
c AS (SELECT *, {_reply('m', _filled(prompts.SUMMARIZE, english_review='english_review'))}
        AS summary FROM b),
d AS (SELECT *, {_reply('m', _filled(prompts.REPLY, review='text', language='language',
                                     summary='summary'))} AS followup_message FROM c)
SELECT conv_id, turn, language, english_review, summary, followup_message,
       {_reply('m', _filled(prompts.TRANSLATE_REPLY, language='language',
                            followup_message='followup_message'))} AS "English_followup_message"
FROM d""",
    "chain_router": f"""WITH {_routed_sql('subject', prompts.SUBJECTS)}
SELECT conv_id, turn, destination, next_input,
       {_by_destination(_SUBJECT_CHAINS, 0, 'a', input='next_input')} AS text
FROM routed""",
    "chain_routed_sequential": f"""WITH
{_routed_sql('category', prompts.PRODUCT_CATEGORIES)},
named AS (
  SELECT *, {_by_destination(_PRODUCT_CHAINS, 0, 'n', input='next_input')} AS name FROM routed)
SELECT conv_id, turn, destination, name,
       {_by_destination(_PRODUCT_CHAINS, 1, 'w', input='next_input', name='name')} AS text
FROM named""",
}
