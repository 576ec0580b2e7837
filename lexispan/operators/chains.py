"""Prompt chains over tables; the model is a function given by the caller.

A model function takes a list of prompts and returns as many replies.  Rows stay
in their partitions: a chain is one ``mapInPandas``, in which every stage of a
batch sees the replies of the stages before it.  Retries and rate limits belong
to the function; save the result before using it twice, or the model runs twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexispan.functions.text import parse_route, template_parts

Model = Callable[[list[str]], list[str]]
BATCH_SIZE = 256


@dataclass(frozen=True)
class Stage:
    """Fill ``template``, send it to ``model``, store the reply as ``output``."""

    template: str
    model: Model
    output: str


def _fill(template: str, batch: pd.DataFrame) -> list[str]:
    parts = template_parts(template)
    columns = {name: batch[name].fillna("") for _, name in parts if name is not None}
    pieces = [
        [literal] * len(batch) if name is None
        else [f"{literal}{value}" for value in columns[name]]
        for literal, name in parts
    ]
    return ["".join(row) for row in zip(*pieces)] if pieces else [""] * len(batch)


def _ask(model: Model, prompts: list[str], batch_size: int) -> list[str]:
    """The replies to all prompts, asked for in calls of at most ``batch_size``."""
    replies = []
    for start in range(0, len(prompts), batch_size):
        part = prompts[start: start + batch_size]
        answers = list(model(part))
        if len(answers) != len(part):
            raise ValueError(f"{len(part)} prompts, but {len(answers)} replies")
        replies += answers
    return replies


def _run_stages(stages: Sequence[Stage], batch: pd.DataFrame, batch_size: int) -> pd.DataFrame:
    for stage in stages:
        replies = _ask(stage.model, _fill(stage.template, batch), batch_size)
        batch = batch.assign(**{stage.output: pd.Series(replies, batch.index, "object")})
    return batch


def _with_outputs(df: DataFrame, outputs: Sequence[str]) -> StructType:
    kept = [f for f in df.schema.fields if f.name not in outputs]
    return StructType(kept + [StructField(o, StringType()) for o in outputs])


def run_chain(
    df: DataFrame, stages: Sequence[Stage], batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Add one column per stage; a stage may use any earlier variable."""
    schema = _with_outputs(df, list(dict.fromkeys(s.output for s in stages)))
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _run_stages(stages, batch, batch_size)[names]

    return df.mapInPandas(run, schema)


def route(
    df: DataFrame, router: Stage, destinations: Sequence[str], input_column: str,
    default: str = "None",
) -> DataFrame:
    """Add ``destination`` and ``next_input`` from the router model's reply.

    The reply is parsed by Spark expressions.  An unknown or missing destination
    becomes ``default``; without ``next_inputs`` the original input goes on.
    """
    asked = run_chain(df, [router])
    parsed = asked.withColumn("_route", parse_route(F.col(router.output)))
    name = F.trim("_route.destination")
    return parsed.select(
        *[c for c in asked.columns if c != router.output],
        F.when(name.isin(*destinations), name).otherwise(default).alias("destination"),
        F.coalesce("_route.next_inputs", input_column).alias("next_input"),
    )


def run_routed(
    routed: DataFrame, chains: Mapping[str, Sequence[Stage]], input_variable: str = "input",
    default: str = "None", batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Run on each row the chain of its ``destination``.

    A null destination, or one without a chain, takes the chain of ``default``; where
    there is none either, the outputs stay null.  Templates see the routed text under ``input_variable``.  The rows of a batch
    are handled chain by chain and come back in their order, so no shuffle and no
    union of filtered copies is needed.
    """
    outputs = list(dict.fromkeys(s.output for c in chains.values() for s in c))
    schema = _with_outputs(routed, outputs)
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            answers = {o: pd.Series(None, batch.index, "object") for o in outputs}
            known = batch["destination"].where(batch["destination"].isin(list(chains)), default)
            for destination, rows in batch.groupby(known, sort=True):
                view = rows.assign(**{input_variable: rows["next_input"]})
                stages = chains.get(destination, ())
                done = _run_stages(stages, view, batch_size)
                for stage in stages:
                    answers[stage.output].loc[rows.index] = done[stage.output]
            yield batch.assign(**answers)[names]

    return routed.mapInPandas(run, schema)
