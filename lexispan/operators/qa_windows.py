"""Overlapping context windows over plain tokens, with character offsets.

A window is laid out like a model input: one opening slot (the "no answer"
position 0), the question, a separator, then a stretch of the context and a
closing slot, padded to ``max_length``.  Everything happens inside the row of the
example; windows come out by one explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.functions.arrays import let

BLANKS = (" ", "\n", "\t")
OFFSET = "struct<s:int,e:int>"


def token_offsets(text: Column) -> Column:
    """``array<struct<s, e>>``: character range of each token, end excluded.

    Tokens are what lies between single blanks; empty ones are left out.  Finds
    the blanks once and reads the tokens off the gaps, in time linear in the text.
    """
    characters = F.regexp_extract_all(text, F.lit("(?s)."), 0)
    blanks = F.filter(
        F.transform(characters, lambda c, i: F.when(c.isin(*BLANKS), i)),
        lambda i: i.isNotNull(),
    )

    def gaps(edges: Column) -> Column:
        starts = F.slice(edges, 1, F.size(edges) - 1)
        ends = F.slice(edges, 2, F.size(edges) - 1)
        return F.filter(
            F.zip_with(
                starts, ends, lambda a, b: F.struct((a + 1).alias("s"), b.alias("e"))
            ),
            lambda o: o["e"] > o["s"],
        )

    edges = F.concat(F.array(F.lit(-1)), blanks, F.array(F.length(text)))
    return let(edges, gaps)


def token_texts(text: Column) -> Column:
    """The tokens that ``token_offsets`` describes."""
    return F.filter(F.split(text, "[ \n\t]"), lambda t: t != "")


def window_count(tokens: Column, capacity: Column, step: Column) -> Column:
    beyond = F.ceil((tokens - capacity) / step).cast("int") + 1
    return F.when(tokens <= capacity, 1).otherwise(beyond)


def context_windows(
    examples: DataFrame,
    key: str = "example_id",
    question: str = "question",
    context: str = "context",
    max_length: int = 384,
    stride: int = 128,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per window: ``(key, keep.., window_idx, first_token, shift, offsets)``.

    ``offsets`` are the character ranges of the window's context tokens; the first
    of them stands at position ``shift`` of the input and is token ``first_token``
    of the context.  Neighbouring windows share ``stride`` tokens.
    """
    sized = examples.select(
        key, *keep,
        F.size(token_texts(F.col(question))).alias("_question"),
        token_offsets(F.col(context)).alias("_offsets"),
    )
    capacity = F.lit(max_length) - F.col("_question") - 3
    step = capacity - stride
    checked = F.when(step > 0, step).otherwise(
        F.raise_error("stride leaves no room: question too long for max_length")
    )
    planned = sized.select(
        "*", capacity.alias("_capacity"), checked.cast("int").alias("_step")
    )
    windows = window_count(F.size("_offsets"), F.col("_capacity"), F.col("_step"))
    numbered = planned.select(
        key, *keep, "_question", "_step", "_capacity", "_offsets",
        F.explode(F.sequence(F.lit(0), windows - 1)).alias("window_idx"),
    )
    first = F.col("window_idx") * F.col("_step")
    return numbered.select(
        key, *keep, "window_idx",
        first.alias("first_token"),
        (F.col("_question") + 2).alias("shift"),
        F.slice("_offsets", first + 1, F.col("_capacity")).alias("offsets"),
    )


def masked_offsets(shift: Column, offsets: Column, max_length: int) -> Column:
    """Offsets for every input position, (0, 0) where it is not context."""
    outside = F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"))
    before = F.array_repeat(outside, shift)
    after = F.array_repeat(outside, F.lit(max_length) - shift - F.size(offsets))
    return F.concat(before, offsets, after)


def answer_positions(
    shift: Column, offsets: Column, answer: Column, start: Column
) -> Column:
    """``struct<start_position, end_position>`` of an answer in one window.

    The start is the last token that begins at or before the answer, the end the
    first token that ends at or after it; both are 0 when there is no answer or
    the window does not hold all of it.
    """
    end = start + F.length(answer)
    inside = (
        answer.isNotNull()
        & (F.get(offsets, F.lit(0))["s"] <= start)
        & (end <= F.get(offsets, F.size(offsets) - 1)["e"])
    )
    begun = F.size(F.filter(offsets, lambda o: o["s"] <= start))
    ended = F.size(F.filter(offsets, lambda o: o["e"] < end))
    return F.struct(
        F.when(inside, shift + begun - 1).otherwise(0).cast("int").alias("start_position"),
        F.when(inside, shift + ended).otherwise(0).cast("int").alias("end_position"),
    )


def train_features(
    examples: DataFrame,
    key: str = "example_id",
    question: str = "question",
    context: str = "context",
    answers: str = "answers",
    max_length: int = 384,
    stride: int = 128,
) -> DataFrame:
    """Windows with the token span of the first gold answer.

    ``answers`` is ``struct<text array<string>, answer_start array<int>>``.
    """
    prepared = examples.select(
        key, question, context,
        F.get(F.col(f"{answers}.text"), F.lit(0)).alias("_answer"),
        F.get(F.col(f"{answers}.answer_start"), F.lit(0)).alias("_start"),
    )
    windows = context_windows(
        prepared, key, question, context, max_length, stride, ("_answer", "_start")
    )
    span = answer_positions(
        F.col("shift"), F.col("offsets"), F.col("_answer"), F.col("_start")
    )
    return windows.select("*", span.alias("_span")).select(
        *[c for c in windows.columns if not c.startswith("_")], "_span.*"
    )


def eval_features(
    examples: DataFrame,
    key: str = "example_id",
    question: str = "question",
    context: str = "context",
    max_length: int = 384,
    stride: int = 128,
) -> DataFrame:
    """Windows with their context and the offsets of all ``max_length`` positions."""
    windows = context_windows(
        examples, key, question, context, max_length, stride, (context,)
    )
    return windows.select(
        key, "window_idx", context,
        masked_offsets(F.col("shift"), F.col("offsets"), max_length).alias("offsets"),
    )
