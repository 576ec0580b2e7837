"""Tags that depend on their context: a bigram model learnt from a tagged table.

Counts of (token, tag) and (tag before, tag) become whole-number costs, thousandths of a
negative logarithm with one added to each count.  The tags of a sentence are the path of
least cost (Viterbi), found for all sentences of a batch at once, a position at a time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexispan.operators.bounded import broadcast_if_small
from lexispan.operators.list_slices import in_slices, lists_of, offsets_of
from lexispan.operators.lookup import MAX_DICTIONARY_ROWS, look_up_tokens
from lexispan.operators.unnest import unnest
from lexispan.session import ship_package
from lexispan.sources.scratch import stored

#: The tag before the first token.
START = ""


@dataclass
class TagModel:
    """Costs by tag in the order of ``tags``.

    ``emissions(token, costs)`` has the costs of a token as text, numbers joined by commas;
    ``unknown`` are those of a token that was not seen.  ``transitions`` has a row per tag
    before, the start first.
    """

    tags: list[str]
    transitions: list[list[int]]
    emissions: DataFrame
    unknown: list[int]


def _cost(count: int, total: int, kinds: int) -> int:
    return round(1000 * math.log((total + kinds) / (count + 1)))


def fit_tags(
    tagged: DataFrame, sentence: Sequence[str], position: str, token: str = "token", tag: str = "tag",
) -> TagModel:
    """Learn from ``(sentence.., position, token, tag)``, one row per token.

    Rows without a token or tag are left out, and what follows them follows the token
    before.  An empty table raises ``ValueError``.  The driver holds a number per pair of
    tags; tokens stay a table.
    """
    return _learnt(_pairs_by_window(tagged, sentence, position, token, tag))


def _pairs_by_window(tagged: DataFrame, sentence: Sequence[str], position: str, token: str, tag: str) -> DataFrame:
    """``(token, before, tag)`` of each row."""
    known = tagged.filter(F.col(token).isNotNull() & F.col(tag).isNotNull())
    before = F.coalesce(F.lag(tag).over(Window.partitionBy(*sentence).orderBy(position)), F.lit(START))
    return known.select(F.col(token).alias("token"), before.alias("before"), F.col(tag).alias("tag"))


def fit_tag_lists(df: DataFrame, row_key: str, tokens: str, tags: str) -> TagModel:
    """The same as ``fit_tags`` from a row per sentence, with its tokens and their tags as lists.

    What comes before a tag lies in the row, so sentences are not shuffled, only their keys.
    Rows that share a key are one sentence, by position, and go through the window.  Lists of
    unequal length have null where the shorter one ends.
    """
    rows = df.select(F.col(row_key).alias("_key"), F.arrays_zip(
        F.col(tokens).alias("token"), F.col(tags).alias("tag")).alias("_pairs"))
    repeated = broadcast_if_small(df.groupBy(F.col(row_key).alias("_again")).agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("_again"))
    again = F.col("_key").eqNullSafe(F.col("_again"))
    known = rows.join(repeated, again, "left_anti").select(F.filter(
        "_pairs", lambda e: e["token"].isNotNull() & e["tag"].isNotNull()).alias("_known"))
    own = F.transform("_known", lambda e: e["tag"])
    shifted = F.slice(F.concat(F.array(F.lit(START)), own), F.lit(1), F.size("_known"))
    flat = unnest(known, [], F.arrays_zip(F.col("_known").alias("own"), shifted.alias("before")), "_e")
    shared = rows.join(repeated, again, "left_semi").select("_key", F.posexplode("_pairs").alias("_pos", "_e")).select(
        "_key", "_pos", "_e.token", "_e.tag")
    return _learnt(flat.select("_e.own.token", "_e.before", "_e.own.tag").unionByName(
        _pairs_by_window(shared, ["_key"], "_pos", "token", "tag")))


def _learnt(known: DataFrame) -> TagModel:
    """The model of ``(token, before, tag)`` rows, which are read once."""
    counts = stored(known.groupBy("token", "before", "tag").agg(F.count(F.lit(1)).alias("n")), "tag-counts")
    pairs = {(r["before"], r["tag"]): r["n"] for r in counts.groupBy("before", "tag").agg(F.sum("n").alias("n")).collect()}
    tags = sorted({t for _, t in pairs})
    if not tags:
        raise ValueError("no tagged tokens to learn from")
    totals = {t: sum(n for (_, own), n in pairs.items() if own == t) for t in tags}
    leaving = {t: sum(n for (b, _), n in pairs.items() if b == t) for t in (START, *tags)}
    transitions = [[_cost(pairs.get((b, t), 0), leaving[b], len(tags)) for t in tags] for b in (START, *tags)]
    counted = counts.groupBy("token").pivot("tag", tags).agg(F.sum("n"))
    kinds = counted.count()
    costs = [
        F.round(1000 * F.log((F.lit(totals[t] + kinds)) / (F.coalesce(F.col(f"`{t}`"), F.lit(0)) + 1))).cast("long")
        for t in tags]
    emissions = counted.select("token", F.concat_ws(",", *costs).alias("costs"))
    return TagModel(tags, transitions, emissions, [_cost(0, totals[t], kinds) for t in tags])


def _least_paths(costs: np.ndarray, offsets: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The place of the tag of each token; of equal paths that whose last tag comes first, and so before each token.

    ``costs`` has a row per token, and sentence ``i`` is ``offsets[i]:offsets[i + 1]``.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    # Sentences with more than t tokens, the longest ones first.
    going = np.searchsorted(-lengths, -np.arange(longest), "left")
    came = np.zeros(costs.shape, np.int8 if costs.shape[1] < 128 else np.int32)
    places = np.zeros(len(costs), np.int64)
    if not longest:
        return places
    total = transitions[0] + costs[starts[:going[0]]]
    ends = total.copy()
    for t in range(1, longest):
        at = starts[:going[t]] + t
        ways = total[:going[t], :, None] + transitions[None, 1:, :]
        best = ways.argmin(axis=1)
        came[at] = best
        total = np.take_along_axis(ways, best[:, None, :], 1)[:, 0] + costs[at]
        ends[:going[t]] = total
    tag = ends.argmin(axis=1)
    for t in range(longest - 1, -1, -1):
        at = starts[:going[t]] + t
        own = tag[:going[t]]
        places[at] = own
        if t:
            tag[:going[t]] = came[at, own]
    return places


def tag_in_context(
    df: DataFrame, row_key: str, tokens: str, model: TagModel, output: str,
    max_dictionary_rows: int = MAX_DICTIONARY_ROWS,
) -> DataFrame:
    """Add ``output``: a tag for each token of the sentence ``tokens``.

    Of paths of equal cost the one whose last tag comes first stays, and so before each
    token.  A null or empty sentence has null or no tags.  Costs of tokens are looked up as
    ``look_up_tokens`` does, from a dictionary or by a join.
    """
    found = look_up_tokens(df, row_key, tokens, model.emissions, "_costs", max_dictionary_rows=max_dictionary_rows)
    ship_package(df.sparkSession)
    tags, unknown, moves = model.tags, model.unknown, model.transitions

    @F.arrow_udf(ArrayType(StringType()))
    def path(costs: pa.Array) -> pa.Array:
        names, transitions = pa.array(tags, pa.string()), np.array(moves, np.int64)

        def paths_in(part: pa.Array) -> pa.Array:
            texts = part.flatten().dictionary_encode()
            known = [[int(c) for c in text.split(",")] for text in texts.dictionary.to_pylist()]
            kinds = np.array([*known, unknown], np.int64)
            own = kinds[pc.fill_null(texts.indices, len(known)).to_numpy()]
            return lists_of(part, names.take(pa.array(_least_paths(own, offsets_of(part), transitions))))

        return in_slices(paths_in, costs)

    return found.withColumn(output, path("_costs")).drop("_costs")
