"""The most frequent terms without a shuffle of all distinct ones.

Each task keeps a bounded number of counters (a Misra-Gries summary): when they get too
many, the same number is taken from all, and those that reach zero are dropped.  A counter
is below the true count of its term by what was taken at most.  The merged counters and
the sum of what was taken bound every count from both sides: terms that may be among the
most frequent are counted exactly, the others need not be.  Where the bounds can't tell,
counts by buckets of a hash do (``features.candidate_counts``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.operators.bounded import broadcast_if_small
from lexispan.operators.features import candidate_counts, term_counts, top_terms, with_index
from lexispan.operators.unnest import unnest
from lexispan.session import ship_package
from lexispan.sources.scratch import forget, stored_by_batches

#: Counters of a task for each term that is asked for.
COUNTERS_PER_TERM = 20


def summaries(df: DataFrame, terms: str, counters: int) -> DataFrame:
    """``(term, low, taken)``: up to ``counters`` counters per task, and a row with a null term.

    ``low`` is at most the term's count in the task, and ``taken``, on the row without a
    term, the most by which it is below.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, taken = Counter(), 0
        for batch in batches:
            column = batch[terms]
            for start in range(0, len(column), 256):
                counts.update(column[start: start + 256].flatten().to_pylist())
                counts.pop(None, None)
                if len(counts) > 2 * counters:
                    values = np.fromiter(counts.values(), np.int64, len(counts))
                    cut = int(np.partition(values, len(values) - counters - 1)[len(values) - counters - 1])
                    counts, taken = Counter({t: n - cut for t, n in counts.items() if n > cut}), taken + cut
        yield pa.record_batch({
            "term": pa.array([*counts, None], pa.string()), "low": pa.array([*counts.values(), 0], pa.int64()),
            "taken": pa.array([0] * len(counts) + [taken], pa.int64())})

    return df.select(terms).mapInArrow(run, "term string, low long, taken long")


def top_vocabulary(df: DataFrame, terms: str, top_n: int, counters: int | None = None) -> DataFrame:
    """``(idx, term, cnt)`` as ``features.vocabulary`` gives it, by summaries of ``counters`` terms per task.

    Equal counts are in text order.  Null lists and elements count nothing; an empty table
    has no terms.  The shuffle holds the counters and the terms that the bounds leave open;
    with too few counters, or too even counts, that of ``features.vocabulary``.
    """
    ship_package(df.sparkSession)
    parts = summaries(df, terms, counters or COUNTERS_PER_TERM * max(top_n, 1))
    # Merged per term; what all tasks took is the row without a term.
    merged = stored_by_batches(
        parts.groupBy("term").agg(F.sum("low").alias("low"), F.sum("taken").alias("taken")), "summaries")
    taken = merged.filter("term IS NULL").agg(F.coalesce(F.sum("taken"), F.lit(0))).first()[0]
    found = merged.filter("term IS NOT NULL").select("term", F.col("low").alias("cnt"))
    # Any term of the result has the least of these lower bounds, or more.
    best = top_terms(found, top_n).agg(F.count(F.lit(1)), F.min("cnt")).first()
    enough = best[0] == top_n and best[1] > taken
    if not (enough or taken == 0):
        forget(merged)
        counted = candidate_counts(df, terms, top_n, best[1] if best[0] == top_n else 0)
        if counted is None:
            counted = term_counts(df, terms)
        return with_index(top_terms(counted, top_n)).select("idx", "term", "cnt")
    if taken == 0:
        counted = found
    else:
        open_terms = broadcast_if_small(found.filter(F.col("cnt") + taken >= best[1]).select("term"))
        counted = unnest(df, [], terms, "term").join(open_terms, "term", "left_semi").groupBy("term").agg(
            F.count(F.lit(1)).alias("cnt"))
    return with_index(top_terms(counted, top_n)).select("idx", "term", "cnt")
