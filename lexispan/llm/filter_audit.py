"""What each of several filters removes, and what it would remove in any other order.

Documents are reduced to which filters they fail, and these to counts per part and set
of failed filters.  The removal game gives a coalition of filters the number of documents
that fail one of them at least; its values for all coalitions come from those counts.
The Hart-Mas-Colell potential follows from the potentials of the coalitions with one
filter less: ``|S| P(S) = v(S) + sum of P(S without i)``.  The Shapley value of a filter
is the grand potential minus that without the filter, and what a filter removes at a step
of an order is the difference of two coalitions.  Built-in functions only.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "ABCDE"
#: The filter that looks at the whole table and not at one text.
COPY = 1 << LETTERS.index("E")
GAMES = ("n", "good", "toxic")


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Conditions of one text and its words: short, repetitive, shouted, with symbols.

    Sizes are compared as whole numbers.  A text without words is only too short.
    """
    n = F.size(words).cast("long")
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < n * 50,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.char_length(text).cast("long") * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents per part and set of failed filters.

    Bit k of ``mask`` is the k-th letter of ``ABCDE``.  E fails where a smaller id has
    the same text, by the SHA-256 of its bytes, in any part and whether or not that row
    is removed.  A null id is neither smaller nor larger than others: it never fails E,
    and no more do rows that repeat the smallest id.  ``good`` and ``toxic`` count rows
    whose label ``quality`` or ``toxic`` is 1; of labels that contradict each other the 1
    holds.  Null text is empty, a null part the empty string.  Other columns are not
    read; without documents there are no rows.
    """
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    ).withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    bits = [F.when(fails, 1 << LETTERS.index(letter)).otherwise(0)
            for letter, fails in text_failures(F.col("text"), F.col("words")).items()]
    rows = texts.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), reduce(add, bits).alias("bits"))
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(*[
        F.max(F.when(F.col(label) == 1, 1).otherwise(0)).alias(name)
        for label, name in (("quality", "good"), ("toxic", "toxic"))])
    # Counted before every shuffle, so that many copies of a text are few rows there.
    of_id = rows.filter("id IS NOT NULL").groupBy("id", "digest", "part", "bits").agg(
        F.count(F.lit(1)).alias("n")).join(known, "id", "left").fillna(0, ["good", "toxic"])
    kinds = of_id.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("at_first"))
    # A text has at most four kinds per part.
    stay = F.when(F.col("first") == F.min("first").over(Window.partitionBy("digest")), F.col("at_first")).otherwise(0)
    marked = kinds.withColumn("stay", stay).select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("bits").alias("mask"), F.col("stay").alias("n")),
        F.struct(F.col("bits").bitwiseOR(F.lit(COPY)).alias("mask"), (F.col("n") - F.col("stay")).alias("n")))))
    nameless = rows.filter("id IS NULL").groupBy("part", F.col("bits").alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return marked.unionByName(nameless).filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def coalition_values(counts: DataFrame, filters: int = len(LETTERS)) -> DataFrame:
    """``(part, total, n, good, toxic)``: per game the array of its values for all coalitions.

    Entry S of an array is what the filters in the bits of S remove together.
    """
    caught = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    values = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(2**filters - 1)))).groupBy(
        "part", "coalition").agg(F.sum("n").alias("total"), *[
            F.sum(F.when(caught, F.col(game)).otherwise(0)).alias(game) for game in GAMES])
    # One entry per coalition, whatever the table holds.
    gathered = F.array_sort(F.collect_list(F.struct("coalition", *GAMES)))
    return values.groupBy("part").agg(F.max("total").alias("total"), gathered.alias("values")).select(
        "part", "total", *[F.col(f"values.{game}").alias(game) for game in GAMES])


def potentials(values: Column, filters: int = len(LETTERS)) -> Column:
    """``filters!`` times the potential of every coalition; whole numbers, from small to large.

    The factor makes every division exact.
    """
    def of(done: Column, coalition: Column) -> Column:
        smaller = [
            F.when(coalition.bitwiseAND(F.lit(1 << i)) != 0, F.get(done, coalition.bitwiseXOR(F.lit(1 << i)))).otherwise(0)
            for i in range(filters)]
        own = F.get(values, coalition) * F.lit(math.factorial(filters))
        size = F.bit_count(coalition).cast("long")
        return F.concat(done, F.array(F.call_function("div", reduce(add, smaller, own), size)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2**filters - 1)), F.array(F.lit(0).cast("long")), of)


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``failure_counts``.

    Columns: ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``; ``shapley`` is ``len(letters)!`` times the Shapley value of the
    step's filter.  A part has all its rows, zeros included; no parts give no rows.
    """
    n = len(letters)
    full = 2**n - 1
    orders = []
    for order in itertools.permutations(range(n)):
        reached = list(itertools.accumulate((1 << i for i in order), add, initial=0))
        orders.append(F.struct(
            F.lit("".join(letters[i] for i in order)).alias("filter_order"),
            F.array(*[F.lit(mask) for mask in reached]).alias("reached")))
    steps = coalition_values(counts, n).withColumn("potential", potentials(F.col("n"), n)).select(
        "*", F.inline(F.array(*orders))).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    before, after = F.get("reached", F.col("step") - 1), F.get("reached", F.col("step"))
    own = after.bitwiseXOR(before)
    others = F.lit(full).bitwiseXOR(own)

    def lost(game: str) -> Column:
        return F.get(game, after) - F.get(game, before)

    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.get("n", after)).alias("kept"), lost("n").alias("removed"),
        (F.get("n", own) - lost("n")).alias("redundant"),
        (F.get("n", F.lit(full)) - F.get("n", others)).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(full)) - F.get("potential", others)).alias("shapley"))
