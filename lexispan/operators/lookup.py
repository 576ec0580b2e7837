"""Replace the tokens of each document by values from a table (lemmas, tags)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexispan.functions.text import ngrams
from lexispan.operators.frequent import frequent_values
from lexispan.operators.list_slices import in_slices, lists_of, offsets_of
from lexispan.operators.unnest import unnest
from lexispan.session import ship_package

MAX_DICTIONARY_ROWS = 500_000
#: The most frequent tokens of the documents, which need no join with a larger table.
MAX_HOT_TOKENS = 200_000
#: Texts whose tokens a function of the caller has as Python objects at a time.
TEXTS_AT_ONCE = 64

# Noun endings and what replaces them in the base form.
NOUN_ENDINGS = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]


def changed_lemmas(
    tokens: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None
) -> DataFrame:
    """``(token, lemma)`` for the distinct ``tokens(token)`` that have another base form.

    ``lexicon(word)`` holds the known base forms and ``exceptions(word, lemma)``
    irregular ones.  Candidates come from the endings, or from the exceptions where
    a token has any; those in the lexicon count, and the shortest wins, then the
    first in text order.  The endings never lengthen a word, so a known word need
    not compete with its own regular candidates, only with its exceptions.
    """
    token = F.col("token")
    regular = tokens.select("token")
    if exceptions is not None:
        irregular = exceptions.select(F.col("word").alias("token"), "lemma").join(
            regular, "token", "left_semi"
        )
        regular = regular.join(irregular.select("token"), "token", "left_anti")
    by_ending = F.array(*[
        F.when(
            token.endswith(ending),
            F.concat(
                F.substring(token, F.lit(1), F.length(token) - len(ending)), F.lit(base)
            ),
        )
        for ending, base in NOUN_ENDINGS
    ])
    candidates = unnest(regular, ["token"], by_ending, "lemma")
    if exceptions is not None:
        itself = irregular.select("token", token.alias("lemma"))
        candidates = candidates.unionByName(irregular).unionByName(itself)
    known = candidates.join(
        lexicon.select(F.col("word").alias("lemma")), "lemma", "left_semi"
    )
    shortest = F.min(F.struct(F.length("lemma").alias("n"), F.col("lemma").alias("lemma")))
    best = known.groupBy("token").agg(shortest["lemma"].alias("lemma"))
    return best.filter(token != F.col("lemma"))


def _by_dictionary(rows: pa.Table, keep_unmatched: bool, context):
    """An Arrow function that looks every token up in a broadcast dictionary."""
    shared = context.broadcast(
        (rows.column(0).combine_chunks(), rows.column(1).combine_chunks())
    )

    @F.arrow_udf(ArrayType(StringType()))
    def look_up(tokens: pa.Array) -> pa.Array:
        keys, values = shared.value

        def found_in(part: pa.Array) -> pa.Array:
            flat = part.flatten()
            found = values.take(pc.index_in(flat, value_set=keys.cast(flat.type)))
            return lists_of(part, pc.coalesce(found.cast(flat.type), flat) if keep_unmatched else found)

        return in_slices(found_in, tokens)

    return look_up


def _cold_tokens(shared):
    """An Arrow function: the tokens of a row that a broadcast dictionary does not hold."""

    @F.arrow_udf(ArrayType(StringType()))
    def cold(tokens: pa.Array) -> pa.Array:
        keys, _ = shared.value

        def missing_in(part: pa.Array) -> pa.Array:
            flat = part.flatten()
            missing = pc.and_(pc.is_null(pc.index_in(flat, value_set=keys.cast(flat.type))), pc.is_valid(flat))
            before = np.concatenate([[0], np.cumsum(missing.to_numpy(zero_copy_only=False))])
            return pa.ListArray.from_arrays(
                pa.array(before[offsets_of(part)].astype(np.int32)), flat.filter(missing).cast(pa.string()))

        return in_slices(missing_in, tokens)

    return cold


def _by_both(shared, keep_unmatched: bool):
    """An Arrow function that looks tokens up in a broadcast dictionary and in the pairs beside them."""

    @F.arrow_udf(ArrayType(StringType()))
    def look_up(tokens: pa.Array, others: pa.Array, values: pa.Array) -> pa.Array:
        hot_keys, hot_values = shared.value

        def found_in(part: pa.Array, keys: pa.Array, beside: pa.Array) -> pa.Array:
            flat = part.flatten()
            hot = hot_values.take(pc.index_in(flat, value_set=hot_keys.cast(flat.type))).cast(flat.type)
            # A token has the same value in all rows, so the pairs of all rows are one dictionary.
            cold = beside.flatten().take(pc.index_in(flat, value_set=keys.flatten().cast(flat.type))).cast(flat.type)
            return lists_of(part, pc.coalesce(hot, cold, flat) if keep_unmatched else pc.coalesce(hot, cold))

        return in_slices(found_in, tokens, others, values)

    return look_up


def look_up_tokens(
    df: DataFrame,
    row_key: str,
    tokens: str,
    table: DataFrame,
    output: str,
    keep_unmatched: bool = False,
    max_dictionary_rows: int = MAX_DICTIONARY_ROWS,
    max_hot_tokens: int = MAX_HOT_TOKENS,
) -> DataFrame:
    """Add ``output``: for each token the value that ``table(key, value)`` gives it.

    Tokens without a row give null, or themselves with ``keep_unmatched``.  Of several
    values of a key the smallest counts.  A table of at most ``max_dictionary_rows``
    rows goes to the executors as a dictionary and the documents are not shuffled.  Of a
    larger one the ``max_hot_tokens`` most frequent tokens of the documents do.  The others,
    a few of a hundred, are joined by token, each once per row, and brought to the rows by
    ``row_key`` and a hash of the tokens, so that rows of one key may differ.  ``df`` is
    then read three times.
    """
    key, value = table.columns
    table = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    rows = table.limit(max_dictionary_rows + 1).toArrow()
    context = df.sparkSession.sparkContext
    if rows.num_rows <= max_dictionary_rows:
        return df.withColumn(output, _by_dictionary(rows, keep_unmatched, context)(F.col(tokens)))
    ship_package(df.sparkSession)
    valued = table.select(F.col(key).alias("_token"), F.col(value).cast("string").alias("_found"))
    hot = frequent_values(df, tokens, max_hot_tokens).select(F.col("value").alias("_token")).join(
        valued, "_token", "left").toArrow()
    shared = context.broadcast((hot.column(0).combine_chunks(), hot.column(1).combine_chunks()))
    marked = df.withColumn("_same", F.xxhash64(tokens))
    cold = F.array_distinct(_cold_tokens(shared)(F.col(tokens)))
    others = unnest(marked, [F.col(row_key).alias("_key"), F.col("_same").alias("_hash")], cold, "_token")
    beside = others.join(valued, "_token").groupBy("_key", "_hash").agg(
        F.array_sort(F.collect_set(F.struct("_token", "_found"))).alias("_beside"))
    same_row = F.col(row_key).eqNullSafe(F.col("_key")) & (F.col("_same") == F.col("_hash"))
    none = F.array().cast("array<string>")
    return marked.join(beside, same_row, "left").withColumn(output, _by_both(shared, keep_unmatched)(
        F.col(tokens), F.coalesce("_beside._token", none), F.coalesce("_beside._found", none),
    )).drop("_same", "_key", "_hash", "_beside")


def drop_tokens(
    df: DataFrame,
    row_key: str,
    tokens: str,
    words: DataFrame,
    output: str,
    max_dictionary_rows: int = MAX_DICTIONARY_ROWS,
) -> DataFrame:
    """Add ``output``: the tokens that are not in ``words(word)``, a table of stop words."""
    table = words.select("word", F.col("word").alias("_stop"))
    found = look_up_tokens(
        df, row_key, tokens, table, "_found", max_dictionary_rows=max_dictionary_rows
    )
    kept = F.zip_with(tokens, "_found", lambda t, stop: F.when(stop.isNull(), t))
    return found.withColumn(output, F.filter(kept, lambda t: t.isNotNull())).drop("_found")


def tokens_by(
    df: DataFrame, text: str, make_tokenise: Callable[[], Callable[[str], Sequence[str]]],
    output: str,
) -> DataFrame:
    """Add ``output``: the tokens that the caller's own function finds in each text.

    ``make_tokenise`` runs once per batch of a Python worker and returns the function;
    texts and tokens travel as Arrow batches.  Null text gives null.
    """

    @F.arrow_udf(ArrayType(StringType()))
    def tokenise(texts: pa.Array) -> pa.Array:
        split = make_tokenise()
        # A few texts at a time: their tokens as Python objects take many times the text.
        parts = [
            pa.array([None if t is None else list(split(t)) for t in texts.slice(start, TEXTS_AT_ONCE).to_pylist()],
                     pa.list_(pa.string()))
            for start in range(0, max(1, len(texts)), TEXTS_AT_ONCE)]
        return pa.concat_arrays(parts)

    return df.withColumn(output, tokenise(F.col(text)))


def lemmatize(
    df: DataFrame,
    row_key: str,
    tokens: str,
    lemmas: DataFrame,
    output: str,
    max_dictionary_rows: int = MAX_DICTIONARY_ROWS,
) -> DataFrame:
    """Add ``output``: the tokens, each replaced by its row in ``lemmas``, if any.

    ``lemmas(token, lemma)`` need only hold tokens that change (``changed_lemmas``).
    """
    table = lemmas.select("token", "lemma")
    return look_up_tokens(df, row_key, tokens, table, output, True, max_dictionary_rows)


def tagged_ngrams(
    df: DataFrame,
    row_key: str,
    tokens: str,
    tags: DataFrame,
    output: str,
    keep_tags: tuple[str, ...] = ("NN", "JJ"),
    stop_words: tuple[str, ...] = (),
    n: int = 2,
    max_dictionary_rows: int = MAX_DICTIONARY_ROWS,
) -> DataFrame:
    """Add ``output``: n-grams of ``token/TAG`` over tokens with one of ``keep_tags``.

    ``tags(token, tag)`` is a lexicon.  Tags are given to the whole token list;
    other tags and stop words are dropped before neighbours are paired.
    """
    tagged = look_up_tokens(
        df, row_key, tokens, tags, "_tags", max_dictionary_rows=max_dictionary_rows
    )
    pairs = F.zip_with(
        tokens, "_tags",
        lambda t, tag: F.when(
            tag.isin(*keep_tags) & ~t.isin(*stop_words), F.concat_ws("/", t, tag)
        ),
    )
    kept = tagged.withColumn("_kept", F.filter(pairs, lambda p: p.isNotNull()))
    return kept.withColumn(output, ngrams(F.col("_kept"), n)).drop("_tags", "_kept")
