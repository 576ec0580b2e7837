"""Word vectors of a document pooled into one: mean, maximum or TF-IDF-weighted mean.

A small embedding table goes to the tasks as a matrix and every document is pooled
where it lies.  Of a table beyond the size bound the vectors of the most frequent words
do; the others are joined by word and added to the sums of their documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lexispan.functions.arrays import value_counts
from lexispan.operators.bounded import hint_if_bounded
from lexispan.operators.features import TfidfModel
from lexispan.operators.frequent import frequent_values
from lexispan.operators.list_slices import in_slices
from lexispan.operators.unnest import unnest
from lexispan.session import ship_package
from lexispan.sources.scratch import stored_by_batches

MAX_MATRIX_BYTES = 64 * 1024 * 1024
#: The vectors of the most frequent words of the documents, where the table is larger.
MAX_HOT_BYTES = 64 * 1024 * 1024
BYTES_PER_NUMBER = 4


class WordVectors:
    """An embedding table ``(word, vec)`` for use in several poolings.

    Rows with a null word or vector are left out; of several vectors of a word the
    smallest, number by number from the first, counts.  A table of at most
    ``max_matrix_bytes`` is fetched once, as a matrix.
    """

    def __init__(
        self, embedding: DataFrame, dims: int | None = None,
        max_matrix_bytes: int = MAX_MATRIX_BYTES,
    ) -> None:
        self.known = embedding.filter(F.col("word").isNotNull() & F.col("vec").isNotNull())
        self.table = self.known.groupBy("word").agg(F.min("vec").alias("vec"))
        self.dims = dims or vector_size(embedding)
        self.max_matrix_bytes = max_matrix_bytes

    @cached_property
    def matrix(self):
        # Words alone first: a table that is too large is not fetched, nor are its vectors shuffled.
        if self.known.select("word").distinct().count() > self.max_matrix_bytes // (BYTES_PER_NUMBER * self.dims):
            return None
        return _small_matrix(self.table, self.dims, self.max_matrix_bytes)

    def of(self, words: DataFrame) -> DataFrame:
        """``(word, vec)`` of the words of a small table ``(word)`` alone."""
        return self.known.join(F.broadcast(words), "word", "left_semi").groupBy("word").agg(F.min("vec").alias("vec"))


def word_vectors(
    embedding: DataFrame | WordVectors, dims: int | None = None,
    max_matrix_bytes: int = MAX_MATRIX_BYTES,
) -> WordVectors:
    if isinstance(embedding, WordVectors):
        return embedding
    return WordVectors(embedding, dims, max_matrix_bytes)


def vector_size(embedding: DataFrame) -> int:
    row = embedding.filter("vec IS NOT NULL").select(F.size("vec").alias("d")).first()
    if row is None:
        raise ValueError("the embedding table is empty")
    return row["d"]


def _small_matrix(embedding: DataFrame, dims: int, max_bytes: int):
    """``(words, columns)`` of an embedding of at most ``max_bytes``, else None.

    ``columns[k]`` holds the k-th number of every word.
    """
    limit = max_bytes // (BYTES_PER_NUMBER * dims)
    found = embedding.select("word", "vec").limit(limit + 1).toArrow()
    return None if found.num_rows > limit else _matrix(found, dims)


def _matrix(found: pa.Table, dims: int) -> tuple[pa.Array, np.ndarray]:
    numbers = found.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    columns = np.ascontiguousarray(numbers.reshape(-1, dims).T, dtype=np.float32)
    return found.column("word").combine_chunks(), columns


def _offsets(lists: pa.Array) -> np.ndarray:
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.concatenate([[0], np.cumsum(lengths)])


def _pool_rows(
    columns: np.ndarray, at: np.ndarray, offsets: np.ndarray, how: str,
    counts: np.ndarray | None = None, weights: np.ndarray | None = None,
) -> pa.Array:
    """Pool each stretch ``offsets[i]:offsets[i + 1]`` of the words ``at``.

    Negative positions are unknown words.  One column at a time, so the memory in
    use does not grow with the number of dimensions.
    """
    known = at >= 0
    kept = np.concatenate([[0], np.cumsum(known)])
    starts, ends = kept[offsets[:-1]], kept[offsets[1:]]
    filled = ends > starts
    starts, at = starts[filled], at[known]
    result = np.zeros((len(filled), len(columns)))
    if len(starts):
        n = np.ones(len(at)) if counts is None else counts[known]
        if weights is not None:
            weighted = n * weights[known]
            total = np.add.reduceat(weighted, starts)
            lengths = np.diff(np.append(starts, len(at)))
            n = np.where(np.repeat(total != 0, lengths), weighted, n)
        total = np.add.reduceat(n, starts)
        for k, column in enumerate(columns):
            x = column[at]
            if how == "max":
                result[filled, k] = np.maximum.reduceat(x, starts)
            elif how == "sum":
                result[filled, k] = np.add.reduceat(x * n, starts)
            else:
                result[filled, k] = np.add.reduceat(x * n, starts) / total
    places = np.arange(0, result.size + 1, len(columns), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(result.ravel()))


def _pooled_rows(df: DataFrame) -> DataFrame:
    """``df`` stored, its Python function fed by small batches; on a stream it stays as it is."""
    return df if df.isStreaming else stored_by_batches(df, "pooled")


def _check(how: str) -> None:
    if how not in ("mean", "max"):
        raise ValueError(f"unknown pooling: {how}")


def pool_words(
    df: DataFrame, row_key: str, tokens: str, embedding: DataFrame | WordVectors,
    how: str = "mean", dims: int | None = None, max_matrix_bytes: int = MAX_MATRIX_BYTES,
    keep: Sequence[str] = (), max_hot_bytes: int = MAX_HOT_BYTES,
) -> DataFrame:
    """``(row_key, keep.., features)``: mean or max of the vectors of a document's words.

    A document with no known word gets zeros.  Beyond ``max_matrix_bytes`` the most frequent
    words, whose vectors take ``max_hot_bytes`` at most, are pooled in the row.  The others, a
    few of a hundred, are joined by word, and only their vectors are shuffled; ``df`` is then
    read three times.
    """
    _check(how)
    vectors = word_vectors(embedding, dims, max_matrix_bytes)
    if vectors.matrix is None:
        return _pool_hot_and_joined(df, row_key, tokens, vectors, how, keep, max_hot_bytes)
    shared = df.sparkSession.sparkContext.broadcast(vectors.matrix)

    @F.arrow_udf(ArrayType(DoubleType()))
    def pool(lists: pa.Array) -> pa.Array:
        words, columns = shared.value

        def pooled_in(part: pa.Array) -> pa.Array:
            flat = part.flatten()
            found = pc.index_in(flat, value_set=words.cast(flat.type))
            return _pool_rows(columns, pc.fill_null(found, -1).to_numpy(), _offsets(part), how)

        return in_slices(pooled_in, lists)

    return _pooled_rows(df.select(row_key, *keep, pool(tokens).alias("features")))


def _pool_hot_and_joined(df, row_key, tokens, vectors, how, keep, max_hot_bytes):
    """``pool_words`` by a matrix of the most frequent words and a join of the others.

    Sums and counts of both meet in one row per document, or in its largest numbers.
    """
    ship_package(df.sparkSession)
    dims = vectors.dims
    hot = frequent_values(df, tokens, max_hot_bytes // (BYTES_PER_NUMBER * dims)).select(F.col("value").alias("word"))
    # A frequent word without a vector is known to have none.
    found = hot.join(vectors.of(hot), "word", "left").select("word", "vec").toArrow()
    blank = found.column("vec").is_null()
    words, columns = _matrix(found.filter(pc.invert(blank)), dims)
    shared = df.sparkSession.sparkContext.broadcast(
        (words, columns, found.column("word").filter(blank).combine_chunks()))

    @F.arrow_udf("struct<features array<double>, n bigint, others array<string>>")
    def start(lists: pa.Array) -> pa.Array:
        words, columns, blank = shared.value

        def begun_in(part: pa.Array) -> pa.Array:
            flat, offsets = part.flatten(), _offsets(part)
            at = pc.fill_null(pc.index_in(flat, value_set=words.cast(flat.type)), -1).to_numpy()
            known = np.concatenate([[0], np.cumsum(at >= 0)])
            missing = (at < 0) & ~pc.is_in(flat, value_set=blank.cast(flat.type)).to_numpy(zero_copy_only=False)
            missing &= pc.is_valid(flat).to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(missing)])
            return pa.StructArray.from_arrays([
                _pool_rows(columns, at, offsets, "max" if how == "max" else "sum"), pa.array(np.diff(known[offsets])),
                pa.ListArray.from_arrays(
                    pa.array(before[offsets].astype(np.int32)), flat.filter(pa.array(missing)).cast(pa.string())),
            ], ["features", "n", "others"])

        return in_slices(begun_in, lists)

    marked = df.select(row_key, *keep, tokens, F.xxhash64(tokens).alias("_same"))
    # Both sides of the join below read it.
    begun = _pooled_rows(marked.select(row_key, *keep, "_same", start(tokens).alias("_hot")))
    rare = unnest(begun, [F.col(row_key).alias("_key"), F.col("_same").alias("_hash")],
                  value_counts(F.col("_hot.others")), "_e").select("_key", "_hash", F.col("_e.value").alias("word"), "_e.n")
    each = [F.get("vec", F.lit(i)).cast("double") for i in range(dims)]
    rest = rare.join(vectors.table, "word", "left").groupBy("_key", "_hash").agg(
        F.array(*[F.max(x) if how == "max" else F.sum(x * F.col("n")) for x in each]).alias("_rest"),
        F.coalesce(F.sum(F.when(F.col("vec").isNotNull(), F.col("n"))), F.lit(0)).alias("_m"), F.sum("n").alias("_all"))
    same_row = F.col(row_key).eqNullSafe(F.col("_key")) & (F.col("_same") == F.col("_hash"))
    # Rows that share key and tokens are one group, in which each counts its words.
    copies = F.col("_all") / F.nullif(F.size("others"), F.lit(0))
    both = begun.select(row_key, *keep, "_same", "_hot.*").join(rest, same_row, "left").select(
        row_key, *keep, "features", F.col("n").alias("_n"), "_rest",
        F.when(F.col("_m") > 0, copies).alias("_copies"), (F.coalesce("_m", F.lit(0)) / copies).alias("_m"))
    if how == "max":
        joined = F.zip_with("features", "_rest", lambda x, y: F.greatest(x, y))
        return both.select(row_key, *keep, F.when(F.col("_copies").isNull(), F.col("features")).when(
            F.col("_n") > 0, joined).otherwise(F.col("_rest")).alias("features"))
    total = F.col("_n") + F.coalesce("_m", F.lit(0))
    sums = F.when(F.col("_copies").isNull(), F.col("features")).otherwise(
        F.zip_with("features", "_rest", lambda x, y: x + y / F.col("_copies")))
    return both.withColumn("_sums", sums).withColumn("_total", total).select(row_key, *keep, F.when(
        F.col("_total") > 0, F.transform("_sums", lambda x: x / F.col("_total"))).otherwise(F.col("_sums")).alias("features"))


def pool_weighted(
    df: DataFrame, row_key: str, tokens: str, embedding: DataFrame | WordVectors,
    model: TfidfModel, dims: int | None = None, max_matrix_bytes: int = MAX_MATRIX_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(row_key, keep.., features)``: word vectors averaged with their TF-IDF weights.

    Words outside the model's vocabulary or the embedding count for nothing; when
    all weights are 0 the plain mean is taken, and zeros when no word is known.
    """
    known = word_vectors(embedding, dims, max_matrix_bytes)
    # At most one row per vocabulary term.
    terms = model.table.select("idx", F.col("term").alias("word"))
    vectors = terms.join(known.of(terms.select("word")) if model.listed else known.table, "word")
    fits = model.top_n * known.dims * BYTES_PER_NUMBER <= known.max_matrix_bytes
    if not (model.listed and model.terms and fits):
        return _pool_weighted_by_join(df, row_key, tokens, vectors, model, known.dims, keep)
    words, columns = known.__dict__.get("matrix") or _small_matrix(vectors, known.dims, known.max_matrix_bytes)
    places = {word: i for i, word in enumerate(words.to_pylist())}
    rows = np.array([places.get(term, -1) for term in model.terms], dtype=np.int64)
    shared = df.sparkSession.sparkContext.broadcast((rows, columns))

    @F.arrow_udf(ArrayType(DoubleType()))
    def pool(indices: pa.Array, counts: pa.Array, weights: pa.Array) -> pa.Array:
        rows, columns = shared.value
        return _pool_rows(
            columns, rows[indices.flatten().to_numpy()], _offsets(indices), "mean",
            counts.flatten().to_numpy(), weights.flatten().to_numpy(),
        )

    parts = model.sparse_parts(df.select(row_key, *keep, tokens), tokens)
    return _pooled_rows(parts.select(
        row_key, *keep, pool("_c.indices", "_c.values", "_u.values").alias("features")
    ))


def _pool_weighted_by_join(df, row_key, tokens, vectors, model, dims, keep):
    marked = df.select(row_key, *keep, tokens, F.xxhash64(tokens).alias("_same"))
    entries = model.entries(marked, row_key, tokens, ["_same"]).select(
        row_key, "_same", "idx", F.col("cnt").alias("n"), F.col("tfidf_l2").alias("weight")
    )
    joined = entries.join(
        hint_if_bounded(vectors.select("idx", "vec"), model.top_n), "idx"
    )
    pooled = _pooled(joined, row_key, dims).withColumnsRenamed(
        {row_key: "_key", "_same": "_hash"}
    )
    same_row = F.col(row_key).eqNullSafe(F.col("_key")) & (F.col("_same") == F.col("_hash"))
    zeros = F.array_repeat(F.lit(0.0), dims)
    return marked.join(pooled, same_row, "left").select(
        row_key, *keep, F.coalesce("features", zeros).alias("features")
    )


def _pooled(joined: DataFrame, row_key: str, dims: int) -> DataFrame:
    """Aggregate ``(row_key, _same, n, weight, vec)`` rows, ``vec`` null where unknown.

    Rows that share key and tokens fall into one group; that weighs all their words
    alike and leaves the result as it is.
    """
    known = F.col("vec").isNotNull()

    def total(weight: Column) -> list[Column]:
        return [F.sum(F.get("vec", F.lit(i)).cast("double") * weight) for i in range(dims)]

    def mean(weight: Column) -> list[Column]:
        weights = F.sum(F.when(known, weight))
        return [t / F.nullif(weights, F.lit(0)) for t in total(weight)]

    plain = mean(F.col("n"))
    values = [F.coalesce(w, p) for w, p in zip(mean(F.col("n") * F.col("weight")), plain)]
    return joined.groupBy(row_key, "_same").agg(
        F.array(*[F.coalesce(v, F.lit(0.0)) for v in values]).alias("features")
    )
