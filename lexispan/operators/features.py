"""Term counts, vocabularies and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispan.functions.arrays import value_counts
from lexispan.operators.bounded import fetched, hint_if_bounded
from lexispan.operators.unnest import unnest
from lexispan.sources.scratch import forget, stored

# Up to this many terms (the default of Spark's own vectorizer) documents are looked up
# in a list of the terms that every task holds; beyond, the vocabulary is joined.
MAX_LISTED_TERMS = 262_144
# Stands in for the terms of an empty vocabulary; no token is this.
NO_TERM = "\0"
# Buckets of a hash that terms are counted by before the frequent ones are.
BUCKETS = 1 << 21


def term_counts(df: DataFrame, terms: str, group: Sequence[str] = ()) -> DataFrame:
    """``(group.., term, cnt)`` over all documents, combined before the shuffle."""
    return (
        unnest(df, group, terms, "term")
        .groupBy(*group, "term").agg(F.count(F.lit(1)).alias("cnt"))
    )


def top_terms(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent terms; equal counts in text order."""
    return counts.orderBy(F.desc("cnt"), "term").limit(n)


def with_index(top: DataFrame) -> DataFrame:
    """Add a dense 0-based ``idx`` to an already limited vocabulary."""
    by_count = Window.orderBy(F.desc("cnt"), "term")
    return top.withColumn("idx", F.row_number().over(by_count) - 1)


def candidate_counts(
    df: DataFrame, terms: str, top_n: int, least: int = 0, buckets: int = BUCKETS,
) -> DataFrame | None:
    """``(term, cnt)`` of all terms that may be among the ``top_n`` most frequent, exactly counted.

    Terms are first counted by ``buckets`` buckets of a hash: a term occurs no more often
    than its bucket counts, and the shuffle holds at most ``buckets`` numbers per task.  The
    terms of the fullest buckets are counted; when ``top_n`` of them occur at least as often as a
    bucket left out counts, no other can be among them.  Else the buckets up to the least of
    these counts are added.  ``least`` is a known lower bound of the last count, or 0.
    None where counting all terms is as cheap: few occurrences, or even buckets.
    """
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    flat = unnest(df, [], terms, "term").withColumn("_bucket", bucket)
    totals = stored(flat.groupBy("_bucket").agg(F.count(F.lit(1)).alias("total")), "bucket-counts")
    rows, total = totals.agg(F.count(F.lit(1)), F.coalesce(F.sum("total"), F.lit(0))).first()
    if rows <= top_n or total <= buckets:
        return None
    nth = totals.orderBy(F.desc("total")).limit(top_n).agg(F.min("total")).first()[0]
    cut = max(least, nth - 2 * total // rows, nth // 2)
    while cut > 1:
        chosen = F.broadcast(totals.filter(F.col("total") >= cut).select("_bucket"))
        found = stored(flat.join(chosen, "_bucket", "left_semi").groupBy("term").agg(
            F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") >= least), "term-counts")
        best = top_terms(found, top_n).agg(F.count(F.lit(1)), F.min("cnt")).first()
        if cut <= least or (best[0] == top_n and best[1] >= cut):
            return found
        forget(found)
        cut = max(least, best[1] if best[0] == top_n else 1)
    return None


def vocabulary(df: DataFrame, terms: str, top_n: int) -> DataFrame:
    """``(idx, term, cnt)``: the ``top_n`` most frequent terms of all documents.

    A vocabulary that can be listed is found without shuffling all terms; ``df`` is then
    read twice or three times.
    """
    counts = candidate_counts(df, terms, top_n) if 0 < top_n <= MAX_LISTED_TERMS else None
    if counts is None:
        counts = term_counts(df, terms)
    return with_index(top_terms(counts, top_n)).select("idx", "term", "cnt")


def smoothed_idf(documents: Column | int, document_frequency: Column) -> Column:
    """``ln((N + 1) / (df + 1)) + 1``."""
    total = F.lit(documents) if isinstance(documents, int) else documents
    return F.log((total + 1) / (document_frequency + 1)) + 1


def fitted_vocabulary(df: DataFrame, terms: str, top_n: int) -> DataFrame:
    """``(idx, term, cnt, df, idf)`` for the ``top_n`` most frequent terms.

    The documents of a vocabulary that can be listed are counted over its terms alone,
    by a vector per document.  Else terms are counted inside the row, so one aggregate over a row
    per distinct term of a document gives occurrences and documents.  A narrow job counts the rows.
    """
    if 0 < top_n <= MAX_LISTED_TERMS:
        table = fetched(vocabulary(df, terms, top_n))
        counted = TfidfModel(table.withColumn("idf", F.lit(0.0)), top_n).counts(df, terms, "_found")
        per_term = unnest(counted, [], F.unwrap_udt("_found")["indices"], "idx").groupBy("idx").agg(
            F.count(F.lit(1)).alias("df"))
        return table.join(F.broadcast(per_term), "idx").select(
            "idx", "term", "cnt", "df", smoothed_idf(df.count(), F.col("df")).alias("idf"))
    tally = (
        unnest(df, [], value_counts(F.col(terms)), "e")
        .groupBy(F.col("e.value").alias("term"))
        .agg(F.sum("e.n").alias("cnt"), F.count(F.lit(1)).alias("df"))
    )
    return with_index(top_terms(tally, top_n)).select(
        "idx", "term", "cnt", "df", smoothed_idf(df.count(), F.col("df")).alias("idf")
    )


@dataclass
class TfidfModel:
    """A vocabulary with its inverse document frequencies, ready to apply.

    Learn it from the training documents and apply it to others.  ``listed`` models
    look terms up in a list, others join ``table``; both give the same entries.
    Vectors always need the list of the ``top_n`` terms, which is then fetched once.
    """

    table: DataFrame
    top_n: int
    listed: bool = True

    @classmethod
    def fit(
        cls, df: DataFrame, terms: str, top_n: int, max_listed: int = MAX_LISTED_TERMS
    ) -> TfidfModel:
        table = fitted_vocabulary(df, terms, top_n)
        if top_n > max_listed:
            return cls(table, top_n, False)
        return cls(fetched(table.orderBy("idx")), top_n)

    @cached_property
    def _rows(self) -> list:
        return self.table.select("idx", "term", "idf").orderBy("idx").collect()

    @property
    def terms(self) -> list[str]:
        return [r["term"] for r in self._rows]

    @property
    def idf(self) -> list[float]:
        return [r["idf"] for r in self._rows]

    def counts(self, df: DataFrame, terms: str, output: str) -> DataFrame:
        """Add a sparse vector of term counts per document; no shuffle.

        An empty vocabulary gives vectors of one zero; a null list has no terms.
        """
        model = CountVectorizerModel.from_vocabulary(self.terms or [NO_TERM], "_listed", output)
        listed = F.coalesce(F.col(terms), F.array().cast("array<string>"))
        return model.transform(df.withColumn("_listed", listed)).drop("_listed")

    def vectors(self, df: DataFrame, terms: str, output: str) -> DataFrame:
        """Add L2-normalised TF-IDF vectors; documents without a term stay zero.

        The division of counts by document length cancels in the normalisation.
        """
        weighted = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf or [0.0]), inputCol="_counts", outputCol="_weighted"
        )
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        counted = self.counts(df, terms, "_counts")
        return unit.transform(weighted.transform(counted)).drop("_counts", "_weighted")

    def sparse_parts(self, df: DataFrame, terms: str) -> DataFrame:
        """Add structs ``_c`` (counts) and ``_u`` (unit TF-IDF): ``indices``, ``values``.

        Both list the same terms of a row in the same order.
        """
        counted = self.counts(df, terms, "_count_vector")
        return self.vectors(counted, terms, "_unit_vector").withColumns({
            "_c": F.unwrap_udt("_count_vector"), "_u": F.unwrap_udt("_unit_vector")
        }).drop("_count_vector", "_unit_vector")

    def entries(
        self, df: DataFrame, row_key: str, terms: str, keep: Sequence[str] = ()
    ) -> DataFrame:
        """``(row_key, keep.., idx, term, cnt, tf, tfidf, tfidf_l2)``, a row per known term.

        ``tf`` divides by all terms of the document, known or not.
        """
        rows = df.select(row_key, *keep, terms)
        if self.listed and self.terms:
            found = self._entries_from_vectors(rows, row_key, terms, keep)
        else:
            found = self._entries_by_join(rows, row_key, terms, keep)
        return found.select(row_key, *keep, "idx", "term", "cnt", "tf", "tfidf", "tfidf_l2")

    def _entries_from_vectors(self, df, row_key, terms, keep):
        sparse = self.sparse_parts(df, terms).select(
            row_key, *keep, F.size(terms).alias("_n"), "_c", "_u"
        )
        zipped = F.arrays_zip(
            F.col("_c.indices").alias("idx"), F.col("_c.values").alias("cnt"),
            F.col("_u.values").alias("unit"),
        )
        flat = unnest(sparse, [row_key, *keep, "_n"], zipped, "_e")
        tf = F.col("_e.cnt") / F.col("_n")
        return flat.select(
            row_key, *keep, F.col("_e.idx").alias("idx"),
            F.col("_e.cnt").cast("bigint").alias("cnt"), tf.alias("tf"),
            F.col("_e.unit").alias("tfidf_l2"),
        ).join(
            hint_if_bounded(self.table.select("idx", "term", "idf"), self.top_n), "idx"
        ).withColumn("tfidf", F.col("tf") * F.col("idf"))

    def _entries_by_join(self, df, row_key, terms, keep):
        # What is computed from the list comes first; else each entry would carry the list.
        counted = df.select(row_key, *keep, F.size(terms).alias("_n"), F.xxhash64(terms).alias("_row_hash"),
                            value_counts(F.col(terms)).alias("_entries"))
        flat = unnest(counted, [row_key, *keep, "_n", "_row_hash"], "_entries", "_e").select(
            row_key, *keep, "_n", "_row_hash", F.col("_e.value").alias("term"),
            F.col("_e.n").cast("bigint").alias("cnt"),
        )
        known = flat.join(self.table.select("idx", "term", "idf"), "term").withColumn(
            "tf", F.col("cnt") / F.col("_n")
        ).withColumn("tfidf", F.col("tf") * F.col("idf"))
        # Rows that share key and terms are one group here, each term once per copy.
        row = Window.partitionBy(row_key, "_row_hash")
        copies = F.count(F.lit(1)).over(Window.partitionBy(row_key, "_row_hash", "idx"))
        counted = known.withColumn("_copies", copies)
        norm = F.sqrt(F.sum(F.pow("tfidf", F.lit(2.0)) / F.col("_copies")).over(row))
        return counted.withColumn("tfidf_l2", F.col("tfidf") / norm)


def bag_of_terms(df: DataFrame, row_key: str, terms: str, vocab: DataFrame, top_n: int) -> DataFrame:
    """``(row_key, idx, cnt)``: how often each vocabulary term occurs in a document.

    Terms are counted inside the row; the vocabulary, of at most ``top_n`` rows, is
    broadcast when that is small, and then nothing is shuffled.
    """
    flat = unnest(df, [row_key], value_counts(F.col(terms)), "_e").select(row_key, "_e.*")
    lookup = hint_if_bounded(vocab.select("idx", F.col("term").alias("value")), top_n)
    return flat.join(lookup, "value").select(
        row_key, "idx", F.col("n").cast("bigint").alias("cnt")
    )
