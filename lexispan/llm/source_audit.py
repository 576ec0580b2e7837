"""How the words of a source differ from those of the other sources of its language.

Rows of one language with the same text are collapsed to one text with its number of
rows per source.  Each text is taken apart into terms once, and its counts and document
frequencies are weighed by those numbers.  Divergences of pairs of sources are summed over
the terms that both have; where a source lacks a term, only the other's share matters, so
the numbers of terms with the same share replace its terms.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispan.llm.shared import forget, stored

MIN_DOCS = 10
TOP_TERMS = 10
#: Bytes of the keys and weights of copied texts that go to the tasks; more are joined by shuffle.
MAX_BROADCAST_BYTES = 32 << 20
#: Entries a task gathers before it hands them on.
GATHERED = 400_000
# In UTF-8 every byte from 0x80 on belongs to a term.
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def collapsed_texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source", max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(lang, text, weights array<struct<source, n>>)``: each text of a language once.

    Only digests (SHA-256) are shuffled to find equal texts.  A text with one row stays
    where it lies; of the others one row each is carried on.  Null text, language and
    source are the empty string.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = stored(
        rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("weights"), F.sum("n").alias("rows"))
        .filter("rows > 1").select("lang", "digest", "weights"), "copied-texts")
    names = F.aggregate("weights", F.lit(0), lambda n, w: n + F.octet_length(w["source"]) + 40)
    size = copies.agg(F.coalesce(F.sum(names + F.octet_length("lang") + 80), F.lit(0))).head()[0]
    found = rows.join(F.broadcast(copies) if size <= max_broadcast else copies, ["lang", "digest"], "left")
    single = F.array(F.struct("source", F.lit(1).cast("long").alias("n")))
    alone = found.filter("weights IS NULL").select("lang", "text", single.alias("weights"))
    several = found.filter("weights IS NOT NULL").groupBy("lang", "digest").agg(
        F.any_value("text").alias("text"), F.any_value("weights").alias("weights"))
    return alone.unionByName(several.select("lang", "text", "weights"))


def weighted_terms(texts: DataFrame) -> DataFrame:
    """``(lang, term, docs, sources, ns)`` of collapsed texts, summed within each task.

    A-Z of terms are lower-cased.  The arrays have the sources of the term with their
    counts; a task hands on what it has gathered before that grows without bound.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per language and source: the counts of terms, and the documents that have them.
        gathered: dict[str, dict[str, tuple[Counter, Counter]]] = defaultdict(lambda: defaultdict(lambda: (Counter(), Counter())))
        size = 0
        for batch in batches:
            texts = batch["text"].cast(pa.large_string()).cast(pa.large_binary())
            for i, (lang, weights) in enumerate(zip(batch["lang"].to_pylist(), batch["weights"].to_pylist(), strict=True)):
                words = _TERM.findall(texts[i].as_py().lower())
                distinct = set(words)
                if len(weights) > 1 or weights[0]["n"] > 1:
                    counts = Counter(words)
                for weight in weights:
                    counted, docs = gathered[lang][weight["source"]]
                    before = len(docs)
                    if (times := weight["n"]) == 1:
                        counted.update(words)
                        docs.update(distinct)
                    else:
                        counted.update({term: n * times for term, n in counts.items()})
                        docs.update(dict.fromkeys(distinct, times))
                    size += len(docs) - before
                if size > GATHERED:
                    yield from handed_on(gathered)
                    gathered.clear()
                    size = 0
        yield from handed_on(gathered)

    return texts.mapInArrow(run, "lang string, term string, docs long, sources array<string>, ns array<long>")


def handed_on(gathered: dict[str, dict[str, tuple[Counter, Counter]]]) -> Iterator[pa.RecordBatch]:
    """The gathered numbers with the sources of a term side by side."""
    for lang, sources in gathered.items():
        own = [(source, *both) for source, both in sources.items() if both[0]]
        if not own:
            continue
        terms = pa.chunked_array([pa.array(counted.keys(), pa.binary()) for _, counted, _ in own]).combine_chunks().dictionary_encode()
        code = terms.indices.to_numpy()
        ns = np.concatenate([np.fromiter(counted.values(), np.int64, len(counted)) for _, counted, _ in own])
        docs = np.concatenate([np.fromiter(map(docs.__getitem__, counted), np.int64, len(counted)) for _, counted, docs in own])
        source = np.repeat(np.arange(len(own)), [len(counted) for _, counted, _ in own])
        order = np.argsort(code, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(code))])
        in_docs = np.add.reduceat(docs[order], bounds[:-1])
        names = pa.DictionaryArray.from_arrays(pa.array(source[order]), pa.array([s for s, _, _ in own], pa.string()))
        offsets, words = pa.array(bounds, pa.int32()), terms.dictionary.cast(pa.string())
        whole = pa.record_batch({
            "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(words), np.int64))), "term": words,
            "docs": pa.array(in_docs), "sources": pa.ListArray.from_arrays(offsets, names.cast(pa.string())),
            "ns": pa.ListArray.from_arrays(offsets, pa.array(ns[order]))})
        for k in range(0, len(words), 1 << 14):
            yield whole.slice(k, 1 << 14)


def kept_terms(parts: DataFrame, min_docs: int) -> DataFrame:
    """``(lang, term, own array<struct<source, n>>, n)`` of the terms in at least ``min_docs`` rows.

    One shuffle, by language and term, serves both sums.
    """
    entry = F.arrays_zip("sources", "ns")
    single = parts.repartition("lang", "term").select(
        "lang", "term", "docs", F.posexplode(entry).alias("k", "entry")).select(
        "lang", "term", F.col("entry.sources").alias("source"), F.col("entry.ns").alias("n"),
        F.when(F.col("k") == 0, F.col("docs")).otherwise(0).alias("docs"))
    # An array has one entry per source that has the term.
    return single.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).groupBy(
        "lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("own"), F.sum("n").alias("n"),
                            F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 (count + 2) / (total + 2 terms))`` in whole numbers."""
    exact = "decimal(38,0)"
    return F.lit(1).cast("long") + F.call_function(
        "div", (count.cast("decimal(27,0)") + F.lit(2).cast("decimal(1,0)")).cast("decimal(28,0)")
        * F.lit(10**9).cast("decimal(10,0)"),
        (total.cast("decimal(27,0)") + terms.cast("decimal(27,0)") * F.lit(2).cast("decimal(1,0)")).cast(exact))


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))`` in whole numbers."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: other sources and telling terms of each source.

    A language keeps the terms that stand in at least ``min_docs`` of its rows.  Part
    ``pair`` has each other source of the language with the divergence summed over all
    kept terms, 0 where none is kept.  Part ``term`` has the ``top_terms`` kept terms of
    the source whose share is above that in the language and furthest from it.  Ranks
    count from 1, larger values first, ties by the bytes of the item.  Null text, language
    and source are the empty string; repeated rows count as often as they stand there;
    groups without terms have pairs; no rows give no rows.  Other columns are not read.
    """
    groups = stored(docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"))]).distinct(), "groups")
    counted = weighted_terms(collapsed_texts(docs, text_col, lang_col, source_col, max_broadcast))
    kept = stored(kept_terms(counted, min_docs), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    totals = kept.select("lang", F.inline("own")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per group: its total, its share of a term it lacks.
    sizes = stored(
        groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .fillna(0, ["terms", "lang_total", "total"])
        .withColumn("none", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms")))), "group-sizes")

    one, other = sizes.alias("one"), sizes.alias("other")
    pairs = one.join(other, (F.col("one.lang") == F.col("other.lang")) & (F.col("one.source") != F.col("other.source"))).select(
        F.col("one.lang").alias("lang"), F.col("one.source").alias("source"), F.col("other.source").alias("item"),
        F.col("one.terms").alias("terms"), F.col("one.none").alias("p0"), F.col("other.none").alias("q0"))

    own = kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("own")).join(sizes, ["lang", "source"]).select(
        "lang", "term", "source", "lang_n", "lang_total", "terms", "none",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    own = stored(own, "shares")
    # Terms that one source has: how often each share occurs.
    histogram = own.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    raised = F.col("times") * (divergence(F.col("p"), F.col("q0")) - divergence(F.col("p0"), F.col("q0")))
    one_sided = stored(pairs.join(histogram, ["lang", "source"]).groupBy("lang", "source", "item").agg(
        F.sum(raised).alias("value")), "one-sided")
    # Terms that both have; a pair is met once, in the order of its names.
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    beside = own.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct(
        F.col("source").alias("item"), F.col("p").alias("q"), F.col("none").alias("q0")))).alias("own"))
    both = beside.select("lang", "own", F.posexplode("own").alias("k", "one")).select(
        "lang", F.col("one.item").alias("source"), F.col("one.q").alias("p"), F.col("one.q0").alias("p0"),
        F.inline(F.slice("own", F.col("k") + 2, F.size("own"))))
    mended = divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0)
    common = stored(both.groupBy("lang", "source", "item").agg(F.sum(mended).alias("value")), "common-terms")
    everywhere = pairs.select("lang", "source", "item", F.when(
        F.col("terms") > 0, F.col("terms") * divergence(p0, q0)).otherwise(0).alias("value"))

    def swapped(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    paired = everywhere.unionByName(one_sided).unionByName(swapped(one_sided)).unionByName(common).unionByName(
        swapped(common)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = paired.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    of_terms = own.select(
        "lang", "source", F.col("term").alias("item"), "p",
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")).filter("p > q")
    # Spark limits every partition to its best before the shuffle.
    telling = of_terms.select("lang", "source", "item", divergence(p, q).alias("value")).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    result = stored(ranked.select(*columns).unionByName(telling.select(*columns)), "divergence")
    forget(kept, sizes, groups, own, one_sided, common)
    return result
