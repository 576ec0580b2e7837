"""Queries over the news corpora: words, n-grams, TF-IDF, vectors, classifiers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.stopwords import ENGLISH_STOP_WORDS
from lexispan.functions.text import ngram_range, ngrams, parse_list, words
from lexispan.operators import features, models, pooling, sampling
from lexispan.operators.context_tags import fit_tag_lists, tag_in_context
from lexispan.operators.heavy_terms import top_vocabulary
from lexispan.operators.joint_fits import LinearModel, Svm, fit_jointly
from lexispan.operators.lookup import changed_lemmas, drop_tokens, tagged_ngrams, tokens_by
from lexispan.operators.metrics import binary_report, to_classes, to_signs
from lexispan.operators.ranking import top_per_group
from lexispan.operators.unnest import unnest
from lexispan.plans import inputs, sql
from lexispan.session import keep
from lexispan.sources.scratch import new_path, stored, stored_by_batches
from lexispan.streaming.word_counts import count_new_files, current_counts

TOP_WORDS = 100
NGRAM_TERMS = 5000
SVM_PENALTY = 0.01
SVM_GAP = 1e-4
TFIDF_TERMS = 100
REVIEW_TERMS = 1000


def _counts_by_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lemma_counts(features.term_counts(inputs.news_words(spark, sf_dir), "tokens", ["label"]))


def _lemma_counts(raw: DataFrame) -> DataFrame:
    """``(label, term, cnt)`` of lemmas from that of words.

    Words are counted first and lemmatised afterwards, so the lemma join sees
    distinct words only.  The lexicon is read off the same counts; keeping the
    total in it lets Spark reuse their shuffle.
    """
    lexicon = (
        raw.groupBy("term").agg(F.sum("cnt").alias("total")).filter("total > 0")
        .select(F.col("term").alias("word"))
    )
    changing = inputs.own_lemmas(lexicon).select(F.col("token").alias("term"), "lemma")
    return raw.join(changing, "term", "left").groupBy(
        "label", F.coalesce("lemma", "term").alias("term")
    ).agg(F.sum("cnt").alias("cnt"))


def top_words_per_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_words(_counts_by_corpus(spark, sf_dir))


def top_words_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream: two deliveries of files, the second after a restart from the state."""
    source, state = new_path(spark, "deliveries"), new_path(spark, "word-counts")
    docs = inputs.documents(spark, sf_dir, "doc_id", "text")
    halves = (F.col("doc_id") % 3 == 0).alias("first")
    for first in (True, False):
        docs.filter(halves if first else ~F.coalesce(halves, F.lit(False))).write.mode("append").parquet(source)
        count_new_files(spark, source, "doc_id bigint, text string", state, inputs.words_of_news, files_per_batch=4)
    return _top_words(_lemma_counts(current_counts(spark, state)))


def _top_words(counts: DataFrame) -> DataFrame:
    top = top_per_group(counts, ["label"], [F.desc("cnt"), F.col("term")], TOP_WORDS)
    return top.select("label", "rank", F.col("term").alias("word"), "cnt")


def top_words_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts_by_corpus(spark, sf_dir).groupBy("term").agg(F.sum("cnt").alias("cnt"))
    return features.top_terms(counts, TOP_WORDS).select(F.col("term").alias("word"), "cnt")


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.news_tokens(spark, sf_dir).select(
        "doc_id", F.array_join("tokens", " ").alias("clean_text")
    )


def clean_text_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``clean_text``, by the join that a large dictionary takes."""
    tokens = inputs.with_lemmas(keep(inputs.news_words(spark, sf_dir)), max_dictionary_rows=0)
    return tokens.select("doc_id", F.array_join("tokens", " ").alias("clean_text"))


def stored_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words stored as the text of a list and read back."""
    stored = inputs.news_words(spark, sf_dir).select("doc_id", F.to_json("tokens").alias("list"))
    return stored.select("doc_id", F.array_join(parse_list(F.col("list")), " ").alias("words"))


def stop_words_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words without those of a stop-word table."""
    stops = spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "word string")
    docs = inputs.news(spark, sf_dir).select("doc_id", words(F.col("text")).alias("tokens"))
    kept = drop_tokens(docs, "doc_id", "tokens", stops, "kept")
    return kept.select("doc_id", F.array_join("kept", " ").alias("words"))


def stop_words_by_table_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the join that a large table takes."""
    stops = spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "word string")
    docs = inputs.news(spark, sf_dir).select("doc_id", words(F.col("text")).alias("tokens"))
    kept = drop_tokens(docs, "doc_id", "tokens", stops, "kept", 0)
    return kept.select("doc_id", F.array_join("kept", " ").alias("words"))


def own_tokeniser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a function given by the caller: what lies between bars and blanks."""
    docs = inputs.news(spark, sf_dir).select("doc_id", "text")
    return tokens_by(docs, "text", lambda: re.compile(r"[^ |\n]+").findall, "tokens").select(
        "doc_id", F.size("tokens").alias("n"), F.array_join("tokens", "|").alias("tokens")
    )


def lemma_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas when a sixteenth of the words have an irregular form, the word less its last letter."""
    lexicon = unnest(inputs.news_words(spark, sf_dir), [], "tokens", "word").distinct()
    irregular = lexicon.filter((F.substring(F.md5("word"), 1, 1) == "0") & (F.length("word") > 1)).select(
        "word", F.substring("word", F.lit(1), F.length("word") - 1).alias("lemma")
    )
    tokens = lexicon.select(F.col("word").alias("token"))
    return tokens.join(changed_lemmas(tokens, lexicon, irregular), "token", "left").select(
        "token", F.coalesce("lemma", "token").alias("lemma")
    )


def lemma_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = unnest(inputs.news_words(spark, sf_dir), [], "tokens", "word").distinct()
    tokens = lexicon.select(F.col("word").alias("token"))
    return tokens.join(inputs.own_lemmas(lexicon), "token", "left").select(
        "token", F.coalesce("lemma", "token").alias("lemma")
    )


def _vocabulary(tokens: DataFrame, terms, top_n: int) -> DataFrame:
    return features.vocabulary(tokens.select(terms.alias("terms")), "terms", top_n)


def bigram_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _kept_tokens(spark, sf_dir)
    return _vocabulary(tokens, ngrams(F.col("tokens"), 2), NGRAM_TERMS)


def trigram_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _kept_tokens(spark, sf_dir)
    return _vocabulary(tokens, ngrams(F.col("tokens"), 3), NGRAM_TERMS)


def trigram_vocab_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``trigram_vocab``, from bounded counters of each task and an exact count of what they leave open."""
    tokens = _kept_tokens(spark, sf_dir).select(ngrams(F.col("tokens"), 3).alias("terms"))
    return top_vocabulary(tokens, "terms", NGRAM_TERMS)


def ngram_range_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _kept_tokens(spark, sf_dir)
    return _vocabulary(tokens, ngram_range(F.col("tokens"), 1, 3), REVIEW_TERMS)


def pos_bigram_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stored(inputs.news(spark, sf_dir).select("doc_id", words(F.col("text")).alias("tokens")), "words")
    tagged = stored_by_batches(tagged_ngrams(
        docs, "doc_id", "tokens", inputs.tag_lexicon(docs), "terms",
        stop_words=tuple(ENGLISH_STOP_WORDS),
    ).select("terms"), "tagged")
    return features.vocabulary(tagged, "terms", NGRAM_TERMS)


def tags_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every sentence by a bigram model learnt from tags that depend on the word before."""
    pieces = inputs.documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.posexplode(F.split("text", "[.!?]+")).alias("sentence", "piece"))
    rows = stored(pieces.select(
        "doc_id", "sentence", F.concat_ws(":", "doc_id", "sentence").alias("key"), words(F.col("piece")).alias("tokens"),
    ).filter(F.size("tokens") > 0), "sentences")

    def tag(token, i):
        before = F.when(i > 0, F.get("tokens", i - 1)).otherwise("")
        digit = F.substring(F.md5(F.concat_ws(" ", before, token)), 1, 1)
        return F.when(digit < "6", "NN").when(digit < "a", "JJ").otherwise("VB")

    model = fit_tag_lists(rows.select("key", "tokens", F.transform("tokens", tag).alias("tags")), "key", "tokens", "tags")
    return stored_by_batches(tag_in_context(rows, "key", "tokens", model, "tags").select(
        "doc_id", "sentence", F.size("tokens").alias("n"), F.array_join("tags", " ").alias("tags")), "tagged")


def bag_of_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = _kept_tokens(spark, sf_dir).select(
        "doc_id", ngrams(F.col("tokens"), 2).alias("terms")
    )
    vocab = features.vocabulary(grams, "terms", NGRAM_TERMS)
    return features.bag_of_terms(grams, "doc_id", "terms", vocab, NGRAM_TERMS)


def _kept_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned words, stored for queries that read them several times; executors hold none of them."""
    return stored_by_batches(inputs.news_tokens(spark, sf_dir), "tokens")


def _tfidf_entries(spark: SparkSession, sf_dir: str, max_listed: int = TFIDF_TERMS) -> DataFrame:
    tokens = _kept_tokens(spark, sf_dir)
    model = features.TfidfModel.fit(tokens, "tokens", TFIDF_TERMS, max_listed)
    return model.entries(tokens, "doc_id", "tokens")


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tfidf_entries(spark, sf_dir).select(
        "doc_id", "term", "cnt", F.round("tf", 6).alias("tf")
    )


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _kept_tokens(spark, sf_dir)
    return features.fitted_vocabulary(tokens, "tokens", TFIDF_TERMS).select(
        "idx", "term", "cnt", "df", F.round("idf", 6).alias("idf")
    )


def _tfidf_columns(entries: DataFrame) -> DataFrame:
    return entries.select(
        "doc_id", "idx", F.round("tfidf", 6).alias("tfidf"),
        F.round("tfidf_l2", 6).alias("tfidf_l2"),
    )


def tfidf_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tfidf_columns(_tfidf_entries(spark, sf_dir))


def tfidf_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``tfidf_l2``, by the join that a large vocabulary takes."""
    return _tfidf_columns(_tfidf_entries(spark, sf_dir, max_listed=0))


def tfidf_fit_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary and frequencies from the 80 % split, applied to both parts."""
    tokens = _kept_tokens(spark, sf_dir)
    rows = sampling.train_rows_80_20(tokens.count())
    split = sampling.split_exact(tokens, "doc_id", rows, inputs.SEED)
    model = features.TfidfModel.fit(split.filter("split = 'train'"), "tokens", REVIEW_TERMS)
    return model.entries(split, "doc_id", "tokens", ["split"]).select(
        "doc_id", "split", "idx", F.round("tfidf_l2", 6).alias("tfidf_l2")
    )


def _dimensions(pooled: DataFrame) -> DataFrame:
    return pooled.select("doc_id", F.posexplode_outer("features").alias("dim", "x")).select(
        "doc_id", "dim", (F.round("x", 6) + F.lit(0.0)).alias("x")
    )


def _pool(
    spark: SparkSession, sf_dir: str, how: str,
    max_matrix_bytes: int = pooling.MAX_MATRIX_BYTES,
) -> DataFrame:
    tokens = _kept_tokens(spark, sf_dir)
    embedding = pooling.WordVectors(
        inputs.embedding_table(spark, sf_dir, tokens), inputs.VECTOR_SIZE, max_matrix_bytes
    )
    if how == "weighted":
        model = features.TfidfModel.fit(tokens, "tokens", REVIEW_TERMS)
        pooled = pooling.pool_weighted(tokens, "doc_id", "tokens", embedding, model)
    else:
        pooled = pooling.pool_words(tokens, "doc_id", "tokens", embedding, how)
    return _dimensions(pooled)


def pool_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pool(spark, sf_dir, "mean")


def pool_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pool(spark, sf_dir, "max")


def pool_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pool(spark, sf_dir, "weighted")


def pool_mean_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``pool_mean``, by the join that a large embedding takes."""
    return _pool(spark, sf_dir, "mean", max_matrix_bytes=0)


def pool_tfidf_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``pool_tfidf``, by the join that a large embedding takes."""
    return _pool(spark, sf_dir, "weighted", max_matrix_bytes=0)


def svm_predict_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of a linear rule with weights that follow from the term index."""
    tokens = _kept_tokens(spark, sf_dir)
    model = features.TfidfModel.fit(tokens, "tokens", TFIDF_TERMS)
    vectors = model.vectors(tokens, "tokens", "features")
    weights = [((idx * 37) % 101 - 50) / 50 for idx in range(TFIDF_TERMS)]
    return models.decide(vectors, "features", weights, 0.05).select(
        "doc_id", (F.round("score", 6) + F.lit(0.0)).alias("score"), "sign",
        to_classes(F.col("sign")).alias("pred"),
    )


def _labelled_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test parts (70 : 30) of the two corpora, ``label`` 0 / 1."""
    tokens = _kept_tokens(spark, sf_dir).withColumn("label", to_classes(F.col("label")))
    rows = sampling.train_rows_70_30(tokens.count())
    split = sampling.split_exact(tokens, "doc_id", rows, inputs.SEED)
    return split.filter("split = 'train'"), split.filter("split = 'test'")


def svm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _labelled_split(spark, sf_dir)
    tfidf = features.TfidfModel.fit(train, "tokens", TFIDF_TERMS)
    model = fit_jointly({"svm": (tfidf.vectors(train, "tokens", "features"), Svm(SVM_PENALTY))})["svm"]
    scored = models.decided_classes(tfidf.vectors(test, "tokens", "features"), "features", model)
    return scored.select(
        "doc_id", to_signs(F.col("label")).alias("y"), to_signs(F.col("pred")).alias("pred"),
        F.round("margin", 6).alias("margin"),
    )


def logreg_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _labelled_split(spark, sf_dir)
    embedding = pooling.WordVectors(
        inputs.embedding_table(spark, sf_dir, train), inputs.VECTOR_SIZE
    )

    def vectors(df: DataFrame) -> DataFrame:
        pooled = pooling.pool_words(
            df, "doc_id", "tokens", embedding, "mean", keep=("label",)
        )
        return pooled.withColumn("features", array_to_vector("features"))

    model = models.fit_logistic(vectors(train))
    return model.transform(vectors(test)).select(
        "doc_id", F.col("label").alias("y"), F.col("pred").cast("int").alias("pred")
    )


def _report(model: LinearModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row per part: rows, and accuracy, precision, recall and F1 of the fitted model.

    With the objective it reached on the training rows and a proven lower bound of it.
    """
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    report = binary_report(models.decided_classes(both, "features", model), "label", "pred", ["part"])
    return report.select("part", "n", "accuracy", "precision", "recall", "f1",
                         F.lit(model.objective).alias("primal"), F.lit(model.bound).alias("dual"))


def _ngrams_of(split: tuple[DataFrame, DataFrame], terms) -> tuple[DataFrame, DataFrame]:
    return tuple(part.select("doc_id", "label", terms.alias("terms")) for part in split)


def _count_vectors(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    counts = features.TfidfModel.fit(train, "terms", NGRAM_TERMS)
    return tuple(counts.counts(part, "terms", "features").select("doc_id", "label", "features") for part in (train, test))


def _ngram_svm(spark: SparkSession, sf_dir: str, terms) -> DataFrame:
    return _count_svm(*_ngrams_of(_labelled_split(spark, sf_dir), terms))


def _count_svm(train: DataFrame, test: DataFrame) -> DataFrame:
    train, test = _count_vectors(train, test)
    return _report(fit_jointly({"svm": (train, Svm(SVM_PENALTY))})["svm"], train, test)


def svm_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four feature sets learnt at once: rows, and whether each is proven to be at its optimum.

    The objective is computed again from the weights and the rows, apart from the fit.
    """
    split = _labelled_split(spark, sf_dir)
    train = split[0]
    tfidf = features.TfidfModel.fit(train, "tokens", TFIDF_TERMS)
    tables = {"tfidf": tfidf.vectors(train, "tokens", "features").select("doc_id", "label", "features")}
    for n, name in ((2, "bigram"), (3, "trigram")):
        tables[name], _ = _count_vectors(*_ngrams_of(split, ngrams(F.col("tokens"), n)))
    tables["pos_bigram"], _ = _count_vectors(*_tagged_split(spark, sf_dir))
    learnt = fit_jointly({name: (table, Svm(SVM_PENALTY)) for name, table in tables.items()}, tolerance=SVM_GAP)
    parts = []
    for name, table in tables.items():
        model = learnt[name]
        primal = models.hinge_value(table, "features", "label", model.weights.tolist(), model.bias, SVM_PENALTY)
        proven = abs(primal - model.objective) < 1e-9 and model.bound <= primal <= model.bound + SVM_GAP
        parts.append(table.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_up")).select(
            F.lit(name).alias("model"), "n_rows", "n_up", F.lit(proven).alias("at_optimum")))
    return reduce(DataFrame.unionByName, parts)


def svm_bigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram counts, linear SVM, 70 : 30: how well the corpora are told apart."""
    return _ngram_svm(spark, sf_dir, ngrams(F.col("tokens"), 2))


def svm_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ngram_svm(spark, sf_dir, ngrams(F.col("tokens"), 3))


def svm_pos_bigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with bigrams of nouns and adjectives, not lemmatised."""
    return _count_svm(*_tagged_split(spark, sf_dir))


def _tagged_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = stored(inputs.news(spark, sf_dir).select(
        "doc_id", to_classes(F.col("label")).alias("label"), words(F.col("text")).alias("tokens")
    ), "words")
    tagged = stored_by_batches(tagged_ngrams(
        docs, "doc_id", "tokens", inputs.tag_lexicon(docs), "terms",
        stop_words=tuple(ENGLISH_STOP_WORDS),
    ).select("doc_id", "label", "terms"), "tagged")
    rows = sampling.train_rows_70_30(tagged.count())
    split = sampling.split_exact(tagged, "doc_id", rows, inputs.SEED)
    return split.filter("split = 'train'"), split.filter("split = 'test'")


def svm_known_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An SVM on one feature of -1 and 1 that agrees with four fifths of the labels.

    Its optimum is weight 1 and bias 0, which decides by the feature.
    """
    x = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(-1.0)
    right = (F.col("doc_id") / 2).cast("long") % 5 != 0
    rows = inputs.documents(spark, sf_dir, "doc_id").select(
        "doc_id", F.when(right == (x > 0), 1).otherwise(0).alias("label"),
        array_to_vector(F.array(x)).alias("features"),
    )
    scored = models.fit_svm(rows, penalty=0.001).transform(rows)
    margin = F.get(vector_to_array("margin"), F.lit(1))
    return scored.select(
        "doc_id", F.col("pred").cast("int").alias("pred"), F.round(margin, 1).alias("margin")
    )


def logreg_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpenalised logistic regression on one 0 / 1 feature: the share of each group."""
    labels = inputs.predictions(spark, sf_dir).select(
        (F.col("doc_id") % 3 == 0).cast("int").alias("x"), F.col("y").alias("label")
    ).withColumn("features", array_to_vector(F.array(F.col("x").cast("double"))))
    model = models.fit_logistic(labels, inverse_penalty=1e9)
    share = F.get(vector_to_array("probability"), F.lit(1))
    return model.transform(labels).groupBy("x").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max(share), 3).alias("share")
    )


QUERIES = {f.__name__: f for f in [
    top_words_per_corpus, top_words_all, clean_text, lemma_map, bigram_vocab, trigram_vocab,
    ngram_range_vocab, pos_bigram_vocab, bag_of_bigrams, term_frequency, idf, tfidf_l2,
    tfidf_fit_transform, pool_mean, pool_max, pool_tfidf, svm_predict_fixed_weights,
    stop_words_by_table, stop_words_by_table_joined, own_tokeniser, lemma_exceptions,
    svm_fit, logreg_fit, clean_text_joined, stored_list, tfidf_joined, pool_mean_joined,
    pool_tfidf_joined, svm_bigram, svm_trigram, svm_pos_bigram, svm_known_optimum,
    logreg_closed_form, svm_certificates, trigram_vocab_bounded, top_words_streamed, tags_in_context,
]}

_COUNTS = f"""WITH {sql.CLEAN},
counts AS (
  SELECT label, term, count(*) AS cnt
  FROM (SELECT label, unnest(tokens) AS term FROM clean) GROUP BY label, term)"""

_TAGGED = f"""WITH {sql.NEWS},
flat AS (
  SELECT doc_id, unnest(all_words) AS w, generate_subscripts(all_words, 1) AS i FROM news),
kept AS (
  SELECT doc_id, i, w || '/' || CASE WHEN left(md5(w), 1) < '6' THEN 'NN' ELSE 'JJ' END AS t
  FROM flat WHERE left(md5(w), 1) < 'a' AND w NOT IN ({sql.STOP_LIST})),
paired AS (
  SELECT t || '_' || lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS term FROM kept),
listed AS (SELECT [term] AS terms FROM paired WHERE term IS NOT NULL)"""

_SPLIT_80 = """
split AS (
  SELECT doc_id, label, tokens,
         CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                   <= (SELECT count(*) - ceil(count(*) * 2 / 10) FROM clean)
              THEN 'train' ELSE 'test' END AS split
  FROM clean),
train AS (SELECT * FROM split WHERE split = 'train')"""


def _pool_sql(how: str) -> str:
    flat = """
flat_dims AS (
  SELECT doc_id, n, weight, d - 1 AS dim, CAST(vec[d] AS DOUBLE) AS x
  FROM (SELECT *, unnest(range(1, len(vec) + 1)) AS d FROM known))"""
    grid = """
grid AS (
  SELECT doc_id, unnest(range((SELECT max(len(embedding)) FROM embeddings))) AS dim
  FROM clean)"""
    value = {
        "mean": "sum(n * x) / sum(n)",
        "max": "max(x)",
        "weighted": "coalesce(sum(n * weight * x) / nullif(sum(n * weight), 0), "
                    "sum(n * x) / sum(n))",
    }[how]
    if how == "weighted":
        known = f"""{sql.tfidf('clean', 'clean', REVIEW_TERMS)},
known AS (
  SELECT doc_id, cnt AS n, tfidf_l2 AS weight, vec
  FROM entries JOIN embedding ON entries.term = embedding.word)"""
    else:
        known = """
known AS (
  SELECT doc_id, count(*) AS n, 1.0 AS weight, any_value(vec) AS vec
  FROM (SELECT doc_id, unnest(tokens) AS word FROM clean) t
  JOIN embedding ON t.word = embedding.word GROUP BY doc_id, t.word)"""
    return f"""WITH {sql.CLEAN}, {sql.EMBEDDING}, {known}, {flat}, {grid}
SELECT g.doc_id, CAST(g.dim AS INTEGER) AS dim, round(coalesce(x, 0), 6) + 0.0 AS x
FROM grid g LEFT JOIN (
  SELECT doc_id, dim, {value} AS x FROM flat_dims GROUP BY doc_id, dim) p
  ON g.doc_id = p.doc_id AND g.dim = p.dim"""


def _vocab_sql(n_low: int, n_high: int, top_n: int) -> str:
    terms = " || ".join(sql.grams("tokens", n) for n in range(n_low, n_high + 1))
    return f"""WITH {sql.CLEAN}, {sql.vocabulary('clean', terms, top_n)}
SELECT idx, term, cnt FROM vocab"""


_TOP = f"""{_COUNTS}
SELECT label, CAST(rank AS INTEGER) AS rank, term AS word, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY cnt DESC, term) AS rank
  FROM counts) WHERE rank <= {TOP_WORDS}"""

ORACLES = {
    "top_words_per_corpus": _TOP,
    "top_words_streamed": _TOP,
    "top_words_all": f"""{_COUNTS}
SELECT term AS word, CAST(sum(cnt) AS BIGINT) AS cnt FROM counts
GROUP BY term ORDER BY cnt DESC, word LIMIT {TOP_WORDS}""",
    "clean_text": f"""WITH {sql.CLEAN}
SELECT doc_id, array_to_string(tokens, ' ') AS clean_text FROM clean""",
    "lemma_map": f"""WITH {sql.NEWS}, {sql.LEMMAS}
SELECT word AS token, lemma FROM lemmas""",
    "bigram_vocab": _vocab_sql(2, 2, NGRAM_TERMS),
    "trigram_vocab": _vocab_sql(3, 3, NGRAM_TERMS),
    "tags_in_context": f"""WITH RECURSIVE pieces AS (
  SELECT doc_id, unnest(string_split_regex(text, '[.!?]+')) AS text,
         unnest(range(len(string_split_regex(text, '[.!?]+')))) AS sentence
  FROM documents WHERE text IS NOT NULL),
sentences AS (SELECT doc_id, sentence, {sql.ALL_WORDS} AS ws FROM pieces),
flat AS (SELECT doc_id, sentence, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM sentences),
digits AS (
  SELECT *, left(md5(coalesce(lag(w) OVER (PARTITION BY doc_id, sentence ORDER BY i), '') || ' ' || w), 1) AS d FROM flat),
tagged AS (SELECT *, CASE WHEN d < '6' THEN 'NN' WHEN d < 'a' THEN 'JJ' ELSE 'VB' END AS tag FROM digits),
followed AS (
  SELECT tag, coalesce(lag(tag) OVER (PARTITION BY doc_id, sentence ORDER BY i), '') AS prev FROM tagged),
tags AS (SELECT tag, count(*) AS n FROM tagged GROUP BY tag),
moves AS (
  SELECT p.prev, t.tag, CAST(round(1000 * ln((any_value(p.n) + (SELECT count(*) FROM tags)) / (count(f.tag) + 1))) AS BIGINT) AS c
  FROM (SELECT prev, count(*) AS n FROM followed GROUP BY prev) p CROSS JOIN tags t
  LEFT JOIN followed f ON f.prev = p.prev AND f.tag = t.tag GROUP BY p.prev, t.tag),
seen AS (SELECT w, tag, count(*) AS n FROM tagged GROUP BY w, tag),
emit AS (
  SELECT k.w, t.tag, CAST(round(1000 * ln((t.n + (SELECT count(DISTINCT w) FROM seen)) / (coalesce(s.n, 0) + 1))) AS BIGINT) AS c
  FROM (SELECT DISTINCT w FROM seen) k CROSS JOIN tags t LEFT JOIN seen s ON s.w = k.w AND s.tag = t.tag),
paths AS (
  SELECT f.doc_id, f.sentence, CAST(1 AS BIGINT) AS i, e.tag, m.c + e.c AS cost, e.tag AS path
  FROM flat f JOIN emit e ON e.w = f.w JOIN moves m ON m.prev = '' AND m.tag = e.tag WHERE f.i = 1
  UNION ALL
  SELECT doc_id, sentence, i, tag, best.cost + c, best.path || ' ' || tag FROM (
    SELECT p.doc_id, p.sentence, CAST(p.i + 1 AS BIGINT) AS i, e.tag, any_value(e.c) AS c,
           min({{'cost': p.cost + m.c, 'tag': p.tag, 'path': p.path}}) AS best
    FROM paths p JOIN flat f ON f.doc_id = p.doc_id AND f.sentence = p.sentence AND f.i = p.i + 1
    JOIN emit e ON e.w = f.w JOIN moves m ON m.prev = p.tag AND m.tag = e.tag
    GROUP BY p.doc_id, p.sentence, p.i, e.tag))
SELECT p.doc_id, CAST(p.sentence AS INTEGER) AS sentence, CAST(any_value(len(s.ws)) AS INTEGER) AS n,
       min({{'cost': cost, 'tag': tag, 'path': path}}).path AS tags
FROM paths p JOIN sentences s ON s.doc_id = p.doc_id AND s.sentence = p.sentence AND p.i = len(s.ws)
GROUP BY p.doc_id, p.sentence""",
    "trigram_vocab_bounded": _vocab_sql(3, 3, NGRAM_TERMS),
    "ngram_range_vocab": _vocab_sql(1, 3, REVIEW_TERMS),
    "pos_bigram_vocab": f"""{_TAGGED}, {sql.vocabulary('listed', 'terms', NGRAM_TERMS)}
SELECT idx, term, cnt FROM vocab""",
    "bag_of_bigrams": f"""WITH {sql.CLEAN},
grams AS (SELECT doc_id, {sql.grams('tokens', 2)} AS terms FROM clean),
{sql.vocabulary('grams', 'terms', NGRAM_TERMS)}
SELECT doc_id, idx, count(*) AS cnt
FROM (SELECT doc_id, unnest(terms) AS term FROM grams) g JOIN vocab v ON g.term = v.term
GROUP BY doc_id, idx""",
    "term_frequency": f"""WITH {sql.CLEAN}, {sql.tfidf('clean', 'clean', TFIDF_TERMS)}
SELECT doc_id, term, cnt, round(tf, 6) AS tf FROM entries""",
    "idf": f"""WITH {sql.CLEAN}, {sql.tfidf('clean', 'clean', TFIDF_TERMS)}
SELECT idx, term, cnt, df, round(idf, 6) AS idf FROM idf""",
    "tfidf_l2": f"""WITH {sql.CLEAN}, {sql.tfidf('clean', 'clean', TFIDF_TERMS)}
SELECT doc_id, idx, round(tfidf, 6) AS tfidf, round(tfidf_l2, 6) AS tfidf_l2 FROM entries""",
    "tfidf_fit_transform": f"""WITH {sql.CLEAN}, {_SPLIT_80},
{sql.tfidf('train', 'split', REVIEW_TERMS)}
SELECT e.doc_id, s.split, e.idx, round(e.tfidf_l2, 6) AS tfidf_l2
FROM entries e JOIN split s ON e.doc_id = s.doc_id""",
    "pool_mean": _pool_sql("mean"),
    "pool_max": _pool_sql("max"),
    "pool_tfidf": _pool_sql("weighted"),
    "stop_words_by_table": f"""WITH {sql.NEWS}
SELECT doc_id, array_to_string(tokens, ' ') AS words FROM words""",
    "own_tokeniser": r"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ |\n]'), lambda x: x <> '') AS t
      FROM documents WHERE text IS NOT NULL)""",
    "lemma_exceptions": f"""WITH {sql.NEWS}, {sql.LEMMAS},
irregular AS (
  SELECT word, left(word, length(word) - 1) AS lemma FROM lexicon
  WHERE left(md5(word), 1) = '0' AND length(word) > 1),
chosen AS (
  SELECT word, min({{'n': length(lemma), 'lemma': lemma}}).lemma AS lemma
  FROM (SELECT * FROM irregular UNION ALL SELECT word, word FROM irregular)
  WHERE lemma IN (SELECT word FROM lexicon) GROUP BY word)
SELECT l.word AS token, coalesce(c.lemma, l.lemma) AS lemma
FROM lemmas l LEFT JOIN chosen c ON l.word = c.word""",
    "stored_list": f"""WITH {sql.NEWS}
SELECT doc_id, array_to_string(tokens, ' ') AS words FROM words""",
    "svm_certificates": """WITH n AS (
  SELECT CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS label, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT * FROM n WHERE r <= (SELECT CAST(trunc(CAST(0.7 AS DOUBLE) * count(*)) AS BIGINT) FROM n))
SELECT unnest(['tfidf', 'bigram', 'trigram', 'pos_bigram']) AS model, n_rows, n_up, true AS at_optimum
FROM (SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_up FROM t)""",
    "svm_known_optimum": """
SELECT doc_id, CAST(doc_id % 2 = 0 AS INTEGER) AS pred,
       CASE WHEN doc_id % 2 = 0 THEN 1.0 ELSE -1.0 END AS margin
FROM documents""",
    "logreg_closed_form": """
SELECT CAST(doc_id % 3 = 0 AS INTEGER) AS x, count(*) AS n, round(avg(quality), 3) AS share
FROM labels GROUP BY ALL""",
    "svm_predict_fixed_weights": f"""WITH {sql.CLEAN},
{sql.tfidf('clean', 'clean', TFIDF_TERMS)},
scored AS (
  SELECT c.doc_id, coalesce(sum(tfidf_l2 * (((idx * 37) % 101 - 50) / 50)), 0) + 0.05 AS score
  FROM clean c LEFT JOIN entries e ON c.doc_id = e.doc_id GROUP BY c.doc_id)
SELECT doc_id, round(score, 6) + 0.0 AS score, CAST(sign(score) AS INTEGER) AS sign,
       CASE WHEN score > 0 THEN 1 ELSE 0 END AS pred
FROM scored""",
}
ORACLES |= {
    "clean_text_joined": ORACLES["clean_text"],
    "stop_words_by_table_joined": ORACLES["stop_words_by_table"],
    "tfidf_joined": ORACLES["tfidf_l2"],
    "pool_mean_joined": ORACLES["pool_mean"],
    "pool_tfidf_joined": ORACLES["pool_tfidf"],
}
