"""Input tables of the registered queries, derived from the given tables.

Only integer arithmetic, ``md5`` and ``split`` are used, so the checking SQL can
repeat each derivation (``plans/sql.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import content_words, words
from lexispan.operators.lookup import MAX_DICTIONARY_ROWS, changed_lemmas, lemmatize
from lexispan.operators.qa_windows import eval_features
from lexispan.operators.unnest import unnest
from lexispan.sources.corpora import labelled_reviews
from lexispan.sources.tables import scan

SEED = 42
MAX_LENGTH = 384
STRIDE = 128


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    whole_texts = "text" in columns or not columns
    return scan(spark, f"{sf_dir}/documents.parquet", *columns, spread_by="doc_id" if whole_texts else None)


def news_label() -> Column:
    """-1 for the one corpus, 1 for the other."""
    return F.when(F.col("doc_id") % 2 == 0, -1).otherwise(1)


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, label)``: two corpora in one table."""
    docs = documents(spark, sf_dir, "doc_id", "text").filter(F.col("text").isNotNull())
    return docs.withColumn("label", news_label())


def words_of_news(docs: DataFrame) -> DataFrame:
    """``(doc_id, label, tokens)`` of documents, row by row: words without stop words, not yet lemmatised."""
    return docs.filter(F.col("text").isNotNull()).select(
        "doc_id", news_label().alias("label"), content_words(F.col("text")).alias("tokens"))


def news_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_of_news(documents(spark, sf_dir, "doc_id", "text"))


def own_lemmas(lexicon: DataFrame) -> DataFrame:
    """Changed lemmas of a corpus vocabulary ``(word)`` that is its own lexicon."""
    return changed_lemmas(lexicon.select(F.col("word").alias("token")), lexicon)


def with_lemmas(df: DataFrame, max_dictionary_rows: int = MAX_DICTIONARY_ROWS) -> DataFrame:
    """Lemmatise ``tokens`` of ``(doc_id, .., tokens)``; the lexicon is its distinct words."""
    lexicon = unnest(df, [], "tokens", "word").distinct()
    return lemmatize(
        df, "doc_id", "tokens", own_lemmas(lexicon), "tokens", max_dictionary_rows
    )


def news_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, tokens)``: the cleaned words of every document."""
    return with_lemmas(news_words(spark, sf_dir))


def tag_lexicon(docs: DataFrame) -> DataFrame:
    """``(token, tag)`` for all distinct words of ``docs(.., tokens)``."""
    distinct = unnest(docs, [], "tokens", "token").distinct()
    digit = F.substring(F.md5("token"), 1, 1)
    tag = F.when(digit < "6", "NN").when(digit < "a", "JJ").otherwise("VB")
    return distinct.select("token", tag.alias("tag"))


VECTOR_SIZE = 64


def embedding_table(spark: SparkSession, sf_dir: str, tokens: DataFrame) -> DataFrame:
    """``(word, vec)`` for seven eighths of the corpus's words, chosen by hash; 64 numbers.

    The rest are words that the embedding does not know.
    """
    distinct = unnest(tokens, [], "tokens", "word").distinct()
    vectors = scan(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding")
    total = vectors.count()
    number = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint")
    known = distinct.filter(F.substring(F.md5("word"), 9, 1) < "e").select(
        "word", (number % total).alias("vec_id")
    )
    return known.join(vectors, "vec_id").select("word", F.col("embedding").alias("vec"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, Score, Text)`` with scores 1, 3, 4 and 5."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = scan(spark, f"{sf_dir}/labels.parquet", "doc_id", "quality", "toxic")
    score = (
        F.when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 4).otherwise(5))
        .when(F.col("doc_id") % 3 == 0, 3).otherwise(1)
    )
    return docs.join(labels, "doc_id").select(
        "doc_id", score.alias("Score"), F.col("text").alias("Text")
    )


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with their binary ``label``, the neutral ones left out."""
    return labelled_reviews(reviews(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, y, pred)``: quality as truth, absence of toxicity as prediction."""
    labels = scan(spark, f"{sf_dir}/labels.parquet", "doc_id", "quality", "toxic")
    return labels.select(
        "doc_id", F.col("quality").alias("y"), (1 - F.col("toxic")).alias("pred")
    )


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, doc_id, y, pred)`` of four rules on the same rows."""
    models = {
        "not_toxic": F.col("pred"),
        "perfect": F.col("y"),
        "never": F.lit(0),
        "by_id": (F.col("doc_id") % 2).cast("int"),
    }
    entries = F.array(*[
        F.struct(F.lit(name).alias("model"), rule.alias("pred"))
        for name, rule in models.items()
    ])
    return predictions(spark, sf_dir).select("doc_id", "y", F.inline(entries)).select(
        "model", "doc_id", "y", "pred"
    )


def qa_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, has, ws, at, n, text, source)`` of labelled documents.

    Answers are ``n`` words, 60 at most, from word ``at`` on, anywhere in the text.
    """
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    labels = scan(spark, f"{sf_dir}/labels.parquet", "doc_id", "quality")
    split = docs.join(labels, "doc_id").select(
        "doc_id", (F.col("quality") == 1).alias("has"), F.split("text", " ").alias("ws"),
        "text", "source",
    )
    return split.withColumns({
        "at": ((F.col("doc_id") * 7919) % F.size("ws")).cast("int"),
        "n": (F.col("doc_id") % 60 + 1).cast("int"),
    })


def _words_from(first: Column, n: Column) -> Column:
    """``n`` words of the text from the 0-based word ``first`` on, joined by blanks."""
    return F.array_join(F.slice("ws", first + 1, n), " ")


def qa_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(qid, golds)``: two gold answers, a long one and its first half, or none."""
    first = _words_from(F.col("at"), F.col("n"))
    second = _words_from(F.col("at"), F.ceil(F.col("n") / 2).cast("int"))
    golds = F.when(F.col("has"), F.array(first, second)).otherwise(
        F.array().cast("array<string>")
    )
    return qa_source(spark, sf_dir).select(F.col("doc_id").alias("qid"), golds.alias("golds"))


def qa_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(qid, text)``: right, partly right, empty and missing predictions."""
    qid = F.col("doc_id")
    text = (
        F.when(qid % 5 == 0, "")
        .when(qid % 3 == 0, _words_from(F.col("at") + 1, F.col("n")))
        .otherwise(_words_from(F.col("at"), F.col("n")))
    )
    return qa_source(spark, sf_dir).filter(qid % 11 != 0).select(
        qid.alias("qid"), text.alias("text")
    )


def qa_na_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(qid, na_prob)`` with many ties and some values above 1."""
    labels = scan(spark, f"{sf_dir}/labels.parquet", "doc_id", "quality")
    shift = F.when(F.col("quality") == 1, 0).otherwise(40)
    value = ((F.col("doc_id") * 37) % 101 + shift) / F.lit(100).cast("double")
    return labels.select(F.col("doc_id").alias("qid"), value.alias("na_prob"))


def qa_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, title, question, context, answers)``; answers lie in any window or across two."""
    answer = _words_from(F.col("at"), F.col("n"))
    start = F.length(_words_from(F.lit(0), F.col("at"))) + F.when(F.col("at") > 0, 1).otherwise(0)
    has = F.col("has") & (F.size("ws") > 5)
    answers = F.struct(
        F.when(has, F.array(answer)).otherwise(F.array().cast("array<string>")).alias("text"),
        F.when(has, F.array(start)).otherwise(F.array().cast("array<int>"))
        .alias("answer_start"),
    )
    title = F.when(F.col("doc_id") % 7 != 0, F.col("source"))
    return qa_source(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"), title.alias("title"),
        F.concat_ws(" ", F.slice("ws", 1, 7)).alias("question"),
        F.col("text").alias("context"), answers.alias("answers"),
    )


def window_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, question, context)`` for all documents."""
    return documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.concat_ws(" ", F.slice(F.split("text", " "), 1, 7)).alias("question"),
        F.col("text").alias("context"),
    )


def window_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation windows with one start and one end score per input position."""
    features = eval_features(
        window_examples(spark, sf_dir), "doc_id", max_length=MAX_LENGTH, stride=STRIDE
    ).withColumnRenamed("doc_id", "example_id")
    positions = F.sequence(F.lit(0), F.lit(MAX_LENGTH - 1))

    def scores(a: int, b: int, c: int, modulus: int) -> Column:
        return F.transform(positions, lambda i: (
            (F.col("example_id") * a + i * b + F.col("window_idx") * c) % modulus / 10.0
        ))

    return features.withColumns({
        "start_logits": scores(31, 17, 7, 101), "end_logits": scores(13, 29, 11, 103)
    })


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/conversations.parquet", "conv_id", "turn", "text")
